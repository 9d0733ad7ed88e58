"""Code lists. The codes the two source systems use and the labels published."""

PRODUCT_LINES = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}

MARITAL_STATUSES = {"M": "Married", "S": "Single"}

GENDERS = {"M": "Male", "F": "Female"}

# The second system also spells genders out.
GENDERS_SPELLED_OUT = {**GENDERS, "MALE": "Male", "FEMALE": "Female"}

# Matched with case: any other country text passes through unchanged.
COUNTRIES = {"DE": "Germany", "USA": "United States", "US": "United States", "": "n/a"}
