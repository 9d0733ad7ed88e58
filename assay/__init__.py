"""Bronze, silver and gold tables for sales data, and the checks that guard them."""
