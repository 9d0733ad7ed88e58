"""Table and file names. Fixed values."""

from __future__ import annotations

from dataclasses import dataclass

BRONZE = "bronze"
SILVER = "silver"
GOLD = "gold"

# File below the landing folder -> bronze table, in load order.
SOURCE_FILES = {
    "crm/cust_info.csv": "crm_cust_info",
    "crm/prd_info.csv": "crm_prd_info",
    "crm/sales_details.csv": "crm_sales_details",
    "erp/CUST_AZ12.csv": "erp_cust_az12",
    "erp/LOC_A101.csv": "erp_loc_a101",
    "erp/PX_CAT_G1V2.csv": "erp_px_cat_g1v2",
}

DIM_PRODUCTS = "dim_products"
DIM_CUSTOMERS = "dim_customers"
FACT_SALES = "fact_sales"

# Table -> the column by which the next layer looks it up.
LOOKUP_KEYS = {
    SILVER: {"erp_px_cat_g1v2": "ID", "erp_loc_a101": "CID", "erp_cust_az12": "CID"},
    GOLD: {DIM_PRODUCTS: "product_number", DIM_CUSTOMERS: "customer_id"},
}


@dataclass(frozen=True)
class Names:
    """Where the layers live: below a catalog if one is named, with a prefix for trial runs."""

    catalog: str | None = None
    prefix: str = ""

    def schema(self, layer: str) -> str:
        return ".".join(part for part in (self.catalog, self.prefix + layer) if part)

    def table(self, layer: str, table: str) -> str:
        return f"{self.schema(layer)}.{table}"
