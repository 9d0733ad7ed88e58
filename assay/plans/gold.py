"""Gold: two dimensions with surrogate keys, and the sales fact."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.functions import preferred_label
from assay.operators import left_lookup, with_surrogate_key

# What is known of hot keys, by the argument they are in; see ``left_lookup``.
HotNotes = Mapping[str, str | None]
NO_NOTES: HotNotes = {}


def dim_products(
    products: DataFrame,
    categories: DataFrame,
    end_column: str = "prd_end_dt",
    hot: HotNotes = NO_NOTES,
) -> DataFrame:
    """Current product versions with their category."""
    current = products.where(F.col(end_column).isNull())
    described = left_lookup(
        current, categories, "cat_id", "ID", hot_note=hot.get("categories")
    ).select(
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_number"),
        F.col("prd_nm").alias("product_name"),
        "cat_id",
        F.col("prd_line").alias("product_line"),
        F.col("CAT").alias("category"),
        F.col("SUBCAT").alias("subcategory"),
        F.col("MAINTENANCE").alias("maintenance"),
        F.col("prd_cost").alias("cost"),
        F.col("prd_start_dt").alias("start_date"),
    )
    return with_surrogate_key(
        described,
        "product_key",
        order_by=["product_number", "start_date"],
        tie_breakers=["product_id"],
    )


def dim_customers(
    customers: DataFrame,
    locations: DataFrame,
    demographics: DataFrame,
    hot: HotNotes = NO_NOTES,
) -> DataFrame:
    """Customers with country and birth date; the first system's gender wins where it has one."""
    countries = locations.select(F.col("CID").alias("_loc"), "CNTRY")
    persons = demographics.select(F.col("CID").alias("_az"), "BDATE", "GEN")
    located = left_lookup(
        customers, countries, "cst_key", "_loc", hot_note=hot.get("locations")
    )
    described = left_lookup(
        located, persons, "cst_key", "_az", hot_note=hot.get("demographics")
    ).select(
        F.col("cst_id").alias("customer_id"),
        F.col("cst_key").alias("customer_number"),
        F.col("cst_firstname").alias("first_name"),
        F.col("cst_lastname").alias("last_name"),
        F.col("cst_marital_status").alias("marital_status"),
        preferred_label(F.col("cst_gndr"), F.col("GEN")).alias("gender"),
        F.col("CNTRY").alias("country"),
        F.col("BDATE").alias("birth_date"),
        F.col("cst_create_date").alias("create_date"),
    )
    return with_surrogate_key(
        described,
        "customer_key",
        order_by=["customer_number", "create_date"],
        tie_breakers=["customer_id"],
    )


def fact_sales(
    sales: DataFrame, products: DataFrame, customers: DataFrame, hot: HotNotes = NO_NOTES
) -> DataFrame:
    """Sales with the current keys of both dimensions; a sale without a match keeps a NULL key."""
    product_keys = products.select("product_number", "product_key")
    customer_keys = customers.select("customer_id", "customer_key")
    keyed = left_lookup(
        sales, product_keys, "sls_prd_key", "product_number", hot_note=hot.get("products")
    )
    keyed = left_lookup(
        keyed, customer_keys, "sls_cust_id", "customer_id", hot_note=hot.get("customers")
    )
    return keyed.select(
        F.col("sls_ord_num").alias("order_number"),
        "product_key",
        "customer_key",
        F.col("sls_order_dt").alias("order_date"),
        F.col("sls_ship_dt").alias("shipping_date"),
        F.col("sls_due_dt").alias("due_date"),
        F.col("sls_sales").alias("sales_amount"),
        F.col("sls_quantity").alias("quantity"),
        F.col("sls_price").alias("price"),
    )
