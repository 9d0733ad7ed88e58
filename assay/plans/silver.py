"""Silver: one cleaning query per source table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.functions import (
    clean_price,
    code_label,
    date_from_int,
    not_after,
    reconciled_amount,
    split_product_key,
    strip_text,
)
from assay.functions.cleaning import UNKNOWN
from assay.functions.labels import (
    COUNTRIES,
    GENDERS,
    GENDERS_SPELLED_OUT,
    MARITAL_STATUSES,
    PRODUCT_LINES,
)
from assay.operators import latest_per_key, with_validity_end


def sales_details(raw: DataFrame) -> DataFrame:
    """Dates from integers; amount and price repaired from each other."""
    amount, quantity, price = (F.col(c) for c in ("sls_sales", "sls_quantity", "sls_price"))
    return raw.select(
        "sls_ord_num",
        "sls_prd_key",
        "sls_cust_id",
        *(date_from_int(F.col(c)).alias(c) for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")),
        reconciled_amount(amount, quantity, price).alias("sls_sales"),
        "sls_quantity",
        clean_price(price, amount, quantity).alias("sls_price"),
    )


def product_info(raw: DataFrame, end_column: str = "prd_end_dt") -> DataFrame:
    """Key split, line label, and validity ends derived from the next version of the raw key.

    The delivered end dates precede their starts, so they are dropped.
    """
    versions = with_validity_end(
        raw.drop("prd_end_dt"),
        keys=["prd_key"],
        start="prd_start_dt",
        end=end_column,
        tie_breakers=["prd_id"],
    )
    category, product = split_product_key(F.col("prd_key"))
    return versions.select(
        "prd_id",
        product.alias("prd_key"),
        category.alias("cat_id"),
        "prd_nm",
        "prd_cost",
        code_label(F.col("prd_line"), PRODUCT_LINES).alias("prd_line"),
        "prd_start_dt",
        end_column,
    )


def customer_info(raw: DataFrame) -> DataFrame:
    """The newest row per customer id, with names trimmed and codes spelled out."""
    return latest_per_key(raw, keys=["cst_id"], newest_by=["cst_create_date"]).select(
        "cst_id",
        "cst_key",
        F.trim("cst_firstname").alias("cst_firstname"),
        F.trim("cst_lastname").alias("cst_lastname"),
        code_label(F.col("cst_marital_status"), MARITAL_STATUSES).alias("cst_marital_status"),
        code_label(F.col("cst_gndr"), GENDERS).alias("cst_gndr"),
        "cst_create_date",
    )


def customer_demographics(
    raw: DataFrame, as_of: date | None = None, strict_codes: bool = False
) -> DataFrame:
    """Id prefix removed, future birth dates emptied, gender codes spelled out.

    ``strict_codes`` accepts one-letter codes only and reads written-out genders as unknown.
    """
    today = F.current_date() if as_of is None else F.lit(as_of)
    genders = GENDERS if strict_codes else GENDERS_SPELLED_OUT
    return raw.select(
        strip_text(F.col("CID"), "NAS").alias("CID"),
        not_after(F.col("BDATE"), today).alias("BDATE"),
        code_label(F.col("GEN"), genders).alias("GEN"),
    )


def customer_locations(raw: DataFrame) -> DataFrame:
    """Dashes removed from ids, country codes spelled out."""
    return raw.select(
        strip_text(F.col("CID"), "-").alias("CID"), country_name(F.col("CNTRY")).alias("CNTRY")
    )


def country_name(country: Column) -> Column:
    """Known codes spelled out, blank and NULL unknown, other text trimmed and kept."""
    as_given = F.coalesce(F.trim(country), F.lit(UNKNOWN))
    return code_label(country, COUNTRIES, default=as_given, fold_case=False)


def product_categories(raw: DataFrame) -> DataFrame:
    """Already clean."""
    return raw.select("ID", "CAT", "SUBCAT", "MAINTENANCE")
