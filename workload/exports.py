"""The given tables turned into the six source exports, defects included.

The given tables are clean, so each export spoils some fields, depending on other columns of the same
row. No row is left out. ``workload/exports_sql.py`` states the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.sources.parquet_files import read_parquet


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def dealt_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same for work that starts with grouping, sorting or writing what one task has read."""
    return read_parquet(spark, f"{folder}/{name}.parquet")


def padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def date_int(day: Column) -> Column:
    return F.year(day) * 10_000 + F.month(day) * 100 + F.dayofmonth(day)


def product_number(part_key: Column) -> Column:
    """Three parts are versions of one product."""
    return F.concat(F.lit("FR-P"), padded(product_group(part_key), 9))


def product_group(part_key: Column) -> Column:
    return F.floor(part_key / 3)


def customer_number(customer_key: Column) -> Column:
    return F.concat(F.lit("AW"), padded(customer_key, 8))


def spoiled_date(day: Column, quantity: Column) -> Column:
    """yyyymmdd; zero, too short, or an impossible month for some quantities."""
    return (
        F.when(quantity == 13, 0)
        .when(quantity == 17, 5489)
        .when(quantity == 19, 20101399)
        .otherwise(date_int(day))
    )


def sales(spark: SparkSession, folder: str) -> DataFrame:
    # narrow before the join, which shuffles both sides; what can fail on a value waits for the join
    lineitem = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        "l_returnflag",
        F.floor(F.col("l_extendedprice") / 100).alias("l_hundreds"),
        (F.col("l_discount") > 0.08).alias("l_high_discount"),
        (F.col("l_discount") < 0.02).alias("l_low_discount"),
        (F.col("l_tax") > 0.07).alias("l_high_tax"),
        F.col("l_shipdate").cast("date").alias("l_shipped"),
    )
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("o_day")
    )
    line, quantity = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    price = F.col("l_hundreds").cast("int")
    amount = quantity * price
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    shipped = F.col("l_shipped")
    return joined.select(
        F.concat(F.lit("SO"), F.col("l_orderkey").cast("string")).alias("sls_ord_num"),
        F.when((line == 7) & (F.col("l_returnflag") == "R"), "ZZ-P0")
        .otherwise(product_number(F.col("l_partkey")))
        .alias("sls_prd_key"),
        F.when((line == 6) & (F.col("o_orderpriority") == "5-LOW"), None)
        .otherwise(F.col("o_custkey"))
        .cast("int")
        .alias("sls_cust_id"),
        spoiled_date(F.col("o_day"), quantity).alias("sls_order_dt"),
        spoiled_date(shipped, quantity + 10).alias("sls_ship_dt"),
        spoiled_date(F.date_add(shipped, 7), quantity - 10).alias("sls_due_dt"),
        F.when((line == 1) & (F.col("l_returnflag") == "A"), amount + 1)
        .when((line == 2) & (F.col("l_returnflag") == "N"), None)
        .when(line == 3, None)
        .when(line == 4, -amount)
        .when(line == 5, amount + 1)
        .otherwise(amount)
        .alias("sls_sales"),
        F.when((line == 1) & F.col("l_high_discount"), 0)
        .when((line <= 4) & F.col("l_low_discount"), None)
        .otherwise(quantity)
        .alias("sls_quantity"),
        F.when(line == 1, None)
        .when(line == 2, -price)
        .when((line >= 5) & F.col("l_high_tax"), 2_000_000_000)
        .otherwise(price)
        .alias("sls_price"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    group = product_group(F.col("p_partkey"))
    kind = F.col("p_type")
    start = F.date_add(F.lit("1995-01-01").cast("date"), F.col("p_size"))
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("int").alias("prd_id"),
        F.concat(
            F.lit("NA-"), padded(group % 30, 2), F.lit("-"), product_number(F.col("p_partkey"))
        ).alias("prd_key"),
        F.col("p_name").alias("prd_nm"),
        F.when(kind != "PROMO", F.floor("p_retailprice")).cast("int").alias("prd_cost"),
        F.when(kind == "ECONOMY", "R ")
        .when(kind == "LARGE", " m")
        .when(kind == "MEDIUM", "S")
        .when(kind == "SMALL", "t")
        .when(kind == "STANDARD", "")
        .alias("prd_line"),
        start.alias("prd_start_dt"),
        F.date_sub(start, 100).alias("prd_end_dt"),
    )


def categories(spark: SparkSession, folder: str) -> DataFrame:
    joined = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return joined.select(
        F.concat(F.lit("NA_"), padded(F.col("n_nationkey"), 2)).alias("ID"),
        F.col("r_name").alias("CAT"),
        F.col("n_name").alias("SUBCAT"),
        F.when(F.col("r_name") == "ASIA", "Yes").otherwise("No").alias("MAINTENANCE"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order: each order delivers its customer's data again."""
    joined = table(spark, folder, "orders").join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return joined.select(
        F.when((priority == "5-LOW") & (status == "P"), None)
        .otherwise(F.col("o_custkey"))
        .cast("int")
        .alias("cst_id"),
        customer_number(F.col("c_custkey")).alias("cst_key"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("cst_firstname"),
        F.concat(F.col("c_mktsegment"), F.lit(" ")).alias("cst_lastname"),
        F.when(status == "F", " m").when(status == "O", "s ").otherwise("X").alias(
            "cst_marital_status"
        ),
        F.when(priority == "1-URGENT", "m")
        .when(priority == "2-HIGH", " F ")
        .when(priority == "3-MEDIUM", None)
        .otherwise("")
        .alias("cst_gndr"),
        F.col("o_orderdate").cast("date").alias("cst_create_date"),
    )


def demographics(spark: SparkSession, folder: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    number = customer_number(F.col("c_custkey"))
    days = F.floor(F.col("c_acctbal") * 2).cast("int")
    return table(spark, folder, "customer").select(
        F.when(segment == "FURNITURE", F.concat(F.lit("NASXX"), number))
        .when(segment == "HOUSEHOLD", number)
        .otherwise(F.concat(F.lit("NAS"), number))
        .alias("CID"),
        F.date_add(F.lit("1950-01-01").cast("date"), days).alias("BDATE"),
        F.when(segment == "AUTOMOBILE", "M")
        .when(segment == "BUILDING", " f ")
        .when(segment == "FURNITURE", "Male")
        .when(segment == "HOUSEHOLD", "Female")
        .alias("GEN"),
    )


def locations(spark: SparkSession, folder: str) -> DataFrame:
    joined = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    nation = F.col("n_name")
    return joined.select(
        F.concat(F.lit("AW-"), padded(F.col("c_custkey"), 8)).alias("CID"),
        F.when(nation == "NATION_0", "DE")
        .when(nation == "NATION_1", "USA")
        .when(nation == "NATION_2", "US")
        .when(nation == "NATION_3", " DE ")
        .when(nation == "NATION_4", "")
        .when(nation == "NATION_5", "   ")
        .when(nation == "NATION_6", None)
        .when(nation == "NATION_7", "de")
        .otherwise(nation)
        .alias("CNTRY"),
    )
