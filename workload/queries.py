"""The registered queries. Each reads whole tables and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from assay.functions import (
    clean_price,
    code_label,
    date_from_int,
    not_after,
    preferred_label,
    reconciled_amount,
    split_product_key,
    strip_text,
)
from assay.functions.labels import GENDERS, GENDERS_SPELLED_OUT, PRODUCT_LINES
from assay.operators import (
    latest_per_key,
    left_lookup,
    orphan_rows,
    with_surrogate_key,
    with_validity_end,
)
from assay.plans import gold, layers, silver
from assay.plans.names import BRONZE, DIM_CUSTOMERS, DIM_PRODUCTS, FACT_SALES, GOLD, SILVER, Names
from assay.quality import QualityGateError, QualityRunner, alerts, create_log, run_summary, truncate_log
from assay.session import new_path, remove
from assay.sources import SOURCE_SCHEMAS, create_schema, read_csv
from workload import exports
from workload.exports import customer_number, dealt_table, table

AS_OF = date(2000, 1, 1)
RUN = {
    "run_id": "run-1",
    "run_timestamp": datetime(2000, 1, 1, tzinfo=timezone.utc),
}
CHECK_COLUMNS = [
    "table_name",
    "check_name",
    "check_type",
    "status",
    "severity",
    "records_total",
    "records_failed",
    "failure_rate",
]

Query = Callable[[SparkSession, str], DataFrame]


def bronze_csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The sales export written as CSV files and read back with its schema."""
    path = new_path(spark, "sales-csv")
    exports.sales(spark, folder).write.option("header", True).csv(path)
    return read_csv(spark, path, SOURCE_SCHEMAS["crm_sales_details"])


LINES = StructType(
    [
        StructField("order_key", IntegerType()),
        StructField("line", IntegerType()),
        StructField("quantity", IntegerType()),
        StructField("price", IntegerType()),
        StructField("shipped", DateType()),
        StructField("flag", StringType()),
    ]
)


def bronze_dirty_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Files with their columns in two orders; amounts beyond the schema's types, and text in numbers.

    The columns come out as wide as their values need, each value under its own name, and what is no
    number at all is kept beside the row.
    """
    line, flag = F.col("l_linenumber"), F.col("l_returnflag")
    quantity = F.col("l_quantity").cast("bigint")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    lines = dealt_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        line.alias("line"),
        F.when(line == 7, (quantity + 3_000_000_000).cast("string"))
        .when(line == 5, F.lit("many"))
        .otherwise(quantity.cast("string"))
        .alias("quantity"),
        F.when(line == 6, F.lit("free, today"))
        .when(flag == "R", F.floor(price).cast("string"))
        .otherwise(price.cast("string"))
        .alias("price"),
        F.when(line == 4, F.lit("soon"))
        .otherwise(F.col("l_shipdate").cast("date").cast("string"))
        .alias("shipped"),
        flag.alias("flag"),
    )
    place, schema = new_path(spark, "dirty-csv"), trial_names().schema("bronze")
    tidy(spark, "dirty", schema)
    orders = {"plain": lines.columns, "turned": lines.columns[::-1]}
    for name, columns in orders.items():
        some = lines.where((flag == "R") == (name == "turned")).select(*columns)
        some.write.option("header", True).csv(f"{place}/landing/{name}")
    create_schema(spark, schema, f"{place}/bronze")
    source = layers.CsvSource(f"{place}/landing/*", f"{schema}.lines", LINES, "_malformed", "_rejected")
    layers.load_csv(spark, [source])
    remove(spark, f"{place}/landing")
    return spark.table(source.table).select(
        *LINES.names,
        F.col("_malformed").isNotNull().alias("malformed"),
        *(F.col("_rejected")[c].alias(f"{c}_rejected") for c in ("quantity", "price", "shipped")),
    )


def layers_reload(spark: SparkSession, folder: str) -> DataFrame:
    """Two full loads under names with a catalog: the second, from files in another column order,
    replaces the first, and the silver tables with it."""
    names = Names("spark_catalog", trial_names().prefix)
    place = new_path(spark, "reload")
    tidy(spark, "reload", *(names.schema(layer) for layer in (BRONZE, SILVER)))
    for layer in (BRONZE, SILVER):
        create_schema(spark, names.schema(layer), f"{place}/{layer}")
    file = "erp/LOC_A101.csv"
    rows = exports.locations(spark, folder)
    for turn in (rows.where("CNTRY IS NOT NULL"), rows.select("CNTRY", "CID")):
        turn.write.mode("overwrite").option("header", True).csv(f"{place}/landing/{file}")
        sources = layers.bronze_sources(f"{place}/landing", names)
        layers.load_csv(spark, [s for s in sources if s.path.endswith(file)])
        steps = layers.silver_transformations(names, AS_OF)
        layers.transform(spark, [s for s in steps if s.destination.endswith("erp_loc_a101")])
    remove(spark, f"{place}/landing")
    return spark.table(names.table(SILVER, "erp_loc_a101"))


def layers_end_to_end(spark: SparkSession, folder: str) -> DataFrame:
    """All six exports as CSV files, through bronze, silver and gold tables, to the written fact."""
    names = trial_names()
    tidy(spark, "layers", *(names.schema(layer) for layer in (BRONZE, SILVER, GOLD)))
    place = new_path(spark, "layers")
    landing = f"{place}/landing"
    for file, export in EXPORTS.items():
        df = export(spark, folder)
        df.write.option("header", True).csv(f"{landing}/{file}")
    layers.run_all(spark, landing, names, location=place, as_of=AS_OF)
    remove(spark, landing)
    return spark.table(names.table(GOLD, FACT_SALES))


def written(spark: SparkSession, folder: str, query: str, files: list[str], table_name: str) -> DataFrame:
    """A dimension as the layers write it, from the exports it needs as CSV files."""
    names = trial_names()
    tidy(spark, query, *(names.schema(layer) for layer in (BRONZE, SILVER, GOLD)))
    place = new_path(spark, query)
    for layer in (BRONZE, SILVER, GOLD):
        create_schema(spark, names.schema(layer), f"{place}/{layer}")
    landing = f"{place}/landing"
    for file in files:
        writer = EXPORTS[file](spark, folder).write.option("header", True)
        # blanks around a value belong to it
        writer = writer.option("ignoreLeadingWhiteSpace", False)
        writer.option("ignoreTrailingWhiteSpace", False).csv(f"{landing}/{file}")
    sources = [s for s in layers.bronze_sources(landing, names) if s.path.removeprefix(f"{landing}/") in files]
    layers.load_csv(spark, sources, at_once=3)
    loaded = {s.table.rpartition(".")[2] for s in sources}
    cleaned = layers.silver_transformations(names, AS_OF)
    layers.transform(spark, [s for s in cleaned if s.destination.rpartition(".")[2] in loaded], at_once=3)
    steps = {s.destination: s for s in layers.gold_transformations(names)}
    target = names.table(GOLD, table_name)
    layers.transform(spark, [steps[target]])
    remove(spark, landing)
    return spark.table(target)


def layers_dim_products(spark: SparkSession, folder: str) -> DataFrame:
    files = ["crm/prd_info.csv", "erp/PX_CAT_G1V2.csv"]
    return written(spark, folder, "written-products", files, DIM_PRODUCTS)


def layers_dim_customers(spark: SparkSession, folder: str) -> DataFrame:
    files = ["crm/cust_info.csv", "erp/CUST_AZ12.csv", "erp/LOC_A101.csv"]
    return written(spark, folder, "written-customers", files, DIM_CUSTOMERS)


def layers_sql_transform(spark: SparkSession, folder: str) -> DataFrame:
    """A transformation given as SQL text, run twice: the second load replaces the first."""
    schema = trial_names().schema("gold")
    tidy(spark, "sql", schema)
    create_schema(spark, schema, new_path(spark, "sql"))
    table(spark, folder, "orders").createOrReplaceTempView("orders_raw")
    step = layers.Transformation(
        f"{schema}.by_customer",
        "SELECT o_custkey, count(*) AS orders FROM orders_raw GROUP BY o_custkey",
    )
    layers.transform(spark, [step, step])
    return spark.table(step.destination)


_trials: dict[str, tuple[str, ...]] = {}


def tidy(spark: SparkSession, query: str, *schemas: str) -> None:
    """Drop the schemas of the query's last call; note those of this one."""
    for schema in _trials.pop(query, ()):
        spark.sql(f"DROP DATABASE IF EXISTS {schema} CASCADE")
    _trials[query] = schemas


def trial_names() -> Names:
    """Schemas of their own for one call."""
    return Names(prefix=f"trial_{uuid.uuid4().hex[:12]}_")


def silver_category_passthrough(spark: SparkSession, folder: str) -> DataFrame:
    return silver.product_categories(exports.categories(spark, folder))


def silver_date_key(spark: SparkSession, folder: str) -> DataFrame:
    raw = exports.spoiled_date(F.col("l_shipdate").cast("date"), F.col("l_quantity").cast("int"))
    spoiled = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", raw.alias("raw")
    )
    return spoiled.withColumn("day", date_from_int(F.col("raw")))


def silver_sales_repair(spark: SparkSession, folder: str) -> DataFrame:
    """On exact decimals: amounts wrong on some line numbers, prices on others."""
    line = F.col("l_linenumber")
    full = F.col("l_extendedprice").cast("decimal(12,2)")
    quantity = F.col("l_quantity").cast("int")
    right = (quantity * full).cast("decimal(18,2)")
    amount = (
        F.when(line == 1, None)
        .when(line == 2, -right)
        .when(line == 3, right + 1)
        .otherwise(right)
        .cast("decimal(18,2)")
    )
    price = F.when(line == 4, None).when(line == 5, -full).otherwise(full).cast("decimal(12,2)")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        reconciled_amount(amount, quantity, price).cast("decimal(18,2)").alias("amount"),
        clean_price(price, amount, quantity).cast("decimal(12,2)").alias("price"),
    )


def silver_product_key_split(spark: SparkSession, folder: str) -> DataFrame:
    parts = exports.products(spark, folder)
    category, product = split_product_key(F.col("prd_key"))
    return parts.select("prd_id", category.alias("cat_id"), product.alias("prd_key"))


def silver_code_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Product lines from order states, padded and in both cases."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    state = F.col("o_orderstatus")
    code = F.translate(state, "FOP", "MRX")
    code = F.when(urgent, F.concat(F.lit(" "), F.lower(code), F.lit("  "))).otherwise(code)
    return table(spark, folder, "orders").select(
        "o_orderkey", code_label(code, PRODUCT_LINES).alias("label")
    )


def silver_gender_label(spark: SparkSession, folder: str) -> DataFrame:
    """Both readings of written-out genders."""
    return exports.demographics(spark, folder).select(
        "CID",
        code_label(F.col("GEN"), GENDERS_SPELLED_OUT).alias("gender"),
        code_label(F.col("GEN"), GENDERS).alias("gender_strict"),
    )


def silver_country_standardise(spark: SparkSession, folder: str) -> DataFrame:
    return exports.locations(spark, folder).select(
        "CID", silver.country_name(F.col("CNTRY")).alias("country")
    )


def silver_future_date_null(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, folder, "orders").select(
        "o_orderkey", not_after(day, F.lit(AS_OF)).alias("day")
    )


def silver_id_clean(spark: SparkSession, folder: str) -> DataFrame:
    number = customer_number(F.col("c_custkey"))
    dashed = F.concat_ws("-", number, F.col("c_mktsegment"), F.col("c_name"))
    return table(spark, folder, "customer").select(
        "c_custkey",
        strip_text(F.concat(F.lit("NAS"), number), "NAS").alias("without_prefix"),
        strip_text(dashed, "-").alias("without_dashes"),
    )


def silver_latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    lines = dealt_table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").cast("date").alias("shipped"),
        "l_partkey",
        "l_suppkey",
    )
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], ["shipped"])


def silver_validity_interval(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("valid_from")
    )
    return with_validity_end(orders, ["o_custkey"], "valid_from", "valid_to", ["o_orderkey"])


def silver_validity_of_times(spark: SparkSession, folder: str) -> DataFrame:
    """Starts with a time of day, a NULL start, and a NULL key that has many rows."""
    later = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("event_id") % 86_400).cast("decimal(18,6)"))
    moment = F.col("ts") + later
    events = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") != "click", F.col("user_id")).alias("user_id"),
        F.when(F.col("event_id") % 97 != 0, moment).alias("valid_from"),
    )
    ended = with_validity_end(events, ["user_id"], "valid_from", "valid_to", ["event_id"])
    return ended.withColumn("valid_from", F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss"))


def silver_crm_sales_details(spark: SparkSession, folder: str) -> DataFrame:
    return silver.sales_details(exports.sales(spark, folder))


def silver_crm_prd_info(spark: SparkSession, folder: str) -> DataFrame:
    return silver.product_info(exports.products(spark, folder))


def silver_crm_cust_info(spark: SparkSession, folder: str) -> DataFrame:
    return silver.customer_info(exports.customers(spark, folder))


def silver_erp_cust_az12(spark: SparkSession, folder: str) -> DataFrame:
    return silver.customer_demographics(exports.demographics(spark, folder), AS_OF)


def silver_erp_loc_a101(spark: SparkSession, folder: str) -> DataFrame:
    return silver.customer_locations(exports.locations(spark, folder))


def gold_surrogate_key(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        F.col("o_orderdate").cast("date").alias("ordered"), "o_orderkey"
    )
    return with_surrogate_key(orders, "order_key", ["ordered", "o_orderkey"])


def gold_dim_products(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_products(
        silver_crm_prd_info(spark, folder), silver_category_passthrough(spark, folder)
    )


def gold_dim_customers(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_customers(
        silver_crm_cust_info(spark, folder),
        silver_erp_loc_a101(spark, folder),
        silver_erp_cust_az12(spark, folder),
    )


def gold_source_precedence(spark: SparkSession, folder: str) -> DataFrame:
    """A label from customers, or from the supplier of the same number where that is unknown."""
    segment = F.col("c_mktsegment")
    first = table(spark, folder, "customer").select(
        "c_custkey",
        F.when(segment == "BUILDING", "Female")
        .when(segment == "MACHINERY", "Male")
        .otherwise("n/a")
        .alias("first"),
    )
    balance = F.col("s_acctbal")
    second = table(spark, folder, "supplier").select(
        "s_suppkey",
        F.when(balance > 5000, "Female").when(balance > 1000, "Male").alias("second"),
    )
    return left_lookup(first, second, "c_custkey", "s_suppkey").select(
        "c_custkey", preferred_label(F.col("first"), F.col("second")).alias("gender")
    )


def gold_fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    return gold.fact_sales(
        silver_crm_sales_details(spark, folder),
        gold_dim_products(spark, folder),
        gold_dim_customers(spark, folder),
    )


def row_count_checks(spark: SparkSession, folder: str, runner: QualityRunner) -> None:
    orders = table(spark, folder, "orders")
    runner.check_row_count(orders, "orders", min_rows=1)
    runner.check_row_count(orders, "orders", min_rows=1_000_000_000, severity="HIGH")


def null_checks(spark: SparkSession, folder: str, runner: QualityRunner) -> None:
    declare_null_checks(silver_crm_sales_details(spark, folder), runner)


def declare_null_checks(sales: DataFrame, runner: QualityRunner) -> None:
    runner.check_nulls(
        sales, "crm_sales_details", ["sls_ord_num", "sls_order_dt", "sls_cust_id", "sls_price"]
    )
    runner.check_nulls(sales, "crm_sales_details", ["sls_order_dt"], 0.5, severity="HIGH")


def duplicate_checks(spark: SparkSession, folder: str, runner: QualityRunner) -> None:
    lineitem = dealt_table(spark, folder, "lineitem")
    runner.check_duplicates(lineitem, "lineitem", ["l_orderkey", "l_linenumber"])
    runner.check_duplicates(dealt_table(spark, folder, "orders"), "orders", ["o_orderkey"])


def value_set_checks(spark: SparkSession, folder: str, runner: QualityRunner) -> None:
    low = F.col("o_orderpriority") == "5-LOW"
    orders = table(spark, folder, "orders").select(
        F.when(~low, F.col("o_orderstatus")).alias("o_orderstatus"), "o_orderpriority"
    )
    runner.check_values_in_set(orders, "orders", "o_orderstatus", ["F", "O"])
    runner.check_values_in_set(orders, "orders", "o_orderstatus", ["F", "O", "P"])


def reference_checks(spark: SparkSession, folder: str, runner: QualityRunner) -> None:
    documents, labels = (table(spark, folder, t) for t in ("documents", "labels"))
    runner.check_referential_integrity(documents, "documents", "doc_id", labels, "doc_id")
    sales = exports.sales(spark, folder)
    customer = table(spark, folder, "customer")
    runner.check_referential_integrity(
        sales, "crm_sales_details", "sls_cust_id", customer, "c_custkey"
    )
    lineitem, part = (table(spark, folder, t) for t in ("lineitem", "part"))
    runner.check_referential_integrity(lineitem, "lineitem", "l_partkey", part, "p_partkey")


ALL_CHECKS = [row_count_checks, null_checks, duplicate_checks, value_set_checks, reference_checks]


def report(spark: SparkSession, folder: str, *declare) -> DataFrame:
    runner = QualityRunner(spark, "silver", **RUN)
    for checks in declare:
        checks(spark, folder, runner)
    return runner.report()


def dq_row_count(spark: SparkSession, folder: str) -> DataFrame:
    return report(spark, folder, row_count_checks).select(*CHECK_COLUMNS, "details")


def dq_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return null_report(report(spark, folder, null_checks))


def null_report(entries: DataFrame) -> DataFrame:
    def detail(name: str):
        return F.get_json_object("details", f"$.{name}")

    return entries.select(
        *CHECK_COLUMNS,
        detail("column").alias("column_name"),
        detail("null_rate").cast("double").alias("null_rate"),
        detail("threshold").cast("double").alias("threshold"),
    )


def dq_checked_write(spark: SparkSession, folder: str) -> DataFrame:
    """The null checks, counted as the rows are written, and committed twice by runs of one id."""
    audit = trial_names().schema("audit")
    tidy(spark, "checked", audit)
    create_schema(spark, audit, new_path(spark, "checked"))
    step = layers.Transformation(
        f"{audit}.sales",
        lambda _: silver_crm_sales_details(spark, folder),
        lambda runner, sales: declare_null_checks(sales, runner),
    )
    for _ in range(2):  # the second as after a driver that was lost once the first was saved
        runner = QualityRunner(spark, "silver", **RUN, log_table=f"{audit}.quality_log")
        layers.transform(spark, [step], runner=runner)
        runner.commit(raise_on_critical=False)
    return null_report(spark.table(f"{audit}.quality_log"))


def dq_raising_commit(spark: SparkSession, folder: str) -> DataFrame:
    """The log of a commit that raised: its entries were saved before."""
    audit = trial_names().schema("audit")
    tidy(spark, "raising", audit)
    create_schema(spark, audit, new_path(spark, "raising"))
    log = f"{audit}.quality_log"
    runner = QualityRunner(spark, "silver", **RUN, log_table=log)
    null_checks(spark, folder, runner)
    try:
        runner.commit()
    except QualityGateError:
        return null_report(spark.table(log))
    raise RuntimeError("the gate let critical failures pass")


def dq_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return report(spark, folder, duplicate_checks).select(*CHECK_COLUMNS, "details")


def dq_value_set(spark: SparkSession, folder: str) -> DataFrame:
    return report(spark, folder, value_set_checks).select(*CHECK_COLUMNS, "details")


def dq_ref_integrity(spark: SparkSession, folder: str) -> DataFrame:
    return report(spark, folder, reference_checks).select(*CHECK_COLUMNS, "details")


def dq_orphan_rows(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = (table(spark, folder, t) for t in ("documents", "labels"))
    return orphan_rows(documents, "doc_id", labels, "doc_id").select("doc_id", "lang", "source")


def dq_audit_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log table after two runs committed to it."""
    audit = trial_names().schema("audit")
    tidy(spark, "audit", audit)
    create_schema(spark, audit, new_path(spark, "audit"))
    log = f"{audit}.quality_log"
    for layer in ("bronze", "silver"):
        runner = QualityRunner(spark, layer, **RUN, log_table=log)
        row_count_checks(spark, folder, runner)
        value_set_checks(spark, folder, runner)
        runner.commit(raise_on_critical=False)
    return spark.table(log).select(
        "run_id", run_second(), "layer", "pipeline_run_id", *CHECK_COLUMNS, "details"
    )


def dq_truncated_log(spark: SparkSession, folder: str) -> DataFrame:
    """A run committed to the log, the log emptied, and another run committed."""
    audit = trial_names().schema("audit")
    tidy(spark, "truncated", audit)
    create_schema(spark, audit, new_path(spark, "audit"))
    log = f"{audit}.quality_log"
    for layer in ("bronze", "silver"):
        runner = QualityRunner(spark, layer, **RUN, log_table=log)
        value_set_checks(spark, folder, runner)
        create_log(spark, log)
        truncate_log(spark, log)
        runner.commit(raise_on_critical=False)
    return spark.table(log).select("run_id", "layer", "pipeline_run_id", *CHECK_COLUMNS, "details")


def dq_run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return run_summary(report(spark, folder, *ALL_CHECKS))


def dq_alerts(spark: SparkSession, folder: str) -> DataFrame:
    found = alerts(report(spark, folder, *ALL_CHECKS))
    # the details of null checks hold a double, whose text differs between engines
    details = F.when(~F.startswith("check_name", F.lit("null_check")), F.col("details"))
    return found.withColumns({"details": details, "run_timestamp": run_second()})


def run_second():
    """The run's time as a number, which reads alike in every time zone."""
    return F.unix_seconds("run_timestamp").alias("run_timestamp")


EXPORTS = {
    "crm/cust_info.csv": exports.customers,
    "crm/prd_info.csv": exports.products,
    "crm/sales_details.csv": exports.sales,
    "erp/CUST_AZ12.csv": exports.demographics,
    "erp/LOC_A101.csv": exports.locations,
    "erp/PX_CAT_G1V2.csv": exports.categories,
}

QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        layers_end_to_end,
        layers_sql_transform,
        layers_reload,
        layers_dim_products,
        layers_dim_customers,
        bronze_csv_scan,
        bronze_dirty_csv,
        silver_category_passthrough,
        silver_date_key,
        silver_sales_repair,
        silver_product_key_split,
        silver_code_labels,
        silver_gender_label,
        silver_country_standardise,
        silver_future_date_null,
        silver_id_clean,
        silver_latest_per_key,
        silver_validity_interval,
        silver_validity_of_times,
        silver_crm_sales_details,
        silver_crm_prd_info,
        silver_crm_cust_info,
        silver_erp_cust_az12,
        silver_erp_loc_a101,
        gold_surrogate_key,
        gold_dim_products,
        gold_dim_customers,
        gold_source_precedence,
        gold_fact_sales,
        dq_row_count,
        dq_nulls,
        dq_checked_write,
        dq_raising_commit,
        dq_duplicates,
        dq_value_set,
        dq_ref_integrity,
        dq_orphan_rows,
        dq_audit_log,
        dq_truncated_log,
        dq_run_summary,
        dq_alerts,
    )
}
