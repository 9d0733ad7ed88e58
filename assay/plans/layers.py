"""Running the layers: CSV files to bronze, bronze to silver, silver to gold.

Each step is a full load and reads only what earlier steps wrote, so a failed run is simply repeated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assay.operators import hot_keys
from assay.plans import gold, silver
from assay.plans.names import (
    BRONZE,
    DIM_CUSTOMERS,
    DIM_PRODUCTS,
    FACT_SALES,
    GOLD,
    LOOKUP_KEYS,
    SILVER,
    SOURCE_FILES,
    Names,
)
from assay.quality import QualityRunner
from assay.quality.checks import CRITICAL
from assay.session import scratch, tune
from assay.sources import (
    SOURCE_SCHEMAS,
    create_schema,
    overwrite_table,
    read_csv,
    read_text,
    typed,
)
from assay.sources.csv_files import wider_types, widths
from assay.sources.tables import DEFAULT_FORMAT, in_place, note

CORRUPT_COLUMN = "_malformed"
HOT_NOTE = "hot."


@dataclass(frozen=True)
class CsvSource:
    """A CSV export and the table it fills; without a schema Spark infers one.

    With a schema, a column of whole numbers is widened if its values need it. ``corrupt_column`` keeps
    the whole of each line that holds a value the schema itself cannot take, and ``rejects_column`` what
    no type of its column could.
    """

    path: str
    table: str
    schema: StructType | None = None
    corrupt_column: str | None = None
    rejects_column: str | None = None


@dataclass(frozen=True)
class Transformation:
    """A table and the query that fills it: SQL text, or a function of the session.

    ``checks(runner, df)`` declares checks of the table's rows, if ``transform`` is given a runner. If
    others look the table up by ``lookup_key``, its most frequent values are noted as it is written.
    """

    destination: str
    query: str | Callable[[SparkSession], DataFrame]
    checks: Callable[[QualityRunner, DataFrame], Any] | None = None
    lookup_key: str | None = None


def bronze_sources(
    landing: str,
    names: Names = Names(),
    infer_schema: bool = False,
    corrupt_column: str | None = CORRUPT_COLUMN,
) -> list[CsvSource]:
    """The six exports below the folder ``landing``.

    The schemas are fixed, or inferred at the cost of a pass. A fixed one's whole numbers are widened
    where values need it, and a line with a value beyond the schema is kept whole in ``corrupt_column``
    of its bronze table; None leaves that column out.
    """
    return [
        CsvSource(
            f"{landing.rstrip('/')}/{file}",
            names.table(BRONZE, table),
            None if infer_schema else SOURCE_SCHEMAS[table],
            None if infer_schema else corrupt_column,
        )
        for file, table in SOURCE_FILES.items()
    ]


def silver_transformations(
    names: Names = Names(),
    as_of: date | None = None,
    strict_codes: bool = False,
    product_end_column: str = "prd_end_dt",
) -> list[Transformation]:
    def cleaned(table: str, clean: Callable[..., DataFrame], **options) -> Transformation:
        source = names.table(BRONZE, table)
        return Transformation(
            names.table(SILVER, table),
            lambda spark: clean(spark.table(source), **options),
            lookup_key=LOOKUP_KEYS[SILVER].get(table),
        )

    return [
        cleaned("crm_sales_details", silver.sales_details),
        cleaned("crm_prd_info", silver.product_info, end_column=product_end_column),
        cleaned("crm_cust_info", silver.customer_info),
        cleaned(
            "erp_cust_az12", silver.customer_demographics, as_of=as_of, strict_codes=strict_codes
        ),
        cleaned("erp_loc_a101", silver.customer_locations),
        cleaned("erp_px_cat_g1v2", silver.product_categories),
    ]


def gold_transformations(
    names: Names = Names(), product_end_column: str = "prd_end_dt"
) -> list[Transformation]:
    """Dimensions first: the fact reads them as written."""
    dim_products, dim_customers, fact = (
        names.table(GOLD, t) for t in (DIM_PRODUCTS, DIM_CUSTOMERS, FACT_SALES)
    )

    looked_up = {
        "categories": (names.table(SILVER, "erp_px_cat_g1v2"), "ID"),
        "locations": (names.table(SILVER, "erp_loc_a101"), "CID"),
        "demographics": (names.table(SILVER, "erp_cust_az12"), "CID"),
        "products": (dim_products, LOOKUP_KEYS[GOLD][DIM_PRODUCTS]),
        "customers": (dim_customers, LOOKUP_KEYS[GOLD][DIM_CUSTOMERS]),
    }

    def from_tables(build: Callable[..., DataFrame], *tables: str, **options):
        def query(spark: SparkSession) -> DataFrame:
            hot = {
                argument: note(spark, table, HOT_NOTE + key)
                for argument, (table, key) in looked_up.items()
                if table in tables
            }
            return build(*(spark.table(t) for t in tables), hot=hot, **options)

        return query

    def cleaned(table: str) -> str:
        return names.table(SILVER, table)

    return [
        Transformation(
            dim_products,
            from_tables(
                gold.dim_products,
                cleaned("crm_prd_info"),
                cleaned("erp_px_cat_g1v2"),
                end_column=product_end_column,
            ),
            lookup_key=LOOKUP_KEYS[GOLD][DIM_PRODUCTS],
        ),
        Transformation(
            dim_customers,
            from_tables(
                gold.dim_customers,
                cleaned("crm_cust_info"),
                cleaned("erp_loc_a101"),
                cleaned("erp_cust_az12"),
            ),
            lookup_key=LOOKUP_KEYS[GOLD][DIM_CUSTOMERS],
        ),
        Transformation(
            fact,
            from_tables(
                gold.fact_sales, cleaned("crm_sales_details"), dim_products, dim_customers
            ),
        ),
    ]


def load_csv(
    spark: SparkSession,
    sources: Iterable[CsvSource],
    table_format: str = DEFAULT_FORMAT,
    at_once: int = 1,
) -> None:
    """Load each file into its table, unchanged: in the given order, or several ``at_once``."""

    def load(source: CsvSource) -> None:
        _prepare(spark, source.table)
        if source.schema is None:
            overwrite_table(read_csv(spark, source.path), source.table, table_format)
        else:
            _load_typed(spark, source, table_format)

    _each(load, sources, at_once)


def _load_typed(spark: SparkSession, source: CsvSource, table_format: str) -> None:
    """Load with the schema's types, and again with wider ones if the first write met the need."""
    schema = source.schema
    text = read_text(spark, source.path, schema.names, source.corrupt_column)
    columns = {"corrupt_column": source.corrupt_column, "rejects_column": source.rejects_column}
    needed = widths(schema)
    if not needed:
        overwrite_table(typed(text, schema, **columns), source.table, table_format)
        return
    if in_place(spark, source.table, table_format):  # others would see a first write
        found = text.agg(*(need.alias(name) for name, need in needed.items())).first().asDict()
        types = wider_types(schema, found)
        overwrite_table(typed(text, schema, types, **columns), source.table, table_format)
        return
    seen = Observation(f"widths of {source.table}")
    observed = text.observe(seen, *(need.alias(name) for name, need in needed.items()))

    def wider() -> DataFrame | None:
        types = wider_types(schema, seen.get)
        return typed(text, schema, types, **columns) if types else None

    overwrite_table(typed(observed, schema, **columns), source.table, table_format, revise=wider)


def transform(
    spark: SparkSession,
    transformations: Iterable[Transformation],
    table_format: str = DEFAULT_FORMAT,
    at_once: int = 1,
    runner: QualityRunner | None = None,
) -> None:
    """Run each query and replace its destination.

    In the given order, so that one may read what an earlier one wrote; queries that do not read
    each other's tables may run several ``at_once``. With a ``runner``, a step's checks are declared on
    it, and its plain counts are taken from the rows as they are written.
    """

    def run(step: Transformation) -> None:
        _prepare(spark, step.destination)

        def write(df: DataFrame) -> None:
            key = step.lookup_key
            if key is None:
                overwrite_table(df, step.destination, table_format)
                return
            seen = Observation()
            noted = df.observe(seen, hot_keys.frequency_sketch(key).alias("keys"))
            overwrite_table(
                noted,
                step.destination,
                table_format,
                notes=lambda: {HOT_NOTE + key: hot_keys.to_note(seen.get["keys"])},
            )

        with scratch(spark):
            df = spark.sql(step.query) if isinstance(step.query, str) else step.query(spark)
            if runner is None or step.checks is None:
                write(df)
            else:
                written = partial(spark.table, step.destination)
                runner.check_while_writing(df, step.checks, write, written)

    _each(run, transformations, at_once)


def run_all(
    spark: SparkSession,
    landing: str,
    names: Names = Names(),
    location: str | None = None,
    table_format: str = DEFAULT_FORMAT,
    as_of: date | None = None,
    strict_codes: bool = False,
    product_end_column: str = "prd_end_dt",
    gate: Callable[[SparkSession, str], None] | None = None,
    at_once: int = 6,
    infer_schema: bool = False,
    corrupt_column: str | None = CORRUPT_COLUMN,
) -> None:
    """All three layers, below the folder ``location`` if given.

    The independent tables of a layer load ``at_once``: small ones then use cores that a large one
    leaves idle. ``gate(spark, layer)`` runs after each layer and stops the run by raising.
    """
    tune(spark)
    for layer in (BRONZE, SILVER, GOLD):
        folder = f"{location.rstrip('/')}/{layer}" if location else None
        create_schema(spark, names.schema(layer), folder)
    sources = bronze_sources(landing, names, infer_schema, corrupt_column)
    load_csv(spark, sources, table_format, at_once)
    _pass(gate, spark, BRONZE)
    cleaned = silver_transformations(names, as_of, strict_codes, product_end_column)
    transform(spark, cleaned, table_format, at_once)
    _pass(gate, spark, SILVER)
    *dimensions, fact = gold_transformations(names, product_end_column)
    transform(spark, dimensions, table_format, at_once)
    transform(spark, [fact], table_format)
    _pass(gate, spark, GOLD)


def check_lookup_keys(runner: QualityRunner, names: Names = Names()) -> QualityRunner:
    """Declare that the tables of the runner's layer hold each lookup key once.

    A second row with the same key would repeat the rows that look it up.
    """
    for table, key in LOOKUP_KEYS.get(runner.layer, {}).items():
        name = names.table(runner.layer, table)
        runner.check_duplicates(runner.spark.table(name), name, [key])
    return runner


def check_malformed(
    runner: QualityRunner, names: Names = Names(), corrupt_column: str = CORRUPT_COLUMN
) -> QualityRunner:
    """Declare that no bronze table holds a line its schema could not take, and count those that do."""
    for table in SOURCE_FILES.values():
        name = names.table(BRONZE, table)
        lines = runner.spark.table(name)
        if corrupt_column in lines.columns:
            kept = F.when(F.col(corrupt_column).isNull(), "well-formed").otherwise("malformed")
            lines = lines.select(kept.alias("line"))
            runner.check_values_in_set(lines, name, "line", ["well-formed"], CRITICAL)
    return runner


def _each(work: Callable[[Any], None], items: Iterable[Any], at_once: int) -> None:
    """Do ``work`` on each item; a failure is raised once the items under way are done."""
    if at_once == 1:
        for item in items:
            work(item)
        return
    with ThreadPoolExecutor(at_once) as pool:
        for done in [pool.submit(work, item) for item in items]:
            done.result()


def _pass(gate, spark: SparkSession, layer: str) -> None:
    if gate is not None:
        gate(spark, layer)


def _prepare(spark: SparkSession, table: str) -> None:
    schema, _, _ = table.rpartition(".")
    if schema:
        create_schema(spark, schema)
