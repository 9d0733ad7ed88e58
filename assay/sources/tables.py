"""Catalog tables as sinks. Reading one is ``spark.table(name)``.

The format is a parameter. A table format with transactions overwrites in place. With others every
load writes a table of its own, in a folder of its own, and the name is a view of it: replacing the
view is one call to the catalog. A load that fails at any point leaves the old rows under the name,
no reader finds the name missing, and since nothing is ever written to where a reader looks, other
sessions need not refresh. The load before the present one is kept for readers still at work.
"""

from __future__ import annotations

import logging
import re
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from assay.session import remove

DEFAULT_FORMAT = "parquet"
# Formats whose overwrite is a transaction.
TRANSACTIONAL = {"delta", "hudi", "iceberg", "paimon"}
SESSION_CATALOG = "spark_catalog"

# Properties of the view: the table it shows, and the one it showed before.
SHOWN, BEFORE = "assay.version", "assay.before"
NOTE = "assay.note."
VERSION = "__v"

logger = logging.getLogger(__name__)


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a schema if absent, in the warehouse or at ``location``."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def overwrite_table(
    df: DataFrame,
    table: str,
    table_format: str = DEFAULT_FORMAT,
    partition_by: Sequence[str] = (),
    revise: Callable[[], DataFrame | None] | None = None,
    notes: Callable[[], Mapping[str, str]] | None = None,
) -> None:
    """Full load: replace the table's rows and schema. A load that fails leaves the old ones.

    ``revise`` is called once the rows are written, before anyone sees them, and may return others to
    load in their place. ``notes`` is called after that, and what it returns can be read with ``note``
    as long as these rows stand under the name. One load of a name may run at a time. Names have one, two or three parts.
    """
    spark = df.sparkSession
    if in_place(spark, table, table_format):
        _writer(df, table_format, partition_by).saveAsTable(table)
        if revise is not None and (other := revise()) is not None:
            _writer(other, table_format, partition_by).saveAsTable(table)
        if notes is not None:
            listed = ", ".join(f"'{NOTE}{key}' = '{_quoted(v)}'" for key, v in notes().items())
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")
        return
    version = _load(df, table, table_format, partition_by)
    if revise is not None:
        try:
            other = revise()
        except Exception:
            _drop_version(spark, version)
            raise
        if other is not None:
            _drop_version(spark, version)
            version = _load(other, table, table_format, partition_by)
    try:
        before = _show(spark, table, version, notes() if notes is not None else {})
    except Exception:
        _drop_version(spark, version)
        raise
    _forget(spark, table, before)


def in_place(spark: SparkSession, table: str, table_format: str) -> bool:
    """Whether an overwrite is one transaction of the table's format or catalog."""
    parts = table.split(".")
    catalog = parts[0] if len(parts) > 2 else spark.catalog.currentCatalog()
    return table_format.lower() in TRANSACTIONAL or catalog.lower() != SESSION_CATALOG


def append_rows(df: DataFrame, table: str) -> None:
    """Append to an existing table, matching columns by name and keeping format and partitions."""
    spark = df.sparkSession
    columns = spark.table(table).columns
    df.select(*columns).write.mode("append").insertInto(shown_version(spark, table) or table)


def truncate(spark: SparkSession, table: str) -> None:
    version = shown_version(spark, table)
    if version is None:
        spark.sql(f"TRUNCATE TABLE {table}")
    else:  # Spark truncates no table with a folder of its own choice
        nothing = spark.createDataFrame([], spark.table(version).schema)
        nothing.write.insertInto(version, overwrite=True)


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop the name and all that its loads left; nothing happens if it does not exist."""
    if _kind(spark, table) not in ("", "VIEW"):
        spark.sql(f"DROP TABLE {table}")
    spark.sql(f"DROP VIEW IF EXISTS {table}")
    for version in _versions(spark, table):
        _drop_version(spark, version)


def shown_version(spark: SparkSession, table: str) -> str | None:
    """The table that holds the rows under a name; None if the name itself is that table."""
    return _properties(spark, table).get(SHOWN)


def note(spark: SparkSession, table: str, key: str) -> str | None:
    """What the present load of a table noted under a key; None if nothing."""
    return _properties(spark, table).get(NOTE + key)


def _writer(df: DataFrame, table_format: str, partition_by: Sequence[str]):
    writer = df.write.mode("overwrite").format(table_format)
    return writer.partitionBy(*partition_by) if partition_by else writer


def _load(df: DataFrame, table: str, table_format: str, partition_by: Sequence[str]) -> str:
    """Write the rows to a table of their own, and return its name."""
    spark = df.sparkSession
    schema, name = _split(spark, table)
    # names in the order of their loads
    version = f"{name}{VERSION}{time.time_ns():020d}_{uuid.uuid4().hex[:8]}".lower()
    # a plain table of this name has its files in the folder that loads would share
    folder = name if _kind(spark, table) in ("", "VIEW") else f"{name}_loads"
    place = spark.catalog.getDatabase(schema).locationUri.rstrip("/")
    full = f"{schema}.{version}"
    try:
        writer = _writer(df, table_format, partition_by)
        writer.option("path", f"{place}/{folder}/{version}").saveAsTable(full)
    except Exception:
        _drop_version(spark, full, f"{place}/{folder}/{version}")
        raise
    return full


def _show(spark: SparkSession, table: str, version: str, notes: Mapping[str, str]) -> str | None:
    """Make the name show a version, and return the one it showed."""
    if _kind(spark, table) not in ("", "VIEW"):
        return _replace_plain_table(spark, table, version, notes)
    before = shown_version(spark, table)
    _point(spark, table, version, before, notes)
    return before


def _point(
    spark: SparkSession, table: str, version: str, before: str | None, notes: Mapping[str, str]
) -> None:
    properties = {SHOWN: version, **({BEFORE: before} if before else {})}
    properties |= {NOTE + key: _quoted(value) for key, value in notes.items()}
    listed = ", ".join(f"'{key}' = '{value}'" for key, value in properties.items())
    spark.sql(
        f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({listed}) AS SELECT * FROM {version}"
    )


def _quoted(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def _replace_plain_table(
    spark: SparkSession, table: str, version: str, notes: Mapping[str, str]
) -> str:
    """The same once for a name that is a table made by other means, which steps aside.

    The catalog has no single call for this; if the second one fails the first is undone.
    """
    schema, name = _split(spark, table)
    aside = f"{schema}.{name}{VERSION}{0:020d}_{uuid.uuid4().hex[:8]}".lower()
    short = schema.removeprefix(f"{SESSION_CATALOG}.")  # a new name may have two parts at most
    target = f"{short}.{aside.rpartition('.')[2]}"
    spark.sql(f"ALTER TABLE {table} RENAME TO {target}")
    try:
        _point(spark, table, version, aside, notes)
    except Exception:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {short}.{name}")
        raise
    return aside


def _forget(spark: SparkSession, table: str, before: str | None) -> None:
    """Drop what is older than the load before this one, leftovers of broken loads too."""
    try:
        for version in _versions(spark, table):
            if before is not None and version.rpartition(".")[2] < before.lower().rpartition(".")[2]:
                _drop_version(spark, version)
    except Exception:  # the load itself has succeeded
        logger.warning("could not remove earlier loads of %s", table, exc_info=True)


def _versions(spark: SparkSession, table: str) -> list[str]:
    schema, name = _split(spark, table)
    listed = spark.sql(f"SHOW TABLES IN {schema} LIKE '{name}{VERSION}*'").collect()
    ours = re.compile(re.escape(f"{name}{VERSION}".lower()) + r"\d{20}_[0-9a-f]{8}")
    return sorted(f"{schema}.{r.tableName}".lower() for r in listed if ours.fullmatch(r.tableName.lower()))


def _drop_version(spark: SparkSession, version: str, place: str | None = None) -> None:
    if spark.catalog.tableExists(version):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {version}").where("col_name = 'Location'")
        place = rows.select("data_type").first()[0]
        spark.sql(f"DROP TABLE IF EXISTS {version}")
    if place is not None:
        remove(spark, place)


def _split(spark: SparkSession, table: str) -> tuple[str, str]:
    schema, _, name = table.rpartition(".")
    return schema or spark.catalog.currentDatabase(), name


def _kind(spark: SparkSession, table: str) -> str:
    """VIEW, MANAGED or EXTERNAL, or nothing if the name is free."""
    schema, name = _split(spark, table)
    full = f"{schema}.{name}"  # a temporary view of the same name does not count
    return spark.catalog.getTable(full).tableType if spark.catalog.tableExists(full) else ""


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    if not _kind(spark, table):
        return {}
    schema, name = _split(spark, table)
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {schema}.{name}").collect()}
