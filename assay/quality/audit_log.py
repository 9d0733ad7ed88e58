"""The audit log table, and what is read from it."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assay.quality.checks import FAILED, PASSED
from assay.sources import tables
from assay.sources.schemas import AUDIT_LOG

LOG_TABLE = "audit.quality_log"
PARTITION = "layer"


def create_log(
    spark: SparkSession, table: str = LOG_TABLE, table_format: str = tables.DEFAULT_FORMAT
) -> None:
    """Create the log and its schema if absent, partitioned by layer."""
    if "." in table:
        tables.create_schema(spark, table.rpartition(".")[0])
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in AUDIT_LOG.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) "
        f"USING {table_format} PARTITIONED BY ({PARTITION})"
    )


def truncate_log(spark: SparkSession, table: str = LOG_TABLE) -> None:
    tables.truncate(spark, table)


# What names an entry of the log; a run may declare a check of the same name more than once.
ENTRY = ["run_id", "layer", "table_name", "check_name", "check_type", "severity"]


def entry_key(entry: Mapping[str, Any]) -> tuple:
    return tuple(entry[c] for c in ENTRY)


def unsaved(entries: DataFrame, log: DataFrame, saved: Mapping[tuple, int]) -> DataFrame:
    """The entries of one run and layer without as many of each name as the log has already.

    ``saved`` are those of them that belong to earlier commits of the same runner and so are no repeats.
    The log is read for this layer and run only.
    """
    spark = entries.sparkSession
    one_run = entries.select("run_id", "layer").distinct()
    run = one_run.first()
    there = log.where((F.col("layer") == run.layer) & (F.col("run_id") == run.run_id))
    own = spark.createDataFrame(
        [(*key, count) for key, count in saved.items()],
        ", ".join(f"{c} string" for c in ENTRY) + ", own long",
    )
    counted = (
        there.groupBy(*ENTRY)
        .agg(F.count(F.lit(1)).alias("held"))
        .join(own, ENTRY, "left")
        .select(*ENTRY, (F.col("held") - F.coalesce("own", F.lit(0))).alias("held"))
    )
    turn = F.row_number().over(Window.partitionBy(*ENTRY).orderBy("details"))
    return (
        entries.withColumn("turn", turn)
        .join(F.broadcast(counted), ENTRY, "left")
        .where("held IS NULL OR turn > held")
        .drop("turn", "held")
        .coalesce(1)
    )


def run_summary(log: DataFrame) -> DataFrame:
    """Passed and failed checks per run, layer and table."""
    return log.groupBy("run_id", "layer", "table_name").agg(
        F.count_if(F.col("status") == PASSED).alias("passed"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
    )


def alerts(log: DataFrame) -> DataFrame:
    """The failed checks, as somebody should be told of them, each with the run it belongs to."""
    ratio = F.concat_ws(" / ", F.col("records_failed"), F.col("records_total"))
    return log.where(F.col("status") == FAILED).select(
        "layer",
        "run_id",
        "run_timestamp",
        "pipeline_run_id",
        "table_name",
        "check_name",
        "check_type",
        "status",
        "severity",
        ratio.alias("failed_of_total"),
        "details",
    )
