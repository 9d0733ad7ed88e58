"""Given Parquet tables, dealt out where their files are not."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.operators import hot_keys

ROWS_PER_TASK = 1_000_000


def read_parquet(spark: SparkSession, path: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """A Parquet file or folder, for work that holds or writes many rows of a task.

    Spark reads a row group in one task, and a file may be a single row group. If a task would have
    more than four times ``rows_per_task`` rows, they are dealt out by their place in the file, so that
    equal keys spread and nothing is sorted. Counting the rows of the splits reads footers alone;
    inputs small enough to broadcast are not counted.
    """
    rows = spark.read.parquet(path)
    if rows_per_task >= ROWS_PER_TASK and not hot_keys.may_hold_hot_keys(rows):
        return rows
    splits = rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("rows"))
    counted = splits.agg(F.max("rows").alias("most"), F.sum("rows").alias("total")).first()
    if (counted.most or 0) <= 4 * rows_per_task:
        return rows
    placed = rows.select("*", F.col("_metadata.row_index").alias("_place"))
    return placed.repartition(-(-counted.total // rows_per_task), "_place").drop("_place")
