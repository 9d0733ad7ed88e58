"""Dense surrogate keys without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assay.operators.ties import row_hash
from assay.session import stage

# Fixed value of Spark: monotonically_increasing_id() holds the row's position in its partition in
# the lower 33 bits.
POSITION_BITS = 33


def with_surrogate_key(
    df: DataFrame, key: str, order_by: Sequence[str], tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """Put a column ``key`` in front: 1, 2, 3, ... over the whole table in the given order.

    Equals ``row_number()`` over an unpartitioned window, but all tasks take part: a range-sorted
    write, then one offset per sorted partition. Rows level on the tie-breakers follow their hash.
    The row's source partition ends the sort order, so that equal rows can still go to different
    tasks; it is the same whenever a task is retried. Writing the sorted rows fixes their positions
    for the two later reads.
    """
    order = [F.col(c).asc_nulls_first() for c in (*order_by, *tie_breakers)]
    numbered = (
        df.withColumns({"_hash": row_hash(df), "_source": F.spark_partition_id()})
        .orderBy(*order, "_hash", "_source")
        .drop("_hash", "_source")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_position", F.monotonically_increasing_id().bitwiseAND(2**POSITION_BITS - 1))
    )
    numbered = stage(numbered, "sorted")
    # One row per sorted partition: as many as there are shuffle partitions, whatever the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    number = F.col("_offset") + F.col("_position") + 1
    return numbered.join(F.broadcast(offsets), "_part").select(
        number.cast("bigint").alias(key), *(F.col(c) for c in df.columns)
    )
