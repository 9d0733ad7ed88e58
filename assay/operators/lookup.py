"""Left lookups and their opposite, the rows that find nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.operators import hot_keys

# Rows of one key, of either side, that a salted group holds at least.
LEAST_PER_GROUP = 50
NO_KEY = "[]"


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    rows_per_task: int = hot_keys.ROWS_PER_TASK,
    sample: float = hot_keys.SAMPLE,
    hot_note: str | None = None,
) -> DataFrame:
    """Left equi-join that drops ``right_key``; other column names must not overlap.

    No broadcast is forced: Spark broadcasts ``right`` only if its size, measured at run time at
    the latest, is below ``spark.sql.autoBroadcastJoinThreshold``. A key that is hot in ``left``
    (NULL too) is split by adaptive execution. It cannot split the right side of a left join, so
    rows of keys hot in ``right`` are dealt over salted groups, as many as their number asks for, and
    rows that look them up go to each of these; copies that find nothing are dropped, since such a
    key has a match. Both sides are read once. Which keys are hot a ``hot_note`` says that was taken as
    ``right`` was written (``hot_keys.to_note``); without one they are searched for in a sample of the
    key of ``right``, unless its inputs are small enough to broadcast.
    """
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"both sides have columns {sorted(shared)}")
    right = right.where(F.col(right_key).isNotNull())
    hot = None
    if hot_note is not None:
        if hot_note != NO_KEY:
            kind = right.schema[right_key].dataType
            hot = hot_keys.from_note(right.sparkSession, hot_note, right_key, kind)
    elif rows_per_task < hot_keys.ROWS_PER_TASK or hot_keys.may_hold_hot_keys(right):
        hot = hot_keys.find_hot_keys(right, [right_key], rows_per_task, sample)
    if hot is None:
        return _plain_lookup(left, right, left_key, right_key)

    groups = F.ceil(F.col(hot_keys.HOT_ROWS) / F.lit(max(rows_per_task, LEAST_PER_GROUP)))
    listed = hot.select(F.col(right_key).alias("_hot"), groups.cast("int").alias("_groups"))
    number = F.coalesce("_groups", F.lit(1))
    # A task's number as salt: equal rows spread, and a retried task salts as before.
    salted = (
        right.join(listed, F.col(right_key) == F.col("_hot"), "left")
        .withColumn("_salt", F.pmod(F.spark_partition_id(), number))
        .drop("_hot", "_groups")
    )
    copies = (
        left.join(listed, F.col(left_key) == F.col("_hot"), "left")
        .withColumn("_copy", F.explode(F.sequence(F.lit(0), number - 1)))
        .drop("_hot")
    )
    same = (F.col(left_key) == F.col(right_key)) & (F.col("_copy") == F.col("_salt"))
    joined = copies.join(salted, same, "left")
    kept = joined.where(F.col("_groups").isNull() | F.col("_salt").isNotNull())
    return kept.drop(right_key, "_salt", "_copy", "_groups")


def _plain_lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    return left.join(right, F.col(left_key) == F.col(right_key), "left").drop(right_key)


def orphan_rows(df: DataFrame, fk: str, ref: DataFrame, pk: str) -> DataFrame:
    """The rows of ``df`` whose ``fk`` is NULL or not among ``ref``'s ``pk``.

    The reference side is reduced to distinct keys map-side; the other side may be split.
    """
    known = ref.select(F.col(pk).alias("_pk")).distinct()
    return df.join(known, F.col(fk) == F.col("_pk"), "left_anti")
