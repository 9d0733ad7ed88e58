"""Validity intervals: each version of a key ends the day before the next one starts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.operators import hot_keys
from assay.operators.surrogate import with_surrogate_key
from assay.operators.ties import row_hash
from assay.session import stage


def with_validity_end(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    tie_breakers: Sequence[str],
    rows_per_task: int = hot_keys.ROWS_PER_TASK,
    sample: float = hot_keys.SAMPLE,
) -> DataFrame:
    """Add the date column ``end``: the next version's start minus one day, NULL for the last.

    Versions of one key follow each other by ``start`` (a date or time, NULL first), then by
    ``tie_breakers``, then by their hash. Ordinary keys take one window, a single shuffle. A key too
    large for one task takes the way of ``_end_by_calendar`` if starts are dates, and of
    ``_end_by_position`` if they are times; the result is the same. No search for such keys where
    the inputs are small enough to broadcast.
    """
    kind = df.schema[start].dataType
    if not isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
        raise TypeError(f"{start} must be a date or a time")
    searched = rows_per_task < hot_keys.ROWS_PER_TASK or hot_keys.may_hold_hot_keys(df)
    hot = hot_keys.find_hot_keys(df, keys, rows_per_task, sample) if searched else None
    rows = df.withColumn("_hash", row_hash(df))
    ranks = [*tie_breakers, "_hash"]
    if hot is None:
        ended = _end_by_window(rows, keys, start, end, ranks)
    else:
        large, ordinary = hot_keys.split_by_keys(rows, hot, keys)
        if isinstance(kind, T.DateType):
            others = _end_by_calendar(large, keys, start, end, ranks)
        else:
            others = _end_by_position(large.drop("_hash"), keys, start, end, tie_breakers, rows_per_task)
        ended = _end_by_window(ordinary, keys, start, end, ranks).drop("_hash")
        ended = ended.unionByName(others.drop("_hash"))
    return ended.drop("_hash")


def _end_by_window(df, keys, start, end, ranks) -> DataFrame:
    in_order = Window.partitionBy(*keys).orderBy(start, *ranks)
    return df.withColumn(end, F.date_sub(F.lead(start).over(in_order), 1))


def _end_by_calendar(df, keys, start, end, ranks) -> DataFrame:
    """The same without bringing a key's rows together.

    All versions of a key that start on one day, but the last of them, end the day before it. Only
    the last needs the key's next start, and a window over the *distinct days* of a key finds that:
    for dates its size is bounded by the calendar, not by the data. The days are aggregated before any
    shuffle, and the join that brings them back is one whose large side adaptive execution splits.
    """
    # Equal rows must still be told apart, and alike in both uses below: number them and write.
    rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "versions")
    rank = F.struct(*ranks, "_row")
    days = rows.groupBy(*keys, start).agg(F.max(rank).alias("_last"))
    days = days.withColumn("_next", F.lead(start).over(Window.partitionBy(*keys).orderBy(start)))
    each_day = [*keys, start]
    joined = rows.join(hot_keys.marked(days, each_day), hot_keys.same_keys(each_day), "left")
    following = F.when(rank == F.col("_last"), F.col("_next")).otherwise(F.col(start))
    return joined.select(*df.columns, F.date_sub(following, 1).alias(end))


def _end_by_position(df, keys, start, end, ranks, rows_per_task) -> DataFrame:
    """The same for any number of distinct starts, however many of them one key has.

    All tasks sort and number the rows by key and start. The row that follows has the next number:
    windows over blocks of equal length find it, whatever the keys, and at a block's end the first row
    of the next one does, a table of one row per block that is dealt as the blocks are.
    """
    rows = with_surrogate_key(df, "_number", [*keys, start], ranks)  # which adds the hash
    length = max(rows_per_task, 1)
    block = F.call_function("div", F.col("_number") - 1, F.lit(length))
    version = F.struct(*(F.col(c).alias(f"_{i}") for i, c in enumerate([*keys, start])))
    rows = rows.withColumns({"_block": block, "_version": version})
    in_order = Window.partitionBy("_block").orderBy("_number")
    after = (
        rows.where((F.col("_number") - 1) % length == 0)
        .select((F.col("_block") - 1).alias("_border"), F.col("_version").alias("_first"))
    )
    joined = rows.withColumn("_next", F.lead("_version").over(in_order)).join(
        after, F.col("_block") == F.col("_border"), "left"
    )
    following = F.coalesce("_next", "_first")
    same = reduce(
        and_, (following[f"_{i}"].eqNullSafe(F.col(key)) for i, key in enumerate(keys)), F.lit(True)
    )
    next_start = F.when(following.isNotNull() & same, following[f"_{len(keys)}"])
    return joined.select(*df.columns, F.date_sub(next_start, 1).alias(end))
