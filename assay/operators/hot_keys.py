"""Finding the few keys that hold too many rows for one task.

The operators that use this are exact on both of their ways, so a sample is enough: missing a key
costs balance, never rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from assay.session import stage

ROWS_PER_TASK = 5_000_000
SAMPLE = 0.001
MARK = "_same_"
HOT_ROWS = "_hot_rows"
# Values that a sketch lists at most, and counters it holds.
LISTED, TRACKED = 1_000, 100_000


def find_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
    sample: float = SAMPLE,
) -> DataFrame | None:
    """(keys, estimated rows) of the keys with more than about ``rows_per_task`` rows; None if none.

    Reads a sample of the key columns alone. At most one key for each ``rows_per_task`` rows of the
    table can be among them. The list is a written table: joins broadcast it only if it is small.
    """
    estimate = F.count(F.lit(1)) / F.lit(sample)
    counted = (
        df.select(*keys)
        .sample(fraction=sample, seed=11)
        .groupBy(*keys)
        .agg(estimate.alias(HOT_ROWS))
        .where(F.col(HOT_ROWS) > rows_per_task)
    )
    found = stage(counted, "hot-keys")
    return found if found.limit(1).count() else None


def may_hold_hot_keys(df: DataFrame) -> bool:
    """Whether the inputs of ``df`` together are too large for Spark's limit for broadcasts.

    A table made from less has no key with millions of rows, unless a join multiplies them. The sum of
    the inputs says more than Spark's estimate of the result, which multiplies the sides of a join.
    """
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return limit <= 0 or sum(sizes) > limit


def frequency_sketch(key: str) -> Column:
    """An aggregate that lists the most frequent values of a column, from a mergeable sketch.

    For ``DataFrame.observe`` on a write, so that looking for hot keys later needs no job. Its size is
    bounded; a value it misses costs balance, never rows.
    """
    return F.expr(f"approx_top_k(cast(`{key}` as string), {LISTED}, {TRACKED})")


def to_note(sketch: Sequence | None, rows_per_task: int = ROWS_PER_TASK) -> str:
    """The keys that a sketch found to have more than ``rows_per_task`` rows, as text."""
    found = [(row["item"], row["count"]) for row in sketch or () if row["item"] is not None]
    return json.dumps([[key, count] for key, count in found if count > rows_per_task])


def from_note(spark: SparkSession, note: str | None, key: str, kind: DataType) -> DataFrame | None:
    """``(key, rows)`` as ``find_hot_keys`` returns them; no row if the table has none."""
    if note is None:
        return None
    rows = spark.createDataFrame(json.loads(note), f"_key string, {HOT_ROWS} long")
    return rows.select(F.col("_key").cast(kind).alias(key), HOT_ROWS)


def marked(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with its keys renamed, ready to be joined by ``same_keys``."""
    return df.withColumnsRenamed({key: MARK + key for key in keys})


def same_keys(keys: Sequence[str]) -> Column:
    """Join condition on equal keys where NULL equals NULL, as grouping does."""
    return reduce(and_, (F.col(key).eqNullSafe(F.col(MARK + key)) for key in keys))


def split_by_keys(
    df: DataFrame, hot: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(rows with a hot key, all other rows). ``hot`` comes from ``find_hot_keys``."""
    listed = marked(hot.select(*keys), keys)
    on = same_keys(keys)
    return df.join(listed, on, "left_semi"), df.join(listed, on, "left_anti")
