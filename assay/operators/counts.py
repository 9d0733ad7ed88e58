"""Counts behind the uniqueness and integrity checks, each in one pass over the data.

Both group first. Partial aggregation folds a hot key into one row per map task before the shuffle,
so the reducers see distinct keys rather than rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``(total, failed)``: all rows, and those beyond the first of each key.

    NULLs are equal to each other here, as in ``dropDuplicates``.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("failed"),
    )


def orphan_counts(df: DataFrame, fk: str, ref: DataFrame, pk: str) -> DataFrame:
    """One row ``(total, failed)``: all rows, and those whose ``fk`` is NULL or unknown."""
    per_key = df.groupBy(F.col(fk).alias("_fk")).agg(F.count(F.lit(1)).alias("_rows"))
    known = ref.select(F.col(pk).alias("_pk")).distinct()
    found = per_key.join(known, F.col("_fk") == F.col("_pk"), "left")
    missing = F.when(F.col("_pk").isNull(), F.col("_rows")).otherwise(0)
    return found.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(missing), F.lit(0)).alias("failed"),
    )
