"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """One row per key (NULL is a key): the newest by ``newest_by``, NULLs oldest.

    All remaining columns break ties, so the result does not depend on row order. Catalyst turns
    the rank filter into a group limit ahead of the exchange: each map task sends at most one row
    per key, and a key with a third of all rows costs its reducer one row per map task.
    """
    ranked_by = [*newest_by, *(c for c in df.columns if c not in {*keys, *newest_by})]
    newest_first = Window.partitionBy(*keys).orderBy(*(F.desc_nulls_last(c) for c in ranked_by))
    return df.withColumn("_rank", F.row_number().over(newest_first)).where("_rank = 1").drop("_rank")
