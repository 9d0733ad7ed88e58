"""The five checks, evaluated together.

All counts of one DataFrame that need no grouping share a single scan. Each key set and each foreign
key adds one aggregation of its own; two distinct key sets in one aggregation would multiply the
rows instead.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.operators.counts import duplicate_counts, orphan_counts

# The words of the audit log.
PASSED = "PASSED"
FAILED = "FAILED"
CRITICAL = "CRITICAL"
HIGH = "HIGH"
COMPLETENESS = "completeness"
UNIQUENESS = "uniqueness"
VALIDITY = "validity"
CONSISTENCY = "consistency"


@dataclass(frozen=True)
class Verdict:
    """A check's outcome as Columns over its two counts."""

    passed: Column
    failed_rows: Column
    details: Column


@dataclass(frozen=True)
class Check:
    """One rule on one DataFrame.

    ``counted`` is an aggregate Column that counts failing rows in a plain scan, or a function that
    makes a one-row DataFrame ``(total, failed)``. ``judge`` turns both counts into a verdict.
    """

    df: DataFrame
    table_name: str
    check_name: str
    check_type: str
    severity: str
    counted: Column | Callable[[], DataFrame]
    judge: Callable[[Column, Column], Verdict]

    @property
    def is_plain(self) -> bool:
        """Whether a plain scan counts the failing rows."""
        return isinstance(self.counted, Column)

    def known(self, total: int, failed: int) -> Check:
        """The same check of rows that have been counted already."""
        spark = self.df.sparkSession
        counts = [(total, failed)]
        return replace(
            self, counted=lambda: spark.createDataFrame(counts, "total long, failed long")
        )

    def outcome(self, number: int, total: Column, failed: Column) -> Column:
        """The check's entry for the log, as a struct."""
        verdict = self.judge(total, failed)
        share = F.coalesce(F.try_divide(verdict.failed_rows, total), F.lit(0.0))
        return F.struct(
            F.lit(number).alias("check_number"),
            F.lit(self.table_name).alias("table_name"),
            F.lit(self.check_name).alias("check_name"),
            F.lit(self.check_type).alias("check_type"),
            F.when(verdict.passed, PASSED).otherwise(FAILED).alias("status"),
            F.lit(self.severity).alias("severity"),
            total.cast("bigint").alias("records_total"),
            verdict.failed_rows.cast("bigint").alias("records_failed"),
            share.cast("double").alias("failure_rate"),
            verdict.details.alias("details"),
        )


def row_count(df: DataFrame, table: str, min_rows: int, severity: str = CRITICAL) -> Check:
    def judge(total: Column, _: Column) -> Verdict:
        enough = total >= min_rows
        details = _json(min_expected=F.lit(min_rows), actual=total)
        return Verdict(enough, F.when(enough, 0).otherwise(total), details)

    every_row = F.count(F.lit(1))
    return Check(df, table, "row_count_min", COMPLETENESS, severity, every_row, judge)


def nulls(
    df: DataFrame, table: str, column: str, threshold: float = 0.0, severity: str = CRITICAL
) -> Check:
    def judge(total: Column, failed: Column) -> Verdict:
        rate = F.coalesce(F.try_divide(failed, total), F.lit(0.0))
        details = _json(column=F.lit(column), null_rate=rate, threshold=F.lit(float(threshold)))
        return Verdict(rate <= threshold, failed, details)

    counted = F.count_if(F.col(column).isNull())
    return Check(df, table, f"null_check_{column}", COMPLETENESS, severity, counted, judge)


def duplicates(
    df: DataFrame, table: str, key_columns: Sequence[str], severity: str = CRITICAL
) -> Check:
    keys = list(key_columns)

    def judge(_: Column, failed: Column) -> Verdict:
        listed = F.array(*(F.lit(k) for k in keys))
        return Verdict(failed == 0, failed, _json(key_columns=listed, duplicate_count=failed))

    name = f"duplicate_check_{'_'.join(keys)}"
    return Check(
        df, table, name, UNIQUENESS, severity, lambda: duplicate_counts(df, keys), judge
    )


def values_in_set(
    df: DataFrame, table: str, column: str, valid_values: Sequence[Any], severity: str = HIGH
) -> Check:
    """NULL is neither in the set nor outside it, so it does not fail."""
    values = list(valid_values)
    listed = _text({"column": column, "valid_values": values})
    outside = F.count_if(~F.col(column).isin(values))
    return Check(
        df,
        table,
        f"value_set_{column}",
        VALIDITY,
        severity,
        outside,
        lambda _, failed: Verdict(failed == 0, failed, listed),
    )


def referential_integrity(
    df: DataFrame, table: str, fk: str, ref_df: DataFrame, pk: str, severity: str = HIGH
) -> Check:
    """A NULL foreign key is an orphan."""
    named = _text({"fk_column": fk, "pk_column": pk})
    return Check(
        df,
        table,
        f"ref_integrity_{fk}",
        CONSISTENCY,
        severity,
        lambda: orphan_counts(df, fk, ref_df, pk),
        lambda _, failed: Verdict(failed == 0, failed, named),
    )


def outcomes(checks: Sequence[Check]) -> DataFrame:
    """One row per check: its log entry, and ``check_number``, its place in ``checks``."""
    scans: list[list[tuple[int, Check]]] = []
    parts: list[DataFrame] = []
    for number, check in enumerate(checks):
        if check.is_plain:
            scan = next((s for s in scans if _same_rows(s[0][1].df, check.df)), None)
            if scan is None:
                scans.append(scan := [])
            scan.append((number, check))
        else:
            entry = check.outcome(number, F.col("total"), F.col("failed"))
            parts.append(check.counted().select(F.inline(F.array(entry))))
    parts.extend(_scan_once(numbered) for numbered in scans)
    return reduce(DataFrame.unionByName, parts)


def _same_rows(one: DataFrame, other: DataFrame) -> bool:
    """Whether both are the same query, such as one table read twice."""
    return one is other or (one.columns == other.columns and one.sameSemantics(other))


def _scan_once(numbered: Sequence[tuple[int, Check]]) -> DataFrame:
    df = numbered[0][1].df
    counts = [check.counted.alias(f"failed_{number}") for number, check in numbered]
    one_row = df.agg(F.count(F.lit(1)).alias("total"), *counts)
    entries = [
        check.outcome(number, F.col("total"), F.col(f"failed_{number}"))
        for number, check in numbered
    ]
    return one_row.select(F.inline(F.array(*entries)))


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*(value.alias(name) for name, value in fields.items())))


def _text(fields: dict[str, Any]) -> Column:
    return F.lit(json.dumps(fields, separators=(",", ":"), default=str, ensure_ascii=False))
