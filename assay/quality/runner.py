"""Declaring checks, logging their outcomes, and stopping a run on critical failures."""

from __future__ import annotations

import logging
import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from copy import copy
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from assay.quality import audit_log, checks
from assay.sources.schemas import AUDIT_LOG
from assay.sources.tables import DEFAULT_FORMAT, append_rows

logger = logging.getLogger(__name__)

# Fixed value: the pipeline run of checks that no job runs.
MANUAL = "manual"

AlertSink = Callable[[DataFrame, Sequence[str]], None]


class QualityGateError(Exception):
    """A critical check failed."""


def _require(value: Any, name: str) -> None:
    """A check of nothing would pass."""
    if len(value) == 0:
        raise ValueError(f"{name} must not be empty")


class QualityRunner:
    """Collects checks for one layer, and commits their outcomes to the audit log.

    A check is only declared when its method is called. The first look at ``results``, or the
    commit, evaluates all declared ones together, so checks on the same DataFrame share a scan.
    """

    def __init__(
        self,
        spark: SparkSession,
        layer: str,
        table_name: str | None = None,
        run_id: str | None = None,
        pipeline_run_id: str | None = None,
        alert_emails: Sequence[str] = (),
        alert_sink: AlertSink | None = None,
        log_table: str = audit_log.LOG_TABLE,
        run_timestamp: datetime | None = None,
        log_format: str = DEFAULT_FORMAT,
    ) -> None:
        self.spark = spark
        self.layer = layer
        self.table_name = table_name
        self._may_be_repeated = run_id is not None  # a new id has nothing in the log
        self.run_id = run_id or str(uuid.uuid4())
        self.run_timestamp = run_timestamp or datetime.now(timezone.utc)
        self.pipeline_run_id = pipeline_run_id or MANUAL
        self.alert_emails = list(alert_emails or ())
        self.alert_sink = alert_sink
        self.log_table = log_table
        self.log_format = log_format
        self._declared: list[checks.Check] = []
        self._results: list[dict[str, Any]] = []
        self._saved: Counter = Counter()

    def check_row_count(
        self,
        df: DataFrame,
        table_name: str | None = None,
        min_rows: int = 1,
        severity: str = checks.CRITICAL,
    ) -> QualityRunner:
        """At least ``min_rows`` rows; if not, all of them count as failed."""
        return self._declare(checks.row_count(df, self._table(table_name), min_rows, severity))

    def check_nulls(
        self,
        df: DataFrame,
        table_name: str | None = None,
        columns: Sequence[str] = (),
        threshold: float = 0.0,
        severity: str = checks.CRITICAL,
    ) -> QualityRunner:
        """For each column, a share of NULLs of at most ``threshold``. One entry per column; at
        least one must be named."""
        _require(columns, "columns")
        table = self._table(table_name)
        return self._declare(*(checks.nulls(df, table, c, threshold, severity) for c in columns))

    def check_duplicates(
        self,
        df: DataFrame,
        table_name: str | None = None,
        key_columns: Sequence[str] = (),
        severity: str = checks.CRITICAL,
    ) -> QualityRunner:
        """No two rows with the same key, of one or more columns; NULLs are the same."""
        _require(key_columns, "key_columns")
        return self._declare(checks.duplicates(df, self._table(table_name), key_columns, severity))

    def check_values_in_set(
        self,
        df: DataFrame,
        table_name: str | None = None,
        column: str = "",
        valid_values: Sequence[Any] = (),
        severity: str = checks.HIGH,
    ) -> QualityRunner:
        """No value outside the set, which must not be empty; NULL does not count."""
        _require(column, "column")
        _require(valid_values, "valid_values")
        table = self._table(table_name)
        return self._declare(checks.values_in_set(df, table, column, valid_values, severity))

    def check_referential_integrity(
        self,
        df: DataFrame,
        table_name: str | None,
        fk_col: str,
        ref_df: DataFrame,
        pk_col: str,
        severity: str = checks.HIGH,
    ) -> QualityRunner:
        """Every ``fk_col`` is among ``pk_col``; NULL is not."""
        table = self._table(table_name)
        return self._declare(
            checks.referential_integrity(df, table, fk_col, ref_df, pk_col, severity)
        )

    def check_while_writing(
        self,
        df: DataFrame,
        declare: Callable[[QualityRunner, DataFrame], Any],
        write: Callable[[DataFrame], None],
        read: Callable[[], DataFrame],
    ) -> QualityRunner:
        """Write ``df`` and check it; what a plain scan would count is counted as the rows pass.

        ``declare`` calls check methods on the runner and the DataFrame it is given, ``write`` writes the
        one it is given, and ``read`` returns what was written. Row counts, nulls and values come from
        the write itself, where each row that is kept counts once, also if tasks are retried. Keys and
        references are checked on what was written, as are the plain counts of other DataFrames. If
        writing fails nothing is declared.
        """
        declared = self._declared_by(declare, df)
        plain = [k for k, check in enumerate(declared) if check.df is df and check.is_plain]
        seen = Observation()
        if plain:
            counts = [declared[k].counted.alias(f"failed_{k}") for k in plain]
            write(df.observe(seen, F.count(F.lit(1)).alias("total"), *counts))
        else:
            write(df)
        written = self._declared_by(declare, read())
        if [c.check_name for c in written] != [c.check_name for c in declared]:
            raise ValueError("the same checks must be declared on each call")
        for k in plain:
            written[k] = written[k].known(seen.get["total"], seen.get[f"failed_{k}"])
        return self._declare(*written)

    def _declared_by(self, declare, df: DataFrame) -> list[checks.Check]:
        apart = copy(self)
        apart._declared = []
        declare(apart, df)
        return apart._declared

    def report(self) -> DataFrame:
        """The declared checks' log entries as a lazy DataFrame; at least one must be declared."""
        entries = checks.outcomes(self._declared)
        return entries.select(
            F.lit(self.run_id).alias("run_id"),
            F.lit(self.run_timestamp).alias("run_timestamp"),
            F.lit(self.layer).alias("layer"),
            *(c for c in entries.columns),
            F.lit(self.pipeline_run_id).alias("pipeline_run_id"),
        )

    @property
    def results(self) -> list[dict[str, Any]]:
        """The uncommitted log entries in the order of declaration, one small row per check."""
        if self._declared:
            rows = self.report().orderBy("check_number").drop("check_number").collect()
            # not the collected time: that has passed through the driver's time zone
            at = {"run_timestamp": self.run_timestamp}
            self._results += [row.asDict() | at for row in rows]
            self._declared = []
        return self._results

    @property
    def has_critical_failure(self) -> bool:
        return any(
            r["status"] == checks.FAILED and r["severity"] == checks.CRITICAL for r in self.results
        )

    def commit(self, raise_on_critical: bool = True) -> list[dict[str, Any]]:
        """Append the outcomes to the log, report and alert; then raise if a critical check failed.

        The entries are saved before anything is raised, and a second commit does not save them
        again. If saving fails they are kept, so that a repeated commit saves them and raises as the
        first would have. Nor are they saved again by another runner of the same ``run_id``, as after a
        driver that was lost once they were in the log: what a run, layer, table and check have there
        already, beyond what this runner itself has saved, is left out. Without checks nothing happens.
        """
        results = self.results
        stop = self.has_critical_failure
        if not results:
            return results
        log = self.spark.createDataFrame(results, AUDIT_LOG).coalesce(1)
        audit_log.create_log(self.spark, self.log_table, self.log_format)
        fresh = log
        if self._may_be_repeated:
            fresh = audit_log.unsaved(log, self.spark.table(self.log_table), self._saved)
        append_rows(fresh, self.log_table)
        self._saved.update(audit_log.entry_key(r) for r in results)
        self._results = []
        passed = sum(r["status"] == checks.PASSED for r in results)
        logger.info(
            "%s run %s: %d checks passed, %d failed",
            self.layer,
            self.run_id,
            passed,
            len(results) - passed,
        )
        if passed < len(results):
            self._alert(audit_log.alerts(log))
        if stop and raise_on_critical:
            failing = sorted({r["table_name"] for r in results if r["status"] == checks.FAILED})
            raise QualityGateError(
                f"critical checks failed in {self.layer} ({', '.join(failing)}); "
                f"see {self.log_table}, run {self.run_id}"
            )
        return results

    def _alert(self, failures: DataFrame) -> None:
        """Hand the failures to the caller's sink; its errors must not fail the run."""
        if self.alert_sink is None:
            return
        try:
            self.alert_sink(failures, self.alert_emails)
        except Exception:
            logger.exception("alert for run %s was not delivered", self.run_id)

    def _table(self, table_name: str | None) -> str:
        return table_name or self.table_name or "unnamed"

    def _declare(self, *declared: checks.Check) -> QualityRunner:
        self._declared.extend(declared)
        return self
