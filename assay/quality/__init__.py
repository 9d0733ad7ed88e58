"""Data-quality checks, their audit log, and the gate that stops a run."""

from assay.quality.audit_log import alerts, create_log, run_summary, truncate_log
from assay.quality.runner import QualityGateError, QualityRunner

__all__ = [
    "QualityGateError",
    "QualityRunner",
    "alerts",
    "create_log",
    "run_summary",
    "truncate_log",
]
