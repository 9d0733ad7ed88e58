"""Relational operators that need more care than one DataFrame call at scale."""

from assay.operators.counts import duplicate_counts, orphan_counts
from assay.operators.hot_keys import find_hot_keys
from assay.operators.latest import latest_per_key
from assay.operators.lookup import left_lookup, orphan_rows
from assay.operators.surrogate import with_surrogate_key
from assay.operators.validity import with_validity_end

__all__ = [
    "duplicate_counts",
    "find_hot_keys",
    "latest_per_key",
    "left_lookup",
    "orphan_counts",
    "orphan_rows",
    "with_surrogate_key",
    "with_validity_end",
]
