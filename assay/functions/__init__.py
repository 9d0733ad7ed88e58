"""Column expressions: every rule here is a pure function of Columns, evaluated in the JVM."""

from assay.functions.cleaning import (
    clean_price,
    code_label,
    date_from_int,
    not_after,
    preferred_label,
    reconciled_amount,
    split_product_key,
    strip_text,
)

__all__ = [
    "clean_price",
    "code_label",
    "date_from_int",
    "not_after",
    "preferred_label",
    "reconciled_amount",
    "split_product_key",
    "strip_text",
]
