"""Repair and standardisation rules as Column functions.

Each takes input columns only, so a caller builds all outputs in a single ``select`` and no rule
sees another rule's result. Malformed values become NULL rather than failing the job, also under
ANSI mode: one bad row must not stop a run over billions of good ones.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats and markers that appear in the source data or the published tables.
EIGHT_DIGITS = (10_000_000, 99_999_999)
UNKNOWN = "n/a"
PRICE_TYPE = "decimal(10,2)"


def date_from_int(value: Column) -> Column:
    """A yyyymmdd integer as a date; 0, other lengths and impossible days become NULL.

    Arithmetic is several times faster than parsing text, most of all on malformed values, which a
    parser throws on. The expression is kept short: generated code beyond the JVM's limit for
    compiled methods would run interpreted. It uses its input five times, so pass a column.
    """
    number = value.try_cast("int")
    year = _div(number, 10_000)
    month = _div(number, 100) % 100
    zero = F.lit(0)
    midnight = F.try_make_timestamp_ntz(year, month, number % 100, zero, zero, zero)
    plausible = number.between(*EIGHT_DIGITS) & month.between(1, 12)
    return F.when(plausible, midnight.cast("date"))


def _div(number: Column, divisor: int) -> Column:
    return F.call_function("div", number, F.lit(divisor)).cast("int")


def reconciled_amount(amount: Column, quantity: Column, unit_price: Column) -> Column:
    """quantity x |unit price| where both are known, else a positive amount as it stands, else NULL.

    A product too large for its type is NULL, not unknown: the delivered amount does not stand in for
    it. An amount that already equals the product needs no case of its own. The sign is turned by
    ``try_subtract`` because ``abs`` fails on the smallest integer.
    """
    size = F.when(unit_price < 0, F.try_subtract(F.lit(0), unit_price)).otherwise(unit_price)
    product = F.try_multiply(quantity, size)
    known = quantity.isNotNull() & unit_price.isNotNull()
    return F.when(known, product).otherwise(F.when(amount > 0, amount))


def clean_price(unit_price: Column, amount: Column, quantity: Column) -> Column:
    """A positive price rounded to cents; otherwise amount / quantity, NULL at quantity 0.

    ``amount`` is the amount as delivered, not the reconciled one.
    """
    derived = F.try_divide(amount, quantity).try_cast(PRICE_TYPE)
    return F.when(unit_price > 0, F.round(unit_price, 2)).otherwise(derived)


def split_product_key(raw_key: Column) -> tuple[Column, Column]:
    """(category id, product key): characters 1-5 with ``_`` for ``-``, and those from 7 on."""
    category = F.replace(F.substring(raw_key, 1, 5), F.lit("-"), F.lit("_"))
    product = F.substring(raw_key, F.lit(7), F.length(raw_key))
    return category, product


def code_label(
    code: Column,
    labels: Mapping[str, str],
    default: str | Column = UNKNOWN,
    fold_case: bool = True,
) -> Column:
    """The label of a trimmed, by default upper-cased code; ``default`` for all others and NULL."""
    tidy = F.upper(F.trim(code)) if fold_case else F.trim(code)
    other = default if isinstance(default, Column) else F.lit(default)
    pairs = (F.lit(text) for text in chain.from_iterable(labels.items()))
    return F.coalesce(F.element_at(F.create_map(*pairs), tidy), other)


def not_after(day: Column, as_of: Column) -> Column:
    """The day, or NULL if it lies after ``as_of``."""
    return F.when(day <= as_of, day)


def strip_text(value: Column, text: str) -> Column:
    """The value without any occurrence of ``text``."""
    return F.replace(value, F.lit(text), F.lit(""))


def preferred_label(first: Column, second: Column) -> Column:
    """The first source's label unless it is unknown, then the second's, then unknown."""
    unknown = F.lit(UNKNOWN)
    return F.coalesce(F.nullif(first, unknown), second, unknown)
