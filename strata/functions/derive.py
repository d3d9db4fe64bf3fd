"""Derived values: buckets, durations, guarded ratios, percentages, row hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.casts import safe_to_date


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucketize(c: str | Column, bounds: Sequence[tuple[float, str]], otherwise: str,
              null_label: str | None = None) -> Column:
    """Chained ``when(c < bound, label)``; values past the last bound get ``otherwise``.

    A chained ``when`` sends null to ``otherwise`` (a null age becomes the top
    bucket); ``null_label`` gives nulls a bucket of their own instead.
    """
    c = _c(c)
    expr = None
    if null_label is not None:
        expr = F.when(c.isNull(), F.lit(null_label))
    for bound, label in bounds:
        expr = F.when(c < bound, F.lit(label)) if expr is None else expr.when(c < bound, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def minutes_between(start: str | Column, end: str | Column, scale: int = 2) -> Column:
    """Whole-second difference of two timestamps in minutes, rounded."""
    return F.round((F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))) / 60, scale)


def stay_days(end: str | Column, start: str | Column) -> Column:
    """Days from ``start`` to ``end``; null when either is no date."""
    return F.datediff(safe_to_date(end), safe_to_date(start))


def guarded_rate(amount: str | Column, minutes: str | Column, scale: int = 2) -> Column:
    """Per-hour rate (e.g. mph); null unless both amount and minutes are positive."""
    amount, minutes = _c(amount), _c(minutes)
    return F.round(F.when((minutes > 0) & (amount > 0), amount / (minutes / 60)), scale)


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """Division that yields null for a zero denominator (ANSI-safe)."""
    return F.try_divide(_c(num), _c(den))


def pct(part: str | Column, whole: str | Column, scale: int = 2) -> Column:
    """``round(part * 100 / whole, scale)`` in double arithmetic; null for a zero whole."""
    return F.round(F.try_divide(_c(part).cast("double") * 100.0, _c(whole).cast("double")), scale)


# Fixed values of the row hash: field delimiter, escape character and the
# marker that stands for null, so ('a', null, 'b') and ('a', 'b', null) differ.
HASH_DELIMITER = "|"
HASH_NULL_MARKER = "\\N"


def _hash_field(c: Column) -> Column:
    text = c.cast("string")
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
    return F.coalesce(escaped, F.lit(HASH_NULL_MARKER))


def row_hash(columns: Sequence[str | Column]) -> Column:
    """SHA-256 over the delimited text of the columns, nulls and delimiters made unambiguous."""
    return F.sha2(F.concat_ws(HASH_DELIMITER, *[_hash_field(_c(c)) for c in columns]), 256)
