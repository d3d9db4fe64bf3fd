"""Null-safe casts and null handling.

Spark 4 runs with ANSI mode on: a plain ``cast('' as double)`` raises. The
layered flows expect null and then quarantine the row, so every cast here is
a ``try_`` form; ANSI mode itself is never switched off.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: str | Column, data_type: str) -> Column:
    """``try_cast``: null instead of an error for unparsable values."""
    return _c(c).try_cast(data_type)


def safe_to_date(c: str | Column, fmt: str | None = None) -> Column:
    """``try_to_date``; dates and timestamps pass through as dates."""
    return F.try_to_date(_c(c), F.lit(fmt)) if fmt else F.try_to_date(_c(c))


def null_if_equal(c: str | Column, sentinel) -> Column:
    """Replace a sentinel value (``"Source"``, ``"Destination"``) by null."""
    return F.nullif(_c(c), F.lit(sentinel))


def flag(predicate: Column) -> Column:
    """Boolean flag that is false, not null, when the predicate is unknown."""
    return F.coalesce(predicate, F.lit(False))
