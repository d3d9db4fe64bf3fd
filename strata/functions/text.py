"""String expressions: trimming, case, regular-expression extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns the layered flows use to split labelled text.
# "NAME - CODE" station labels, "ORIGIN to DESTINATION" routes, the digits of a
# distance such as "25 kms", and the characters a cleaned phone number keeps.
LABEL_NAME_PATTERN = r"^(.+?) -"
LABEL_CODE_PATTERN = r"- (.+)$"
ROUTE_ORIGIN_PATTERN = r"^(.+?) to "
ROUTE_DESTINATION_PATTERN = r" to (.+)$"
FIRST_INTEGER_PATTERN = r"(\d+)"
PHONE_DROP_PATTERN = r"[^\d+]"
# Optional full-number parse: thousands separators dropped, decimals kept.
FULL_NUMBER_PATTERN = r"(\d+(?:\.\d+)?)"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed_extract(c: str | Column, pattern: str, group: int = 1) -> Column:
    """``trim(regexp_extract(c, pattern, group))``: ``""`` when unmatched, null for null."""
    return F.trim(F.regexp_extract(_c(c), pattern, group))


def split_labelled(c: str | Column) -> tuple[Column, Column]:
    """Split ``"MARWAR JN - MJ"`` into (name, code); a label without " -" gives ("", "")."""
    return trimmed_extract(c, LABEL_NAME_PATTERN), trimmed_extract(c, LABEL_CODE_PATTERN)


def split_route(c: str | Column) -> tuple[Column, Column]:
    """Split ``"A to B"`` into (origin, destination)."""
    return trimmed_extract(c, ROUTE_ORIGIN_PATTERN), trimmed_extract(c, ROUTE_DESTINATION_PATTERN)


def leading_number(c: str | Column, mode: str = "first_integer") -> Column:
    """Number inside text such as ``"25 kms"`` as double; null when none.

    ``first_integer`` keeps the first run of digits (``"1,234 kms"`` → 1,
    ``"25.7 kms"`` → 25), which is what the trains flow does; ``full`` drops
    thousands separators and keeps decimals.
    """
    c = _c(c)
    if mode == "full":
        digits = F.regexp_extract(F.regexp_replace(c, ",", ""), FULL_NUMBER_PATTERN, 1)
    else:
        digits = F.regexp_extract(c, FIRST_INTEGER_PATTERN, 1)
    return digits.try_cast("double")


def digits_and_plus(c: str | Column) -> Column:
    """Drop every character but digits and ``+`` (phone normalisation)."""
    return F.regexp_replace(_c(c), PHONE_DROP_PATTERN, "")


def proper_case(c: str | Column) -> Column:
    """``initcap(trim(c))``: first letter of each space-separated word upper, rest lower."""
    return F.initcap(F.trim(_c(c)))
