"""Small building blocks shared by the other function modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def non_blank(c: Column | str) -> Column:
    """Empty string -> NULL."""
    return F.nullif(as_col(c), F.lit(""))


def strip(c: Column | str) -> Column:
    """Text without white space of any kind at its ends (``trim`` takes spaces only)."""
    return F.regexp_replace(as_col(c), r"(?U)^\s+|\s+$", "")


def non_zero(c: Column | str) -> Column:
    """Zero -> NULL; stored tables do not tell zero from absent."""
    return F.nullif(as_col(c), F.lit(0))


def extract(c: Column | str, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern``, NULL when there is none or it is empty."""
    return F.nullif(F.regexp_extract(as_col(c), pattern, group), F.lit(""))


def first_match(c: Column | str, patterns: tuple[str, ...]) -> Column:
    """First non-empty capture over ordered patterns."""
    return F.coalesce(*[extract(c, p) for p in patterns])


def digits_to_long(c: Column) -> Column:
    """'1,234' -> 1234; NULL when nothing but commas is left."""
    return F.regexp_replace(c, ",", "").try_cast("bigint")


def round_exact(x: Column | str, digits: int = 2) -> Column:
    """Round the exact binary value of a double, ties to even.

    ``F.round`` rounds the shortest decimal rendering instead (1.005 -> 1.01), so it is
    off by a cent now and then. Number formatting works on the exact value; the text is
    read back as the nearest double. 0.0 is added so that no -0.0 comes out.
    """
    pattern = "0." + "0" * digits if digits else "0"
    shown = F.call_function("format_number", as_col(x).cast("double"), F.lit(pattern))
    return shown.cast("double") + 0.0
