"""Reusable rules for text that should have been a number, and for bounds.

All casts are ``try_cast`` and all divisions ``try_divide``: a value that cannot be
read becomes NULL under ANSI mode, which stays switched on.

The bounding helpers mention their argument more than once. Give them a column of a
previous projection, not a fresh regular expression, so that it is evaluated once.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How a number is recognised inside dirty text.
UNSIGNED_DECIMAL = r"(\d+\.?\d*)"
SIGNED_DECIMAL = r"([+-]?\d+\.?\d*)"
DIGIT_RUN = r"(\d+)"
SIGNED_INTEGER = r"([+-]?\d+)"
PLACEHOLDER = "_"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_placeholder(c: Column | str) -> Column:
    """Remove every underscore, the filler character of the raw text fields."""
    return F.replace(_col(c), F.lit(PLACEHOLDER), F.lit(""))


def first_match(c: Column | str, pattern: str, dtype: str) -> Column:
    """First match of group 1 read as ``dtype``; no match or overflow gives NULL.

    No match is the empty string. It is set to NULL before the cast: a failing cast costs
    far more than a NULL one.
    """
    return F.nullif(F.regexp_extract(_col(c), pattern, 1), F.lit("")).try_cast(dtype)


def parse_decimal(c: Column | str, signed: bool = False, places: int = 2) -> Column:
    """First decimal number in the text, half-up rounded.

    The unsigned form drops a leading sign: ``-5`` reads as ``5.0``.
    """
    pattern = SIGNED_DECIMAL if signed else UNSIGNED_DECIMAL
    return F.round(first_match(strip_placeholder(c), pattern, "double"), places)


def parse_digits(c: Column | str) -> Column:
    """First run of digits as an int. The sign is lost, so ``-100`` reads as 100."""
    return first_match(strip_placeholder(c), DIGIT_RUN, "int")


def cap(c: Column | str, hi: float) -> Column:
    c = _col(c)
    return F.when(c.isNotNull(), F.least(c, F.lit(hi)))


def floor_at(c: Column | str, lo: float) -> Column:
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(lo)))


def clamp(c: Column | str, lo: float, hi: float) -> Column:
    """Pull values into [lo, hi]. ``least``/``greatest`` skip NULL, hence the guard."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(lo), F.least(c, F.lit(hi))))


def null_outside(c: Column | str, lo: float, hi: float) -> Column:
    c = _col(c)
    return F.when(c.between(lo, hi), c)


def parse_count(c: Column | str, hi: int) -> Column:
    """Digit run bounded above. Prefer ``cap`` over a projected ``parse_digits`` in hot paths."""
    return cap(parse_digits(c), hi)


def replace_value(c: Column | str, old: str, new: str) -> Column:
    c = _col(c)
    return F.when(c == old, F.lit(new)).otherwise(c)


def recode(c: Column | str, mapping: Mapping[str, object], default: object = None) -> Column:
    """Value to value by an exact, case-sensitive table; anything else is ``default``."""
    c = _col(c)
    out = F
    for source, target in mapping.items():
        out = out.when(c == source, F.lit(target))
    return out.otherwise(F.lit(default))


def whitelist(c: Column | str, values: Iterable[str]) -> Column:
    c = _col(c)
    return F.when(c.isin(*values), c)


def default_date(c: Column | str, run_date) -> Column:
    """NULL becomes the run date; without a run date the column is returned as it is."""
    c = _col(c)
    return c if run_date is None else F.coalesce(c, F.lit(run_date).cast("date"))


def read_as(c: Column | str, source: T.DataType, target: T.DataType) -> Column:
    """Tolerant cast by source type; text that is no value of the target gives NULL.

    Whole numbers written as ``10.0`` (a common artefact of exported integer columns
    with gaps) still read as 10.
    """
    c = _col(c)
    if source == target:
        return c
    if isinstance(source, T.StringType) and isinstance(target, T.IntegerType):
        return F.coalesce(c.try_cast(target), c.try_cast("decimal(38,6)").try_cast(target))
    return c.try_cast(target)


def number_from(c: Column | str, source: T.DataType, target: T.DataType) -> Column:
    """Like ``read_as``, and if text is no clean number, the first signed number in it."""
    c = _col(c)
    if not isinstance(source, T.StringType):
        return read_as(c, source, target)
    pattern = SIGNED_INTEGER if isinstance(target, T.IntegerType) else SIGNED_DECIMAL
    return F.coalesce(
        read_as(c, source, target), first_match(strip_placeholder(c), pattern, target.simpleString())
    )
