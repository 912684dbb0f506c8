"""Null policy of the screening rules, one helper per rule."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_one(c: Column | str) -> Column:
    """N7: ``eq(1)``; null is False."""
    return F.coalesce(_col(c) == 1, F.lit(False))


def not_one(c: Column | str) -> Column:
    """N7: ``ne(1)``; null is True (plain SQL ``c <> 1`` would drop the row)."""
    return ~is_one(c)


def any_is_one(cols: Iterable[Column | str]) -> Column:
    return reduce(lambda a, b: a | b, (is_one(c) for c in cols), F.lit(False))


def nonzero(c: Column | str) -> Column:
    """N9: truthiness inside ``any(axis=1)``; null is False."""
    return F.coalesce(_col(c) != 0, F.lit(False))


def any_nonzero(cols: Iterable[Column | str]) -> Column:
    return reduce(lambda a, b: a | b, (nonzero(c) for c in cols), F.lit(False))


def truthy(c: Column | str, null_as_true: bool = True) -> Column:
    """N10 / TXT-9: ``astype(bool)``; a missing value (NaN) counts as True."""
    return F.coalesce(_col(c) != 0, F.lit(null_as_true))


def fill0_int(c: Column | str) -> Column:
    """N11 / TXT-7: ``fillna(0).astype(int)``."""
    return F.coalesce(_col(c), F.lit(0)).cast("int")


def lenient_int(c: Column | str) -> Column:
    """N14 / TXT-6: ``to_numeric(errors='coerce')`` then truncate to int;
    text that is no number, or a number outside the int range, is null
    (ANSI casts would raise)."""
    return lenient_double(c).try_cast("int")


def lenient_double(c: Column | str) -> Column:
    """A number in plain or scientific notation, else null. The pattern comes
    first: the cast alone also takes ``2021d`` and ``2022f``."""
    text = _col(c).cast("string")
    plain = text.rlike(r"\A\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z")
    return F.when(plain, F.trim(text).try_cast("double"))


def sum0(c: Column | str) -> Column:
    """N8: pandas ``sum`` skips nulls and gives 0 for an all-null group."""
    return F.coalesce(F.sum(_col(c)), F.lit(0)).cast("long")


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def nonblank(c: Column | str) -> Column:
    """A value that is not null and not blank after a Unicode strip."""
    from .text import strip_ws

    return F.coalesce(strip_ws(_col(c)) != "", F.lit(False))
