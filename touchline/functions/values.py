"""Casts and presence tests that tolerate placeholder values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int(col: Column) -> Column:
    """Integer from text such as "5000" or "5000.0"; anything else is null."""
    return F.round(col.cast("string").try_cast("double")).try_cast("int")


def gate_figure(col: Column) -> Column:
    """Attendance with zero and negative placeholders as null."""
    value = to_int(col)
    return F.when(value > 0, value)


def is_populated(col: Column) -> Column:
    """A usable figure: numeric and above zero."""
    number = col.cast("string").try_cast("double")
    return F.coalesce((number > 0) & ~F.isnan(number), F.lit(False))


def is_present(col: Column) -> Column:
    """Weaker test: anything but null, empty and -1."""
    text = col.cast("string")
    return text.isNotNull() & ~text.isin("", "-1")


def split_score(col: Column) -> tuple[Column, Column]:
    """Home and away goals of a "2-1" text."""
    pattern = r"^\s*(\d+)\s*-\s*(\d+)\s*$"
    return tuple(F.regexp_extract(col, pattern, i).try_cast("int") for i in (1, 2))


def points(gf: Column, ga: Column) -> Column:
    """Three for a win, one for a draw."""
    return F.when(gf > ga, 3).when(gf == ga, 1).otherwise(0)


def differs(a: Column, b: Column) -> Column:
    """Null-safe inequality."""
    return ~a.eqNullSafe(b)
