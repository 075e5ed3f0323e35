"""Numbers as Python formats and rounds them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamarack.functions.regex import let

# doubles that lie exactly half-way between hundredths as written, and what Python rounds them to
_HALF = [(k + 0.5) / 100 for k in range(100)]
_ROUNDED = [round(x, 2) for x in _HALF]


def _table(values: list[float]) -> Column:
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def round2(x: Column) -> Column:
    """``round(x, 2)`` of Python for doubles from 0 to 1."""
    k = lambda v: F.floor(v * 100).cast("int")
    return let(x, lambda v: F.when(F.get(_table(_HALF), k(v)) == v, F.get(_table(_ROUNDED), k(v))).otherwise(F.round(v, 2)))


def two_places(x: Column) -> Column:
    return F.format_string("%.2f", x)


def to_double(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")
