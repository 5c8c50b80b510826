"""Missing values: null and NaN mean the same to every operator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def known(c: Column) -> Column:
    """True where a number is neither null nor NaN."""
    d = c.cast("double")
    return d.isNotNull() & ~F.isnan(d)


def number(c: Column) -> Column:
    """As double; NaN becomes null."""
    d = c.cast("double")
    return F.when(~F.isnan(d), d)


def clip0(x: Column) -> Column:
    """max(x, 0); missing stays null (``greatest`` alone would skip it)."""
    return F.when(known(x), F.greatest(x.cast("double"), F.lit(0.0)))
