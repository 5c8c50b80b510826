"""Sorted-index encoders for strings (F5 state, F6 brand).

The code of a value is its position among the distinct values in byte order,
the order a label encoder fitted on the values gives. Encoding tables are
computed from a *distinct* projection, so the window that numbers them only
ever sees the distinct values (states, brands), never the facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def fit_encoding(values: DataFrame, col: str, code_col: str) -> DataFrame:
    """(value, code) for the distinct non-null values of ``col``, codes 0..n-1."""
    d = values.select(col).where(F.col(col).isNotNull()).distinct()
    return d.select(col, (F.row_number().over(Window.orderBy(col)) - 1).alias(code_col))


def apply_encoding(df: DataFrame, col: str, encoding: DataFrame, code_col: str,
                   unseen: str = "max_plus_one") -> DataFrame:
    """Left-join the codes; unseen values get max+1 (or stay null)."""
    from ..operators.joins import broadcast_if_small
    out = df.join(broadcast_if_small(encoding), col, "left")
    if unseen == "max_plus_one":
        top = encoding.agg((F.max(code_col) + 1).alias("__unseen"))
        out = (out.crossJoin(F.broadcast(top))
                  .withColumn(code_col, F.coalesce(F.col(code_col), F.col("__unseen")))
                  .drop("__unseen"))
    return out
