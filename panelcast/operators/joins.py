"""Join helpers: size-checked broadcast and dimension-key checks.

Dimension tables (products, towns, encodings, brand maps) are broadcast only
after a bounded count proves they are small; above the bound the join is left
to the planner (sort-merge, or AQE's runtime broadcast when the *measured*
shuffle size is below ``spark.sql.adaptive.autoBroadcastJoinThreshold``).
Aggregated feature tables are never hinted: their size is only known at run
time, which is exactly what AQE measures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024


_CHECKED: dict = {}


def _type_bytes(t: T.DataType) -> int:
    if isinstance(t, (T.ByteType, T.BooleanType)):
        return 1
    if isinstance(t, T.ShortType):
        return 2
    if isinstance(t, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(t, (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)):
        return 8
    if isinstance(t, T.DecimalType):
        return 8 if t.precision <= 18 else 16
    if isinstance(t, (T.StringType, T.BinaryType)):
        return 20
    if isinstance(t, T.StructType):
        return sum(_type_bytes(f.dataType) for f in t.fields)
    return 100                          # arrays and maps: a generous guess


def row_bytes(df: DataFrame) -> int:
    """Estimated bytes per row from the schema (the per-type default sizes
    Spark's own estimates use; strings count 20 bytes) plus row overhead."""
    return sum(_type_bytes(f.dataType) for f in df.schema.fields) + 8


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when it has at most ``max_rows`` rows and an
    estimated size of at most ``max_bytes``, else ``df``.

    The check reads at most ``max_rows + 1`` rows (a bounded job). Its
    answer is remembered per session, plan (``semanticHash``) and input
    files, so the same dimension is counted once, not at every feature
    build, and a table rewritten in place (new part files) is counted again.
    """
    key = (df.sparkSession.sparkContext.applicationId, df.semanticHash(),
           tuple(sorted(df.inputFiles())), max_rows, max_bytes)
    small = _CHECKED.get(key)
    if small is None:
        limit = min(max_rows, max_bytes // row_bytes(df))
        small = df.limit(limit + 1).count() <= limit
        _CHECKED[key] = small
    return F.broadcast(df) if small else df


def assert_unique_keys(df: DataFrame, keys: list[str], name: str = "dimension") -> None:
    """Raise when a dimension has duplicate join keys (a join would fan out)."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(5).collect()
    if dup:
        raise ValueError(f"{name} has duplicate keys {keys}: {[tuple(r) for r in dup]}")
