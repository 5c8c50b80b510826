"""Typed CSV scans (S1, S3, S4) and the week-partitioned parquet store
(S5-S10).

CSV is read with declared schemas (no inference pass), columns by header name
and in any order; a malformed value fails the read. The store is parquet
partitioned by ``Semana`` so reading a list of weeks prunes directories
instead of opening files by name.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..config import (CLIENT_SCHEMA, PRODUCT_SCHEMA, SALES_SCHEMA, SCORE_SCHEMA, TOWN_SCHEMA,
                      WEEK_COL)

#: Options of every CSV scan, batch and stream: headers are checked against
#: the schema and a malformed value raises.
CSV_OPTIONS = {"encoding": "UTF-8", "mode": "FAILFAST", "enforceSchema": "false"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """The columns of ``schema``, found by header name (any order, extra
    columns ignored); a file with another header than the first, or without
    one of the columns, raises. Without a header, columns go by position."""
    if not header:
        return spark.read.schema(schema).options(header=False, **CSV_OPTIONS).csv(path)
    names = spark.read.options(header=True, encoding="UTF-8").csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {names}")
    kinds = {f.name: f.dataType for f in schema.fields}
    found = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names])
    return (spark.read.schema(found).options(header=True, **CSV_OPTIONS).csv(path)
                 .select(*schema.names))


def load_sales_csv(spark: SparkSession, path: str) -> DataFrame:
    """The whole sales file(s), typed; input splits replace chunks."""
    return read_csv(spark, path, SALES_SCHEMA)


def load_score_csv(spark: SparkSession, path: str) -> DataFrame:
    """S3: score rows (id + keys)."""
    return read_csv(spark, path, SCORE_SCHEMA)


def load_dimensions(spark: SparkSession, product_path: str, town_path: str,
                    client_path: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(products, towns, clients); clients are optional and unused."""
    products = read_csv(spark, product_path, PRODUCT_SCHEMA)
    towns = read_csv(spark, town_path, TOWN_SCHEMA)
    clients = read_csv(spark, client_path, CLIENT_SCHEMA) if client_path else None
    return products, towns, clients


def save_by_week(df: DataFrame, path: str, mode: str = "overwrite",
                 cluster_by: tuple[str, ...] = ("Cliente_ID", "Producto_ID")) -> None:
    """Parquet partitioned by week.

    Rows are dealt by (week, salt): a week is spread over several tasks (by
    the week alone, one task would get a seventh of the data), each task
    writes files of a few weeks only, and even a hot key or a group of
    identical rows is split. A hash needs no sampling pass, so the upstream
    plan (the CSV scan) runs once. Inside a file rows are sorted by client and
    product, so parquet statistics can skip row groups on those keys.
    ``spark.sql.files.maxRecordsPerFile`` bounds file size at scale.
    """
    keys = [WEEK_COL] + [c for c in cluster_by if c in df.columns]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*df.columns, F.monotonically_increasing_id()), F.lit(max(1, n // 8)))
    (df.repartition(F.col(WEEK_COL), salt).sortWithinPartitions(*keys)
       .write.mode(mode).partitionBy(WEEK_COL).parquet(path))


def available_weeks(spark: SparkSession, path: str,
                    week_range: tuple[int, int] | None = None) -> list[int]:
    """All weeks present in the store, or those within an explicit range.

    Only the partition column is read, so no column of a data file is; the
    driver gets one value per week.
    """
    try:
        df = spark.read.parquet(path)
    except AnalysisException:
        return []
    if WEEK_COL not in df.columns:
        return []
    weeks = sorted(r[0] for r in df.select(WEEK_COL).distinct().collect() if r[0] is not None)
    if week_range is not None:
        weeks = [w for w in weeks if week_range[0] <= w <= week_range[1]]
    return weeks


def load_weeks(spark: SparkSession, path: str, weeks: Iterable[int]) -> DataFrame:
    """Rows of the listed weeks; raises if any week is missing."""
    weeks = sorted(set(int(w) for w in weeks))
    have = set(available_weeks(spark, path)) if weeks else set()
    missing = [w for w in weeks if w not in have]
    if missing:
        raise FileNotFoundError(f"weeks {missing} not found in {path}; run preprocessing first")
    return spark.read.parquet(path).where(F.col(WEEK_COL).isin(weeks))


def save_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Plain parquet table."""
    df.write.mode(mode).parquet(path)


def load_table(spark: SparkSession, path: str, required: bool = True,
               empty_schema: str | None = None) -> DataFrame:
    """Parquet table; a missing optional table reads as empty."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        if required or empty_schema is None:
            raise
        return spark.createDataFrame([], empty_schema)


def save_training_set(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The multi-week feature matrix, partitioned by target week
    (``mode="append"`` adds the partitions of further target weeks)."""
    df.write.mode(mode).partitionBy("target_semana").parquet(path)


def load_training_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Read back only the model columns (column pruning at the scan)."""
    return spark.read.parquet(path).select(*columns)
