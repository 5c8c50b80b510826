"""Intermediate tables in the shared folder, and their removal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.session import scratch_path


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written once as Parquet below ``spark.checkpoint.dir`` and read
    back, with its path: lineage ends there and every reader sees one result."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def forget(spark: SparkSession, path: str) -> None:
    """Delete a table that ``written`` made and nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
