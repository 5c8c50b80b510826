"""Incremental ingest of sales files into the week-partitioned store.

A file-source stream with a declared schema reads new CSV files in bounded
micro-batches (``maxFilesPerTrigger``), with the options of the batch scan: a
file whose header does not match, or a malformed value, fails the batch
instead of being stored as null; the parquet file sink, partitioned
by week, commits each batch through its own metadata log, so a retried batch
after an executor or driver failure is written exactly once. ``availableNow``
processes everything present and stops, which makes the same query usable
as a scheduled incremental job.

``ingest_with_rejects`` is the lenient form: files may have their columns in
any order, and rows that cannot be read go to a table of rejected rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import SALES_SCHEMA, WEEK_COL
from ..sources.files import CSV_OPTIONS


def sales_stream(spark: SparkSession, source_dir: str, files_per_batch: int = 1,
                 schema=SALES_SCHEMA) -> DataFrame:
    return (spark.readStream.schema(schema).options(header=True, **CSV_OPTIONS)
                 .option("maxFilesPerTrigger", files_per_batch).csv(source_dir))


def start_ingest(spark: SparkSession, source_dir: str, store_dir: str, checkpoint_dir: str,
                 files_per_batch: int = 1, transform=None) -> StreamingQuery:
    """Start the stream into ``store_dir`` (parquet, partitioned by week).

    ``transform`` may map each micro-batch's rows (e.g. dimension joins of
    preprocessing; static dimension tables join per batch without state).
    """
    src = sales_stream(spark, source_dir, files_per_batch)
    if transform is not None:
        src = transform(src)
    return (src.writeStream.format("parquet").option("path", store_dir)
               .option("checkpointLocation", checkpoint_dir)
               .partitionBy(WEEK_COL).outputMode("append")
               .trigger(availableNow=True).start())


def ingest_available(spark: SparkSession, source_dir: str, store_dir: str, checkpoint_dir: str,
                     files_per_batch: int = 1, transform=None, timeout_s: float | None = None) -> int:
    """Run the ingest until all present files are committed; returns the
    number of micro-batches run."""
    q = start_ingest(spark, source_dir, store_dir, checkpoint_dir, files_per_batch, transform)
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("ingest did not finish in time")
    if q.exception() is not None:
        raise q.exception()
    return len(q.recentProgress)


#: Columns of a file listing as a stream; contents are not read.
_LISTING = "path string, modificationTime timestamp, length long, content binary"
BATCH_COL = "ingest_batch"
REJECT_SCHEMA = f"file string, line string, reason string, {BATCH_COL} long"
_NOTES = ("file", "line", "reason")
REASON_VALUE = "malformed row"
REASON_COLUMNS = "missing columns"


def read_with_rejects(spark: SparkSession, paths: list[str], schema=SALES_SCHEMA) -> DataFrame:
    """Rows of CSV files with any headers: the columns of ``schema``, file, and
    for a rejected row its line and the reason (else null).

    Columns are found by name in each file, in any order, others ignored.
    Rejected are rows with a malformed value or another number of fields than
    their header, and all rows of a file whose header lacks a column (an empty
    file has none and gives no rows). Files with equal headers are read
    together, so the driver holds one plan per distinct header.
    """
    headers: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        names = spark.read.options(header=True, encoding="UTF-8").csv(path).columns
        headers.setdefault(tuple(names), []).append(path)
    kinds = {f.name: f.dataType for f in schema.fields}
    out = spark.createDataFrame([], T.StructType([*schema.fields, *(T.StructField(c, T.StringType()) for c in _NOTES)]))
    file = F.col("_metadata.file_path").alias("file")
    for names, group in headers.items():
        missing = [n for n in schema.names if n not in names]
        if missing:
            rows = (spark.read.options(header=True, encoding="UTF-8", sep="\u0001", quote="").schema("line string").csv(group)
                         .select(*(F.lit(None).cast(t).alias(n) for n, t in kinds.items()), file, "line",
                                 F.lit(f"{REASON_COLUMNS}: {', '.join(missing)}").alias("reason")))
        else:
            # By position, as the header of these files is known; extra columns stay text.
            fields = [T.StructField(f"c{i}", kinds.get(n, T.StringType())) for i, n in enumerate(names)]
            rows = (spark.read.schema(T.StructType([*fields, T.StructField("__line", T.StringType())]))
                         .options(header=True, encoding="UTF-8", mode="PERMISSIVE", columnNameOfCorruptRecord="__line").csv(group)
                         .select(*(F.col(f"c{names.index(n)}").alias(n) for n in schema.names), file, F.col("__line").alias("line"),
                                 F.when(F.col("__line").isNotNull(), REASON_VALUE).alias("reason")))
        out = out.unionByName(rows)
    return out


def store_batch(spark: SparkSession, paths: list[str], batch_id: int, store_dir: str, rejects_dir: str,
                schema=SALES_SCHEMA) -> None:
    """Write the rows of ``paths`` to the store and the rejects, both below the
    number of their batch: run again, it replaces what it wrote before."""
    # Kept for the two writes, so the files are parsed once.
    rows = read_with_rejects(spark, paths, schema).withColumn(BATCH_COL, F.lit(batch_id).cast("long")).persist()
    good = rows.where("reason IS NULL").drop(*_NOTES)
    bad = rows.where("reason IS NOT NULL").select(*_NOTES, BATCH_COL)
    for df, keys, path in ((good, [WEEK_COL, BATCH_COL], store_dir), (bad, [BATCH_COL], rejects_dir)):
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path))
    rows.unpersist()


def ingest_with_rejects(spark: SparkSession, source_dir: str, store_dir: str, rejects_dir: str, checkpoint_dir: str,
                        files_per_batch: int = 1, schema=SALES_SCHEMA, timeout_s: float | None = None) -> None:
    """Ingest all present files: stored rows by week and batch, rejected rows by
    batch (see ``read_with_rejects``).

    The stream carries file names only, at most ``files_per_batch`` a batch; the
    rows are read inside ``foreachBatch``. A batch that is run again after a
    failure replaces its own partitions in both tables, so each row is stored or
    rejected once as long as the checkpoint folder is kept.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        paths = [r.path for r in batch.select("path").collect()]
        store_batch(batch.sparkSession, paths, batch_id, store_dir, rejects_dir, schema)

    files = (spark.readStream.format("binaryFile").schema(_LISTING).option("pathGlobFilter", "*.csv")
                  .option("maxFilesPerTrigger", files_per_batch).load(source_dir))
    q = (files.select("path").writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir)
              .trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("ingest did not finish in time")
    if q.exception() is not None:
        raise q.exception()


def rejected_rows(spark: SparkSession, rejects_dir: str) -> DataFrame:
    """All rejected rows, none if no file had any."""
    return spark.read.schema(REJECT_SCHEMA).parquet(rejects_dir)


def preprocess_transform(meta: DataFrame, towns: DataFrame, state_map: DataFrame):
    """Per-micro-batch preprocessing for ``start_ingest(transform=...)``.

    Product attributes and state codes come from static dimension tables
    (stream-static left joins, no state kept); ``state_map`` is the encoding
    fitted by the batch preprocessing job, so streamed and batch rows get
    the same codes.
    """
    from ..operators.clean import preprocess

    def transform(stream: DataFrame) -> DataFrame:
        return preprocess(stream, meta, towns, state_map)
    return transform
