"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import (byte_bpe, chat, language_id, line_dedup, ngram_join, outliers, packing, periodic_runs,
                           quality_cnn, signature_search, substring_dedup, warc, winnowing)
from panelcast.llm.oracles import SQL as SQL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mcd_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.quality(table(spark, sf_dir, "documents")).drop("row_key")


def op2_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.flat(chat.rotate(table(spark, sf_dir, "conversations")))


def op3_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.remove_repeated(table(spark, sf_dir, "documents")))


def op5_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.digest(winnowing.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op6_byte_cnn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cnn.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                held_out=language_id.remainder("doc_id", 3) == 1)


def op7_site_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = line_dedup.mark(table(spark, sf_dir, "pages"), "page_id", line_dedup.host(F.col("url")),
                             line_dedup.visible_lines(F.col("html")))
    return marked.select(F.col("id").alias("page_id"), "host", "n_lines", "n_dropped", "kept")


def op8_ngram_trie_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op9_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()))


def op10_cross_parsing_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"), held_out=language_id.remainder("doc_id", 4) == 2)


def op11_signature_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.runs(table(spark, sf_dir, "documents"), plant=True))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.digest(byte_bpe.decode(encoded, ranks))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_mcd_outliers, op2_perspective_rotation, op3_warc_round_trip, op4_substring_dedup,
        op5_winnowing_decontamination, op6_byte_cnn_quality, op7_site_line_dedup, op8_ngram_trie_join,
        op9_hierarchical_packing, op10_cross_parsing_langid, op11_signature_search, op12_periodic_runs,
        op13_byte_bpe, pipeline)
}
