"""Lookups in tables whose keys may be hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1_000        # a key with more than 1 / HOT_SHARE of all rows is hot


def lookup(left: DataFrame, right: DataFrame, key: str, weight: str, row_id: Column, total: int) -> DataFrame:
    """Left join of ``right``, which has one row per ``key`` and in ``weight``
    the number of left rows with it (of ``total``). It must have a row for
    every key that may be hot, be it of nulls.

    At most ``HOT_SHARE`` keys can be hot, whatever the data, so their rows of
    ``right`` are broadcast. The others are joined by a shuffle in which no
    key has more than 1 / HOT_SHARE of the rows; rows already served are dealt
    by ``row_id`` there. Null keys find nothing.
    """
    values = [c for c in right.columns if c not in (key, weight)]
    own = F.concat(F.lit("k"), F.col(key).cast("string"))
    hot = right.where(F.col(weight) * HOT_SHARE > total).select(F.col(key).alias("hot_key"), *(F.col(c).alias(f"hot_{c}") for c in values))
    cold = right.where(F.col(weight) * HOT_SHARE <= total).select(own.alias("cold_key"), *(F.col(c).alias(f"cold_{c}") for c in values))
    served = F.col("hot_key").isNotNull() | F.col(key).isNull()
    once = (left.join(F.broadcast(hot), left[key] == F.col("hot_key"), "left")
            .withColumn("dealt_by", F.when(served, F.concat(F.lit("r"), row_id.cast("string"))).otherwise(own)))
    both = once.join(cold, F.col("dealt_by") == F.col("cold_key"), "left")
    return both.select(*left.columns, *(F.coalesce(f"hot_{c}", f"cold_{c}").alias(c) for c in values))
