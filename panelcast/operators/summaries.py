"""Small summary tables of the jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TARGET_COL, WEEK_COL


def distinct_counts(state_map: DataFrame, meta: DataFrame) -> DataFrame:
    """One row with the number of states and of brands."""
    return (state_map.agg(F.countDistinct("State").alias("n_states"))
            .crossJoin(meta.agg(F.countDistinct("brand").alias("n_brands"))))


def level_frequencies(backoff: DataFrame) -> DataFrame:
    """A10: how many rows took their estimate from each backoff level."""
    return backoff.groupBy("backoff_level").agg(F.count(F.lit(1)).alias("n")).orderBy("backoff_level")


def prediction_summary(submission: DataFrame, units: str = TARGET_COL) -> DataFrame:
    """Mean, median and largest submitted count (missing ones left out).

    The median is taken over distinct counts with their frequencies, so no
    buffer holds all values."""
    from .cumulative import exact_quantile
    rest = submission.agg(F.avg(units).alias("mean_units"), F.max(units).alias("max_units"))
    return rest.crossJoin(F.broadcast(exact_quantile(submission, units, 0.5, "median_units")))


def week_counts(df: DataFrame) -> DataFrame:
    """Rows per week."""
    return df.groupBy(WEEK_COL).agg(F.count(F.lit(1)).alias("n_rows"))
