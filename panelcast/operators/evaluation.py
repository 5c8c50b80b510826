"""Evaluation: overall and per-segment metrics, splits, CV folds, histograms
and samples (E5-E13, O2-O3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import CLIP_PERCENTILE, CV_MIN_TRAIN_WEEKS, ERROR_BINS, SAMPLE_SEED, WEEK_COL
from ..functions.metrics import all_metrics
from ..functions.values import known, number
from ..session import materialize
from .cumulative import exact_quantile

METRIC_COLS = ["rmse", "mae", "bias", "rmsle"]


def evaluate(df: DataFrame, y: str, p: str) -> DataFrame:
    """E5: one row with rmse, mae, bias, rmsle (one pass)."""
    return df.agg(*all_metrics(y, p))


def evaluate_by_segment(df: DataFrame, y: str, p: str, segment: str) -> DataFrame:
    """Segment, n (rows that the metrics use), metrics; worst RMSE first,
    ties by segment key.

    Rows with a null segment are dropped (they form no group in the
    reference semantics).
    """
    return (df.where(F.col(segment).isNotNull())
              .groupBy(segment)
              .agg(F.count(F.when(known(F.col(y)) & known(F.col(p)), 1)).alias("n"), *all_metrics(y, p))
              .orderBy(F.desc("rmse"), F.asc(segment)))


def worst_segments(df: DataFrame, y: str, p: str, segment: str, n: int) -> DataFrame:
    """The n segments with the highest RMSE (top-k, no full sort)."""
    return evaluate_by_segment(df, y, p, segment).limit(n)


def temporal_split(df: DataFrame, val_week: int) -> tuple[DataFrame, DataFrame]:
    """(weeks < v, week = v)."""
    return df.where(F.col(WEEK_COL) < val_week), df.where(F.col(WEEK_COL) == val_week)


def cv_fold_table(df: DataFrame, min_train_weeks: int = CV_MIN_TRAIN_WEEKS) -> DataFrame:
    """E8 as a table: (fold, val_semana, Semana, role) for every observed week.

    A fold exists for each observed week with at least ``min_train_weeks``
    earlier observed weeks; its training weeks are all earlier ones. Built
    from the distinct weeks only (one row per week).
    """
    weeks = df.select(WEEK_COL).distinct()
    ranked = weeks.withColumn("__i", F.row_number().over(Window.orderBy(WEEK_COL)) - 1)
    vals = (ranked.where(F.col("__i") >= min_train_weeks)
                  .select(F.col(WEEK_COL).alias("val_semana"),
                          (F.col("__i") - min_train_weeks + 1).alias("fold")))
    pairs = weeks.crossJoin(vals).where(F.col(WEEK_COL) <= F.col("val_semana"))
    return pairs.select("fold", "val_semana", WEEK_COL,
                        F.when(F.col(WEEK_COL) == F.col("val_semana"), F.lit("val"))
                         .otherwise(F.lit("train")).alias("role"))


def rolling_window_cv(df: DataFrame, min_train_weeks: int = CV_MIN_TRAIN_WEEKS
                      ) -> list[tuple[DataFrame, DataFrame]]:
    """List of (train, val) frames. The week list (one value per observed
    week, so bounded by the calendar) is the only thing collected."""
    weeks = sorted(r[0] for r in df.select(WEEK_COL).distinct().collect())
    folds = []
    for i, v in enumerate(weeks):
        if i >= min_train_weeks:
            folds.append((df.where(F.col(WEEK_COL) < v), df.where(F.col(WEEK_COL) == v)))
    return folds


def histogram(df: DataFrame, value: str, bins: int = ERROR_BINS,
              range_frame: DataFrame | None = None) -> DataFrame:
    """Equal-width histogram over [min, max] with every bin listed.

    Bin i covers [lo + i w, lo + (i+1) w); the last bin is closed, so the
    maximum lands in it (``width_bucket`` would put it in bin n+1). A
    constant sample uses [x - 0.5, x + 0.5]. ``range_frame`` may supply a
    one-row (lo, hi) instead of the data's own range.
    """
    v = F.col(value).cast("double")
    data = df.where(known(v)).select(v.alias("__x"))
    if range_frame is None:
        range_frame = data.agg(F.min("__x").alias("lo"), F.max("__x").alias("hi"))
    rng = range_frame.select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("__lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("__hi"))
    x = data.crossJoin(F.broadcast(rng))
    idx = F.floor((F.col("__x") - F.col("__lo")) * (F.lit(float(bins)) / (F.col("__hi") - F.col("__lo"))))
    idx = F.least(F.greatest(idx, F.lit(0)), F.lit(bins - 1))
    # The quotient can round across an edge: compare with the edges themselves.
    width = (F.col("__hi") - F.col("__lo")) / F.lit(float(bins))
    edge = lambda i: F.col("__lo") + i * width
    x = x.withColumn("__i", idx)
    idx = (F.when((F.col("__i") > 0) & (F.col("__x") < edge(F.col("__i"))), F.col("__i") - 1)
            .when((F.col("__i") < bins - 1) & (F.col("__x") >= edge(F.col("__i") + 1)), F.col("__i") + 1)
            .otherwise(F.col("__i")))
    counts = (x.where((F.col("__x") >= F.col("__lo")) & (F.col("__x") <= F.col("__hi")))
               .select(idx.cast("int").alias("bin"))
               .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    spark = df.sparkSession
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(F.broadcast(rng))
    return (grid.join(counts, "bin", "left")
                .select("bin",
                        edge(F.col("bin")).alias("lo"),
                        F.when(F.col("bin") == bins - 1, F.col("__hi")).otherwise(edge(F.col("bin") + 1)).alias("hi"),
                        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))


def clipped_values(df: DataFrame, value: str, q: float = CLIP_PERCENTILE) -> DataFrame:
    """Rows with -c < value < c, c = q-quantile of |value| (exact)."""
    absd = df.select(F.abs(F.col(value).cast("double")).alias("__a"))
    c = exact_quantile(absd, "__a", q, "__c")
    v = F.col(value).cast("double")
    return (df.crossJoin(F.broadcast(c)).where((v > -F.col("__c")) & (v < F.col("__c")))
              .drop("__c"))


def error_histograms(df: DataFrame, y: str, p: str, bins: int = ERROR_BINS) -> DataFrame:
    """Histograms of pred - actual, all errors ("all") and those inside
    +-p99 of |error| ("clipped")."""
    # One column, written once: both histograms and the quantile read it.
    e = materialize(df.select((F.col(p).cast("double") - F.col(y).cast("double")).alias("error")),
                    "errors")
    h_all = histogram(e, "error", bins).withColumn("variant", F.lit("all"))
    h_clip = histogram(clipped_values(e, "error"), "error", bins).withColumn("variant", F.lit("clipped"))
    return h_all.unionByName(h_clip).select("variant", "bin", "lo", "hi", "n")


def seeded_sample(df: DataFrame, n: int, key_cols: list[str], seed: int = SAMPLE_SEED) -> DataFrame:
    """Exactly min(n, rows) rows: the n smallest MD5 digests of the seed
    and ``key_cols`` (any engine can take the same sample).

    Deterministic and distributed. A bare ``orderBy(h).limit(n)`` would merge
    up to n rows from *every* partition in one task; here rows are first
    filtered to hash < t, with t set from n / N plus a safety margin (raised
    and retried in the rare case too few rows pass), so the final top-n
    merge sees about n rows whatever the partition count. The result is the
    same rows as the plain top-n. Pass key columns that identify a row.
    """
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols]))
    hashed = df.withColumn("__h", key)
    total = df.count()
    if total <= n:
        return df
    frac = min(1.0, n / total * 1.05 + 6.0 * (n ** 0.5) / total)
    while True:
        cand = hashed if frac >= 1.0 else hashed.where(F.col("__h") < F.lit(f"{int(frac * (1 << 52)):013x}"))
        if frac >= 1.0 or cand.count() >= n:
            break
        frac = min(1.0, frac * 2)
    return cand.orderBy("__h", *key_cols).limit(n).drop("__h")


def sample_limits(df: DataFrame, y: str, p: str, q: float = CLIP_PERCENTILE) -> DataFrame:
    """One row with the axis limits of the predicted-vs-actual chart:
    max of both and the q-quantiles of actual and predicted."""
    ya = exact_quantile(df.select(F.col(y).cast("double").alias("v")), "v", q, "actual_p99")
    pa = exact_quantile(df.select(F.col(p).cast("double").alias("v")), "v", q, "predicted_p99")
    mx = df.agg(F.greatest(F.max(number(F.col(y))), F.max(number(F.col(p)))).alias("max_value"))
    return mx.crossJoin(ya).crossJoin(pa)


def residuals(df: DataFrame, y: str, p: str) -> DataFrame:
    """Predicted value and residual (actual - predicted) per row."""
    return df.select(F.col(p).cast("double").alias("predicted"),
                     (F.col(y).cast("double") - F.col(p).cast("double")).alias("residual"))
