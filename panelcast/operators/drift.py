"""Drift and bias monitoring.

KS statistics come from ``cumulative.ks_from_counts``: exact D, and the
asymptotic p-value at every sample size. Feature drift unpivots both frames
into (feature, value) rows so all features are tested in one job, grouped by
feature. Null and NaN values are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DRIFT_BINS, DRIFT_THRESHOLD, HIGH_BIAS_FACTOR
from ..functions.values import known, number
from .cumulative import ecdf, ks_from_counts, side_counts, side_moments
from .evaluation import histogram


def _tagged(ref: DataFrame, ref_col: str, cur: DataFrame, cur_col: str) -> DataFrame:
    return (ref.select(F.col(ref_col).cast("double").alias("value"), F.lit(True).alias("is_ref"))
               .unionByName(cur.select(F.col(cur_col).cast("double").alias("value"),
                                       F.lit(False).alias("is_ref"))))


def prediction_drift(ref: DataFrame, cur: DataFrame, ref_col: str = "prediction",
                     cur_col: str | None = None, threshold: float = DRIFT_THRESHOLD,
                     method: str = "asymp") -> DataFrame:
    """One row: ks_statistic, p_value, drift_detected, reference/current
    mean and population std. ``method`` as in ``cumulative.ks_from_counts``."""
    cur_col = cur_col or ref_col
    vc = side_counts(_tagged(ref, ref_col, cur, cur_col), "value", "is_ref")
    ks = ks_from_counts(vc, "value", method=method)
    mom = side_moments(vc, "value").select(
        F.col("ref_mean").alias("reference_mean"), F.col("cur_mean").alias("current_mean"),
        F.col("ref_std").alias("reference_std"), F.col("cur_std").alias("current_std"))
    return ks.crossJoin(mom).select(
        "ks_statistic", "p_value", (F.col("p_value") < threshold).alias("drift_detected"),
        "reference_mean", "current_mean", "reference_std", "current_std")


def _long(df: DataFrame, cols: list[str], is_ref: bool) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                      for c in cols])
    return (df.select(F.explode(pairs).alias("__kv"))
              .select("__kv.feature", "__kv.value", F.lit(is_ref).alias("is_ref")))


def feature_drift(ref: DataFrame, cur: DataFrame, feature_cols: list[str],
                  threshold: float = DRIFT_THRESHOLD, method: str = "asymp") -> DataFrame:
    """Per feature present in both frames: ks_statistic, p_value,
    drift_detected, ref_mean, cur_mean; missing values dropped, features with an
    empty side skipped; sorted by p-value (then name)."""
    cols = [c for c in feature_cols if c in ref.columns and c in cur.columns]
    if not cols:
        return ref.sparkSession.createDataFrame(
            [], "feature string, ks_statistic double, p_value double, drift_detected boolean, "
                "ref_mean double, cur_mean double")
    both = (_long(ref, cols, True).unionByName(_long(cur, cols, False))
            .where(known(F.col("value"))))
    vc = side_counts(both, "value", "is_ref", ["feature"])
    ks = ks_from_counts(vc, "value", ["feature"], method=method)
    means = side_moments(vc, "value", ["feature"]).select("feature", "ref_mean", "cur_mean")
    return (ks.where((F.col("n_ref") > 0) & (F.col("n_cur") > 0))
              .join(means, "feature")
              .select("feature", "ks_statistic", "p_value",
                      (F.col("p_value") < threshold).alias("drift_detected"),
                      "ref_mean", "cur_mean")
              .orderBy("p_value", "feature"))


def bias_monitor(df: DataFrame, y: str, p: str, segment: str,
                 factor: float = HIGH_BIAS_FACTOR) -> DataFrame:
    """Per segment: bias, the overall bias, and high_bias when
    |segment bias| > factor * |overall bias|. ``n`` and both biases are of the
    rows in which actual and predicted value are known."""
    e = number(F.col(p)) - number(F.col(y))
    overall = df.agg(F.avg(e).alias("overall_bias"))
    seg = df.groupBy(segment).agg(F.count(e).alias("n"), F.avg(e).alias("bias"))
    return (seg.crossJoin(F.broadcast(overall))
               .withColumn("high_bias",
                           F.abs(F.col("bias")) > F.lit(factor) * F.abs(F.col("overall_bias"))))


def drift_report(ref: DataFrame, cur: DataFrame, ref_col: str = "prediction",
                 cur_col: str | None = None, bins: int = DRIFT_BINS) -> tuple[DataFrame, DataFrame]:
    """(densities, ecdfs) of both samples.

    densities: sample, bin, lo, hi, n, density = n / (N * width), each sample
    over its own range. ecdfs: sample, value, n, cum, ecdf_lo, ecdf.
    """
    cur_col = cur_col or ref_col
    parts, curves = [], []
    for name, df, c in (("reference", ref, ref_col), ("current", cur, cur_col)):
        h = histogram(df, c, bins)
        tot = h.agg(F.sum("n").alias("__N"))
        parts.append(h.crossJoin(F.broadcast(tot)).select(
            F.lit(name).alias("sample"), "bin", "lo", "hi", "n",
            F.try_divide(F.col("n"), F.col("__N") * (F.col("hi") - F.col("lo"))).alias("density")))
        curves.append(ecdf(df.select(F.col(c).cast("double").alias("value")), "value")
                      .select(F.lit(name).alias("sample"), "*"))
    return parts[0].unionByName(parts[1]), curves[0].unionByName(curves[1])
