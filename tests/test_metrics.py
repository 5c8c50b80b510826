"""Metrics, segments, histograms, quantiles, ECDF and KS."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import cumulative, drift, evaluation


def _df(spark, y, p, seg=None):
    rows = [(float(a), float(b), s) for a, b, s in zip(y, p, seg or [None] * len(y))]
    return spark.createDataFrame(rows, "actual double, predicted double, segment string")


def _m(spark, y, p):
    return evaluation.evaluate(_df(spark, y, p), "actual", "predicted").first()


def test_metrics_by_hand(spark):
    m = _m(spark, [0, 10, 4], [3, 6, 4])                     # errors 3, -4, 0
    assert m.rmse == pytest.approx((25 / 3) ** 0.5)
    assert m.mae == pytest.approx(7 / 3)
    assert m.bias == pytest.approx(-1 / 3)
    logs = [math.log1p(3), math.log1p(6) - math.log1p(10), 0.0]
    assert m.rmsle == pytest.approx((sum(x * x for x in logs) / 3) ** 0.5)
    assert _m(spark, [2, 0], [2, -5]).rmsle == 0.0           # negative predictions count as 0


@pytest.mark.parametrize("missing", [None, float("nan")])
def test_metrics_use_the_same_known_rows(spark, missing):
    rows = [(5.0, 5.0), (100.0, missing), (missing, 7.0), (8.0, 6.0)]
    df = spark.createDataFrame(rows, "actual double, predicted double")
    m = evaluation.evaluate(df, "actual", "predicted").first()
    known = evaluation.evaluate(df.where("actual in (5, 8)"), "actual", "predicted").first()
    assert m == known and m.bias == -1.0
    none = evaluation.evaluate(df.where("actual = 100"), "actual", "predicted").first()
    assert tuple(none) == (None, None, None, None)


def test_segments_are_ranked_by_error(spark):
    df = _df(spark, [10, 20, 30, 40, 50], [10, 21, 33, 43, 50], ["s", "t", "u", "u", None])
    out = evaluation.evaluate_by_segment(df, "actual", "predicted", "segment").collect()
    assert [(r.segment, r.n, r.rmse) for r in out] == [("u", 2, 3.0), ("t", 1, 1.0), ("s", 1, 0.0)]
    tied = _df(spark, [1, 1], [2, 2], ["z", "y"])
    assert [r.segment for r in evaluation.evaluate_by_segment(tied, "actual", "predicted", "segment").collect()] == ["y", "z"]


@pytest.mark.parametrize("lo,hi,bins", [(-60, -4, 100), (0, 49, 100), (-7, 13, 30), (1, 4, 3), (-59, 58, 37)])
def test_histogram_of_integers_equals_numpy(spark, lo, hi, bins):
    x = list(range(lo, hi + 1))
    df = spark.createDataFrame([(float(v),) for v in [*x, x[0], x[-1]]] + [(None,), (float("nan"),)], "x double")
    h = evaluation.histogram(df, "x", bins).orderBy("bin").toPandas()
    counts, edges = np.histogram([*x, x[0], x[-1]], bins=bins)
    assert h.n.tolist() == counts.tolist()
    np.testing.assert_allclose(h.hi.to_numpy(), edges[1:], atol=1e-12)


def test_drift_leaves_missing_values_out(spark):
    nan = float("nan")
    ref = spark.createDataFrame([(1.0,), (nan,), (2.0,), (None,)], "prediction double")
    cur = spark.createDataFrame([(2.0,), (3.0,), (nan,)], "prediction double")
    out = drift.prediction_drift(ref, cur).first()
    assert (out.ks_statistic, out.reference_mean, out.current_mean) == (0.5, 1.5, 2.5)
    feat = drift.feature_drift(ref, cur, ["prediction"]).first()
    assert (feat.ks_statistic, feat.ref_mean, feat.cur_mean) == (0.5, 1.5, 2.5)


def test_p_value_has_one_method_at_every_size(spark):
    """The p-value of the same D and effective size does not jump at 10,000,
    and no verdict is null; the exact option raises where it cannot run."""
    def run(n, **kw):
        ref = spark.range(n).select(F.col("id").cast("double").alias("prediction"))
        cur = ref.select((F.col("prediction") + int(0.0193 * n)).alias("prediction"))
        return drift.prediction_drift(ref, cur, **kw).first()
    small, large = run(10_000), run(10_001)
    assert small.p_value == pytest.approx(large.p_value, rel=0.02)
    assert small.drift_detected is not None and large.drift_detected is not None
    with pytest.raises(Exception, match="limited to 10000 values"):
        run(10_001, method="exact")
    with pytest.raises(ValueError):
        run(10, method="auto")


def test_buckets_follow_the_number_of_values(spark):
    vc = spark.range(100).select(F.col("id").alias("v"), F.lit(1).alias("n"))
    assert cumulative.bucket_count(vc) == 1
    many = spark.range(cumulative.BUCKET_ROWS * 100 + 1).select("id")
    assert cumulative.bucket_count(many) == 101


@pytest.mark.parametrize("fan", [2, 3, 1_024])
def test_cumulative_sums_over_levels_of_ranges(spark, fan):
    """One, several and many levels of range totals give NumPy's running sums;
    one group has a single value, one most of them."""
    rng = np.random.RandomState(11)
    rows = [(g, float(v), int(rng.randint(1, 9)), int(rng.randint(0, 3)))
            for g, n in (("a", 400), ("b", 1), ("c", 37)) for v in rng.permutation(1000)[:n] / 7 - 60]
    df = spark.createDataFrame(rows, "g string, v double, n int, k int").repartition(5)
    got = cumulative.cumulative_sums(df, "v", ["n", "k"], ["g"], buckets=23, fan=fan).toPandas()
    assert len(got) == len(rows)
    for g, part in got.sort_values(["g", "v"]).groupby("g"):
        np.testing.assert_array_equal(part.cum_n, part.n.cumsum())
        np.testing.assert_array_equal(part.cum_k, part.k.cumsum())
    alone = cumulative.cumulative_sums(df.where("g = 'a'").drop("g"), "v", ["n"], buckets=9, fan=fan).toPandas().sort_values("v")
    np.testing.assert_array_equal(alone.cum_n, alone.n.cumsum())
    assert cumulative.cumulative_sums(df.limit(0), "v", ["n"], ["g"], fan=fan).count() == 0


def test_histogram_matches_numpy(spark):
    rng = np.random.RandomState(1)
    x = np.round(rng.normal(size=997) * 10, 3)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    h = evaluation.histogram(df, "x", 100).orderBy("bin").toPandas()
    counts, edges = np.histogram(x, bins=100)
    assert h.n.tolist() == counts.tolist()
    np.testing.assert_allclose(h.lo.to_numpy(), edges[:-1], atol=1e-9)


def test_histogram_constant(spark):
    df = spark.createDataFrame([(3.0,)] * 5, "x double")
    h = evaluation.histogram(df, "x", 10).orderBy("bin").toPandas()
    counts, edges = np.histogram(np.full(5, 3.0), bins=10)
    assert h.n.tolist() == counts.tolist()


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.99, 1.0])
def test_exact_quantile(spark, q):
    rng = np.random.RandomState(3)
    x = rng.randint(0, 50, size=1001).astype(float)
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = cumulative.exact_quantile(df, "v", q, "q", buckets=16).first().q
    assert got == pytest.approx(np.percentile(x, q * 100))


def _ks_d(a, b):
    allv = np.sort(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), allv, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), allv, side="right") / len(b)
    return np.abs(fa - fb).max()


def test_ks_statistic_matches_brute_force(spark):
    rng = np.random.RandomState(5)
    a = rng.poisson(5, 700).astype(float)
    b = rng.poisson(6, 900).astype(float)
    ref = spark.createDataFrame([(float(v),) for v in a], "prediction double")
    cur = spark.createDataFrame([(float(v),) for v in b], "prediction double")
    out = drift.prediction_drift(ref, cur).first()
    assert out.ks_statistic == pytest.approx(_ks_d(a, b))
    assert out.drift_detected and out.p_value < 0.05
    assert out.reference_std == pytest.approx(a.std())     # population std
    same = drift.prediction_drift(ref, ref).first()
    assert same.ks_statistic == 0 and same.p_value == 1.0 and not same.drift_detected


def test_feature_drift_skips_and_sorts(spark):
    ref = spark.createDataFrame([(1.0, None, 1.0), (2.0, None, 2.0), (3.0, None, 3.0)], "a double, b double, c double")
    cur = spark.createDataFrame([(10.0, 1.0, 1.0), (11.0, 2.0, 2.0), (12.0, 3.0, 3.0)], "a double, b double, c double")
    out = drift.feature_drift(ref, cur, ["a", "b", "c", "zz"]).collect()
    assert [r.feature for r in out] == ["a", "c"]        # b empty on one side, zz absent
    assert out[0].ks_statistic == 1.0 and out[1].ks_statistic == 0.0


def test_ecdf_heights(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 2.0, 5.0]], "value double")
    e = cumulative.ecdf(df, "value").orderBy("value").collect()
    assert [(r.value, r.cum) for r in e] == [(1.0, 1), (2.0, 3), (5.0, 4)]
    lin = np.linspace(0, 1, 4)
    assert [r.ecdf for r in e] == pytest.approx([lin[0], lin[2], lin[3]])


def test_bias_monitor(spark):
    df = _df(spark, [1, 1, 1, 1], [1, 1, 1, 5], list("AABB"))
    out = {r.segment: r for r in drift.bias_monitor(df, "actual", "predicted", "segment").collect()}
    assert out["B"].bias == 2.0 and out["A"].bias == 0.0 and out["B"].overall_bias == 1.0
    assert not out["B"].high_bias and not out["A"].high_bias


def test_seeded_sample_exact_size(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    s1 = evaluation.seeded_sample(df, 100, ["k"]).collect()
    s2 = evaluation.seeded_sample(df, 100, ["k"]).collect()
    assert len(s1) == 100 and s1 == s2
    assert evaluation.seeded_sample(df, 5000, ["k"]).count() == 1000


def test_cv_folds(spark):
    df = spark.createDataFrame([(w,) for w in [3, 4, 5, 6, 7, 9]], "Semana int")
    folds = evaluation.rolling_window_cv(df)
    assert len(folds) == 3
    tab = evaluation.cv_fold_table(df).where(F.col("role") == "val").orderBy("fold").collect()
    assert [(r.fold, r.val_semana) for r in tab] == [(1, 6), (2, 7), (3, 9)]


def _brute_ks_p(k, m, n):
    import itertools
    tot = out = 0
    for pos in itertools.combinations(range(m + n), m):
        ps, i, j, worst = set(pos), 0, 0, 0
        for t in range(m + n):
            if t in ps:
                i += 1
            else:
                j += 1
            worst = max(worst, abs(i * n - j * m))
        tot += 1
        out += worst >= k
    return out / tot


@pytest.mark.parametrize("m,n", [(3, 4), (5, 5), (4, 7), (2, 9)])
def test_exact_ks_pvalue_matches_enumeration(m, n):
    for k in range(0, m * n + 2):
        assert cumulative.ks_exact_pvalue_np(k, m, n) == pytest.approx(_brute_ks_p(k, m, n), abs=1e-12)


def test_exact_ks_through_spark(spark):
    a = [1.0, 2.5, 3.0, 7.0, 9.0]
    b = [0.5, 4.0, 4.5, 6.0, 8.0, 10.0, 11.0]
    ref = spark.createDataFrame([(v,) for v in a], "prediction double")
    cur = spark.createDataFrame([(v,) for v in b], "prediction double")
    out = drift.prediction_drift(ref, cur, method="exact").first()
    d = _ks_d(np.array(a), np.array(b))
    assert out.ks_statistic == pytest.approx(d)
    assert out.p_value == pytest.approx(_brute_ks_p(round(d * 5 * 7), 5, 7))


def test_missing_values_in_bias_limits_and_segments(spark):
    """Null and NaN are left out alike, and n counts the rows that are used."""
    from panelcast.operators import evaluation
    rows = [(1.0, 2.0, "a"), (3.0, float("nan"), "a"), (4.0, 6.0, "b"), (5.0, None, "b"), (None, 1.0, "b")]
    df = spark.createDataFrame(rows, "y double, p double, s string")
    bias = {r.s: (r.n, r.bias, r.overall_bias, r.high_bias) for r in drift.bias_monitor(df, "y", "p", "s", factor=1.2).collect()}
    assert bias == {"a": (1, 1.0, 1.5, False), "b": (1, 2.0, 1.5, True)}
    assert evaluation.sample_limits(df, "y", "p").first().max_value == 6.0
    assert {r.s: (r.n, r.rmse) for r in evaluation.evaluate_by_segment(df, "y", "p", "s").collect()} == {"a": (1, 1.0), "b": (1, 2.0)}
