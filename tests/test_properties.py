"""Property-based checks on random small panels (gaps, duplicate rows per
pair-week, zeros): the Spark operators equal a plain pandas statement of
the same semantics."""

import numpy as np
import pytest
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelcast import config as C
from panelcast.operators import aggregates, lags
from test_features import expected_lags

ROW = st.tuples(st.integers(3, 9), st.integers(1, 4), st.integers(1, 3), st.integers(0, 20))


def _frame(spark, rows):
    pdf = pd.DataFrame(rows, columns=["Semana", "Cliente_ID", "Producto_ID", C.TARGET_COL])
    pdf["Agencia_ID"] = pdf.Cliente_ID % 2
    pdf["Ruta_SAK"] = pdf.Producto_ID % 2
    pdf["Canal_ID"] = 1
    schema = ("Semana int, Cliente_ID long, Producto_ID long, Demanda_uni_equil long, "
              "Agencia_ID int, Ruta_SAK int, Canal_ID int")
    return pdf, spark.createDataFrame(pdf, schema)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, min_size=1, max_size=40), s=st.integers(4, 10))
def test_lag_features_property(spark, rows, s):
    pdf, df = _frame(spark, rows)
    got = lags.lag_features(df, s).toPandas()
    want = expected_lags([(w, c % 2, 1, p % 2, c, p, d) for w, c, p, d in rows], s)
    assert set(zip(got.Cliente_ID, got.Producto_ID, strict=True)) == set(want)
    for r in got.to_dict("records"):
        for name, value in want[r["Cliente_ID"], r["Producto_ID"]].items():
            assert np.isnan(r[name]) if value is None else r[name] == pytest.approx(value, abs=1e-9), name


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, min_size=1, max_size=40), s=st.integers(4, 10))
def test_entity_aggregate_property(spark, rows, s):
    pdf, df = _frame(spark, rows)
    keys = ["Agencia_ID", "Producto_ID"]
    got = aggregates.agg_table(df, "ap", keys, s).toPandas()
    h = pdf[pdf.Semana < s]
    want = h.groupby(keys)[C.TARGET_COL].agg(["mean", "std", "count"]).reset_index()
    want["std"] = want["std"].fillna(0)
    assert len(got) == len(want)
    if len(want):
        g = got.sort_values(keys)[keys + ["ap_mean", "ap_std", "ap_count"]].to_numpy(float)
        w = want.sort_values(keys)[keys + ["mean", "std", "count"]].to_numpy(float)
        np.testing.assert_allclose(g, w, rtol=1e-9, atol=1e-9)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(3, 8), st.integers(1, 4), st.integers(1, 3),
                               st.integers(0, 1), st.integers(0, 15)), min_size=5, max_size=40))
def test_multi_week_equals_single_week_property(spark, rows):
    """A7 on random panels (with an unknown product and agency): the
    multi-week matrix equals the single-week matrix, week by week."""
    from pyspark.sql import functions as F
    from panelcast.operators import pipeline
    from panelcast.plans.prepare import Prepared
    sales = spark.createDataFrame(
        [(w, a, 1, r, c, p, 1, 1.0, 0, 0.0, d) for w, c, p, a, d in rows for r in (p % 2,)],
        "Semana int, Agencia_ID int, Canal_ID int, Ruta_SAK int, Cliente_ID long, Producto_ID int, "
        "Venta_uni_hoy int, Venta_hoy double, Dev_uni_proxima int, Dev_proxima double, "
        "Demanda_uni_equil long")
    products = spark.createDataFrame([(1, "Rolls 6p 480g ABC 1"), (2, "Milk 2p 1.5kg QRS 2")],
                                     "Producto_ID int, NombreProducto string")
    towns = spark.createDataFrame([(0, "T0", "S0")], "Agencia_ID int, Town string, State string")
    p = Prepared(sales, products, towns)
    proc = p.processed
    weeks = sorted({w for w, *_ in rows if w >= 4})
    if not weeks:
        return
    multi = pipeline.build_features_multi(proc, proc, weeks, **p.feature_kwargs()).toPandas()
    keys = list(C.ID_COLS) + [C.TARGET_COL] + list(C.FEATURE_COLS)
    for s in weeks:
        single = pipeline.build_features(proc.where(F.col("Semana") == s), proc, s,
                                         **p.feature_kwargs()).toPandas()
        m = multi[multi.Semana == s]
        a = m.sort_values(keys)[C.FEATURE_COLS].to_numpy(float)
        b = single.sort_values(keys)[C.FEATURE_COLS].to_numpy(float)
        assert a.shape == b.shape
        np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-9)


VALS = st.lists(st.integers(0, 12).map(float), min_size=1, max_size=60)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=VALS, b=VALS)
def test_ks_statistic_property(spark, a, b):
    """Distributed KS D (few buckets, many ties) equals the brute-force D."""
    from panelcast.operators import cumulative
    rows = [(v, True) for v in a] + [(v, False) for v in b]
    df = spark.createDataFrame(rows, "v double, ref boolean")
    got = cumulative.ks_two_sample(df, "v", "ref", buckets=4, method="asymp").first().ks_statistic
    grid = np.array(sorted(set(a) | set(b)))
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    assert got == np.float64(np.abs(fa - fb).max()) or abs(got - np.abs(fa - fb).max()) < 1e-12


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(x=VALS, q=st.sampled_from([0.0, 0.1, 0.5, 0.9, 0.99, 1.0]))
def test_exact_quantile_property(spark, x, q):
    """Distributed exact quantile (few buckets) equals NumPy's linear percentile."""
    from panelcast.operators import cumulative
    df = spark.createDataFrame([(v,) for v in x], "v double")
    got = cumulative.exact_quantile(df, "v", q, "q", buckets=3).first().q
    assert got == pytest.approx(np.percentile(x, q * 100))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(x=VALS)
def test_ecdf_property(spark, x):
    """ECDF height at each distinct value = linspace(0, 1, N) at its last sorted position."""
    from panelcast.operators import cumulative
    df = spark.createDataFrame([(v,) for v in x], "value double")
    got = cumulative.ecdf(df, "value", buckets=3).orderBy("value").toPandas()
    xs = np.sort(np.array(x))
    lin = np.linspace(0, 1, len(xs))
    want = [lin[np.searchsorted(xs, v, side="right") - 1] for v in got.value]
    np.testing.assert_allclose(got.ecdf.to_numpy(), want, atol=1e-12)
    assert got.cum.iloc[-1] == len(xs)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(x=st.lists(st.floats(-50, 50, allow_nan=False), min_size=1, max_size=80),
       bins=st.integers(1, 12))
def test_histogram_property(spark, x, bins):
    from panelcast.operators import evaluation
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    h = evaluation.histogram(df, "x", bins).orderBy("bin").toPandas()
    counts, _ = np.histogram(np.array(x), bins=bins)
    assert h.n.sum() == len(x)
    # bin edges agree with NumPy up to rounding at the edges themselves
    assert np.abs(h.n.to_numpy() - counts).sum() <= 2 * sum(
        np.isclose(np.array(x)[:, None], np.linspace(min(x), max(x), bins + 1)[None, 1:-1]).any(axis=1))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.integers(-1000, 1000), min_size=0, max_size=120, unique=True),
       parts=st.integers(1, 9))
def test_dense_ids_property(spark, keys, parts):
    """Ids are 1..N in key order for any input partitioning."""
    from panelcast.operators.ids import with_dense_ids
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(parts)
    got = with_dense_ids(df, ["k"]).toPandas().sort_values("k")
    assert got["id"].tolist() == list(range(1, len(keys) + 1))
