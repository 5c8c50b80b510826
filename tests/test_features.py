"""Feature operators on a panel with gaps, name parsing, and properties (no
leakage, multi-week equals single-week)."""

import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from panelcast import config as C
from panelcast.functions import names
from panelcast.operators import aggregates, lags, pipeline
from panelcast.plans.prepare import Prepared
from panelcast.sources import fixtures as fx

PANEL_SCHEMA = ("Semana int, Agencia_ID int, Canal_ID int, Ruta_SAK int, Cliente_ID long, "
                "Producto_ID int, Demanda_uni_equil int")


def _panel_rows() -> list[tuple]:
    """Weeks 2..11 without 6; five clients, three products; a client sells a
    product only in some weeks, and sometimes twice in one."""
    rows = []
    for week in (2, 3, 4, 5, 7, 8, 9, 10, 11):
        for client in range(11, 16):
            for product in (7, 8, 9):
                if (week * client + product) % 3:
                    for copy in range(1 + (week + client + product) % 2):
                        rows.append((week, client % 2, 4, client % 3, client, product, (week * 5 + client * product + copy) % 23))
    return rows


@pytest.fixture(scope="module")
def panel(spark):
    return spark.createDataFrame(_panel_rows(), PANEL_SCHEMA)


def expected_lags(rows, week: int) -> dict:
    """(client, product) -> feature -> value, by the definitions: weekly sums
    per pair; lag k is the sum in week - k; a window of w covers the pair's
    sums in the last w weeks that anybody observed."""
    sums: dict = {}
    for w, *_, client, product, demand in rows:
        if w < week:
            pair = sums.setdefault((client, product), {})
            pair[w] = pair.get(w, 0) + demand
    observed = sorted({w for pair in sums.values() for w in pair}, reverse=True)
    out = {}
    for key, pair in sums.items():
        f = {f"lag_{k}": pair.get(week - k) for k in C.LAG_WEEKS}
        for n in C.ROLLING_WINDOWS:
            seen = [pair[w] for w in observed[:n] if w in pair]
            f[f"rolling_mean_{n}"] = sum(seen) / len(seen) if seen else None
            f[f"rolling_median_{n}"] = statistics.median(seen) if seen else None
            f[f"rolling_std_{n}"] = statistics.stdev(seen) if len(seen) > 1 else 0.0
        out[key] = f
    return out


def _assert_lags(got, want):
    assert {(r.Cliente_ID, r.Producto_ID) for r in got} == set(want)
    for r in got:
        for name, value in want[r.Cliente_ID, r.Producto_ID].items():
            have = r[name]
            assert (have is None) == (value is None), (name, r)
            assert value is None or have == pytest.approx(value, abs=1e-9), (name, r)


@pytest.mark.parametrize("week", [3, 6, 7, 12, 14])
def test_lags_equal_their_definition(panel, week):
    _assert_lags(lags.lag_features(panel, week).collect(), expected_lags(_panel_rows(), week))


def test_lag_of_an_unobserved_week_is_null(panel):
    out = lags.lag_features(panel, 8)                       # nobody sold in week 6
    assert out.where(F.col("lag_2").isNotNull()).count() == 0
    assert out.where(F.col("lag_1").isNotNull()).count() > 0


def test_no_history_no_lags(spark):
    assert lags.lag_features(spark.createDataFrame([], PANEL_SCHEMA), 9).count() == 0


def test_aggregates_equal_their_definition(panel):
    rows = [r for r in _panel_rows() if r[0] < 9]
    got = aggregates.agg_features(panel, 9)
    assert set(got) == set(C.AGG_GROUP_KEYS)
    for r in got["agency_product"].collect():
        own = [x[-1] for x in rows if (x[1], x[5]) == (r.Agencia_ID, r.Producto_ID)]
        assert r.agency_product_count == len(own)
        assert r.agency_product_mean == pytest.approx(statistics.fmean(own))
        assert r.agency_product_std == pytest.approx(statistics.stdev(own) if len(own) > 1 else 0.0)


def test_missing_key_column_skipped(panel):
    out = aggregates.agg_features(panel.drop("Ruta_SAK"), 7)
    assert "route" not in out and "route_product" not in out and "product" in out


def test_squares_of_large_demands_do_not_overflow(spark):
    rows = [(3, 1, 1, 1, 1, 1, 2_000_000_000 + i) for i in (0, 1, 2)]
    h = spark.createDataFrame(rows, PANEL_SCHEMA)
    one = pipeline.target_weeks_frame(spark, [4])
    for tab in (aggregates.agg_table_multi(h, "product", ["Producto_ID"], one),
                aggregates.key_set_stats(h, {"product": ["Producto_ID"]}, one)["product"]):
        r = tab.first()
        assert (r.product_mean, r.product_std, r.product_count) == (2_000_000_001.0, pytest.approx(1.0), 3)


def test_key_set_table_holds_one_row_per_key_and_week(spark, panel):
    """However many target weeks ask: rows are not copied per target week."""
    sets = {"product": ["Producto_ID"], "agency_product": ["Agencia_ID", "Producto_ID"], "global": []}
    running = aggregates.running_moments(panel, sets)
    for name, keys in sets.items():
        assert running[name].count() == panel.select(*keys, "Semana").distinct().count()
        at = aggregates.at_weeks(running[name], pipeline.target_weeks_frame(spark, range(1, 30)))
        for s in (2, 3, 7, 12, 29):
            own = panel.where(F.col("Semana") < s).groupBy(*keys).agg(F.avg(C.TARGET_COL).alias("m"), F.count(F.lit(1)).alias("n"))
            want = sorted((*r[:-2], round(r.m, 9), r.n) for r in own.collect() if r.n)
            got = at.where(F.col("S") == s).select(*keys, f"{name}_mean", f"{name}_count").collect()
            assert sorted((*r[:-2], round(r[-2], 9), r[-1]) for r in got) == want


def test_as_of_takes_the_last_week_before(spark, panel):
    running = aggregates.running_moments(panel, {"client": ["Cliente_ID"]})["client"]
    rows = spark.createDataFrame([(1, 11, 2), (2, 11, 3), (3, 11, 7), (4, 11, 40), (5, 999, 9), (6, None, 9)], "i int, Cliente_ID long, Semana int")
    got = {r.i: r.client_count for r in aggregates.as_of(rows, running, ["Cliente_ID"]).collect()}
    own = [r[0] for r in _panel_rows() if r[4] == 11]
    assert got == {1: None, 2: sum(w < 3 for w in own), 3: sum(w < 7 for w in own), 4: len(own), 5: None, 6: None}


def test_missing_values_become_zero_features(spark):
    df = spark.createDataFrame([(float("nan"), None, 2)], "lag_1 double, lag_2 double, lag_3 int")
    got = pipeline.align_features(df, ["lag_3", "lag_1", "lag_2", "absent"]).first()
    assert tuple(got) == (2.0, 0.0, 0.0, 0.0)
    assert tuple(pipeline.finalize_features(df, [], ["lag_1", "lag_2"]).first()) == (0.0, 0.0)


def test_numeric_feature_columns(panel):
    df = panel.withColumn("weight_g", F.lit(1.5)).withColumn("brand", F.lit("x")).withColumn("promo", F.lit(True))
    assert pipeline.numeric_feature_columns(df) == ["weight_g", "promo"]


def test_raw_history_forms_an_unknown_brand_group(spark):
    from panelcast.operators import backoff
    h = spark.createDataFrame([(3, 1, 1, 1, 1, 100, 4), (3, 2, 1, 2, 2, 101, 8), (3, 3, 1, 3, 3, 5, 90)], PANEL_SCHEMA)
    target = spark.createDataFrame([(4, 9, 1, 9, 9, 102, 0)], PANEL_SCHEMA)
    brands = spark.createDataFrame([(5, "ABC")], "Producto_ID int, brand string")
    r = backoff.backoff_features(target, h, brands, 4).first()
    assert (r.backoff_level, r.backoff_estimate) == (4, 6.0)      # mean of the two unknown products
    branded = h.withColumn("brand", F.when(F.col("Producto_ID") == 5, "ABC"))
    assert backoff.backoff_features(target, branded, brands, 4).first().backoff_level == 5


def _parse(spark, name):
    df = spark.createDataFrame([(name,)], "NombreProducto string")
    return names.enrich_products(df).first()


def test_parse_names(spark):
    r = _parse(spark, "Rolls Ext Sesame 6p 480g ABC 41")
    assert (r.brand, r.weight_g, r.pieces) == ("ABC", 480.0, 6)
    assert _parse(spark, "Coffee Mocha 750g XYZ 9").weight_g == 750.0
    assert _parse(spark, "White Bread 500g ABC 10").has_promo == 0
    assert _parse(spark, "X").brand == "UNK"
    assert _parse(spark, "Milk 1.5kg Descremada QRS 3").weight_g == 1500.0
    assert _parse(spark, "Milk 1.5kg Descremada QRS 3").has_promo == 1   # unanchored 'desc'
    assert _parse(spark, "Water 2L  DEF 7").weight_g == 2000.0
    assert _parse(spark, "Bread 2 p 300g ABC 1").pieces == 2            # Unicode \\s
    assert _parse(spark, "").brand == "UNK"


@pytest.fixture(scope="module")
def prep(spark):
    return Prepared(fx.demand_sales(spark, SF_SMALL), fx.products(spark, SF_SMALL),
                    fx.towns(spark, SF_SMALL))


def _sorted_pd(df):
    pdf = df.toPandas()
    keys = list(C.ID_COLS) + [C.TARGET_COL] + list(C.FEATURE_COLS)
    return pdf.sort_values(keys).reset_index(drop=True)


def test_multi_week_equals_single_week(prep):
    proc = prep.processed.cache()
    kw = prep.feature_kwargs()
    multi = pipeline.build_features_multi(proc, proc, [6, 9], **kw)
    for s in (6, 9):
        single = _sorted_pd(pipeline.build_features(proc.where(F.col("Semana") == s), proc, s, **kw))
        m = _sorted_pd(multi.where(F.col("Semana") == s))
        assert len(single) == len(m) > 0
        np.testing.assert_allclose(m[C.FEATURE_COLS].to_numpy(float),
                                   single[C.FEATURE_COLS].to_numpy(float), rtol=1e-9, atol=1e-9)


def test_features_ignore_future_rows(prep):
    """Changing rows of weeks >= S leaves the features of week S unchanged."""
    proc = prep.processed.cache()
    kw = prep.feature_kwargs()
    s = 7
    target = proc.where(F.col("Semana") == s)
    base = _sorted_pd(pipeline.build_features(target, proc, s, **kw))
    future = proc.where(F.col("Semana") >= s).withColumn(C.TARGET_COL, F.col(C.TARGET_COL) * 7 + 3)
    changed = proc.where(F.col("Semana") < s).unionByName(future)
    got = _sorted_pd(pipeline.build_features(target, changed, s, **kw))
    np.testing.assert_allclose(got[C.FEATURE_COLS].to_numpy(float), base[C.FEATURE_COLS].to_numpy(float))


def test_feature_list_and_fill(prep):
    proc = prep.processed
    out = pipeline.build_features(proc.where(F.col("Semana") == 9), proc, 9, **prep.feature_kwargs())
    assert out.columns[-43:] == C.FEATURE_COLS
    nulls = out.select([F.sum(F.col(c).isNull().cast("int")).alias(c) for c in C.FEATURE_COLS]).first()
    assert sum(nulls) == 0
    assert not set(C.SALE_MEASURES) & set(out.columns)


def test_key_set_stats_equal_groupby(spark, prep):
    from panelcast.operators import aggregates
    proc = prep.processed
    one = pipeline.target_weeks_frame(spark, [8])
    sets = {k: v for k, v in C.AGG_GROUP_KEYS.items() if k != "client_product"}
    got = aggregates.key_set_stats(proc, sets, one)
    for name, keys in sets.items():
        a = got[name].drop("S").toPandas().sort_values(keys).reset_index(drop=True)
        b = aggregates.agg_table(proc, name, keys, 8).toPandas().sort_values(keys).reset_index(drop=True)
        assert len(a) == len(b) > 0
        cols = [f"{name}_mean", f"{name}_std", f"{name}_count"]
        np.testing.assert_allclose(a[cols].to_numpy(float), b[cols].to_numpy(float), rtol=1e-9, atol=1e-9)


def test_hot_client_third_of_rows(spark, prep):
    """One client holding a third of all rows: results stay exact."""
    proc = prep.processed
    hot = proc.withColumn(
        "Cliente_ID",
        F.when(F.xxhash64("Cliente_ID", "Producto_ID", "Ruta_SAK") % 3 == 0, F.lit(7)).otherwise(F.col("Cliente_ID")))
    share = hot.where(F.col("Cliente_ID") == 7).count() / hot.count()
    assert 0.25 < share < 0.45
    rows = [tuple(r) for r in hot.select("Semana", "Cliente_ID", "Producto_ID", C.TARGET_COL).collect()]
    _assert_lags(lags.lag_features(hot, 9).collect(), expected_lags(rows, 9))
    kw = prep.feature_kwargs()
    single = _sorted_pd(pipeline.build_features(hot.where(F.col("Semana") == 9), hot, 9, **kw))
    multi = _sorted_pd(pipeline.build_features_multi(hot, hot, [8, 9], **kw).where(F.col("Semana") == 9))
    np.testing.assert_allclose(multi[C.FEATURE_COLS].to_numpy(float), single[C.FEATURE_COLS].to_numpy(float),
                               rtol=1e-9, atol=1e-9)
    client7 = single[single.Cliente_ID == 7]
    h = hot.where((F.col("Semana") < 9) & (F.col("Cliente_ID") == 7)).toPandas()
    assert np.allclose(client7.client_count, len(h)) and np.allclose(client7.client_mean, h[C.TARGET_COL].mean())


def test_backoff_ladder_is_a_parameter(spark, prep):
    from panelcast.operators import backoff
    sales = prep.sales
    tgt = sales.where(F.col("Semana") == 9)
    default = backoff.backoff_features(tgt, sales, prep.brand_map, 9).toPandas()
    ladder = list(C.BACKOFF_LEVELS)
    same = backoff.backoff_features(tgt, sales, prep.brand_map, 9, levels=ladder).toPandas()
    assert default.equals(same)
    short = backoff.backoff_features(tgt, sales, prep.brand_map, 9,
                                     levels=[("Producto_ID",), ()]).toPandas()
    assert set(short.backoff_level) <= {0, 1}
    assert (short.backoff_level >= 0).all() and short.backoff_estimate.notna().all()
    # a product level value equals the plain product mean of earlier weeks
    h = sales.where(F.col("Semana") < 9).toPandas()
    means = h.groupby("Producto_ID")[C.TARGET_COL].mean()
    row = short[short.backoff_level == 0].iloc[0]
    assert row.backoff_estimate == pytest.approx(means[row.Producto_ID])


def test_empty_history_gives_zero_features(spark, prep):
    """No history at all -> every feature row exists, filled with 0
    (target_semana aside), no failure."""
    proc = prep.processed
    target = proc.where(F.col("Semana") == 9)
    empty = proc.where(F.lit(False))
    out = pipeline.build_features(target, empty, 9, **prep.feature_kwargs()).toPandas()
    assert len(out) == target.count()
    history_cols = C.LAG_COLS + C.ROLLING_COLS + C.AGG_COLS + ["backoff_estimate"]
    assert (out[history_cols] == 0).all().all()
    assert (out.target_semana == 9).all()
    multi = pipeline.build_features_multi(proc.where(F.col("Semana") >= 8), empty, [8, 9],
                                          **prep.feature_kwargs()).toPandas()
    assert (multi[history_cols] == 0).all().all()


# --- what grows with the input ------------------------------------------------

def test_stats_before_equal_groupby_and_skip_empty_history(panel):
    sets = {"agency_product": ["Agencia_ID", "Producto_ID"], "brand": ["brand"], "global": []}
    branded = panel.withColumn("brand", F.when(F.col("Producto_ID") % 2 == 0, "EVEN"))
    got = aggregates.stats_before(panel, sets, 7, branded=branded)
    for name, rows in (("agency_product", panel), ("brand", branded.where("brand IS NOT NULL")), ("global", panel)):
        want = aggregates.agg_table(rows, name, sets[name], 7)
        assert got[name].columns == want.columns
        assert (sorted(tuple(map(str, r[:-3])) + (round(r[-3], 6), round(r[-2], 6), r[-1]) for r in got[name].collect())
                == sorted(tuple(map(str, r[:-3])) + (round(r[-3], 6), round(r[-2], 6), r[-1]) for r in want.collect()))
    assert all(t.count() == 0 for t in aggregates.stats_before(panel, sets, 0, branded=branded).values())


def test_wanted_pairs_equal_the_full_table_where_asked(spark, panel):
    """Weeks of a pair without a later target row are dropped before they are
    copied; a target row finds the values it finds in the whole table."""
    targets = pipeline.target_weeks_frame(spark, [5, 8])
    asked = panel.where(F.col("Semana").isin(5, 8)).select(*C.PAIR, F.col("Semana").alias("S"))
    full = lags.pair_features_multi(panel, targets)
    some = lags.pair_features_multi(panel, targets, wanted=asked.unionByName(asked))
    keys = [*C.PAIR, "S"]
    by = lambda df: sorted(map(str, df.join(asked.distinct(), keys, "left_semi").select(full.columns).collect()))
    assert by(some) == by(full)
    none = lags.pair_features_multi(panel, targets, wanted=asked.where("S < 0"))
    assert none.count() == 0 < some.count() <= full.count()


def test_tasks_follow_the_rows(spark):
    least = spark.sparkContext.defaultParallelism
    assert lags.tasks_for(10, spark) == lags.tasks_for(0, spark) == least
    assert lags.tasks_for(1000 * lags.ROWS_PER_TASK + 1, spark) == 1001


def test_lines_are_joined_after_orders_met_their_customers(spark):
    """With no table small enough to broadcast, the lines are shuffled once."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fx.demand_sales(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert len(joins) == 2 and "l_orderkey" in joins[0] and "o_custkey" in joins[1]


def test_csv_files_follow_the_rows(spark):
    import __spark_entry__ as entry
    assert entry._csv_files(spark.range(25), 4, 5) == 5
    assert entry._csv_files(spark.range(25), 4, 100) == 4 and entry._csv_files(spark.range(0), 2) == 2
