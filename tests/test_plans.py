"""Plan-shape guards: the properties that matter at scale, checked on the
executed physical plans (small fixture, same plans as at any size)."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from panelcast.operators import aggregates, cumulative, drift, pipeline
from panelcast.plans import jobs
from panelcast.sources import files, fixtures as fx


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    art = jobs.Artifacts(str(tmp_path_factory.mktemp("plans")))
    jobs.run_preprocess(fx.demand_sales(spark, SF_SMALL), fx.products(spark, SF_SMALL),
                        fx.towns(spark, SF_SMALL), art)
    hist = files.load_weeks(spark, art.store, files.available_weeks(spark, art.store))
    return art, hist, jobs.load_feature_inputs(spark, art)


def _final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString().split("== Initial Plan ==")[0]


def _store_scans(plan: str, art) -> int:
    return len(re.findall(r"Location: InMemoryFileIndex\(1 paths\)\[file:" + re.escape(art.store), plan))


def test_feature_matrix_scans_store_at_most_three_times(store):
    art, hist, inputs = store
    fm = pipeline.build_features(hist.where(F.col("Semana") == 9), hist, 9, **inputs)
    plan = _final_plan(fm)
    assert _store_scans(plan, art) <= 3          # pair table, key sets (written), target rows
    assert "MapInPandas" not in plan and "BatchEvalPython" not in plan
    assert "Exchange SinglePartition" not in plan     # no single-task step over facts
    multi = pipeline.build_features_multi(hist, hist, [6, 7, 8, 9], **inputs)
    mplan = _final_plan(multi)
    assert _store_scans(mplan, art) <= 3
    assert "Exchange SinglePartition" not in mplan


def test_week_filters_reach_the_scan(store):
    art, hist, _ = store
    plan = _final_plan(files.load_weeks(hist.sparkSession, art.store, [5, 6]))
    assert re.search(r"PartitionFilters: \[[^\]]*Semana", plan)


def test_aggregates_combine_map_side(store):
    _, hist, _ = store
    plan = _final_plan(aggregates.agg_table(hist, "client", ["Cliente_ID"], 9))
    # partial aggregate below the shuffle, final above it
    assert re.search(r"HashAggregate\(keys=\[Cliente_ID[^\]]*\], functions=\[partial_", plan)


def test_ks_has_no_window_over_all_values(store):
    _, hist, _ = store
    out = drift.feature_drift(hist.where(F.col("Semana") == 8), hist.where(F.col("Semana") == 9),
                              ["Venta_hoy", "Demanda_uni_equil"])
    plan = _final_plan(out)
    specs = [m.group(1) for m in re.finditer(r"Window \[[^\n]*?\], \[([^\]]*)\]", plan)]
    assert specs, "expected the windows over ranges in the plan"
    for spec in specs:
        assert spec.strip(), "a window without PARTITION BY would run in one task"


def test_cumulative_sums_broadcast_nothing_of_the_values(spark):
    """Offsets meet their ranges in a shuffle join unless the measured size
    allows otherwise; no sketch decides the cuts."""
    vc = spark.range(5_000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"), F.lit(1).alias("n"))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        plan = _final_plan(cumulative.cumulative_sums(vc, "v", ["n"], ["g"], buckets=8, fan=2))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "Broadcast" not in plan and "percentile_approx" not in plan and "SinglePartition" not in plan
    # the rows of the values are moved once: window and join share one exchange
    assert len(re.findall(r"Exchange hashpartitioning\(g[^)]*__b", plan)) <= 2 + 2 * 2
