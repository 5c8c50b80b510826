"""End-to-end jobs on the smallest fixture: preprocess -> train -> evaluate -> infer."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from panelcast import config as C
from panelcast.operators import scoring
from panelcast.plans import jobs
from panelcast.sources import fixtures as fx


def test_pipeline_end_to_end(spark, tmp_dir):
    art = jobs.Artifacts(tmp_dir)
    jobs.run_preprocess(fx.demand_sales(spark, SF_SMALL), fx.products(spark, SF_SMALL),
                        fx.towns(spark, SF_SMALL), art)
    res = jobs.run_training(spark, art, num_rounds=3, with_quantiles=True,
                            boost_kw={"params": {"min_child_samples": 20}, "max_depth": 4})
    assert set(res) >= {"gbm", "baseline_lag1", "baseline_ma", "best_iteration"}
    assert res["n_features"] == len(C.FEATURE_COLS) == 43
    runs = spark.read.parquet(art.runs)
    assert runs.count() == 1
    metrics = jobs.run_evaluation(spark, art)
    assert set(metrics) == {"rmse", "mae", "bias", "rmsle"}
    reqs = fx.score_rows(spark, SF_SMALL)
    sub = jobs.run_inference(spark, art, reqs, f"{tmp_dir}/submission")
    n = reqs.count()
    rows = sub.collect()
    assert len(rows) == n
    assert [r["id"] for r in rows] == sorted(r["id"] for r in rows)
    assert min(r[C.TARGET_COL] for r in rows) >= 0
    resp = jobs.score_requests(spark, art, reqs)
    bad = resp.where(F.col("confidence_lower").isNull() | F.col("predicted_demand").isNull()).count()
    assert bad == 0 and resp.count() == n
    ordered = jobs.score_requests(spark, art, reqs, enforce_order=True)
    assert ordered.where((F.col("confidence_lower") > F.col("predicted_demand"))
                         | (F.col("predicted_demand") > F.col("confidence_upper"))).count() == 0
    bad_reqs = reqs.limit(3).withColumn("Semana", F.lit(0))
    _, rejected = scoring.split_requests(bad_reqs)
    assert rejected.count() == 3 and rejected.where(F.col("reason").isNull()).count() == 0
    imp = spark.read.option("header", True).csv(art.report("feature_importance"))
    assert 0 < imp.count() <= C.TOP_FEATURES


def test_training_set_in_week_chunks(spark, tmp_dir):
    """Chunked A7 writes the same training set as one job."""
    art = jobs.Artifacts(tmp_dir)
    jobs.run_preprocess(fx.demand_sales(spark, SF_SMALL), fx.products(spark, SF_SMALL),
                        fx.towns(spark, SF_SMALL), art, check_keys=False)
    from panelcast.sources import files
    hist = files.load_weeks(spark, art.store, files.available_weeks(spark, art.store))
    inputs = jobs.load_feature_inputs(spark, art)
    jobs.write_training_set(hist, inputs, 9, f"{tmp_dir}/one")
    jobs.write_training_set(hist, inputs, 9, f"{tmp_dir}/chunks", weeks_per_job=2)
    cols = ["Cliente_ID", "Producto_ID", C.TARGET_COL] + C.FEATURE_COLS   # includes target_semana
    a = spark.read.parquet(f"{tmp_dir}/one").select(*cols)
    b = spark.read.parquet(f"{tmp_dir}/chunks").select(*cols)
    pa = a.toPandas().sort_values(cols).reset_index(drop=True)
    pb = b.toPandas().sort_values(cols).reset_index(drop=True)
    assert len(pa) == len(pb) > 0
    assert pa.equals(pb)


def test_cli_round_trip(spark, tmp_dir):
    """The four commands, on CSV inputs written from the fixture views."""
    from panelcast.plans import cli
    paths = {}
    for name, df in (("sales", fx.demand_sales(spark, SF_SMALL)), ("products", fx.products(spark, SF_SMALL)),
                     ("towns", fx.towns(spark, SF_SMALL)), ("requests", fx.score_rows(spark, SF_SMALL))):
        paths[name] = f"{tmp_dir}/in-{name}"
        df.write.option("header", True).csv(paths[name])
    root = f"{tmp_dir}/art"
    assert cli.main(["preprocess", "--root", root, "--sales", paths["sales"],
                     "--products", paths["products"], "--towns", paths["towns"]]) == 0
    assert cli.main(["train", "--root", root, "--rounds", "2", "--no-quantiles"]) in (0, 1)
    assert cli.main(["evaluate", "--root", root]) == 0
    assert cli.main(["infer", "--root", root, "--requests", paths["requests"],
                     "--out", f"{tmp_dir}/submission"]) == 0
    sub = spark.read.option("header", True).csv(f"{tmp_dir}/submission")
    assert sub.count() == fx.score_rows(spark, SF_SMALL).count()
