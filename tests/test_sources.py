"""Sources and sinks: typed CSV scan, week store with pruning, streaming
ingest equal to the batch scan, optional tables, run log."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from panelcast import config as C
from panelcast.sources import files, fixtures as fx, sinks
from panelcast.streaming import ingest


def _sales_csv(spark, tmp_dir, parts=3):
    path = f"{tmp_dir}/csv"
    fx.demand_sales(spark, SF_SMALL).repartition(parts).write.option("header", True).csv(path)
    return path


def test_csv_scan_typed(spark, tmp_dir):
    df = files.load_sales_csv(spark, _sales_csv(spark, tmp_dir))
    assert df.schema == C.SALES_SCHEMA
    assert df.count() == fx.demand_sales(spark, SF_SMALL).count()


def test_store_roundtrip_and_pruning(spark, tmp_dir):
    sales = fx.demand_sales(spark, SF_SMALL)
    files.save_by_week(sales, f"{tmp_dir}/store")
    weeks = files.available_weeks(spark, f"{tmp_dir}/store")
    assert weeks == sorted(r[0] for r in sales.select("Semana").distinct().collect())
    part = files.load_weeks(spark, f"{tmp_dir}/store", [4, 5])
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "Semana" in plan
    assert part.count() == sales.where(F.col("Semana").isin(4, 5)).count()
    try:
        files.load_weeks(spark, f"{tmp_dir}/store", [4, 99])
        raise AssertionError("missing week must fail")
    except FileNotFoundError:
        pass


def test_streaming_ingest_equals_batch(spark, tmp_dir):
    src = _sales_csv(spark, tmp_dir, parts=4)
    n_batches = ingest.ingest_available(spark, src, f"{tmp_dir}/st", f"{tmp_dir}/ck",
                                        files_per_batch=1, timeout_s=300)
    assert n_batches >= 4
    got = spark.read.parquet(f"{tmp_dir}/st")
    want = files.load_sales_csv(spark, src)
    assert got.count() == want.count()
    assert got.agg(F.sum(C.TARGET_COL)).first()[0] == want.agg(F.sum(C.TARGET_COL)).first()[0]
    # a second run finds nothing new: exactly once
    ingest.ingest_available(spark, src, f"{tmp_dir}/st", f"{tmp_dir}/ck", timeout_s=300)
    assert spark.read.parquet(f"{tmp_dir}/st").count() == want.count()


def _write(folder, name, text):
    import os
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_csv_columns_are_found_by_name(spark, tmp_dir):
    _write(f"{tmp_dir}/p", "a.csv", "NombreProducto,extra,Producto_ID\n12 ABC 5,x,34\n")
    got = files.read_csv(spark, f"{tmp_dir}/p", C.PRODUCT_SCHEMA)
    assert got.schema == C.PRODUCT_SCHEMA and tuple(got.first()) == (34, "12 ABC 5")
    _write(f"{tmp_dir}/q", "a.csv", "Producto,Nombre\n1,2\n")
    with pytest.raises(ValueError, match="no column"):
        files.read_csv(spark, f"{tmp_dir}/q", C.PRODUCT_SCHEMA)
    _write(f"{tmp_dir}/p", "b.csv", "Producto_ID,NombreProducto,extra\n1,n,x\n")      # another header than a.csv
    with pytest.raises(Exception):
        files.read_csv(spark, f"{tmp_dir}/p", C.PRODUCT_SCHEMA).collect()


def test_malformed_rows_fail_batch_and_stream_alike(spark, tmp_dir):
    header = ",".join(C.SALES_SCHEMA.names)
    _write(f"{tmp_dir}/bad", "a.csv", header + "\n3,1,1,1,1,x,1,1.0,0,0.0,1\n")
    with pytest.raises(Exception):
        files.load_sales_csv(spark, f"{tmp_dir}/bad").collect()
    with pytest.raises(Exception):
        ingest.ingest_available(spark, f"{tmp_dir}/bad", f"{tmp_dir}/bst", f"{tmp_dir}/bck", timeout_s=120)


def test_rejected_rows_and_reordered_headers(spark, tmp_dir):
    """Any column order, extra columns; malformed values, short rows and files
    without a column are rejected with their line; a batch run again replaces its rows."""
    names = C.SALES_SCHEMA.names
    good = "3,1,1,1,{c},1,1,1.5,0,0.0,{d}"
    _write(f"{tmp_dir}/m", "a.csv", ",".join(names) + "\n" + good.format(c=1, d=5) + "\n" + good.format(c="x", d=1) + "\n3,1\n")
    _write(f"{tmp_dir}/m", "b.csv", ",".join(["nota", *reversed(names)]) + "\nn,7,0.0,0,1.5,1,1,2,1,1,1,4\n")
    _write(f"{tmp_dir}/m", "c.csv", ",".join(names[:-1]) + "\n3,1,1,1,3,1,1,1.5,0,0.0\n")
    _write(f"{tmp_dir}/m", "d.csv", "")
    _write(f"{tmp_dir}/m", "e.csv", ",".join(names) + "\n")
    paths = [f"{tmp_dir}/m/{k}.csv" for k in "abcde"]

    def tables(store, rejects):
        rows = spark.read.parquet(store).select("Semana", "Cliente_ID", C.TARGET_COL, "Venta_hoy").collect()
        bad = ingest.rejected_rows(spark, rejects).collect()
        return sorted(map(tuple, rows)), sorted((r.file[-5:], r.line, r.reason) for r in bad)

    want = ([(3, 1, 5, 1.5), (4, 2, 7, 1.5)],
            [("a.csv", "3,1", "malformed row"), ("a.csv", good.format(c="x", d=1), "malformed row"),
             ("c.csv", "3,1,1,1,3,1,1,1.5,0,0.0", f"missing columns: {names[-1]}")])
    ingest.ingest_with_rejects(spark, f"{tmp_dir}/m", f"{tmp_dir}/ms", f"{tmp_dir}/mr", f"{tmp_dir}/mc", timeout_s=300)
    assert tables(f"{tmp_dir}/ms", f"{tmp_dir}/mr") == want
    ingest.ingest_with_rejects(spark, f"{tmp_dir}/m", f"{tmp_dir}/ms", f"{tmp_dir}/mr", f"{tmp_dir}/mc", timeout_s=300)
    assert tables(f"{tmp_dir}/ms", f"{tmp_dir}/mr") == want
    for _ in range(2):                               # one batch, run twice as after a failure
        ingest.store_batch(spark, paths, 0, f"{tmp_dir}/s2", f"{tmp_dir}/r2")
        assert tables(f"{tmp_dir}/s2", f"{tmp_dir}/r2") == want


def test_every_stored_week_is_seen(spark, tmp_dir):
    sales = fx.demand_sales(spark, SF_SMALL)
    late = sales.where("Semana = 5").withColumn("Semana", F.lit(12))
    files.save_by_week(sales.where("Semana = 3").unionByName(late), f"{tmp_dir}/late")
    assert files.available_weeks(spark, f"{tmp_dir}/late") == [3, 12]
    assert files.available_weeks(spark, f"{tmp_dir}/late", (1, 11)) == [3]
    assert files.load_weeks(spark, f"{tmp_dir}/late", [12]).count() == late.count()
    assert files.available_weeks(spark, f"{tmp_dir}/nowhere") == []


def test_fixture_views_keep_every_dimension_row(spark):
    for view, source in ((fx.products, "part"), (fx.towns, "nation")):
        assert view(spark, SF_SMALL).count() == fx.table(spark, SF_SMALL, source).count()
    sales = fx.demand_sales(spark, SF_SMALL)
    assert sales.join(fx.products(spark, SF_SMALL), "Producto_ID", "left_anti").count() > 0
    assert sales.join(fx.towns(spark, SF_SMALL), "Agencia_ID", "left_anti").count() > 0


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace
    from panelcast.session import scratch_dir
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        sc = SimpleNamespace(master=master, getConf=lambda: {}, getCheckpointDir=lambda: None)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_dir(SimpleNamespace(sparkContext=sc))


def test_optional_table_and_runs(spark, tmp_dir):
    empty = files.load_table(spark, f"{tmp_dir}/nope", required=False,
                             empty_schema="Producto_ID int, brand string")
    assert empty.count() == 0
    sinks.append_run(spark, f"{tmp_dir}/runs", val_semana=9, n_features=43, n_train_rows=10,
                     n_val_rows=5, best_iteration=3, params={"a": 1}, metrics={"gbm": {"rmse": 1.0}})
    sinks.append_run(spark, f"{tmp_dir}/runs", val_semana=9, n_features=43, n_train_rows=10,
                     n_val_rows=5, best_iteration=4, params={"a": 1}, metrics={"gbm": {"rmse": 0.5}})
    assert spark.read.parquet(f"{tmp_dir}/runs").count() == 2


def test_streaming_ingest_with_preprocessing(spark, tmp_dir):
    from panelcast.plans.prepare import Prepared
    src = _sales_csv(spark, tmp_dir, parts=3)
    batch_sales = files.load_sales_csv(spark, src)
    p = Prepared(batch_sales, fx.products(spark, SF_SMALL), fx.towns(spark, SF_SMALL))
    tr = ingest.preprocess_transform(p.meta, p.towns, p.state_map)
    ingest.ingest_available(spark, src, f"{tmp_dir}/pst", f"{tmp_dir}/pck", transform=tr, timeout_s=300)
    got = spark.read.parquet(f"{tmp_dir}/pst")
    want = p.processed
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert want.select(cols).exceptAll(got.select(cols)).count() == 0
