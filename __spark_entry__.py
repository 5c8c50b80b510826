"""

Every query reads the driver's tables through the fixture views of
``panelcast.sources.fixtures`` (whole tables, no row caps) and runs the
engine's operators.

Inputs are staged the way a deployment would stage them, once per session,
under the scratch folder (``spark.checkpoint.dir``):

* the views are written as input tables;
* feature queries read the week store written by the preprocessing job
  (``stored``);
* report queries read baseline predictions written once (``_scored``), as
  they would read a model's scored output.

Outputs are normalised to declared column kinds (BIGINT / DOUBLE rounded to
6 places / VARCHAR / BOOLEAN) on both the Spark side and the DuckDB side,
because engines differ in the last bits of std and interpolated values.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from importlib.util import find_spec

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks import duck_sql as D  # noqa: E402
from panelcast import config as C  # noqa: E402
from panelcast.operators import (aggregates, backoff, baselines, clean, drift,  # noqa: E402
                                 evaluation, lags, pipeline, scoring, summaries)
from panelcast.plans.prepare import Prepared  # noqa: E402
from panelcast.sources import fixtures as fx  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
Y = C.TARGET_COL


# --- helpers ----------------------------------------------------------------

def norm(df: DataFrame, shape: list[tuple[str, str]]) -> DataFrame:
    cols = []
    for c, k in shape:
        x = F.col(c)
        if k == "i":
            cols.append(x.cast("bigint").alias(c))
        elif k == "d":
            cols.append((F.round(x.cast("double"), 6) + F.lit(0.0)).alias(c))
        elif k == "s":
            cols.append(x.cast("string").alias(c))
        elif k == "b":
            cols.append(x.cast("boolean").alias(c))
        else:
            raise ValueError(k)
    return df.select(*cols)


def shape_of(spec: str) -> list[tuple[str, str]]:
    out = []
    for part in spec.split(","):
        name, kind = part.strip().rsplit(":", 1)
        out.append((name.strip(), kind.strip()))
    return out


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Fixture view as an input table (written once per session, then scanned)."""
    return fx.materialized(spark, sf, name)


def prepared(spark: SparkSession, sf: str) -> Prepared:
    """Preprocessing inputs; ``processed`` etc. are computed lazily from them."""
    return Prepared(view(spark, sf, "demand_sales"), view(spark, sf, "products"),
                    view(spark, sf, "towns"))


_STORES: dict = {}


def stored(spark: SparkSession, sf: str):
    """The preprocessing job run once per session: (processed store rows,
    feature inputs read back from the written dimension tables)."""
    from panelcast.plans import jobs
    from panelcast.session import scratch_path
    from panelcast.sources import files
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORES:
        art = jobs.Artifacts(scratch_path(spark, "artifacts"))
        jobs.run_preprocess(view(spark, sf, "demand_sales"), view(spark, sf, "products"),
                            view(spark, sf, "towns"), art)
        _STORES[key] = art
    art = _STORES[key]
    hist = files.load_weeks(spark, art.store, files.available_weeks(spark, art.store))
    return hist, jobs.load_feature_inputs(spark, art)


SALES_SHAPE = ("Semana:i, Agencia_ID:i, Canal_ID:i, Ruta_SAK:i, Cliente_ID:i, Producto_ID:i, "
               "Venta_uni_hoy:i, Venta_hoy:d, Dev_uni_proxima:i, Dev_proxima:d, Demanda_uni_equil:i")
PROCESSED_SHAPE = SALES_SHAPE + ", brand:s, weight_g:d, pieces:i, has_promo:i, State_encoded:i"
LAG_SHAPE = "Cliente_ID:i, Producto_ID:i, " + ", ".join(f"{c}:d" for c in C.LAG_COLS + C.ROLLING_COLS)
FM_SHAPE = (", ".join(f"{c}:i" for c in C.ID_COLS) + f", {Y}:i, "
            + ", ".join(f"{c}:d" for c in C.FEATURE_COLS))
PRED_SHAPE = SALES_SHAPE + ", prediction:d"
METRIC_SHAPE = "rmse:d, mae:d, bias:d, rmsle:d"
HIST_SHAPE = "variant:s, bin:i, lo:d, hi:d, n:i"
VAL_WEEK = C.VAL_WEEK
DRIFT_FEATURES = ["Venta_uni_hoy", "Venta_hoy", "Dev_uni_proxima", "Dev_proxima", Y,
                  "weight_g", "pieces", "has_promo", "State_encoded", "not_a_column"]

_REG: list[tuple[str, Callable, str | None, list[tuple[str, str]]]] = []


def register(name: str, shape: str, sql: str | None):
    sh = shape_of(shape)

    def deco(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return norm(fn(spark, sf), sh)
        run.__name__ = name
        _REG.append((name, run, None if sql is None else D.wrap(sql, sh), sh))
        return fn
    return deco


# --- sources and preprocessing ----------------------------------------------

@register("parse_products", "Producto_ID:i, NombreProducto:s, brand:s, weight_g:d, pieces:i, has_promo:i",
          D.with_ctes([], "SELECT * FROM parsed"))
def q_parse_products(spark, sf):
    return clean.product_metadata(view(spark, sf, "products"))


@register("brand_encoding", "brand:s, brand_encoded:i", D.with_ctes([], "SELECT * FROM brand_enc"))
def q_brand_encoding(spark, sf):
    return prepared(spark, sf).brand_encoding


@register("state_encoding", "State:s, State_encoded:i", D.with_ctes([], "SELECT * FROM state_map"))
def q_state_encoding(spark, sf):
    return prepared(spark, sf).state_map


@register("product_features", "Producto_ID:i, brand_encoded:i, weight_g:d, pieces:i, has_promo:i",
          D.with_ctes([], "SELECT * FROM prod_feats"))
def q_product_features(spark, sf):
    return prepared(spark, sf).product_features


@register("preprocess", PROCESSED_SHAPE, D.with_ctes([], "SELECT * FROM processed"))
def q_preprocess(spark, sf):
    return prepared(spark, sf).processed


@register("distinct_counts", "n_states:i, n_brands:i",
          D.with_ctes([], "SELECT (SELECT count(DISTINCT State) FROM state_map) AS n_states, "
                          "(SELECT count(DISTINCT brand) FROM parsed) AS n_brands"))
def q_distinct_counts(spark, sf):
    p = prepared(spark, sf)
    return summaries.distinct_counts(p.state_map, p.meta)


@register("week_row_counts", "Semana:i, n_rows:i",
          D.with_ctes([], "SELECT Semana, count(*) AS n_rows FROM processed GROUP BY Semana"))
def q_week_row_counts(spark, sf):
    return summaries.week_counts(prepared(spark, sf).processed)


# --- file sources, store and streaming ingest ------------------------------

_TYPED_SALES_SQL = ("SELECT Semana, Agencia_ID, Canal_ID, Ruta_SAK, Cliente_ID, Producto_ID, Venta_uni_hoy, "
                    "CAST(CAST(Venta_hoy AS FLOAT) AS DOUBLE) AS Venta_hoy, Dev_uni_proxima, "
                    "CAST(CAST(Dev_proxima AS FLOAT) AS DOUBLE) AS Dev_proxima, Demanda_uni_equil "
                    "FROM demand_sales")


def _csv_files(df: DataFrame, least: int, rows_per_file: int = 2_000_000) -> int:
    """Files for a table: ``least``, and more for a larger one, so that no task
    writes (or reads) more than about ``rows_per_file`` rows."""
    return max(least, -(-df.count() // rows_per_file))


def _sales_csv_dir(spark, sf, files: int = 4) -> tuple[str, int]:
    """demand_sales written as CSV files (derived from the driver tables), and
    the files of a batch when they are ingested in ``files`` batches."""
    from panelcast.session import scratch_path
    path, sales = scratch_path(spark, "sales-csv"), view(spark, sf, "demand_sales")
    n = _csv_files(sales, files)
    sales.repartition(n).write.option("header", True).csv(path)
    return path, -(-n // files)


@register("csv_scan", SALES_SHAPE, D.with_ctes([], _TYPED_SALES_SQL))
def q_csv_scan(spark, sf):
    from panelcast.sources import files
    return files.load_sales_csv(spark, _sales_csv_dir(spark, sf)[0])


def _view_csv_dir(spark, sf, name: str) -> str:
    """A fixture view written as CSV (header) under the scratch folder."""
    from panelcast.session import scratch_path
    path = scratch_path(spark, f"{name}-csv")
    view(spark, sf, name).write.option("header", True).csv(path)
    return path


@register("score_csv_scan", "id:i, Semana:i, Agencia_ID:i, Canal_ID:i, Ruta_SAK:i, Cliente_ID:i, Producto_ID:i",
          D.with_ctes([], "SELECT * FROM score_rows"))
def q_score_csv_scan(spark, sf):
    """S3: score rows read from CSV with the declared score schema."""
    from panelcast.sources import files
    return files.load_score_csv(spark, _view_csv_dir(spark, sf, "score_rows"))


@register("dimension_csv_scan", "dimension:s, key:i, name:s, state:s",
          D.with_ctes([], "SELECT 'product' AS dimension, Producto_ID AS key, NombreProducto AS name, "
                          "CAST(NULL AS VARCHAR) AS state FROM products UNION ALL "
                          "SELECT 'town', Agencia_ID, Town, State FROM towns"))
def q_dimension_csv_scan(spark, sf):
    """Product and town dimensions read from CSV with declared schemas."""
    from panelcast.sources import files
    products, towns, _ = files.load_dimensions(spark, _view_csv_dir(spark, sf, "products"),
                                               _view_csv_dir(spark, sf, "towns"))
    p = products.select(F.lit("product").alias("dimension"), F.col("Producto_ID").alias("key"),
                        F.col("NombreProducto").alias("name"), F.lit(None).cast("string").alias("state"))
    t = towns.select(F.lit("town").alias("dimension"), F.col("Agencia_ID").alias("key"),
                     F.col("Town").alias("name"), F.col("State").alias("state"))
    return p.unionByName(t)


def _store(spark, sf) -> str:
    from panelcast.session import scratch_path
    from panelcast.sources import files
    path = scratch_path(spark, "store")
    files.save_by_week(prepared(spark, sf).processed, path)
    return path


@register("store_roundtrip", PROCESSED_SHAPE, D.with_ctes([], "SELECT * FROM processed"))
def q_store_roundtrip(spark, sf):
    from panelcast.sources import files
    path = _store(spark, sf)
    weeks = files.available_weeks(spark, path)
    return files.load_weeks(spark, path, weeks)


@register("available_weeks", "Semana:i",
          D.with_ctes([], "SELECT DISTINCT Semana FROM processed"))
def q_available_weeks(spark, sf):
    from panelcast.sources import files
    weeks = files.available_weeks(spark, _store(spark, sf))
    return spark.createDataFrame([(w,) for w in weeks], "Semana int")


@register("ingest_stream", SALES_SHAPE, D.with_ctes([], _TYPED_SALES_SQL))
def q_ingest_stream(spark, sf):
    from panelcast.session import scratch_path
    from panelcast.streaming import ingest
    src, per_batch = _sales_csv_dir(spark, sf)
    store = scratch_path(spark, "ingest-store")
    ingest.ingest_available(spark, src, store, scratch_path(spark, "ingest-ckpt"),
                            files_per_batch=per_batch, timeout_s=600)
    return spark.read.parquet(store)


@register("ingest_stream_preprocessed", PROCESSED_SHAPE,
          D.with_ctes([], "SELECT Semana, Agencia_ID, Canal_ID, Ruta_SAK, Cliente_ID, Producto_ID, "
                          "Venta_uni_hoy, CAST(CAST(Venta_hoy AS FLOAT) AS DOUBLE) AS Venta_hoy, "
                          "Dev_uni_proxima, CAST(CAST(Dev_proxima AS FLOAT) AS DOUBLE) AS Dev_proxima, "
                          "Demanda_uni_equil, brand, weight_g, pieces, has_promo, State_encoded "
                          "FROM processed"))
def q_ingest_stream_preprocessed(spark, sf):
    """S2 into the processed store: each micro-batch is preprocessed with the
    static dimensions and the state encoding of the batch job."""
    from panelcast.session import scratch_path
    from panelcast.streaming import ingest
    p = prepared(spark, sf)
    src, per_batch = _sales_csv_dir(spark, sf)
    store = scratch_path(spark, "ingest-processed")
    ingest.ingest_available(spark, src, store, scratch_path(spark, "ingest-processed-ckpt"),
                            files_per_batch=per_batch, timeout_s=600,
                            transform=ingest.preprocess_transform(p.meta, p.towns, p.state_map))
    return spark.read.parquet(store)


@register("ingest_with_rejects", "kind:s, Semana:i, n:i, demand:i", D.with_ctes([], """
SELECT 'stored' AS kind, Semana, count(*) AS n, sum(Demanda_uni_equil) AS demand FROM demand_sales
WHERE Cliente_ID % 4 < 2 OR (Cliente_ID % 4 = 2 AND Producto_ID % 5 <> 0) GROUP BY Semana
UNION ALL SELECT 'malformed row', NULL, count(*), NULL FROM demand_sales
WHERE Cliente_ID % 4 = 2 AND Producto_ID % 5 = 0 HAVING count(*) > 0
UNION ALL SELECT 'missing columns: Demanda_uni_equil', NULL, count(*), NULL FROM demand_sales
WHERE Cliente_ID % 4 = 3 HAVING count(*) > 0"""))
def q_ingest_with_rejects(spark, sf):
    """S2 over files with reordered and extra columns, malformed values and a
    missing column, run twice: rows stored by week, rows rejected by reason."""
    from panelcast.session import scratch_path
    from panelcast.streaming import ingest
    sales, src = view(spark, sf, "demand_sales"), scratch_path(spark, "mixed-csv")
    broken = F.concat(F.when(F.col("Producto_ID") % 5 == 0, "x").otherwise(""), F.col("Canal_ID").cast("string"))
    for i, part in enumerate((sales, sales.select(F.lit("n").alias("nota"), *reversed(sales.columns)),
                              sales.withColumn("Canal_ID", broken), sales.drop("Demanda_uni_equil"))):
        part = part.where(F.col("Cliente_ID") % 4 == i)
        part.repartition(_csv_files(part, 2)).write.option("header", True).csv(f"{src}/{i}")
    store, rejects, ckpt = (scratch_path(spark, f"mixed-{k}") for k in ("store", "rejects", "ckpt"))
    for _ in range(2):
        ingest.ingest_with_rejects(spark, f"{src}/*", store, rejects, ckpt, files_per_batch=3, timeout_s=600)
    stored = spark.read.parquet(store).groupBy("Semana").agg(F.count(F.lit(1)).alias("n"), F.sum(Y).alias("demand"))
    rejected = ingest.rejected_rows(spark, rejects).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return (stored.select(F.lit("stored").alias("kind"), "Semana", "n", "demand")
                  .unionByName(rejected.select(F.col("reason").alias("kind"), F.lit(None).cast("int").alias("Semana"), "n",
                                               F.lit(None).cast("long").alias("demand"))))


# --- features ---------------------------------------------------------------

@register("weekly_demand", "Cliente_ID:i, Producto_ID:i, Semana:i, Demanda_uni_equil:i",
          D.with_ctes([], f"SELECT Cliente_ID, Producto_ID, Semana, sum({Y}) AS {Y} FROM demand_sales "
                          "GROUP BY Cliente_ID, Producto_ID, Semana"))
def q_weekly_demand(spark, sf):
    return lags.weekly_demand(view(spark, sf, "demand_sales"))


_ev_ctes = D.lag_sql("demand_events", 7, "ev")
_sl_ctes = D.lag_sql("demand_sales", VAL_WEEK, "sl")


@register("lag_features", LAG_SHAPE, D.with_ctes(_ev_ctes, "SELECT * FROM ev_lag"))
def q_lag_features(spark, sf):
    return lags.lag_features(view(spark, sf, "demand_events"), 7)


@register("lag_features_sparse", LAG_SHAPE, D.with_ctes(_sl_ctes, "SELECT * FROM sl_lag"))
def q_lag_features_sparse(spark, sf):
    return lags.lag_features(view(spark, sf, "demand_sales"), VAL_WEEK)


ROLL_SHAPE = "Cliente_ID:i, Producto_ID:i, " + ", ".join(f"{c}:d" for c in C.ROLLING_COLS)


@register("rolling_features", ROLL_SHAPE,
          D.with_ctes(_sl_ctes, "SELECT Cliente_ID, Producto_ID, "
                      + ", ".join(C.ROLLING_COLS) + " FROM sl_lag"))
def q_rolling_features(spark, sf):
    out = lags.lag_features(view(spark, sf, "demand_sales"), VAL_WEEK, lags=[])
    return out.select("Cliente_ID", "Producto_ID", *C.ROLLING_COLS)


def _agg_query(name):
    keys = C.AGG_GROUP_KEYS[name]
    shape = ", ".join(f"{k}:i" for k in keys) + f", {name}_mean:d, {name}_std:d, {name}_count:i"

    @register(f"agg_{name}", shape, D.with_ctes([], D.agg_sql("demand_sales", VAL_WEEK, name)))
    def q(spark, sf):
        return aggregates.agg_table(view(spark, sf, "demand_sales"), name, keys, VAL_WEEK)
    return q


for _name in C.AGG_GROUP_KEYS:
    _agg_query(_name)


_bo_sql_ctes = [
    ("bo_h", f"SELECT s.*, coalesce(p.brand, 'UNK') AS brand FROM demand_sales s LEFT JOIN parsed p "
             f"USING (Producto_ID) WHERE s.Semana < {VAL_WEEK}"),
    ("bo_0", f"SELECT Cliente_ID, Producto_ID, avg({Y}) AS e FROM bo_h GROUP BY ALL"),
    ("bo_1", f"SELECT Ruta_SAK, Producto_ID, avg({Y}) AS e FROM bo_h GROUP BY ALL"),
    ("bo_2", f"SELECT Agencia_ID, Producto_ID, avg({Y}) AS e FROM bo_h GROUP BY ALL"),
    ("bo_3", f"SELECT Producto_ID, avg({Y}) AS e FROM bo_h GROUP BY ALL"),
    ("bo_4", f"SELECT brand, avg({Y}) AS e FROM bo_h GROUP BY ALL"),
    ("bo_5", f"SELECT avg({Y}) AS e FROM bo_h"),
    ("bo", f"""SELECT t.*,
       CASE WHEN l0.e IS NOT NULL THEN 0 WHEN l1.e IS NOT NULL THEN 1 WHEN l2.e IS NOT NULL THEN 2
            WHEN l3.e IS NOT NULL THEN 3 WHEN l4.e IS NOT NULL THEN 4 ELSE 5 END AS backoff_level,
       coalesce(l0.e, l1.e, l2.e, l3.e, l4.e, l5.e) AS backoff_estimate
FROM demand_sales t
LEFT JOIN parsed pb ON t.Producto_ID = pb.Producto_ID
LEFT JOIN bo_0 l0 ON t.Cliente_ID = l0.Cliente_ID AND t.Producto_ID = l0.Producto_ID
LEFT JOIN bo_1 l1 ON t.Ruta_SAK = l1.Ruta_SAK AND t.Producto_ID = l1.Producto_ID
LEFT JOIN bo_2 l2 ON t.Agencia_ID = l2.Agencia_ID AND t.Producto_ID = l2.Producto_ID
LEFT JOIN bo_3 l3 ON t.Producto_ID = l3.Producto_ID
LEFT JOIN bo_4 l4 ON coalesce(pb.brand, 'UNK') = l4.brand
CROSS JOIN bo_5 l5
WHERE t.Semana = {VAL_WEEK}"""),
]


def _backoff(spark, sf):
    p = prepared(spark, sf)
    tgt = p.sales.where(F.col("Semana") == VAL_WEEK)
    return backoff.backoff_features(tgt, p.sales, p.brand_map, VAL_WEEK)


@register("backoff_features", SALES_SHAPE + ", backoff_level:i, backoff_estimate:d",
          D.with_ctes(_bo_sql_ctes, "SELECT * FROM bo"))
def q_backoff_features(spark, sf):
    return _backoff(spark, sf)


@register("backoff_level_counts", "backoff_level:i, n:i",
          D.with_ctes(_bo_sql_ctes, "SELECT backoff_level, count(*) AS n FROM bo GROUP BY 1"))
def q_backoff_level_counts(spark, sf):
    return summaries.level_frequencies(_backoff(spark, sf))


_fm_ctes, _fm_body = D.feature_matrix_ctes(VAL_WEEK)


@register("feature_matrix", FM_SHAPE, D.with_ctes(_fm_ctes, _fm_body))
def q_feature_matrix(spark, sf):
    hist, inputs = stored(spark, sf)
    return pipeline.build_features(hist.where(F.col("Semana") == VAL_WEEK), hist, VAL_WEEK, **inputs)


MULTI_WEEKS = [4, 5, 6, 7, 8, 9]
_mctes, _mbodies = [], []
for _s in MULTI_WEEKS:
    _c, _b = D.feature_matrix_ctes(_s)
    _mctes += _c
    _mbodies.append(_b)


@register("feature_matrix_multi", FM_SHAPE, D.with_ctes(_mctes, "\nUNION ALL\n".join(_mbodies)))
def q_feature_matrix_multi(spark, sf):
    hist, inputs = stored(spark, sf)
    return pipeline.build_features_multi(hist, hist, MULTI_WEEKS, **inputs)


@register("training_set_roundtrip", FM_SHAPE, D.with_ctes(_mctes, "\nUNION ALL\n".join(_mbodies)))
def q_training_set_roundtrip(spark, sf):
    """The multi-week training set written partitioned by target week
    (in chunks of two target weeks) and read back with the model columns."""
    from panelcast.plans import jobs
    from panelcast.session import scratch_path
    from panelcast.sources import files
    hist, inputs = stored(spark, sf)
    path = scratch_path(spark, "training-set")
    jobs.write_training_set(hist, inputs, VAL_WEEK, path, weeks_per_job=2)
    return files.load_training_columns(spark, path, [*C.ID_COLS, Y, *C.FEATURE_COLS])


@register("written_encodings", "kind:s, value:s, code:i",
          D.with_ctes([], "SELECT 'brand' AS kind, brand AS value, brand_encoded AS code FROM brand_enc "
                          "UNION ALL SELECT 'state', State, State_encoded FROM state_map"))
def q_written_encodings(spark, sf):
    """Encodings written by the preprocessing job, read back."""
    from panelcast.sources import files
    stored(spark, sf)
    art = _STORES[(spark.sparkContext.applicationId, sf)]
    b = files.load_table(spark, art.feature("brand_encoding"))
    st = files.load_table(spark, art.feature("state_mapping"))
    return (b.select(F.lit("brand").alias("kind"), F.col("brand").alias("value"),
                     F.col("brand_encoded").alias("code"))
             .unionByName(st.select(F.lit("state").alias("kind"), F.col("State").alias("value"),
                                    F.col("State_encoded").alias("code"))))


# --- baselines and evaluation ----------------------------------------------

_l1_ctes, _l1_body = D.lag1_sql("demand_sales", f"(SELECT * FROM demand_sales WHERE Semana = {VAL_WEEK})",
                                VAL_WEEK, "b1")
_ma_ctes, _ma_body = D.ma_sql("demand_sales", f"(SELECT * FROM demand_sales WHERE Semana = {VAL_WEEK})",
                              VAL_WEEK, "b3")
_eval_ctes = _l1_ctes + [("lag1", _l1_body)] + _ma_ctes + [("ma3", _ma_body)]


_SCORED: dict = {}


def _scored(spark, sf, name):
    """Baseline predictions as the evaluation queries' input: computed and
    written once per session (as a model's scored output would be), then
    every report reads the written table instead of re-running the model."""
    from panelcast.session import materialize
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _SCORED:
        fn = {"lag1": _lag1, "ma3": _ma3}[name]
        _SCORED[key] = materialize(fn(spark, sf), f"scored-{name}")
    return _SCORED[key]


def _lag1(spark, sf):
    s = view(spark, sf, "demand_sales")
    return baselines.naive_lag1(s, s.where(F.col("Semana") == VAL_WEEK), VAL_WEEK)


def _ma3(spark, sf):
    s = view(spark, sf, "demand_sales")
    return baselines.moving_average(s, s.where(F.col("Semana") == VAL_WEEK), VAL_WEEK)


@register("baseline_lag1", PRED_SHAPE, D.with_ctes(_eval_ctes, "SELECT * FROM lag1"))
def q_baseline_lag1(spark, sf):
    return _lag1(spark, sf)


@register("baseline_ma3", PRED_SHAPE, D.with_ctes(_eval_ctes, "SELECT * FROM ma3"))
def q_baseline_ma3(spark, sf):
    return _ma3(spark, sf)


@register("metrics_overall", "model:s, " + METRIC_SHAPE,
          D.with_ctes(_eval_ctes, f"SELECT 'lag1' AS model, {D.metrics_select(Y, 'prediction')} FROM lag1 "
                                  f"UNION ALL SELECT 'ma3', {D.metrics_select(Y, 'prediction')} FROM ma3"))
def q_metrics_overall(spark, sf):
    a = evaluation.evaluate(_scored(spark, sf, "lag1"), Y, "prediction").select(F.lit("lag1").alias("model"), "*")
    b = evaluation.evaluate(_scored(spark, sf, "ma3"), Y, "prediction").select(F.lit("ma3").alias("model"), "*")
    return a.unionByName(b)


@register("metrics_by_segment", "Producto_ID:i, n:i, " + METRIC_SHAPE,
          D.with_ctes(_eval_ctes, f"SELECT Producto_ID, count(*) AS n, {D.metrics_select(Y, 'prediction')} "
                                  "FROM lag1 WHERE Producto_ID IS NOT NULL GROUP BY Producto_ID"))
def q_metrics_by_segment(spark, sf):
    return evaluation.evaluate_by_segment(_scored(spark, sf, "lag1"), Y, "prediction", "Producto_ID")


@register("worst_segments", "segment_col:s, segment:i, n:i, " + METRIC_SHAPE,
          D.with_ctes(_eval_ctes, f"""
SELECT * FROM (SELECT 'Producto_ID' AS segment_col, Producto_ID AS segment, count(*) AS n,
       {D.metrics_select(Y, 'prediction')} FROM lag1 GROUP BY Producto_ID
       ORDER BY rmse DESC, segment LIMIT {C.WORST_SEGMENTS}) a
UNION ALL
SELECT * FROM (SELECT 'Agencia_ID', Agencia_ID, count(*) AS n,
       {D.metrics_select(Y, 'prediction')} FROM lag1 GROUP BY Agencia_ID
       ORDER BY rmse DESC, Agencia_ID LIMIT {C.WORST_SEGMENTS}) b"""))
def q_worst_segments(spark, sf):
    pred = _scored(spark, sf, "lag1")
    out = []
    for seg in ("Producto_ID", "Agencia_ID"):
        w = evaluation.worst_segments(pred, Y, "prediction", seg, C.WORST_SEGMENTS)
        out.append(w.select(F.lit(seg).alias("segment_col"), F.col(seg).alias("segment"), "n",
                            *evaluation.METRIC_COLS))
    return out[0].unionByName(out[1])


@register("train_val_split", "role:s, n_rows:i, sum_demand:i",
          D.with_ctes([], f"SELECT 'train' AS role, count(*) AS n_rows, sum({Y}) AS sum_demand "
                          f"FROM demand_sales WHERE Semana < {VAL_WEEK} UNION ALL "
                          f"SELECT 'val', count(*), sum({Y}) FROM demand_sales WHERE Semana = {VAL_WEEK}"))
def q_train_val_split(spark, sf):
    tr, va = evaluation.temporal_split(view(spark, sf, "demand_sales"), VAL_WEEK)
    a = tr.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(Y).alias("sum_demand")).select(
        F.lit("train").alias("role"), "*")
    b = va.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(Y).alias("sum_demand")).select(
        F.lit("val").alias("role"), "*")
    return a.unionByName(b)


@register("rolling_cv_folds", "fold:i, val_semana:i, role:s, n_weeks:i, n_rows:i",
          D.with_ctes([("wk", "SELECT DISTINCT Semana FROM demand_sales"),
                       ("wr", "SELECT Semana, row_number() OVER (ORDER BY Semana) - 1 AS i FROM wk"),
                       ("vals", f"SELECT Semana AS val_semana, i - {C.CV_MIN_TRAIN_WEEKS} + 1 AS fold "
                                f"FROM wr WHERE i >= {C.CV_MIN_TRAIN_WEEKS}")], """
SELECT v.fold, v.val_semana, CASE WHEN s.Semana = v.val_semana THEN 'val' ELSE 'train' END AS role,
       count(DISTINCT s.Semana) AS n_weeks, count(*) AS n_rows
FROM demand_sales s JOIN vals v ON s.Semana <= v.val_semana
GROUP BY 1, 2, 3"""))
def q_rolling_cv_folds(spark, sf):
    s = view(spark, sf, "demand_sales")
    folds = evaluation.cv_fold_table(s)
    rows = s.groupBy("Semana").agg(F.count(F.lit(1)).alias("n"))
    return (folds.join(rows, "Semana")
                 .groupBy("fold", "val_semana", "role")
                 .agg(F.countDistinct("Semana").alias("n_weeks"), F.sum("n").alias("n_rows")))


_hist_ctes = (_eval_ctes
              + [("err", f"SELECT prediction - CAST({Y} AS DOUBLE) AS error FROM lag1"),
                 ("errc", f"SELECT error FROM err, (SELECT quantile_cont(abs(error), {C.CLIP_PERCENTILE}) AS c "
                          f"FROM err) q WHERE error > -q.c AND error < q.c")])
_ha_c, _ha_b = D.histogram_sql("err", "error", C.ERROR_BINS, "ha")
_hc_c, _hc_b = D.histogram_sql("errc", "error", C.ERROR_BINS, "hc")


@register("error_histogram", HIST_SHAPE,
          D.with_ctes(_hist_ctes + _ha_c + _hc_c,
                      f"SELECT 'all' AS variant, * FROM ({_ha_b}) UNION ALL SELECT 'clipped', * FROM ({_hc_b})"))
def q_error_histogram(spark, sf):
    return evaluation.error_histograms(_scored(spark, sf, "lag1"), Y, "prediction")


@register("sample_limits", "max_value:d, actual_p99:d, predicted_p99:d",
          D.with_ctes(_eval_ctes, f"SELECT greatest(max(CAST({Y} AS DOUBLE)), max(prediction)) AS max_value, "
                                  f"quantile_cont(CAST({Y} AS DOUBLE), {C.CLIP_PERCENTILE}) AS actual_p99, "
                                  f"quantile_cont(prediction, {C.CLIP_PERCENTILE}) AS predicted_p99 FROM lag1"))
def q_sample_limits(spark, sf):
    return evaluation.sample_limits(_scored(spark, sf, "lag1"), Y, "prediction")


# --- drift and monitoring ---------------------------------------------------

_ks_ctes = _eval_ctes + [
    ("ksv", "SELECT prediction AS v, 1 AS r, 0 AS c FROM lag1 UNION ALL SELECT prediction, 0, 1 FROM ma3"),
    ("ksc", "SELECT v, sum(r) AS r, sum(c) AS c FROM ksv WHERE v IS NOT NULL GROUP BY v"),
    ("kss", "SELECT v, sum(r) OVER (ORDER BY v) AS cr, sum(c) OVER (ORDER BY v) AS cc, "
            "sum(r) OVER () AS nr, sum(c) OVER () AS nc FROM ksc"),
    ("ksd", "SELECT max(abs(cr / nr - cc / nc)) AS d, max(nr) AS nr, max(nc) AS nc FROM kss"),
]


@register("ks_prediction", "ks_statistic:d, p_value:d, drift_detected:b, reference_mean:d, current_mean:d, "
                           "reference_std:d, current_std:d",
          D.with_ctes(_ks_ctes, f"""
SELECT d AS ks_statistic, {D.ks_pvalue_sql('d', 'nr', 'nc')} AS p_value,
       {D.ks_pvalue_sql('d', 'nr', 'nc')} < {C.DRIFT_THRESHOLD} AS drift_detected,
       (SELECT avg(prediction) FROM lag1) AS reference_mean, (SELECT avg(prediction) FROM ma3) AS current_mean,
       (SELECT stddev_pop(prediction) FROM lag1) AS reference_std,
       (SELECT stddev_pop(prediction) FROM ma3) AS current_std
FROM ksd"""))
def q_ks_prediction(spark, sf):
    return drift.prediction_drift(_scored(spark, sf, "lag1"), _scored(spark, sf, "ma3"))


def _ks_features_sql() -> str:
    present = [c for c in DRIFT_FEATURES if c != "not_a_column"]
    unions = []
    for c in present:
        unions.append(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, 1 AS r, 0 AS c FROM processed "
                      f"WHERE Semana = 8 AND {c} IS NOT NULL")
        unions.append(f"SELECT '{c}', CAST({c} AS DOUBLE), 0, 1 FROM processed "
                      f"WHERE Semana = 9 AND {c} IS NOT NULL")
    ctes = [("fv", " UNION ALL ".join(unions)),
            ("fc", "SELECT feature, v, sum(r) AS r, sum(c) AS c FROM fv GROUP BY feature, v"),
            ("fs", "SELECT feature, v, sum(r) OVER (PARTITION BY feature ORDER BY v) AS cr, "
                   "sum(c) OVER (PARTITION BY feature ORDER BY v) AS cc, "
                   "sum(r) OVER (PARTITION BY feature) AS nr, sum(c) OVER (PARTITION BY feature) AS nc FROM fc"),
            ("fd", "SELECT feature, max(abs(cr / nr - cc / nc)) AS d, max(nr) AS nr, max(nc) AS nc "
                   "FROM fs GROUP BY feature"),
            ("fm", "SELECT feature, sum(v * r) / sum(r) AS ref_mean, sum(v * c) / sum(c) AS cur_mean "
                   "FROM fv GROUP BY feature")]
    body = (f"SELECT fd.feature, d AS ks_statistic, {D.ks_pvalue_sql('d', 'nr', 'nc')} AS p_value, "
            f"{D.ks_pvalue_sql('d', 'nr', 'nc')} < {C.DRIFT_THRESHOLD} AS drift_detected, "
            f"fm.ref_mean, fm.cur_mean FROM fd JOIN fm ON fd.feature = fm.feature WHERE nr > 0 AND nc > 0")
    return D.with_ctes(ctes, body)


@register("ks_features", "feature:s, ks_statistic:d, p_value:d, drift_detected:b, ref_mean:d, cur_mean:d",
          _ks_features_sql())
def q_ks_features(spark, sf):
    proc, _ = stored(spark, sf)
    return drift.feature_drift(proc.where(F.col("Semana") == 8), proc.where(F.col("Semana") == 9),
                               DRIFT_FEATURES)


@register("bias_by_segment", "Agencia_ID:i, n:i, bias:d, overall_bias:d, high_bias:b",
          D.with_ctes(_eval_ctes, f"""
SELECT Agencia_ID, count(*) AS n, avg(prediction - {Y}) AS bias,
       (SELECT avg(prediction - {Y}) FROM lag1) AS overall_bias,
       abs(avg(prediction - {Y})) > {C.HIGH_BIAS_FACTOR} * abs((SELECT avg(prediction - {Y}) FROM lag1)) AS high_bias
FROM lag1 GROUP BY Agencia_ID"""))
def q_bias_by_segment(spark, sf):
    return drift.bias_monitor(_scored(spark, sf, "lag1"), Y, "prediction", "Agencia_ID")


_d_r_c, _d_r_b = D.histogram_sql("lag1", "prediction", C.DRIFT_BINS, "dr")
_d_c_c, _d_c_b = D.histogram_sql("ma3", "prediction", C.DRIFT_BINS, "dc")


@register("drift_density", "sample:s, bin:i, lo:d, hi:d, n:i, density:d",
          D.with_ctes(_eval_ctes + _d_r_c + _d_c_c, f"""
SELECT 'reference' AS sample, h.*, n / (sum(n) OVER () * (hi - lo)) AS density FROM ({_d_r_b}) h
UNION ALL
SELECT 'current', h.*, n / (sum(n) OVER () * (hi - lo)) FROM ({_d_c_b}) h"""))
def q_drift_density(spark, sf):
    dens, _ = drift.drift_report(_scored(spark, sf, "lag1"), _scored(spark, sf, "ma3"))
    return dens


@register("ecdf", "sample:s, value:d, n:i, cum:i, ecdf_lo:d, ecdf:d",
          D.with_ctes(_eval_ctes + [
              ("ev", "SELECT 'reference' AS sample, prediction AS value FROM lag1 UNION ALL "
                     "SELECT 'current', prediction FROM ma3"),
              ("evc", "SELECT sample, value, count(*) AS n FROM ev WHERE value IS NOT NULL GROUP BY ALL"),
          ], """
SELECT sample, value, n, sum(n) OVER w AS cum,
       (sum(n) OVER w - n) / CAST(greatest(sum(n) OVER (PARTITION BY sample) - 1, 1) AS DOUBLE) AS ecdf_lo,
       (sum(n) OVER w - 1) / CAST(greatest(sum(n) OVER (PARTITION BY sample) - 1, 1) AS DOUBLE) AS ecdf
FROM evc WINDOW w AS (PARTITION BY sample ORDER BY value)"""))
def q_ecdf(spark, sf):
    _, curves = drift.drift_report(_scored(spark, sf, "lag1"), _scored(spark, sf, "ma3"))
    return curves


# --- scoring ----------------------------------------------------------------

_sc_l1_ctes, _sc_l1_body = D.lag1_sql("demand_sales", "score_rows", 10, "sc")


_BAD = """SELECT id, CASE id % 7 WHEN 1 THEN 99 WHEN 4 THEN NULL ELSE Semana END AS Semana, Agencia_ID, Canal_ID,
       CASE id % 7 WHEN 3 THEN NULL ELSE Ruta_SAK END AS Ruta_SAK,
       CASE id % 7 WHEN 2 THEN -1 - Cliente_ID ELSE Cliente_ID END AS Cliente_ID, Producto_ID FROM score_rows"""


@register("request_validation", "id:i, is_valid:b, reason:s",
          D.with_ctes([("requests", _BAD)], """
SELECT id, id % 7 NOT IN (1, 2, 3, 4) AS is_valid,
       CASE id % 7 WHEN 1 THEN 'Semana outside 3..15' WHEN 2 THEN 'Cliente_ID negative'
                   WHEN 3 THEN 'Ruta_SAK missing' WHEN 4 THEN 'Semana missing' END AS reason FROM requests"""))
def q_request_validation(spark, sf):
    kind = F.col("id") % 7
    bad = (view(spark, sf, "score_rows")
           .withColumn("Semana", F.when(kind == 1, 99).when(kind != 4, F.col("Semana")))
           .withColumn("Ruta_SAK", F.when(kind != 3, F.col("Ruta_SAK")))
           .withColumn("Cliente_ID", F.when(kind == 2, -1 - F.col("Cliente_ID")).otherwise(F.col("Cliente_ID"))))
    return scoring.validate_requests(bad)


@register("batch_scores_lag1", f"id:i, {Y}:i",
          D.with_ctes(_sc_l1_ctes + [("scp", _sc_l1_body)],
                      f"SELECT id, CAST(greatest(round_even(prediction, 0), 0) AS BIGINT) AS {Y} FROM scp"))
def q_batch_scores_lag1(spark, sf):
    return _scores(spark, sf)


def _scores(spark, sf):
    hist = view(spark, sf, "demand_sales")
    reqs = view(spark, sf, "score_rows")

    def features(rows, weeks):
        return rows

    def model(rows):
        return baselines.naive_lag1_multi(hist, rows)

    scored = scoring.score_batch(reqs, model, features)
    return scoring.submission(scored)


@register("prediction_summary", "mean_units:d, median_units:d, max_units:i",
          D.with_ctes(_sc_l1_ctes + [("scp", _sc_l1_body),
                                     ("sub", f"SELECT id, CAST(greatest(round_even(prediction, 0), 0) AS BIGINT) "
                                             f"AS u FROM scp")],
                      "SELECT avg(u) AS mean_units, median(u) AS median_units, max(u) AS max_units FROM sub"))
def q_prediction_summary(spark, sf):
    return summaries.prediction_summary(_scores(spark, sf))


# --- model (rows-only checks: boosting is not SQL-expressible) --------------

_MODELS: dict = {}


def _trained(spark, sf, quantiles: bool = False):
    """Features for weeks 4..9 (A7), the Tweedie model with early stopping on
    week 9 and, when asked for, the two quantile models; memoised per session
    and fixture, so each is trained once."""
    from panelcast.operators import boosting
    from panelcast.session import materialize
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        hist, inputs = stored(spark, sf)
        fm = materialize(pipeline.build_features_multi(hist, hist, MULTI_WEEKS, **inputs), "features")
        train, val = fm.where(F.col("Semana") < VAL_WEEK), fm.where(F.col("Semana") == VAL_WEEK)
        learner = boosting.BoostingRegressor(C.FEATURE_COLS, Y)
        blocks = learner.bins(train, val)
        _MODELS[key] = [boosting.IntervalModel(learner.fit_blocks(blocks, True)), val, blocks]
    model, val, blocks = _MODELS[key]
    if quantiles and model.lower is None:
        model.lower, model.upper = boosting.quantile_models(blocks, model.main, C.FEATURE_COLS, Y)
    return model, val


@register("gbm_metrics", "model:s, " + METRIC_SHAPE, None)
def q_gbm_metrics(spark, sf):
    model, val = _trained(spark, sf)
    g = evaluation.evaluate(model.main.transform(val), Y, "prediction").select(
        F.lit("gbm").alias("model"), "*")
    return g.unionByName(q_metrics_overall(spark, sf))


@register("gbm_interval_scores", "id:i, prediction:d, lower:d, upper:d, Demanda_uni_equil:i", None)
def q_gbm_interval_scores(spark, sf):
    model, _ = _trained(spark, sf, quantiles=True)
    hist, inputs = stored(spark, sf)
    valid, _ = scoring.split_requests(view(spark, sf, "score_rows"))
    feats = pipeline.build_features_multi(valid, hist, [10], include_target=False, keep=("id",),
                                          **inputs)
    scored = model.transform(feats)
    return scored.select("id", "prediction", "lower", "upper",
                         scoring.round_units(F.col("prediction")).alias(Y))


@register("feature_importance", "position:i, feature:s, importance:d", None)
def q_feature_importance(spark, sf):
    model, _ = _trained(spark, sf)
    return model.main.importance_frame(spark, C.TOP_FEATURES)


@register("shap_importance", "feature:s, mean_abs_shap:d", None)
def q_shap_importance(spark, sf):
    from panelcast.operators import attribution
    model, val = _trained(spark, sf)
    return attribution.mean_abs_attribution(model.main, val)


# --- trees small enough for SQL: same bins, same sums, same order of growth ---------

#: feature -> upper bin edges; features in the order of their ties
_TREE_BINS = {"lag_1": [0, 4, 8, 15, 22, 30, 40], "product_mean": [20, 23, 24, 25, 25.5, 26, 27, 30],
              "client_count": [5, 20, 30, 40, 50], "backoff_estimate": [5, 10, 20, 25, 30, 40], "target_semana": [9]}
_L1, _L2, _LEAST_ROWS = C.GBM_PARAMS["lambda_l1"], C.GBM_PARAMS["lambda_l2"], C.GBM_PARAMS["min_child_samples"]


def _small_tree(spark, sf, objective: str, leaves: int, **kw):
    """One round on the feature matrix, without bagging or feature sampling."""
    from panelcast.operators import boosting
    fm = q_feature_matrix(spark, sf)
    params = {"bagging_freq": 0, "feature_fraction": 1.0, "num_leaves": leaves}
    return boosting.BoostingRegressor(list(_TREE_BINS), Y, objective, num_rounds=1, params=params,
                                      edges=list(_TREE_BINS.values()), **kw).fit(fm)


def _best_split_sql(src: str) -> str:
    """Best split of each ``side`` of ``src`` (columns side, g, h and features)."""
    score = lambda g, h: f"power(greatest(abs({g}) - {_L1}, 0), 2) / ({h} + {_L2})"
    cases = " UNION ALL ".join(
        f"SELECT side, {i} AS f, '{c}' AS feature, edge, sum(g) FILTER (WHERE {c} <= edge) AS gl, sum(h) FILTER (WHERE {c} <= edge) AS hl, "
        f"count(*) FILTER (WHERE {c} <= edge) AS nl, sum(g) AS g, sum(h) AS h, count(*) AS n "
        f"FROM {src}, (SELECT unnest({[float(e) for e in edges]}) AS edge) GROUP BY side, edge" for i, (c, edges) in enumerate(_TREE_BINS.items()))
    return (f"SELECT * FROM (SELECT *, {score('gl', 'hl')} + {score('(g - gl)', '(h - hl)')} - {score('g', 'h')} AS gain FROM ({cases}) "
            f"WHERE nl >= {_LEAST_ROWS} AND n - nl >= {_LEAST_ROWS}) WHERE gain > 1e-12 "
            "QUALIFY row_number() OVER (PARTITION BY side ORDER BY gain DESC, f, edge) = 1")


_goes_low = "CASE r.feature " + " ".join(f"WHEN '{c}' THEN w.{c}" for c in _TREE_BINS) + " END <= r.edge"
_tweedie_ctes = [*_fm_ctes, ("fm", _fm_body), ("b", f"SELECT ln(avg({Y})) AS b FROM fm"),
                 ("w", f"SELECT 'root' AS side, {Y} * exp(-0.5 * b) - exp(0.5 * b) AS g, 0.5 * {Y} * exp(-0.5 * b) + 0.5 * exp(0.5 * b) AS h, "
                       + ", ".join(_TREE_BINS) + " FROM fm, b"),
                 ("r", _best_split_sql("w")),
                 ("w2", f"SELECT CASE WHEN {_goes_low} THEN 'low' ELSE 'high' END AS side, w.* EXCLUDE (side) FROM w, r"),
                 ("r2", _best_split_sql("w2")),
                 ("nodes", "SELECT * FROM r UNION ALL SELECT * FROM r2")]
_leaf_sql = lambda g, h: f"sign({g}) * greatest(abs({g}) - {_L1}, 0) / ({h} + {_L2})"


@register("gbm_tree", "node:s, feature:s, threshold:d, gain:d, n:i, low_n:i, low_value:d, high_value:d",
          D.with_ctes(_tweedie_ctes, f"SELECT side AS node, feature, edge AS threshold, gain, n, nl AS low_n, "
                                     f"CASE WHEN side <> 'root' THEN {_leaf_sql('gl', 'hl')} END AS low_value, "
                                     f"CASE WHEN side <> 'root' THEN {_leaf_sql('(g - gl)', '(h - hl)')} END AS high_value FROM nodes"))
def q_gbm_tree(spark, sf):
    """M3: splits, gains and Newton leaves of a two-level Tweedie tree."""
    nodes = _small_tree(spark, sf, "tweedie", 4, max_depth=2).nodes_frame(spark)
    inner, low, high = (nodes.alias(a) for a in ("t", "l", "h"))
    value = lambda side: F.when(F.col(f"{side}.feature").isNull(), F.col(f"{side}.value"))
    side = F.when(F.col("t.node") == 0, "root").when(F.col("t.path") == "0", "low").otherwise("high")
    return (inner.where("feature IS NOT NULL").join(low, F.col("t.low") == F.col("l.node")).join(high, F.col("t.high") == F.col("h.node"))
            .select(side.alias("node"), "t.feature", "t.threshold", "t.gain", F.col("t.n").cast("long"), F.col("l.n").cast("long").alias("low_n"),
                    F.when(side != "root", value("l")).alias("low_value"), F.when(side != "root", value("h")).alias("high_value")))


@register("gbm_gain", "position:i, feature:s, importance:d",
          D.with_ctes(_tweedie_ctes, "SELECT row_number() OVER (ORDER BY importance DESC, feature) AS position, feature, importance FROM ("
                                     "SELECT f.feature, coalesce(sum(gain), 0) AS importance FROM (SELECT unnest("
                                     f"{list(_TREE_BINS)}) AS feature) f LEFT JOIN nodes ON nodes.feature = f.feature GROUP BY f.feature)"))
def q_gbm_gain(spark, sf):
    """Gain of the boosting objective by feature, ranked."""
    return _small_tree(spark, sf, "tweedie", 4, max_depth=2).importance_frame(spark, C.TOP_FEATURES)


_alpha = C.QUANTILE_ALPHAS[1]


@register("gbm_leaf_quantiles", "base:d, side:s, feature:s, threshold:d, n:i, value:d",
          D.with_ctes([*_fm_ctes, ("fm", _fm_body), ("b", f"SELECT quantile_cont(CAST({Y} AS DOUBLE), {_alpha}) AS b FROM fm"),
                       ("w", f"SELECT 'root' AS side, {Y} - b AS residual, CASE WHEN {Y} >= b THEN {_alpha} ELSE {_alpha} - 1 END AS g, 1.0 AS h, "
                             + ", ".join(_TREE_BINS) + " FROM fm, b"),
                       ("r", _best_split_sql("w"))],
                      f"SELECT any_value(b) AS base, CASE WHEN {_goes_low} THEN 'low' ELSE 'high' END AS side, any_value(r.feature) AS feature, "
                      f"any_value(r.edge) AS threshold, count(*) AS n, quantile_cont(residual, {_alpha}) AS value FROM w, r, b GROUP BY 2"))
def q_gbm_leaf_quantiles(spark, sf):
    """M5: both leaves of a stump hold the exact quantile of their residuals."""
    model = _small_tree(spark, sf, "quantile", 2, alpha=_alpha)
    nodes = model.nodes_frame(spark)
    root = nodes.where("feature IS NOT NULL").select("feature", "threshold")
    return nodes.where("feature IS NULL").crossJoin(root.alias("r")).select(
        F.lit(model.base_score).alias("base"), F.when(F.col("path") == "0", "low").otherwise("high").alias("side"), "r.feature", "r.threshold",
        F.col("n").cast("long"), "value")


_SAMPLE_KEYS = [*C.ID_COLS, Y]


def _sample_sql(n: int) -> str:
    key = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in _SAMPLE_KEYS)
    return (f"SELECT CAST({Y} AS DOUBLE) AS actual, prediction AS predicted FROM lag1 "
            f"ORDER BY md5(concat_ws('|', '{C.SAMPLE_SEED}', {key})) LIMIT {n}")


@register("scatter_sample", "actual:d, predicted:d", D.with_ctes(_eval_ctes, _sample_sql(C.SCATTER_SAMPLE)))
def q_scatter_sample(spark, sf):
    s = evaluation.seeded_sample(_scored(spark, sf, "lag1"), C.SCATTER_SAMPLE, _SAMPLE_KEYS)
    return s.select(F.col(Y).alias("actual"), F.col("prediction").alias("predicted"))


@register("seeded_sample", "actual:d, predicted:d", D.with_ctes(_eval_ctes, _sample_sql(500)))
def q_seeded_sample(spark, sf):
    """E9 with a size that is smaller than the table at every scale."""
    s = evaluation.seeded_sample(_scored(spark, sf, "lag1"), 500, _SAMPLE_KEYS)
    return s.select(F.col(Y).alias("actual"), F.col("prediction").alias("predicted"))


_rs_c, _rs_b = D.histogram_sql("res", "residual", C.ERROR_BINS, "rs")


@register("residual_histogram", "bin:i, lo:d, hi:d, n:i",
          D.with_ctes(_eval_ctes + [("res", f"SELECT CAST({Y} AS DOUBLE) - prediction AS residual FROM lag1")] + _rs_c, _rs_b))
def q_residual_histogram(spark, sf):
    pred = _scored(spark, sf, "lag1")
    return evaluation.histogram(evaluation.residuals(pred, Y, "prediction"), "residual", C.ERROR_BINS)


_ih_c, _ih_b = D.histogram_sql("gap", "gap", 37, "ih")


@register("integer_histogram", "bin:i, lo:d, hi:d, n:i",
          D.with_ctes([("gap", f"SELECT {Y} - 2 * Venta_uni_hoy AS gap FROM demand_sales")] + _ih_c, _ih_b))
def q_integer_histogram(spark, sf):
    """E10 on integers, many of which lie on a bin's edge."""
    gap = view(spark, sf, "demand_sales").select((F.col(Y) - 2 * F.col("Venta_uni_hoy")).alias("gap"))
    return evaluation.histogram(gap, "gap", 37)


@register("metrics_with_missing", METRIC_SHAPE,
          D.with_ctes(_eval_ctes, f"SELECT {D.metrics_select(Y, 'prediction')} FROM lag1 "
                                  "WHERE Producto_ID % 5 <> 0 AND Producto_ID % 7 <> 0 AND Cliente_ID % 11 <> 0"))
def q_metrics_with_missing(spark, sf):
    """E1-E5 when predictions are null or NaN and actual values are null."""
    product, df = F.col("Producto_ID"), _scored(spark, sf, "lag1")
    df = df.withColumn("prediction", F.when(product % 7 == 0, F.lit(float("nan"))).when(product % 5 != 0, F.col("prediction")))
    return evaluation.evaluate(df.withColumn(Y, F.when(F.col("Cliente_ID") % 11 != 0, F.col(Y))), Y, "prediction")


@register("aligned_features", "Cliente_ID:i, Producto_ID:i, State_encoded:d, absent:d, lag_1:d, product_mean:d",
          D.with_ctes(_fm_ctes, f"SELECT Cliente_ID, Producto_ID, State_encoded, 0.0 AS absent, lag_1, product_mean "
                                f"FROM ({_fm_body}) f"))
def q_aligned_features(spark, sf):
    """Another feature list, in another order, with an unknown feature."""
    return pipeline.align_features(q_feature_matrix(spark, sf), ["State_encoded", "absent", "lag_1", "product_mean"],
                                   ["Cliente_ID", "Producto_ID"])


@register("csv_report", "Producto_ID:i, n:i, " + METRIC_SHAPE,
          D.with_ctes(_eval_ctes, f"SELECT Producto_ID, count(*) AS n, {D.metrics_select(Y, 'prediction')} "
                                  "FROM lag1 WHERE Producto_ID IS NOT NULL GROUP BY Producto_ID"))
def q_csv_report(spark, sf):
    """A report written as CSV and read back."""
    from panelcast.session import scratch_path
    from panelcast.sources import sinks
    report, path = q_metrics_by_segment(spark, sf), scratch_path(spark, "report")
    sinks.write_csv_report(report, path)
    return spark.read.schema(report.schema).option("header", True).csv(path)


@register("run_row", "val_semana:i, n_features:i, n_train_rows:i, n_val_rows:i, lag1_rmse:d, ma3_rmse:d",
          D.with_ctes(_eval_ctes, f"""
SELECT {VAL_WEEK} AS val_semana, {len(C.FEATURE_COLS)} AS n_features,
       (SELECT count(*) FROM demand_sales WHERE Semana < {VAL_WEEK}) AS n_train_rows,
       (SELECT count(*) FROM demand_sales WHERE Semana = {VAL_WEEK}) AS n_val_rows,
       (SELECT sqrt(avg(power({Y} - prediction, 2))) FROM lag1) AS lag1_rmse,
       (SELECT sqrt(avg(power({Y} - prediction, 2))) FROM ma3) AS ma3_rmse"""))
def q_run_row(spark, sf):
    """The run table with the baselines' metrics, read back."""
    from panelcast.session import scratch_path
    from panelcast.sources import sinks
    sales, path = view(spark, sf, "demand_sales"), scratch_path(spark, "runs")
    train, val = evaluation.temporal_split(sales, VAL_WEEK)
    found = {r["model"]: r.asDict() for r in q_metrics_overall(spark, sf).collect()}
    sinks.append_run(spark, path, val_semana=VAL_WEEK, n_features=len(C.FEATURE_COLS), n_train_rows=train.count(),
                     n_val_rows=val.count(), best_iteration=0, params={}, metrics=found)
    rmse = lambda m: F.get_json_object("metrics", f"$.{m}.rmse").cast("double").alias(f"{m}_rmse")
    return spark.read.parquet(path).select("val_semana", "n_features", "n_train_rows", "n_val_rows", rmse("lag1"), rmse("ma3"))



@register("training_job", "val_semana:i, n_features:i, n_train_rows:i, n_val_rows:i, lag1_rmse:d, ma3_rmse:d, rule_followed:b",
          D.with_ctes(_eval_ctes, f"""
SELECT {VAL_WEEK} AS val_semana, {len(C.FEATURE_COLS)} AS n_features,
       (SELECT count(*) FROM demand_sales WHERE Semana < {VAL_WEEK} AND Semana > (SELECT min(Semana) FROM demand_sales)) AS n_train_rows,
       (SELECT count(*) FROM demand_sales WHERE Semana = {VAL_WEEK}) AS n_val_rows,
       (SELECT sqrt(avg(power({Y} - prediction, 2))) FROM lag1) AS lag1_rmse,
       (SELECT sqrt(avg(power({Y} - prediction, 2))) FROM ma3) AS ma3_rmse, TRUE AS rule_followed"""))
def q_training_job(spark, sf):
    """The whole training job (training set, baselines, the main model
    until early stopping, report, saved model), told by its run row; the
    job accepts the model if its RMSE is below that of lag 1."""
    from panelcast.plans import jobs
    stored(spark, sf)
    art = _STORES[spark.sparkContext.applicationId, sf]
    accepted = jobs.run_training(spark, art, with_quantiles=False)["accepted"]
    rmse = lambda m: F.get_json_object("metrics", f"$.{m}.rmse").cast("double")
    runs = spark.read.parquet(art.runs).orderBy(F.desc("run_ts")).limit(1)          # of this run
    return runs.select("val_semana", "n_features", "n_train_rows", "n_val_rows", rmse("baseline_lag1").alias("lag1_rmse"),
                       rmse("baseline_ma").alias("ma3_rmse"), ((rmse("gbm") < rmse("baseline_lag1")) == F.lit(accepted)).alias("rule_followed"))

# --- a fixed ensemble: scoring, persistence and attribution have closed forms ----

#: (feature, threshold, value at or below it, value above it, share of rows at or below it)
_STUMPS = [("lag_1", 4.0, -0.6, 0.9, 0.7), ("product_mean", 20.0, -0.2, 0.5, 0.4), ("lag_1", 30.0, 0.1, 0.8, 0.9),
           ("client_count", 6.0, 0.25, -0.35, 0.5)]
_BASE, _RATE = 1.2, 0.5


def _ensemble(objective: str, base: float):
    from panelcast.operators.boosting import BoostedTrees, Tree
    cols = sorted({s[0] for s in _STUMPS})
    trees = [Tree(feature=[cols.index(f), -1, -1], threshold=[t, 0.0, 0.0], left=[1, -1, -1], right=[2, -1, -1],
                  value=[0.0, lo, hi], gain=[1.0, 0.0, 0.0], cover=[100.0, 100 * share, 100 * (1 - share)])
             for f, t, lo, hi, share in _STUMPS]
    return BoostedTrees(cols, objective, base, _RATE, trees, best_iteration=len(trees))


def _margin_sql(base: float) -> str:
    return f"({base}" + "".join(f" + {_RATE} * CASE WHEN {f} <= {t} THEN {lo} ELSE {hi} END" for f, t, lo, hi, _ in _STUMPS) + ")"


@register("ensemble_scores", "Cliente_ID:i, Producto_ID:i, Ruta_SAK:i, Agencia_ID:i, prediction:d, lower:d, upper:d",
          D.with_ctes(_fm_ctes, f"SELECT Cliente_ID, Producto_ID, Ruta_SAK, Agencia_ID, exp({_margin_sql(_BASE)}) AS prediction, "
                                f"greatest({_margin_sql(-0.4)}, 0.0) AS lower, greatest({_margin_sql(2.5)}, 0.0) AS upper "
                                f"FROM ({_fm_body}) f"))
def q_ensemble_scores(spark, sf):
    """A model triple saved, loaded and applied to the features."""
    from panelcast.operators.boosting import IntervalModel
    from panelcast.session import scratch_path
    path = scratch_path(spark, "model")
    IntervalModel(_ensemble("tweedie", _BASE), _ensemble("quantile", -0.4), _ensemble("quantile", 2.5)).save(spark, path)
    return IntervalModel.load(spark, path).transform(q_feature_matrix(spark, sf))


def _attribution_sql() -> str:
    parts = []
    for name in sorted({s[0] for s in _STUMPS}):
        phi = " + ".join(f"{_RATE} * (CASE WHEN {f} <= {t} THEN {lo} ELSE {hi} END - {share * lo + (1 - share) * hi})"
                         for f, t, lo, hi, share in _STUMPS if f == name)
        parts.append(f"SELECT '{name}' AS feature, avg(abs({phi})) AS mean_abs_shap FROM fm")
    return " UNION ALL ".join(parts)


@register("ensemble_attribution", "feature:s, mean_abs_shap:d", D.with_ctes(_fm_ctes + [("fm", _fm_body)], _attribution_sql()))
def q_ensemble_attribution(spark, sf):
    """M9 on stumps: a stump's Shapley value is its value less its mean."""
    from panelcast.operators import attribution
    return attribution.mean_abs_attribution(_ensemble("tweedie", _BASE), q_feature_matrix(spark, sf))


#: A tree of three levels: (feature, threshold, low, high), leaves (value, training rows)
_DEEP = ("lag_1", 12.0,
         ("product_mean", 25.0, ("lag_1", 4.0, (-0.7, 30.0), (0.2, 25.0)), ("client_count", 30.0, (0.4, 11.0), (-0.1, 9.0))),
         ("client_count", 25.0, ("product_mean", 26.0, (0.9, 14.0), (-0.4, 6.0)), ("lag_1", 33.0, (1.3, 7.0), (0.6, 18.0))))


def _deep_cover(t) -> float:
    return t[1] if len(t) == 2 else _deep_cover(t[2]) + _deep_cover(t[3])


def _deep_model():
    from panelcast.operators.boosting import BoostedTrees, Tree
    cols = sorted({"lag_1", "product_mean", "client_count"})
    tree = Tree([], [], [], [], [], [], [])

    def add(t) -> int:
        own = len(tree.feature)
        leaf = len(t) == 2
        for values, v in ((tree.feature, -1 if leaf else cols.index(t[0])), (tree.threshold, 0.0 if leaf else t[1]), (tree.left, -1),
                          (tree.right, -1), (tree.value, t[0] if leaf else 0.0), (tree.gain, 0.0), (tree.cover, _deep_cover(t))):
            values.append(v)
        if not leaf:
            tree.left[own], tree.right[own] = add(t[2]), add(t[3])
        return own
    add(_DEEP)
    return BoostedTrees(cols, "tweedie", _BASE, _RATE, [tree], best_iteration=1)


def _real(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _deep_sql(t, known: frozenset) -> str:
    """Expected leaf value when the features in ``known`` are given."""
    if len(t) == 2:
        return _real(t[0])
    low, high = _deep_sql(t[2], known), _deep_sql(t[3], known)
    if t[0] in known:
        return f"CASE WHEN {t[0]} <= {t[1]} THEN {low} ELSE {high} END"
    share = _deep_cover(t[2]) / _deep_cover(t)
    return f"({_real(share)} * {low} + {_real(1 - share)} * {high})"


def _shapley_sql() -> str:
    from itertools import combinations
    from math import factorial
    cols, out = sorted({"lag_1", "product_mean", "client_count"}), []
    for c in cols:
        rest = [x for x in cols if x != c]
        terms = [f"{_real(factorial(len(s)) * factorial(len(rest) - len(s)) / factorial(len(cols)))} * "
                 f"({_deep_sql(_DEEP, frozenset((*s, c)))} - {_deep_sql(_DEEP, frozenset(s))})"
                 for k in range(len(cols)) for s in combinations(rest, k)]
        out.append(f"{_RATE} * ({' + '.join(terms)}) AS phi_{c}")
    return ", ".join(out) + f", {_BASE} + {_RATE} * {_deep_sql(_DEEP, frozenset())} AS expected_value"


_ROW_KEYS = "Cliente_ID:i, Producto_ID:i, Ruta_SAK:i, Agencia_ID:i"


@register("row_attribution", _ROW_KEYS + ", phi_client_count:d, phi_lag_1:d, phi_product_mean:d, expected_value:d",
          D.with_ctes(_fm_ctes, f"SELECT Cliente_ID, Producto_ID, Ruta_SAK, Agencia_ID, {_shapley_sql()} FROM ({_fm_body}) f"))
def q_row_attribution(spark, sf):
    """M9 per row, on a tree of three levels that asks for features twice; the
    SQL side adds up all subsets of features."""
    from panelcast.operators import attribution
    return attribution.attribute(_deep_model(), q_feature_matrix(spark, sf), ["Cliente_ID", "Producto_ID", "Ruta_SAK", "Agencia_ID"])


#: Full trees of seven levels, by rule: node i of tree k, children 2i + 1 and 2i + 2.
_FULL_COLS = ["backoff_estimate", "client_count", "client_mean", "lag_1", "product_mean", "rolling_mean_3", "route_product_mean"]
_FULL_TREES, _FULL_DEPTH = 3, 7


def _full_split(k: int, i: int) -> tuple[int, float]:
    return (5 * i + 3 * k + i // 7) % len(_FULL_COLS), float((37 * i + 11 * k) % 45) + 0.5


def _full_value(k: int, i: int) -> float:
    return ((13 * i + 5 * k) % 21 - 10) / 16


def _full_model(objective: str):
    from panelcast.operators.boosting import BoostedTrees, Tree
    inner, trees = 2 ** _FULL_DEPTH - 1, []
    for k in range(_FULL_TREES):
        every = range(2 * inner + 1)
        trees.append(Tree(feature=[_full_split(k, i)[0] if i < inner else -1 for i in every], threshold=[_full_split(k, i)[1] for i in every],
                          left=[2 * i + 1 if i < inner else -1 for i in every], right=[2 * i + 2 if i < inner else -1 for i in every],
                          value=[_full_value(k, i) if i >= inner else 0.0 for i in every], gain=[0.0 for _ in every],
                          cover=[float(2 ** (_FULL_DEPTH + 1)) / (i + 1) for i in every]))
    return BoostedTrees(_FULL_COLS, objective, _BASE, _RATE, trees, best_iteration=_FULL_TREES)


def _full_sql() -> str:
    def case(k: int, i: int) -> str:
        if i >= 2 ** _FULL_DEPTH - 1:
            return str(_full_value(k, i))
        f, t = _full_split(k, i)
        return f"CASE WHEN {_FULL_COLS[f]} <= {t} THEN {case(k, 2 * i + 1)} ELSE {case(k, 2 * i + 2)} END"
    return f"({_BASE} + {_RATE} * (" + " + ".join(case(k, 0) for k in range(_FULL_TREES)) + "))"


@register("deep_ensemble_scores", _ROW_KEYS + ", prediction:d, lower:d, upper:d",
          D.with_ctes(_fm_ctes, "SELECT Cliente_ID, Producto_ID, Ruta_SAK, Agencia_ID, exp(m) AS prediction, greatest(m, 0.0) AS lower, "
                                f"greatest(m, 0.0) AS upper FROM (SELECT *, {_full_sql()} AS m FROM ({_fm_body}) f)"))
def q_deep_ensemble_scores(spark, sf):
    """M6, M7: trees of seven levels on the compiled arrays."""
    from panelcast.operators.boosting import IntervalModel
    return IntervalModel(_full_model("tweedie"), _full_model("quantile"), _full_model("quantile")).transform(q_feature_matrix(spark, sf))


_P12 = ["Venta_uni_hoy", "Venta_hoy", "Dev_uni_proxima", "Dev_proxima", "weight_g", "pieces", "has_promo", "State_encoded"]


@register("numeric_columns", "feature:s, n:i, mean:d",
          D.with_ctes([], " UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS n, avg(CAST({c} AS DOUBLE)) AS mean FROM processed" for c in _P12)))
def q_numeric_columns(spark, sf):
    """Every numeric column of the store that is neither id nor target."""
    hist, _ = stored(spark, sf)
    cols = pipeline.numeric_feature_columns(hist)
    sums = hist.agg(*[F.count(c).alias(f"n_{c}") for c in cols], *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"n_{c}").alias("n"), F.col(f"m_{c}").alias("mean")) for c in cols])
    return sums.select(F.explode(rows).alias("r")).select("r.*")


# --- driver contract ---------------------------------------------------------

def entry(spark: SparkSession) -> DataFrame:
    """Flagship: how good is lag-1 for the last week? (sales view -> M1 -> E5)."""
    s = fx.demand_sales(spark, SMOKE_DIR)
    pred = baselines.naive_lag1(s, s.where(F.col("Semana") == VAL_WEEK), VAL_WEEK)
    return evaluation.evaluate(pred, Y, "prediction")


def _llm():
    """The training-data queries, if their subpackage is there (a module that
    it lacks raises as usual)."""
    if find_spec("panelcast.llm") is None:
        return {}, {}
    from panelcast.llm import queries as llm
    return llm.QUERIES, llm.SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, fn, _, _ in _REG} | _llm()[0]


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, _, sql, _ in _REG if sql is not None} | _llm()[1]
