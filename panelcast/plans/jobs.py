"""End-to-end jobs: preprocess (M12), train (M11), evaluate, batch inference
(M8) and request scoring.

Paths are parameters (no global locations); on a cluster they point at the
shared filesystem. Each job is a handful of lazy plans and one action per
output, so Spark sees whole jobs, not per-week loops.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import (ERROR_BINS, FEATURE_COLS, GBM_NUM_ROUNDS, GBM_PARAMS,
                      SAMPLE_SEED, SCATTER_SAMPLE, TARGET_COL, TOP_FEATURES, VAL_WEEK, WEEK_COL,
                      WORST_SEGMENTS)
from ..operators import attribution, baselines, boosting, clean, evaluation, pipeline, scoring
from ..operators.joins import assert_unique_keys
from ..session import materialize
from ..sources import files, sinks
from .prepare import Prepared

Y = TARGET_COL


@dataclass
class Artifacts:
    """Locations of everything the jobs write and read."""
    root: str

    @property
    def store(self) -> str:
        return f"{self.root}/processed"

    def feature(self, name: str) -> str:
        return f"{self.root}/features/{name}"

    @property
    def model(self) -> str:
        return f"{self.root}/models/gbm"

    @property
    def runs(self) -> str:
        return f"{self.root}/runs"

    def report(self, name: str) -> str:
        return f"{self.root}/reports/{name}"


# --- M12 ----------------------------------------------------------------------

def run_preprocess(sales: DataFrame, products: DataFrame, towns: DataFrame, art: Artifacts,
                   check_keys: bool = True) -> Prepared:
    """Facts + dimensions -> week-partitioned store and dimension tables."""
    if check_keys:
        assert_unique_keys(products, ["Producto_ID"], "products")
        assert_unique_keys(towns, ["Agencia_ID"], "towns")
    p = Prepared(sales, products, towns)
    # The facts are read twice: for the states that occur, and for the store.
    # The encodings are written first and read back, so the store's plan joins
    # small tables and does not fit them again.
    spark = sales.sparkSession
    files.save_table(p.meta, art.feature("product_metadata"))
    p.meta = files.load_table(spark, art.feature("product_metadata"))
    files.save_table(p.brand_map, art.feature("product_brand_map"))
    files.save_table(p.brand_encoding, art.feature("brand_encoding"))
    files.save_table(p.state_map, art.feature("state_mapping"))
    p.state_map = files.load_table(spark, art.feature("state_mapping"))
    files.save_by_week(p.processed, art.store)
    files.save_table(towns, art.feature("towns"))
    return p


def load_feature_inputs(spark: SparkSession, art: Artifacts) -> dict:
    """Dimension inputs of the feature pipeline, as written by preprocessing."""
    meta = files.load_table(spark, art.feature("product_metadata"))
    enc = files.load_table(spark, art.feature("brand_encoding"))
    brand_map = files.load_table(spark, art.feature("product_brand_map"), required=False,
                                 empty_schema="Producto_ID int, brand string")
    return dict(product_feats=clean.product_features(meta, enc), brand_map=brand_map,
                towns=files.load_table(spark, art.feature("towns")),
                state_map=files.load_table(spark, art.feature("state_mapping")))


# --- M11 ----------------------------------------------------------------------

def target_weeks(history: DataFrame, val_week: int) -> list[int]:
    """Observed weeks up to ``val_week`` that have an earlier one (one value
    per week reaches the driver)."""
    weeks = sorted(r[0] for r in history.where(F.col(WEEK_COL) <= val_week).select(WEEK_COL).distinct().collect())
    return weeks[1:]


def training_frames(history: DataFrame, inputs: dict, val_week: int,
                    weeks: list[int] | None = None) -> DataFrame:
    """Features for all target weeks (or ``weeks``) in one job."""
    target = weeks if weeks is not None else target_weeks(history, val_week)
    return pipeline.build_features_multi(history, history, target, **inputs)


def write_training_set(history: DataFrame, inputs: dict, val_week: int, path: str,
                       weeks_per_job: int | None = None) -> None:
    """S10 + A7: write the training set, partitioned by target week.

    ``weeks_per_job`` bounds the rows of one job for long week lists: the
    target weeks are processed in chunks, each one distributed job appending
    its own partitions.
    """
    target = target_weeks(history, val_week)
    k = weeks_per_job or len(target)
    for i in range(0, len(target), k):
        chunk = target[i:i + k]
        files.save_training_set(training_frames(history, inputs, val_week, chunk), path,
                                mode="overwrite" if i == 0 else "append")


def run_training(spark: SparkSession, art: Artifacts, val_week: int = VAL_WEEK,
                 num_rounds: int = GBM_NUM_ROUNDS, with_quantiles: bool = True,
                 boost_kw: dict | None = None, weeks_per_job: int | None = None) -> dict:
    weeks = [w for w in files.available_weeks(spark, art.store) if w <= val_week]
    history = files.load_weeks(spark, art.store, weeks)
    inputs = load_feature_inputs(spark, art)
    # The training set is written once, partitioned by target week, and
    # re-read with only the model columns.
    ts_path = art.feature("training_set")
    write_training_set(history, inputs, val_week, ts_path, weeks_per_job)
    ts = files.load_training_columns(spark, ts_path, [WEEK_COL, Y, *FEATURE_COLS])
    train, val = ts.where(F.col(WEEK_COL) < val_week), ts.where(F.col(WEEK_COL) == val_week)

    val_rows = history.where(F.col(WEEK_COL) == val_week)
    lag1 = baselines.naive_lag1(history, val_rows, val_week)
    ma3 = baselines.moving_average(history, val_rows, val_week)
    m_lag1 = evaluation.evaluate(lag1, Y, "prediction").first().asDict()
    m_ma3 = evaluation.evaluate(ma3, Y, "prediction").first().asDict()

    model = boosting.train_interval_model(train, val, FEATURE_COLS, Y, num_rounds=num_rounds,
                                          with_quantiles=with_quantiles, **(boost_kw or {}))
    m_gbm = evaluation.evaluate(model.main.transform(val), Y, "prediction").first().asDict()
    sinks.write_csv_report(model.main.importance_frame(spark, TOP_FEATURES),
                           art.report("feature_importance"), single_file=True)
    model.save(spark, art.model)
    n_train, n_val = train.count(), val.count()
    sinks.append_run(spark, art.runs, val_semana=val_week, n_features=len(FEATURE_COLS),
                     n_train_rows=n_train, n_val_rows=n_val,
                     best_iteration=model.main.best_iteration,
                     params={**GBM_PARAMS, "num_rounds": num_rounds,
                             "with_quantiles": with_quantiles, **(boost_kw or {})},
                     metrics={"gbm": m_gbm, "baseline_lag1": m_lag1, "baseline_ma": m_ma3})
    return {"gbm": m_gbm, "baseline_lag1": m_lag1, "baseline_ma": m_ma3,
            "best_iteration": model.main.best_iteration, "n_features": len(FEATURE_COLS),
            "feature_cols": list(FEATURE_COLS), "accepted": m_gbm["rmse"] < m_lag1["rmse"]}


# --- evaluation ---------------------------------------------------------------

def evaluation_reports(scored: DataFrame, model: boosting.BoostedTrees | None = None,
                       y: str = Y, p: str = "prediction") -> dict[str, DataFrame]:
    """All report tables of the evaluation job, as lazy frames."""
    reports = {"metrics": evaluation.evaluate(scored, y, p)}
    for seg in ("Producto_ID", "Agencia_ID"):
        reports[f"segment_metrics_{seg}"] = evaluation.evaluate_by_segment(scored, y, p, seg)
        reports[f"worst_segments_{seg}"] = evaluation.worst_segments(scored, y, p, seg, WORST_SEGMENTS)
    reports["error_histograms"] = evaluation.error_histograms(scored, y, p, ERROR_BINS)
    keys = [c for c in ("id", *pipeline.ID_COLS) if c in scored.columns]
    # Points to draw are a sample; limits, histograms and means are of all rows.
    sample = materialize(evaluation.seeded_sample(scored, SCATTER_SAMPLE, keys, SAMPLE_SEED),
                         "scatter-sample")
    reports["scatter_sample"] = sample.select(F.col(y).alias("actual"), F.col(p).alias("predicted"))
    reports["scatter_limits"] = evaluation.sample_limits(scored, y, p)
    reports["residual_sample"] = evaluation.residuals(sample, y, p)
    reports["residual_histogram"] = evaluation.histogram(evaluation.residuals(scored, y, p), "residual", ERROR_BINS)
    if model is not None:
        reports["shap_importance"] = attribution.mean_abs_attribution(model, scored)
    return reports


#: Reports of a few rows whatever the data; the others are written distributed.
SMALL_REPORTS = {"metrics", "worst_segments_Producto_ID", "worst_segments_Agencia_ID", "error_histograms",
                 "scatter_limits", "residual_histogram", "shap_importance"}


def run_evaluation(spark: SparkSession, art: Artifacts, val_week: int = VAL_WEEK) -> dict:
    weeks = [w for w in files.available_weeks(spark, art.store) if w <= val_week]
    data = files.load_weeks(spark, art.store, weeks)
    inputs = load_feature_inputs(spark, art)
    feats = pipeline.build_features(data.where(F.col(WEEK_COL) == val_week), data, val_week, **inputs)
    model = boosting.IntervalModel.load(spark, art.model)
    # Scored once and written: every report below reads it (tree scoring is
    # the expensive step and would otherwise rerun per report branch).
    scored = materialize(model.main.transform(feats), "scored-validation")
    reports = evaluation_reports(scored, model.main)
    for name, df in reports.items():
        sinks.write_csv_report(df, art.report(name), single_file=name in SMALL_REPORTS)
    return reports["metrics"].first().asDict()


# --- M8 -----------------------------------------------------------------------

def score_frame(spark: SparkSession, art: Artifacts, requests: DataFrame,
                model: boosting.IntervalModel | None = None,
                enforce_order: bool = False) -> tuple[DataFrame, DataFrame]:
    """(scored valid requests with prediction/lower/upper, rejected requests).

    The three models are independent, so lower <= prediction <= upper is not
    guaranteed; ``enforce_order=True`` sorts the three per row (opt-in)."""
    history = files.load_weeks(spark, art.store, files.available_weeks(spark, art.store))
    inputs = load_feature_inputs(spark, art)
    model = model or boosting.IntervalModel.load(spark, art.model)
    valid, rejected = scoring.split_requests(requests)
    weeks = sorted(r[0] for r in valid.select(WEEK_COL).distinct().collect())
    feats = pipeline.build_features_multi(valid, history, weeks, include_target=False,
                                          keep=("id",), **inputs)
    # The model's own feature list and order; features it lacks are 0.
    head = [c for c in feats.columns if c not in FEATURE_COLS]
    feats = pipeline.align_features(feats, model.main.feature_cols, head)
    return model.transform(feats, enforce_order=enforce_order), rejected


def run_inference(spark: SparkSession, art: Artifacts, requests: DataFrame,
                  out_path: str | None = None) -> DataFrame:
    """Submission (id, units): half-even rounding, clipped at 0, ordered by id.

    With ``out_path``, it is written there, and the rejected requests with
    their reasons to ``<out_path>_rejected``; the result is the written file
    read back, so nothing is scored twice."""
    scored, rejected = score_frame(spark, art, requests)
    sub = scoring.submission(scored)
    if out_path:
        sinks.write_csv_report(sub, out_path)
        sinks.write_csv_report(rejected, f"{out_path}_rejected")
        return spark.read.schema(sub.schema).option("header", True).csv(out_path)
    return sub


def score_requests(spark: SparkSession, art: Artifacts, requests: DataFrame,
                   enforce_order: bool = False) -> DataFrame:
    """Request path: id, predicted_demand, confidence_lower, confidence_upper
    (two decimals, half-even); rejected requests are returned by
    ``scoring.split_requests`` separately."""
    scored, _ = score_frame(spark, art, requests, enforce_order=enforce_order)
    return scored.select("id", scoring.round2(F.col("prediction")).alias("predicted_demand"),
                         scoring.round2(F.col("lower")).alias("confidence_lower"),
                         scoring.round2(F.col("upper")).alias("confidence_upper"))
