"""The feature matrix (X5, P11-P13) for one target week and for many.

Two tables carry all history features: the pair table (lags, rolling
windows and the client x product aggregate, one ``groupBy(pair, S)``) and
the key-set tables (the six other key sets plus the brand and global backoff
levels, one aggregate each,
written by one job). Join order is chosen for the
shuffle cost of the *target* side, which is the wide one: the pair table
first, the remaining key sets while the target is still narrow, dimension
tables (products, towns, brand/global means) last as broadcasts. All nulls
become 0 at the very end, so "no sales", "unknown" and "outside the window"
look alike to the model, as intended.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import (AGG_GROUP_KEYS, FEATURE_COLS, ID_COLS, PAIR, TARGET_COL, UNKNOWN_BRAND,
                      WEEK_COL)
from ..functions.values import number
from .aggregates import as_of, at_weeks, running_moments, stats_before
from .backoff import backoff_from_means, history_unknown, with_brand
from .clean import attach_state
from .joins import broadcast_if_small
from .lags import pair_features_multi

# The client x product aggregate comes with the lags (one pair-keyed table);
# the other key sets are joined while the target is narrow, small ones last.
PAIR_AGG = "client_product"
JOIN_ORDER = ["client", "route_product", "agency_product", "route", "product", "agency"]


def _target_base(target: DataFrame, y: str, keep: Iterable[str]) -> DataFrame:
    cols = [c for c in ID_COLS if c in target.columns]
    extra = [c for c in keep if c in target.columns and c not in cols]
    if y in target.columns:
        extra.append(y)
    return target.select(*cols, *extra)


def finalize_features(df: DataFrame, head: list[str], feature_cols: list[str] = FEATURE_COLS
                      ) -> DataFrame:
    """Select head + features in model order, as double; null and NaN -> 0."""
    return df.select(*head, *[F.coalesce(number(F.col(c)), F.lit(0.0)).alias(c) for c in feature_cols])


def align_features(df: DataFrame, feature_cols: list[str], head: Iterable[str] = ()) -> DataFrame:
    """Columns of a model's feature list in its order; absent ones are 0."""
    have = set(df.columns)
    return df.select(*head, *[(F.coalesce(number(F.col(c)), F.lit(0.0)) if c in have
                               else F.lit(0.0)).alias(c) for c in feature_cols])


def numeric_feature_columns(df: DataFrame, y: str = TARGET_COL) -> list[str]:
    """Numeric columns that are neither ids nor the target."""
    from pyspark.sql.types import BooleanType, NumericType
    return [f.name for f in df.schema.fields
            if f.name not in ID_COLS and f.name != y
            and isinstance(f.dataType, (NumericType, BooleanType))]


def build_features(target: DataFrame, history: DataFrame, target_week: int,
                   product_feats: DataFrame, brand_map: DataFrame, towns: DataFrame,
                   state_map: DataFrame, include_target: bool = True, y: str = TARGET_COL,
                   keep: Iterable[str] = ("id",)) -> DataFrame:
    """One row per target row with the 43 features of ``FEATURE_COLS``.

    Only history weeks < ``target_week`` are used, whatever is passed in.
    """
    keep = list(keep)
    base = _target_base(target, y, keep)
    one = target_weeks_frame(target.sparkSession, [target_week])
    past = history.where(F.col(WEEK_COL) < target_week)
    pairs = pair_features_multi(past, one, y, wanted=base.select(*PAIR, F.lit(target_week).alias("S"))).drop("S")
    df = base.join(pairs, PAIR, "left")
    bm = broadcast_if_small(brand_map)
    sets = {k: v for k, v in AGG_GROUP_KEYS.items() if k != PAIR_AGG and all(c in past.columns for c in v)}
    sets.update({"brand": ["brand"], "global": []})
    stats = stats_before(past, sets, target_week, y, branded=with_brand(past, bm, history_unknown(history)))
    for name in JOIN_ORDER:
        if name in stats:
            df = df.join(stats[name], AGG_GROUP_KEYS[name], "left")
    df = df.join(broadcast_if_small(product_feats), "Producto_ID", "left")
    df = attach_state(df, towns, state_map)
    df = with_brand(df, bm, UNKNOWN_BRAND)
    df = backoff_from_means(df, stats["brand"].select("brand", F.col("brand_mean").alias("backoff_est_4")),
                            stats["global"].select(F.col("global_mean").alias("backoff_est_5")))
    df = df.withColumn("target_semana", F.lit(target_week))
    head = [c for c in base.columns if c != y or include_target]
    return finalize_features(df, head)


def target_weeks_frame(spark: SparkSession, weeks: Iterable[int]) -> DataFrame:
    """Tiny (S int) table of target weeks; its size is the length of the list."""
    return spark.createDataFrame([(int(s),) for s in sorted(set(weeks))], "S int")


def build_features_multi(rows: DataFrame, history: DataFrame, target_weeks: Iterable[int],
                         product_feats: DataFrame, brand_map: DataFrame, towns: DataFrame,
                         state_map: DataFrame, include_target: bool = True,
                         y: str = TARGET_COL, keep: Iterable[str] = ("id",)) -> DataFrame:
    """X5 for every week in ``target_weeks`` in one job.

    ``rows`` holds the target rows (their Semana is the target week);
    ``history`` the facts (any weeks; each target week sees only weeks
    before it). Equal, week by week, to ``build_features``.
    """
    weeks = sorted(set(int(s) for s in target_weeks))
    spark = rows.sparkSession
    targets = target_weeks_frame(spark, weeks)
    keep = list(keep)
    base = _target_base(rows.where(F.col(WEEK_COL).isin(weeks)), y, keep)
    # Weeks at or after the last target week feed nothing (partition pruning);
    # without target weeks (all requests rejected) the result is empty.
    history = history.where(F.col(WEEK_COL) < max(weeks) if weeks else F.lit(False))
    pairs = pair_features_multi(history, targets, y, wanted=base.select(*PAIR, F.col(WEEK_COL).alias("S"))
                                ).withColumnRenamed("S", WEEK_COL)
    df = base.join(pairs, [*PAIR, WEEK_COL], "left")
    bm = broadcast_if_small(brand_map)
    sets = {k: v for k, v in AGG_GROUP_KEYS.items() if k != PAIR_AGG and all(c in history.columns for c in v)}
    sets.update({"brand": ["brand"], "global": []})
    stats = running_moments(history, sets, y, branded=with_brand(history, bm, history_unknown(history)))
    for name in JOIN_ORDER:
        if name in stats:
            df = as_of(df, stats[name], AGG_GROUP_KEYS[name])
    df = df.join(broadcast_if_small(product_feats), "Producto_ID", "left")
    df = attach_state(df, towns, state_map)
    df = with_brand(df, bm, UNKNOWN_BRAND)
    brand_tab = at_weeks(stats["brand"], targets).select("brand", F.col("S").alias(WEEK_COL),
                                                         F.col("brand_mean").alias("backoff_est_4"))
    glob = at_weeks(stats["global"], targets).select(F.col("S").alias(WEEK_COL), F.col("global_mean").alias("backoff_est_5"))
    df = backoff_from_means(df, brand_tab, glob, [WEEK_COL])
    df = df.withColumn("target_semana", F.col(WEEK_COL))
    head = [c for c in base.columns if c != y or include_target]
    return finalize_features(df, head)
