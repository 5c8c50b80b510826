"""Naive baselines (M1, M2) as prediction columns on the target rows.

Predictions are attached as a column (row order carries no meaning in
Spark), so callers evaluate with the actual and predicted columns side by
side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import MA_WINDOW, PAIR, TARGET_COL, WEEK_COL
from ..functions.values import clip0


def naive_lag1(history: DataFrame, target: DataFrame, target_week: int,
               y: str = TARGET_COL, pred_col: str = "prediction") -> DataFrame:
    """M1: pair sum of week S-1 -> product mean (< S) -> global mean (< S), clipped."""
    h = history.where(F.col(WEEK_COL) < target_week)
    last = (history.where(F.col(WEEK_COL) == target_week - 1)
                   .groupBy(*PAIR).agg(F.sum(y).alias("__last")))
    # The global mean follows from the product sums, so both share one scan.
    sums = h.groupBy("Producto_ID").agg(F.sum(y).alias("__sum"), F.count(y).alias("__n"))
    pmean = sums.select("Producto_ID", F.try_divide(F.col("__sum").cast("double"), F.col("__n")).alias("__pmean"))
    gmean = sums.agg(F.try_divide(F.sum("__sum").cast("double"), F.sum("__n")).alias("__gmean"))
    out = (target.join(last, PAIR, "left")
                 .join(pmean, "Producto_ID", "left")
                 .crossJoin(F.broadcast(gmean)))
    pred = clip0(F.coalesce(F.col("__last").cast("double"), F.col("__pmean"), F.col("__gmean")))
    return out.select(*target.columns, pred.alias(pred_col))


def recent_weeks(history: DataFrame, target_week: int, window: int) -> DataFrame:
    """The last ``window`` observed distinct weeks before S (one row per week)."""
    w = history.where(F.col(WEEK_COL) < target_week).select(WEEK_COL).distinct()
    return (w.withColumn("__r", F.row_number().over(Window.orderBy(F.desc(WEEK_COL))))
             .where(F.col("__r") <= window).select(WEEK_COL))


def moving_average(history: DataFrame, target: DataFrame, target_week: int,
                   window: int = MA_WINDOW, y: str = TARGET_COL,
                   pred_col: str = "prediction") -> DataFrame:
    """M2: raw-row pair mean over the last ``window`` observed weeks -> global mean."""
    weeks = recent_weeks(history, target_week, window)
    recent = history.join(F.broadcast(weeks), WEEK_COL)
    ma = recent.groupBy(*PAIR).agg(F.avg(y).alias("__ma"))
    gmean = history.where(F.col(WEEK_COL) < target_week).agg(F.avg(y).alias("__gmean"))
    out = target.join(ma, PAIR, "left").crossJoin(F.broadcast(gmean))
    pred = clip0(F.coalesce(F.col("__ma"), F.col("__gmean")))
    return out.select(*target.columns, pred.alias(pred_col))


def naive_lag1_multi(history: DataFrame, target: DataFrame, y: str = TARGET_COL,
                     pred_col: str = "prediction") -> DataFrame:
    """M1 for target rows of many weeks at once (each row's Semana is its S).

    Last-week pair sums are shifted one week forward and joined on
    (pair, Semana); product and global means over weeks < S come from the
    per-week moments joined with the (small) target-week table.
    """
    from .aggregates import agg_table_multi
    from .lags import weekly_demand
    from .pipeline import target_weeks_frame
    weeks = sorted(r[0] for r in target.select(WEEK_COL).distinct().collect())
    targets = target_weeks_frame(target.sparkSession, weeks)
    last = (weekly_demand(history.where(F.col(WEEK_COL).isin([s - 1 for s in weeks])), y)
            .select(*PAIR, (F.col(WEEK_COL) + 1).alias(WEEK_COL), F.col(y).alias("__last")))
    pm = (agg_table_multi(history, "product", ["Producto_ID"], targets, y)
          .select("Producto_ID", F.col("S").alias(WEEK_COL), F.col("product_mean").alias("__pmean")))
    gm = (agg_table_multi(history, "global", [], targets, y)
          .select(F.col("S").alias(WEEK_COL), F.col("global_mean").alias("__gmean")))
    out = (target.join(last, [*PAIR, WEEK_COL], "left")
                 .join(pm, ["Producto_ID", WEEK_COL], "left")
                 .join(F.broadcast(gm), WEEK_COL, "left"))
    pred = clip0(F.coalesce(F.col("__last").cast("double"), F.col("__pmean"), F.col("__gmean")))
    return out.select(*target.columns, pred.alias(pred_col))
