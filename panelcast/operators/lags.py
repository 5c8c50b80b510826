"""Weekly sums, calendar lags and rolling windows.

Lags and rolling statistics are computed on weekly *sums* per pair. A lag k
for target week S is the pair's sum at week S-k exactly (null when absent). A
rolling window w is the last w *observed* distinct weeks of the whole panel
before S (not calendar weeks, not per pair); a pair-week that is absent is
absent, not zero.

Neither needs a self join: one ``groupBy(pair, S)`` over the raw rows with
conditional sums evaluates every lag and window (and the client x product
moments) in a single pass. The grid of target weeks x observed weeks (one
row per pair of weeks, so bounded by the calendar) is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import LAG_WEEKS, PAIR, ROLLING_WINDOWS, TARGET_COL, WEEK_COL

RANK = "__wrank"
#: A row here becomes up to one group of some 20 sums per target week.
ROWS_PER_TASK = 250_000


def tasks_for(rows: int, spark, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Tasks that hold at most about ``rows_per_task`` rows each, one per core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // rows_per_task))


def weekly_demand(history: DataFrame, y: str = TARGET_COL) -> DataFrame:
    """(Cliente_ID, Producto_ID, Semana, y) with y summed per pair and week."""
    return history.groupBy(*PAIR, WEEK_COL).agg(F.sum(y).alias(y))


def lag_features(history: DataFrame, target_week: int, y: str = TARGET_COL,
                 lags: Iterable[int] = LAG_WEEKS,
                 windows: Iterable[int] = ROLLING_WINDOWS) -> DataFrame:
    """X1 for one target week: every pair with history before S, 5 lags, 9 rolling.

    Rolling means/medians are null when the pair has no sum in the window;
    rolling std is 0 then (and for a single value). Empty history -> no rows.
    """
    from .pipeline import target_weeks_frame
    one = target_weeks_frame(history.sparkSession, [target_week])
    past = history.where(F.col(WEEK_COL) < target_week)
    return pair_features_multi(past, one, y, lags, windows, None).drop("S")


def _rolling_from_ranks(w: int) -> list[Column]:
    """mean / sample std / median of the non-null weekly sums __w1..__w{w}.

    Computed per row from at most w columns; integer sums make the variance
    numerator exact in DECIMAL.
    """
    vals = [F.col(f"__w{r}") for r in range(1, w + 1)]
    cnt = sum((F.when(v.isNotNull(), 1).otherwise(0) for v in vals), F.lit(0))
    sm = sum((F.coalesce(v, F.lit(0)).cast("decimal(38,0)") for v in vals), F.lit(0).cast("decimal(38,0)"))
    sq = sum((F.coalesce(v, F.lit(0)).cast("decimal(38,0)") * F.coalesce(v, F.lit(0)).cast("decimal(38,0)")
              for v in vals), F.lit(0).cast("decimal(38,0)"))
    cd = cnt.cast("double")
    mean = F.when(cnt > 0, sm.cast("double") / cd)
    var = F.when(cnt > 1, (cnt.cast("decimal(38,0)") * sq - sm * sm).cast("double") / (cd * (cd - 1)))
    std = F.coalesce(F.sqrt(F.greatest(var, F.lit(0.0))), F.lit(0.0))
    if w <= 4:
        mn, mx = F.least(*vals).cast("double"), F.greatest(*vals).cast("double")
        med = (F.when(cnt >= 3, (sm.cast("double") - mn - mx) / (cd - 2))
                .when(cnt >= 1, sm.cast("double") / cd))
    else:
        arr = F.array_sort(F.filter(F.array(*vals), lambda v: v.isNotNull()))
        k = F.size(arr)
        lo = F.element_at(arr, ((k + 1) / 2).cast("int"))
        hi = F.element_at(arr, (k / 2 + 1).cast("int"))
        med = F.when(k > 0, (lo.cast("double") + hi.cast("double")) / 2)
    return [mean.alias(f"rolling_mean_{w}"), std.alias(f"rolling_std_{w}"),
            med.alias(f"rolling_median_{w}")]


def pair_features_multi(history: DataFrame, targets: DataFrame, y: str = TARGET_COL,
                        lags: Iterable[int] = LAG_WEEKS,
                        windows: Iterable[int] = ROLLING_WINDOWS,
                        agg_name: str | None = "client_product",
                        wanted: DataFrame | None = None) -> DataFrame:
    """Lags, rolling windows and the client x product aggregate in one pass.

    Raw rows are first reduced to one row per pair and week (combined
    map-side, so a hot pair leaves a task as one row per week) and dealt by
    pair. Only then do they meet the broadcast grid (target week S, earlier
    observed week, its rank counted back from S): what is copied per target
    week is aggregated by (pair, S) in the same task and never shuffled.
    Conditional sums give the features: the sum at week S-k is lag k, the sum at rank r is the
    pair's weekly sum in the r-th latest observed week (windows are built
    from those), and count / sum / sum of squares over all earlier rows give
    the raw-row mean/std/count of the pair.

    The groups are many times larger than the weekly rows they come from, so
    the number of tasks follows the rows of the history: a task's memory does
    not grow with them. ``wanted`` (pair, S) are the target rows that the
    result will be joined to: weeks of a pair with no later target row feed
    none of them and are dropped before they are copied.
    """
    lags, windows = list(lags), list(windows)
    top = max(windows) if windows else 0
    yl = F.col(y).cast("long")
    known = history.where(F.col(y).isNotNull())
    weekly = known.groupBy(*PAIR, WEEK_COL).agg(
        F.count(F.lit(1)).alias("__c"), F.sum(yl).alias("__y"),
        F.sum(yl.cast("decimal(19,0)") * yl.cast("decimal(19,0)")).alias("__q"))
    # One row per week reaches the driver: the weeks and how many rows there are.
    spark = history.sparkSession
    found = known.groupBy(WEEK_COL).agg(F.count(F.lit(1)).alias("n")).collect()
    weeks = spark.createDataFrame([(r[0],) for r in found if r[0] is not None], known.select(WEEK_COL).schema)
    grid = (targets.crossJoin(F.broadcast(weeks)).where(F.col(WEEK_COL) < F.col("S"))
                 .withColumn(RANK, F.row_number().over(
                     Window.partitionBy("S").orderBy(F.desc(WEEK_COL)))))
    dealt = weekly.repartition(tasks_for(sum(r["n"] for r in found), spark), *PAIR)
    if wanted is not None:
        last = wanted.groupBy(*PAIR).agg(F.max("S").alias("__last"))
        dealt = dealt.join(last.select(*[F.col(k).alias(f"__k_{k}") for k in PAIR], "__last"),
                           [*[F.col(k) == F.col(f"__k_{k}") for k in PAIR], F.col(WEEK_COL) < F.col("__last")],
                           "left_semi")
    x = dealt.join(F.broadcast(grid), WEEK_COL)
    aggs = [F.sum(F.when(F.col("S") - F.col(WEEK_COL) == k, F.col("__y"))).alias(f"__lag{k}") for k in lags]
    aggs += [F.sum(F.when(F.col(RANK) == r, F.col("__y"))).alias(f"__w{r}") for r in range(1, top + 1)]
    if agg_name:
        aggs += [F.sum("__c").alias("__n"), F.sum("__y").alias("__s1"), F.sum("__q").alias("__s2")]
    g = x.groupBy(*PAIR, "S").agg(*aggs)
    out = [F.col(f"__lag{k}").cast("double").alias(f"lag_{k}") for k in lags]
    for w in windows:
        out += _rolling_from_ranks(w)
    if agg_name:
        from .aggregates import moments_to_stats
        out += moments_to_stats(F.col("__n"), F.col("__s1"), F.col("__s2"), agg_name)
    return g.select(*PAIR, "S", *out)
