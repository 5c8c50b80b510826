"""Entity aggregates (A2, X2) and, with the global mean (A5), their multi-week form.

Aggregates are computed on raw rows: mean, sample std (null for one row ->
0) and count of the target per key set, over history weeks < S. Every
aggregate runs as partial + final hash aggregate, so hot keys are combined
map-side before the shuffle.

``agg_table`` is one key set (the X2 table on its own). The feature pipeline
uses ``stats_before`` for one target week and ``running_moments`` for many:
one aggregate per key set, each reading only its own columns, all written by
one job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import AGG_GROUP_KEYS, TARGET_COL, WEEK_COL


def agg_table(history: DataFrame, name: str, keys: list[str], target_week: int,
              y: str = TARGET_COL) -> DataFrame:
    """One key set of X2: keys, {name}_mean, {name}_std, {name}_count."""
    h = history.where(F.col(WEEK_COL) < target_week)
    yc = F.col(y)
    return h.groupBy(*keys).agg(
        F.avg(yc).alias(f"{name}_mean"),
        F.coalesce(F.stddev_samp(yc), F.lit(0.0)).alias(f"{name}_std"),
        F.count(yc).alias(f"{name}_count"),
    )


def agg_features(history: DataFrame, target_week: int, y: str = TARGET_COL,
                 group_keys: dict[str, list[str]] = AGG_GROUP_KEYS) -> dict[str, DataFrame]:
    """Name -> aggregate table; key sets with a missing column are skipped."""
    cols = set(history.columns)
    return {name: agg_table(history, name, keys, target_week, y)
            for name, keys in group_keys.items() if all(k in cols for k in keys)}


# --- multi-target (A7) ------------------------------------------------------

def _square(x: Column) -> Column:
    d = x.cast("decimal(19,0)")
    return d * d


def weekly_moments(history: DataFrame, keys: list[str], y: str = TARGET_COL) -> DataFrame:
    """(keys, Semana, n, s1, s2): count, sum and sum of squares per week.

    Demand is an integer, so the sums are exact integers: LONG for y,
    DECIMAL(38,0) for its square, so neither overflows and the variance
    computed from them has no cancellation error.
    """
    return _moments(history, [*keys, WEEK_COL], y)


_MOMENTS = ("n", "s1", "s2")


def _moments(history: DataFrame, keys: list[str], y: str) -> DataFrame:
    d = F.col(y).cast("long")
    return history.where(F.col(y).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(d).alias("s1"),
        F.sum(_square(d)).alias("s2"),
    )


def moments_to_stats(n: Column, s1: Column, s2: Column, name: str) -> list[Column]:
    nd = n.cast("double")
    s1d = s1.cast("decimal(38,0)")
    num = (n.cast("decimal(38,0)") * s2.cast("decimal(38,0)") - s1d * s1d).cast("double")
    var = F.when(n > 1, num / (nd * (nd - 1)))
    return [
        (s1.cast("double") / nd).alias(f"{name}_mean"),
        F.coalesce(F.sqrt(F.greatest(var, F.lit(0.0))), F.lit(0.0)).alias(f"{name}_std"),
        n.cast("long").alias(f"{name}_count"),
    ]


def agg_table_multi(history: DataFrame, name: str, keys: list[str], targets: DataFrame,
                    y: str = TARGET_COL) -> DataFrame:
    """keys, S, mean/std/count over weeks < S, for every S in ``targets``.

    Per-week moments (already reduced to one row per key and week) meet the
    broadcast target-week table on ``Semana < S``; each weekly row is copied
    at most once per later target week.
    """
    m = weekly_moments(history, keys, y)
    x = m.join(F.broadcast(targets), F.col(WEEK_COL) < F.col("S"))
    g = x.groupBy(*keys, "S").agg(F.sum("n").alias("n"), F.sum("s1").alias("s1"),
                                  F.sum("s2").alias("s2"))
    return g.select(*keys, "S", *moments_to_stats(F.col("n"), F.col("s1"), F.col("s2"), name))


LAST_WEEK = (1 << 31) - 1


def running_moments(history: DataFrame, key_sets: dict[str, list[str]], y: str = TARGET_COL,
                    nonnull_keys: tuple[str, ...] = ("brand",), branded: DataFrame | None = None) -> dict[str, DataFrame]:
    """Mean / std / count of all rows so far, one row per key and observed
    week, for many key sets.

    A row holds from the week after ``__after`` (its own week) up to
    ``__until`` (the key's next observed week), so exactly one row of a key
    answers a target week (``as_of``); nothing is copied per target week.

    Each set combines its own columns map-side to weekly moments (n, sum y,
    sum y^2), which are dealt by key once more for the running sums (a key has
    as many rows as weeks); see ``_written``.
    """
    def run(rows: DataFrame, ks: list[str]) -> DataFrame:
        by_week = Window.partitionBy(*ks).orderBy(WEEK_COL)
        so_far = by_week.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return weekly_moments(rows, ks, y).select(
            *ks, F.col(WEEK_COL).cast("int").alias("__after"),
            F.coalesce(F.lead(WEEK_COL).over(by_week), F.lit(LAST_WEEK)).cast("int").alias("__until"),
            *[F.sum(c).over(so_far).alias(c) for c in _MOMENTS])
    return _written(history, key_sets, nonnull_keys, branded, run, ["__after", "__until"])


def stats_before(history: DataFrame, key_sets: dict[str, list[str]], target_week: int, y: str = TARGET_COL,
                 nonnull_keys: tuple[str, ...] = ("brand",), branded: DataFrame | None = None) -> dict[str, DataFrame]:
    """``key_set_stats`` at one target week, without the column S: one
    aggregate of the rows before it per key set, so no weekly rows are kept
    or dealt. An empty history gives no row, of the set without keys either."""
    def run(rows: DataFrame, ks: list[str]) -> DataFrame:
        past = rows.where(F.col(WEEK_COL) < target_week)
        return _moments(past, ks, y).where(F.col("n") > 0)
    return _written(history, key_sets, nonnull_keys, branded, run, [])


def _written(history: DataFrame, key_sets: dict[str, list[str]], nonnull_keys: tuple[str, ...],
             branded: DataFrame | None, run, more: list[str]) -> dict[str, DataFrame]:
    """The moments that ``run`` makes of the history for each key set, as
    statistics; all sets are written by one job.

    Each set scans its own columns: its partial rows, in the map-side hash
    table and in the shuffle, hold its keys only. (One GROUPING SETS aggregate
    reads the history once, but each of its rows carries the keys of all sets,
    and the map-side table holds the groups of all sets at a time, and spills.)
    Sets with a ``brand`` take their rows from ``branded`` if given, so only
    they pay for the join with the products.

    Written under the shared scratch folder (``spark.checkpoint.dir``) and read
    back: left lazy, every use would aggregate again, and a parquet table is
    sized by its files, while an aggregate's estimate can be far too small and
    invite a broadcast. One folder per set: each reads its own files only. Key
    sets in ``nonnull_keys`` (brand) drop the null group.
    """
    from ..session import scratch_path
    spark, parts = history.sparkSession, []
    dims = list(dict.fromkeys(k for ks in key_sets.values() for k in ks))
    for i, ks in enumerate(key_sets.values()):
        rows = branded if branded is not None and "brand" in ks else history
        for k in ks:
            if k in nonnull_keys:
                rows = rows.where(F.col(k).isNotNull())
        types = dict((branded if branded is not None else history).dtypes)
        parts.append(run(rows, ks).select(F.lit(i).alias("__set"),
                                          *[F.col(k) if k in ks else F.lit(None).cast(types[k]).alias(k) for k in dims],
                                          *more, *_MOMENTS))
    table = reduce(DataFrame.unionByName, parts)
    path = scratch_path(spark, "key-set-stats")
    table.write.partitionBy("__set").parquet(path)
    table = spark.read.schema(table.schema).parquet(path)
    return {name: table.where(F.col("__set") == i).select(
        *ks, *more, *moments_to_stats(F.col("n"), F.col("s1"), F.col("s2"), name))
        for i, (name, ks) in enumerate(key_sets.items())}


def as_of(df: DataFrame, running: DataFrame, keys: list[str], week: str = WEEK_COL) -> DataFrame:
    """``df`` with the values that a table of ``running_moments`` has for each
    row's keys before its week (null: the key was not observed before)."""
    values = [c for c in running.columns if c not in (*keys, "__after", "__until")]
    side = running.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__after", "__until", *values)
    holds = (F.col(week) > F.col("__after")) & (F.col(week) <= F.col("__until"))
    for k in keys:
        holds = (df[k] == F.col(f"__k_{k}")) & holds
    # Without keys the table has one row per observed week.
    return df.join(side if keys else F.broadcast(side), holds, "left").select(*df.columns, *values)


def at_weeks(running: DataFrame, targets: DataFrame) -> DataFrame:
    """keys, S, values: a table of ``running_moments`` at each target week."""
    holds = (F.col("S") > F.col("__after")) & (F.col("S") <= F.col("__until"))
    return running.join(F.broadcast(targets), holds).drop("__after", "__until")


def key_set_stats(history: DataFrame, key_sets: dict[str, list[str]], targets: DataFrame,
                  y: str = TARGET_COL, nonnull_keys: tuple[str, ...] = ("brand",)
                  ) -> dict[str, DataFrame]:
    """``running_moments`` at each target week (a column S), by key set."""
    return {name: at_weeks(run, targets) for name, run in running_moments(history, key_sets, y, nonnull_keys).items()}
