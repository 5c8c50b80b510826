"""Hierarchical backoff estimate.

Level i is the mean demand of the history at key set i of the ladder
(client x product, route x product, agency x product, product, brand, global).
A target row takes the first level that has a value; the global mean is
level 5. Levels 0-3 are exactly the ``*_mean`` columns of the entity
aggregates, so when those are already joined they are reused rather than
recomputed; only the brand and global means are extra.

Brand comes from the product dimension; rows with an unknown product get brand
"UNK". Raw history (without a brand column) therefore forms an UNK group;
history that already carries brands from preprocessing keeps its nulls, which
form none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BACKOFF_LEVELS, TARGET_COL, UNKNOWN_BRAND, WEEK_COL

# Aggregate name holding the mean of each ladder level 0..3.
LEVEL_AGGS = ["client_product", "route_product", "agency_product", "product"]


def with_brand(df: DataFrame, brand_map: DataFrame, unknown: str | None) -> DataFrame:
    """Attach ``brand`` from (Producto_ID, brand); unmatched -> ``unknown``."""
    base = df.drop("brand") if "brand" in df.columns else df
    out = base.join(brand_map.select("Producto_ID", "brand"), "Producto_ID", "left")
    if unknown is not None:
        out = out.withColumn("brand", F.coalesce(F.col("brand"), F.lit(unknown)))
    return out


def history_unknown(history: DataFrame) -> str | None:
    """Brand of history rows with an unknown product (see above)."""
    return None if "brand" in history.columns else UNKNOWN_BRAND


def choose_level(est_cols: list[str], fallback: str):
    """(level, estimate) columns: first non-null of est_cols, else fallback."""
    level = F.lit(len(est_cols))
    for i in reversed(range(len(est_cols))):
        level = F.when(F.col(est_cols[i]).isNotNull(), F.lit(i)).otherwise(level)
    est = F.coalesce(*[F.col(c) for c in est_cols], F.col(fallback))
    return level.cast("int").alias("backoff_level"), est.cast("double").alias("backoff_estimate")


def backoff_features(target: DataFrame, history: DataFrame, brand_map: DataFrame,
                     target_week: int, y: str = TARGET_COL,
                     levels: list[tuple[str, ...]] | None = None) -> DataFrame:
    """Target rows plus backoff_level and backoff_estimate.

    ``levels`` is the ladder, most specific first (default
    ``config.BACKOFF_LEVELS``: client x product, route x product,
    agency x product, product, brand, global). A key tuple may name any
    target column or ``brand``; ``()`` is the global mean. A row takes the
    first level with a value; with no value at any level the level is
    ``len(levels)`` and the estimate null. A level's means are one aggregate of
    the history (``stats_before``); only levels with ``brand`` join it.
    """
    from .aggregates import stats_before
    from .joins import broadcast_if_small
    levels = [tuple(k) for k in (levels if levels is not None else BACKOFF_LEVELS)]
    bm = broadcast_if_small(brand_map.select("Producto_ID", "brand"))
    df = with_brand(target, bm, UNKNOWN_BRAND)
    sets = {f"lvl{i}": list(keys) for i, keys in enumerate(levels)}
    tabs = stats_before(history, sets, target_week, y, branded=with_brand(history, bm, history_unknown(history)))
    est = []
    for i, keys in enumerate(levels):
        col = f"backoff_est_{i}"
        tab = tabs[f"lvl{i}"].select(*keys, F.col(f"lvl{i}_mean").alias(col))
        # A level without keys is at most one row (none for an empty history):
        # broadcast it and keep every target row.
        df = df.join(tab, list(keys), "left") if keys else df.join(F.broadcast(tab), how="left")
        est.append(col)
    level = F.lit(len(levels))
    for i in reversed(range(len(levels))):
        level = F.when(F.col(est[i]).isNotNull(), F.lit(i)).otherwise(level)
    estimate = F.coalesce(*[F.col(c) for c in est]).cast("double")
    keep = [c for c in target.columns if c != "brand"]
    return df.select(*keep, level.cast("int").alias("backoff_level"), estimate.alias("backoff_estimate"))


def backoff_from_means(df: DataFrame, brand_tab: DataFrame, global_tab: DataFrame,
                       join_keys: list[str] = ()) -> DataFrame:
    """Backoff on a frame that already carries the four ``*_mean`` level columns.

    ``brand_tab`` is (brand, *join_keys, backoff_est_4) and ``global_tab``
    (*join_keys, backoff_est_5); ``join_keys`` is [] for one target week or
    ["Semana"] for many. Adds backoff_level/backoff_estimate, drops helpers.
    """
    est = [f"{name}_mean" for name in LEVEL_AGGS]
    d = df.join(brand_tab, ["brand", *join_keys], "left")
    if join_keys:
        d = d.join(F.broadcast(global_tab), list(join_keys), "left")
    else:
        # At most one row (none for an empty history): keep every target row.
        d = d.join(F.broadcast(global_tab), how="left")
    level, estimate = choose_level(est + ["backoff_est_4"], "backoff_est_5")
    return d.select(*df.columns, level, estimate)
