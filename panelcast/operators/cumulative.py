"""Distributed cumulative counts over sorted values, and what they give:
exact quantiles, empirical CDFs and two-sample KS statistics.

A plain ``sum(..) OVER (PARTITION BY g ORDER BY v)`` puts every value of a
group into one task. Here the values are first reduced to distinct values with
counts; these are range-partitioned by (group, value), as many ranges as their
number asks for, and written with the number of their range. A window runs
inside each (group, range) only. The totals of the ranges go up a tree (every
``FAN`` neighbours become one node of the next level) until a group has at most
``FAN`` nodes, and come down again as the sums of all earlier ranges; each range
meets its own sum in a join on (group, range). No step holds more than ``FAN``
totals of a group or one range in a task, and nothing is broadcast that grows
with the values. Totals per group are broadcast: use it with a bounded number of
groups (features, samples), never with a group per entity.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import known
from ..session import materialize

BUCKET_ROWS = 20_000     # distinct values that one range should hold
FAN = 1_024              # neighbouring totals that one task adds up


def bucket_count(df: DataFrame) -> int:
    """Ranges such that each holds about ``BUCKET_ROWS`` rows of ``df`` (one
    row per group and value)."""
    return max(1, -(-df.count() // BUCKET_ROWS))


def cumulative_sums(df: DataFrame, value: str, weights: list[str], groups: list[str] = (),
                    buckets: int | None = None, fan: int = FAN) -> DataFrame:
    """Add ``cum_<w>``: the sum of ``w`` over rows with a value <= this row's
    value in its group. ``df`` must hold one row per (groups, value)."""
    groups = list(groups)
    buckets = buckets or bucket_count(df)
    # Written, so that totals and ranks see the same ranges.
    x = materialize(df.repartitionByRange(buckets, *groups, value)
                      .withColumn("__b", F.spark_partition_id()), "ranges")
    tot = x.groupBy(*groups, "__b").agg(*[F.sum(w).alias(f"__o_{w}") for w in weights])
    offs = sums_before(tot, "__b", [f"__o_{w}" for w in weights], groups, buckets, fan)
    run = Window.partitionBy(*groups, "__b").orderBy(value).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    # The window first: its exchange and its sort serve the join as well.
    x = x.select(*df.columns, "__b", *[F.sum(w).over(run).alias(f"__r_{w}") for w in weights])
    return (x.join(offs, [*groups, "__b"])
             .select(*df.columns, *[(F.col(f"__o_{w}") + F.col(f"__r_{w}")).alias(f"cum_{w}")
                                    for w in weights]))


def sums_before(tot: DataFrame, pos: str, sums: list[str], groups: list[str], n: int,
                fan: int = FAN) -> DataFrame:
    """Replace each of ``sums`` by its total over the rows of the same group
    with a smaller ``pos`` (0 .. n-1, one row per group and position)."""
    def before(*keys):
        w = Window.partitionBy(*groups, *keys).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
        return [F.coalesce(F.sum(c).over(w), F.lit(0)).alias(c) for c in sums]

    if n <= fan:
        return tot.select(*groups, pos, *before())
    node = F.floor(F.col(pos) / fan).cast("int")
    nodes = (tot.select(*groups, node.alias("__node"), *sums)
                .groupBy(*groups, "__node").agg(*[F.sum(c).alias(f"__up_{c}") for c in sums]))
    nodes = sums_before(nodes.withColumnRenamed("__node", pos), pos, [f"__up_{c}" for c in sums],
                        groups, -(-n // fan), fan).withColumnRenamed(pos, "__node")
    inside = tot.withColumn("__node", node).select(*groups, pos, "__node", *before("__node"))
    return (inside.join(nodes, [*groups, "__node"])
                  .select(*groups, pos, *[(F.col(c) + F.col(f"__up_{c}")).alias(c) for c in sums]))


def value_counts(df: DataFrame, value: str, groups: list[str] = ()) -> DataFrame:
    """(groups, value, n): null and NaN dropped. Written once to the scratch folder:
    its rows are counted before they are dealt to ranges, and the input is
    computed only once."""
    vc = (df.where(known(F.col(value)))
            .groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n")))
    return materialize(vc, "value-counts")


def ecdf(df: DataFrame, value: str, groups: list[str] = (),
         buckets: int | None = None) -> DataFrame:
    """Per distinct value: n at the value, cumulative count, and the CDF
    heights of the first and last sorted point at that value on the
    ``linspace(0, 1, N)`` scale (``ecdf_lo``, ``ecdf``)."""
    groups = list(groups)
    vc = value_counts(df, value, groups)
    c = cumulative_sums(vc, value, ["n"], groups, buckets)
    tot = vc.groupBy(*groups).agg(F.sum("n").alias("__N"))
    c = c.join(F.broadcast(tot), groups) if groups else c.crossJoin(F.broadcast(tot))
    denom = F.greatest(F.col("__N") - 1, F.lit(1)).cast("double")
    return c.select(*groups, value, "n", F.col("cum_n").alias("cum"),
                    ((F.col("cum_n") - F.col("n")) / denom).alias("ecdf_lo"),
                    ((F.col("cum_n") - 1) / denom).alias("ecdf"))


def exact_quantile(df: DataFrame, value: str, q: float, alias: str = "quantile",
                   buckets: int | None = None) -> DataFrame:
    """One-row frame with the q-quantile of ``value``, linear interpolation
    between order statistics (NumPy's default), computed without holding
    all values in one buffer."""
    vc = value_counts(df, value)
    c = cumulative_sums(vc, value, ["n"], [], buckets)
    tot = vc.agg(F.sum("n").alias("__N"))
    pos = tot.select(
        "__N",
        F.floor(F.lit(q) * (F.col("__N") - 1)).alias("__k0"),
        F.ceil(F.lit(q) * (F.col("__N") - 1)).alias("__k1"),
        (F.lit(q) * (F.col("__N") - 1) - F.floor(F.lit(q) * (F.col("__N") - 1))).alias("__f"))
    x = c.crossJoin(F.broadcast(pos))
    start = F.col("cum_n") - F.col("n")
    at = lambda k: (start <= F.col(k)) & (F.col(k) < F.col("cum_n"))
    v = F.col(value).cast("double")
    picked = x.where(at("__k0") | at("__k1")).agg(
        F.max(F.when(at("__k0"), v)).alias("__v0"),
        F.max(F.when(at("__k1"), v)).alias("__v1"),
        F.max("__f").alias("__f"))
    return picked.select((F.col("__v0") + (F.col("__v1") - F.col("__v0")) * F.col("__f"))
                         .alias(alias))


def kolmogorov_pvalue(d: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value of a two-sample KS statistic.

    Q(lambda) = 2 sum_{k>=1} (-1)^(k-1) exp(-2 k^2 lambda^2) with the
    small-sample correction lambda = (sqrt(m) + 0.12 + 0.11/sqrt(m)) D,
    m = n1 n2 / (n1 + n2). For lambda < 0.2 the series is 1 to double
    precision (and converges too slowly), so 1 is returned.
    """
    m = F.try_divide(n1.cast("double") * n2.cast("double"), (n1 + n2).cast("double"))
    lam = (F.sqrt(m) + F.lit(0.12) + F.try_divide(F.lit(0.11), F.sqrt(m))) * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(F.lit(-2.0) * k * k * lam * lam))
    p = F.least(F.greatest(F.lit(2.0) * series, F.lit(0.0)), F.lit(1.0))
    # An empty sample has no p-value (null), never a division error.
    return F.when((n1 <= 0) | (n2 <= 0), F.lit(None).cast("double")) \
            .when(lam < 0.2, F.lit(1.0)).otherwise(p)


EXACT_MAX_N = 10_000   # the lattice-path probability is feasible up to this sample size


def ks_exact_pvalue_np(k: int, m: int, n: int) -> float:
    """Exact P(D >= K/(m n)) for two samples of sizes m, n (continuous case).

    A uniformly random monotone lattice path from (0,0) to (m,n) is walked
    anti-diagonal by anti-diagonal in probability space (steps right with
    probability (m-i)/(m+n-s), up otherwise); paths that leave the band
    |i n - j m| < K are dropped. The p-value is the probability mass lost.
    O((m+n) min(m,n)) NumPy work on a few scalars, no data.
    """
    if k <= 0 or m <= 0 or n <= 0:
        return 1.0
    p = np.zeros(m + 1)
    p[0] = 1.0
    for s in range(m + n):
        lo, hi = max(0, s - n), min(s, m)
        i = np.arange(lo, hi + 1)
        j = s - i
        cur = p[lo:hi + 1]
        rem = m + n - s
        nxt = np.zeros(m + 1)
        r = i < m
        np.add.at(nxt, i[r] + 1, cur[r] * (m - i[r]) / rem)
        u = j < n
        np.add.at(nxt, i[u], cur[u] * (n - j[u]) / rem)
        lo2, hi2 = max(0, s + 1 - n), min(s + 1, m)
        ii = np.arange(lo2, hi2 + 1)
        keep = np.zeros(m + 1, dtype=bool)
        keep[ii[np.abs(ii * n - (s + 1 - ii) * m) < k]] = True
        p = np.where(keep, nxt, 0.0)
    return float(min(1.0, max(0.0, 1.0 - p[m])))


@F.pandas_udf(T.DoubleType())
def ks_exact_pvalue(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    """Exact two-sided p-value per row (null for an empty sample); raises
    beyond ``EXACT_MAX_N`` values rather than leave a verdict out."""
    out = []
    for dv, a, b in zip(d, n1, n2):
        if pd.isna(dv) or pd.isna(a) or pd.isna(b) or a <= 0 or b <= 0:
            out.append(None)
        elif max(a, b) > EXACT_MAX_N:
            raise ValueError(f"the exact KS p-value is limited to {EXACT_MAX_N} values; use method='asymp'")
        else:
            out.append(ks_exact_pvalue_np(int(round(dv * a * b)), int(a), int(b)))
    return pd.Series(out, dtype="float64")


def side_counts(df: DataFrame, value: str, side: str, groups: list[str] = ()) -> DataFrame:
    """(groups, value, r, c): rows per distinct value in the reference (r)
    and current (c) sample; written once to the scratch folder."""
    s = F.col(side)
    vc = (df.where(known(F.col(value)))
            .groupBy(*groups, value)
            .agg(F.sum(F.when(s, 1).otherwise(0)).cast("long").alias("r"),
                 F.sum(F.when(s, 0).otherwise(1)).cast("long").alias("c")))
    return materialize(vc, "side-counts")


def side_moments(vc: DataFrame, value: str, groups: list[str] = ()) -> DataFrame:
    """Per group and side: mean and population std from the value counts
    (two passes over the counts, no cancellation from raw power sums)."""
    groups = list(groups)
    v = F.col(value).cast("double")
    means = vc.groupBy(*groups).agg(
        F.try_divide(F.sum(v * F.col("r")), F.sum("r")).alias("ref_mean"),
        F.try_divide(F.sum(v * F.col("c")), F.sum("c")).alias("cur_mean"))
    x = vc.join(F.broadcast(means), groups) if groups else vc.crossJoin(F.broadcast(means))
    dr, dc = v - F.col("ref_mean"), v - F.col("cur_mean")
    return x.groupBy(*groups).agg(
        F.first("ref_mean").alias("ref_mean"), F.first("cur_mean").alias("cur_mean"),
        F.sqrt(F.try_divide(F.sum(F.col("r") * dr * dr), F.sum("r"))).alias("ref_std"),
        F.sqrt(F.try_divide(F.sum(F.col("c") * dc * dc), F.sum("c"))).alias("cur_std"))


def ks_from_counts(vc: DataFrame, value: str, groups: list[str] = (),
                   buckets: int | None = None, method: str = "asymp") -> DataFrame:
    """Per group: n_ref, n_cur, ks_statistic (exact D) and p_value, from the
    (groups, value, r, c) counts of ``side_counts``.

    Ties are handled exactly because both CDFs step at each distinct value
    together. ``method``: "asymp" (Kolmogorov series, the same at every
    size) or "exact" (lattice-path probability, which raises for samples of
    more than ``EXACT_MAX_N`` values).
    """
    groups = list(groups)
    cum = cumulative_sums(vc, value, ["r", "c"], groups, buckets)
    tot = vc.groupBy(*groups).agg(F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"))
    x = cum.join(F.broadcast(tot), groups) if groups else cum.crossJoin(F.broadcast(tot))
    gap = F.abs(F.try_divide(F.col("cum_r"), F.col("n_ref"))
                - F.try_divide(F.col("cum_c"), F.col("n_cur")))
    d = x.groupBy(*groups).agg(F.max(gap).alias("ks_statistic"),
                               F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur"))
    d1, a, b = F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur")
    if method == "asymp":
        p = kolmogorov_pvalue(d1, a, b)
    elif method == "exact":
        p = ks_exact_pvalue(d1, a, b)
    else:
        raise ValueError(f"unknown method {method!r}")
    return d.select(*groups, "n_ref", "n_cur", "ks_statistic", p.alias("p_value"))


def ks_two_sample(df: DataFrame, value: str, side: str, groups: list[str] = (),
                  buckets: int | None = None, method: str = "asymp") -> DataFrame:
    """Two-sample KS per group; ``side`` is true for the reference sample."""
    return ks_from_counts(side_counts(df, value, side, groups), value, groups, buckets, method)
