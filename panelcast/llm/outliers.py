"""Quality rules by robust multivariate outlier detection.

Each document's text statistics become a vector (logarithms of length and mean
word length, arcsine square roots of symbol, repeated-line and repeated-word
shares). Per language and source, the minimum covariance determinant estimate
finds the mean and covariance of the ``SUBSET`` share of vectors that lie
closest together; documents whose Mahalanobis distance from it is beyond the
chi-square cutoff are rejected.

Everything is DataFrame expressions. One C-step is one aggregation: squared
distances are binned finely, moments are summed per bin, and the bins up to
the subset's size (the last one whole) give the next estimate. Two
deterministic starts (coordinate-wise medians and quartile ranges; classical
moments) run side by side until the determinants settle; the smaller
determinant wins and is reweighted once. Vectors are scaled to integers, so
sums are exact whatever the partitioning. Covariances get a small diagonal
floor, as most shares are exactly 0 in clean text.

A group of fewer than ``LEAST`` documents is pooled with the other small ones
of its language, and small pools together; a pool still below that has no
estimate and rejects nothing. Base rules come first: under ``MIN_WORDS`` words
or more than 30 percent repeated words fails, and such documents take no part
in the estimates.

Defined results: null text counts as empty (0 words: base-failed); null
language or source are values of their own; repeated rows count each; a
window is repeated if its 64-bit hash is; columns of other names pass unused.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from panelcast.llm.scratch import forget, written

MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
SUBSET = 0.75
CUTOFF = 1 - 1e-10       # chi-square probability beyond which a vector is rejected
LEAST = 60
STEPS = 20
UNIT = 1000              # vectors are stored as integers of 1 / UNIT
FLOORS = (0.10, 0.06, 0.04, 0.15, 0.15)      # least standard deviation of each coordinate
P = len(FLOORS)
X = [f"x{j}" for j in range(P)]
PAIRS = [(j, k) for j in range(P) for k in range(j + 1)]
SMALL = 100_000          # rows up to which a parameter table is broadcast
_BLANK = r"[\x20\x09-\x0D]+"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words inside ``width``-word windows that occur twice or more."""
    def windows(h):
        last = F.greatest(F.size(h) - width, F.lit(-1))
        at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.xxhash64(F.slice(h, i + 1, width)))

    def positions(s):
        twin = lambda x, i: ((F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
        return F.array_sort(F.transform(F.filter(s, lambda x, i: F.coalesce(twin(x, i), F.get(s, i - 1)["h"] == x["h"],
                                                                           F.get(s, i + 1)["h"] == x["h"], F.lit(False))),
                                        lambda x: x["p"]))

    def covered(p):
        steps = F.transform(p, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(p, i + 1) - x, F.lit(width))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def count(w):
        ranked = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return (F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0))
                .otherwise(_let(_let(ranked, positions), covered)))

    hashes = F.transform(words, lambda x: F.xxhash64(x))
    return _let(_let(hashes, windows), count).cast("long")


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """doc_id, row_key, lang, source and the base statistics of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.select(F.col(id_col).alias("doc_id"), row_key(docs, id_col, text_col, group_cols).alias("row_key"),
                     F.col(group_cols[0]).alias("lang"), F.col(group_cols[1]).alias("source"), text.alias("text"))
    bare = F.btrim("text", F.lit(" \t\n\x0b\f\r"))
    df = df.withColumn("words", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _BLANK)))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) != "")
    df = df.withColumn("lines", lines)
    return df.select(
        "doc_id", "row_key", "lang", "source", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"))


def row_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, str] = ("lang", "source")) -> Column:
    """Names a row by its contents; rows with equal keys get equal verdicts."""
    return F.xxhash64(F.to_json(F.struct(F.col(id_col).alias("i"), *(F.col(c).alias(n) for c, n in zip(group_cols, "ls", strict=True)))),
                      F.coalesce(F.col(text_col), F.lit("")))


def _vector(df: DataFrame) -> DataFrame:
    """Base verdict and the integer vector of those that pass it."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    share = lambda a, b: F.asin(F.sqrt(F.least(F.lit(1.0), F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0)))))
    parts = [F.log1p("n_words"), F.log(F.try_divide(F.col("word_chars").cast("double"), F.col("n_words"))),
             share("n_symbols", "word_chars"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words")]
    df = df.withColumn("base_failed", failed)
    return df.select("*", *(F.when(~F.col("base_failed"), F.round(v * UNIT).cast("long")).alias(x)
                            for v, x in zip(parts, X, strict=True)))


def _lookup(df: DataFrame, small: DataFrame, on, n: int | None = None) -> DataFrame:
    """Left join of a parameter table, broadcast when its counted rows allow."""
    n = small.count() if n is None else n
    return df.join(F.broadcast(small) if n <= SMALL else small, on, "left")


def _cells(points: DataFrame) -> DataFrame:
    """(lang, source) -> cell: the group, its language's pool or the common pool."""
    groups = points.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    small = F.when(F.col("n") < LEAST, F.col("n"))
    pools = groups.groupBy(F.col("lang").alias("pool_lang")).agg(F.coalesce(F.sum(small), F.lit(0)).alias("n_pool"))
    own = F.to_json(F.struct("lang", "source"))
    pool = F.concat(F.lit("pool "), F.to_json(F.struct("lang")))
    cell = F.when(F.col("n") >= LEAST, own).when(F.col("n_pool") >= LEAST, pool).otherwise(F.lit("pool"))
    return (groups.join(pools, F.col("lang").eqNullSafe(F.col("pool_lang")))
            .select(F.col("lang").alias("c_lang"), F.col("source").alias("c_source"), cell.alias("cell")))


def _moments() -> list[Column]:
    """Count, sums and sums of products (exact in LONG)."""
    return [F.count(F.lit(1)).alias("n"), *(F.sum(x).alias(f"s{j}") for j, x in enumerate(X)),
            *(F.sum(F.col(f"x{j}") * F.col(f"x{k}")).alias(f"s{j}_{k}") for j, k in PAIRS)]


MOMENTS = ["n", *(f"s{j}" for j in range(P)), *(f"s{j}_{k}" for j, k in PAIRS)]


def _estimate(df: DataFrame, keys: list[str], scale: float = 1.0) -> DataFrame:
    """keys, mean (m*), Cholesky factor (l*_*) and log determinant from moments."""
    n = F.col("n").cast("double")
    df = df.select(*keys, "n", *(F.col(c).cast("double") for c in MOMENTS[1:])).select(
        *keys, *((F.col(f"s{j}") / n).alias(f"m{j}") for j in range(P)),
        *((scale * (F.col(f"s{j}_{k}") / n - F.col(f"s{j}") / n * F.col(f"s{k}") / n)
           + (F.lit((FLOORS[j] * UNIT) ** 2) if j == k else F.lit(0.0))).alias(f"c{j}_{k}") for j, k in PAIRS))
    return _factor(df, keys)


def _factor(df: DataFrame, keys: list[str]) -> DataFrame:
    """Cholesky factor of the covariance columns c*_*."""
    for j in range(P):
        for k in range(j + 1):
            rest = F.col(f"c{j}_{k}")
            for i in range(k):
                rest = rest - F.col(f"l{j}_{i}") * F.col(f"l{k}_{i}")
            df = df.withColumn(f"l{j}_{k}", F.sqrt(F.greatest(rest, F.lit(1.0))) if j == k else rest / F.col(f"l{k}_{k}"))
    logdet = sum((F.log(f"l{j}_{j}") for j in range(1, P)), F.log("l0_0"))
    return df.select(*keys, *(f"m{j}" for j in range(P)), *(f"l{j}_{k}" for j, k in PAIRS), logdet.alias("logdet"))


def _distance(df: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance (null without an estimate)."""
    for j in range(P):
        z = F.col(f"x{j}") - F.col(f"m{j}")
        for k in range(j):
            z = z - F.col(f"l{j}_{k}") * F.col(f"z{k}")
        df = df.withColumn(f"z{j}", z / F.col(f"l{j}_{j}"))
    return df.withColumn("d2", sum((F.col(f"z{j}") * F.col(f"z{j}") for j in range(1, P)), F.col("z0") * F.col("z0"))).drop(*(f"z{j}" for j in range(P)))


def _starts(points: DataFrame) -> DataFrame:
    """Two initial estimates per cell."""
    values = points.select("cell", F.explode(F.array(*(F.struct(F.lit(j).alias("j"), F.col(x).alias("v")) for j, x in enumerate(X)))).alias("e"))
    counts = values.groupBy("cell", "e.j", "e.v").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("cell", "j")
    ranked = counts.withColumn("below", F.sum("n").over(w.orderBy("v"))).withColumn("all", F.sum("n").over(w))
    at = lambda q: F.min(F.when(F.col("below") >= q * F.col("all"), F.col("v")))
    quartiles = ranked.groupBy("cell", "j").agg(at(0.5).alias("mid"), ((at(0.75) - at(0.25)) / 1.349).alias("sd"))
    pick = lambda j, c: F.max(F.when(F.col("j") == j, F.col(c))).cast("double")
    robust = quartiles.groupBy("cell").agg(*(pick(j, "mid").alias(f"m{j}") for j in range(P)), *(pick(j, "sd").alias(f"d{j}") for j in range(P)))
    robust = robust.select("cell", F.lit(0).alias("start"), *(f"m{j}" for j in range(P)), *(
        (F.col(f"d{j}") * F.col(f"d{j}") + (FLOORS[j] * UNIT) ** 2 if j == k else F.lit(0.0)).alias(f"c{j}_{k}") for j, k in PAIRS))
    classical = points.groupBy("cell").agg(*_moments()).withColumn("start", F.lit(1))
    return _factor(robust, ["cell", "start"]).unionByName(_estimate(classical, ["cell", "start"]))


def chi_square(p: float, k: int) -> float:
    """Quantile by bisection on the regularised gamma series."""
    def below(x):
        term = total = 1 / math.gamma(k / 2 + 1)
        for i in range(1, 500):
            term *= x / 2 / (k / 2 + i)
            total += term
        return total * (x / 2) ** (k / 2) * math.exp(-x / 2)
    lo, hi = 0.0, 10.0 * k + 20 * NormalDist().inv_cdf(max(p, 0.5)) ** 2 + 50
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return lo


def _consistency() -> float:
    """Factor that makes the covariance of the closest ``SUBSET`` share that
    of a normal sample (Croux and Haesbroeck)."""
    lo, hi, q = 0.0, 1.0, chi_square(SUBSET, P)
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(mid, P + 2) < q else (lo, mid)
    return SUBSET / lo


def fit(points: DataFrame) -> DataFrame:
    """Estimate (one row per cell) from points (cell, x0..)."""
    spark = points.sparkSession
    def step(df: DataFrame) -> tuple[DataFrame, str, tuple]:
        """Writes an estimate; its number of rows and sum of determinants."""
        seen = Observation()
        table, path = written(df.observe(seen, F.count(F.lit(1)).alias("n"), F.round(F.sum("logdet"), 4).alias("sum")), "mcd")
        return table, path, (seen.get["n"], seen.get["sum"])

    twice = points.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    now, path, mark = step(_starts(points))
    marks: set[tuple] = set()
    while mark not in marks and len(marks) < STEPS:      # binned steps may end in a short cycle
        marks.add(mark)
        d = _distance(_lookup(twice, now, ["cell", "start"], mark[0]))
        bins = (d.withColumn("bin", F.floor(32 * F.log2(F.col("d2") + F.lit(1e-3))))
                .groupBy("cell", "start", "bin").agg(*_moments()))
        w = Window.partitionBy("cell", "start")
        bins = (bins.withColumn("below", F.coalesce(F.sum("n").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                .withColumn("all", F.sum("n").over(w)).where(F.col("below") < SUBSET * F.col("all")))
        closest = bins.groupBy("cell", "start").agg(*(F.sum(c).alias(c) for c in MOMENTS))
        after, new_path, mark = step(_estimate(closest, ["cell", "start"]))
        forget(spark, path)
        now, path = after, new_path
    best = now.groupBy("cell").agg(F.min(F.struct("logdet", "start")).alias("b")).select("cell", F.col("b.start").alias("start"))
    raw = now.join(best, ["cell", "start"]).drop("start")
    # the raw estimate, made consistent, selects the vectors of the final one
    near = _distance(_lookup(points, raw, "cell", mark[0])).where(F.col("d2") <= _consistency() * chi_square(0.975, P))
    final, _ = written(_estimate(near.groupBy("cell").agg(*_moments()), ["cell"], scale=1.0), "mcd-final")
    return final


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, str] = ("lang", "source"),
            cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, row_key, base statistics, base_failed, kept and distance (null
    for base-failed rows and where there is no estimate)."""
    stats, _ = written(_vector(statistics(docs, id_col, text_col, group_cols)), "statistics")
    passed = stats.where(~F.col("base_failed"))
    cells, _ = written(_cells(passed), "cells")
    on = stats.lang.eqNullSafe(cells.c_lang) & stats.source.eqNullSafe(cells.c_source)
    celled = _lookup(stats, cells, on).withColumn("cell", F.when(~F.col("base_failed"), F.col("cell")))
    points, points_path = written(celled.where(F.col("cell").isNotNull()).select("cell", *X), "points")
    large = points.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST).select("cell")
    enough = points.join(F.broadcast(large) if cells.count() <= SMALL else large, "cell")
    estimate = fit(enough)
    forget(docs.sparkSession, points_path)
    scored = _distance(_lookup(celled, estimate, "cell"))
    far = F.coalesce(F.col("d2") > chi_square(cutoff, P), F.lit(False))
    return scored.select("doc_id", "row_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", (~F.col("base_failed") & ~far).alias("kept"), F.sqrt("d2").alias("distance"))


def keep_good(docs: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were."""
    bad = quality(docs, **kw).where(~F.col("kept")).select(F.col("row_key").alias("bad_key")).distinct()
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    of = lambda name, default: names[kw.get(name, default)]
    groups = tuple(names[c] for c in kw.get("group_cols", ("lang", "source")))
    key = row_key(plain, of("id_col", "doc_id"), of("text_col", "text"), groups)
    return plain.join(bad, key == F.col("bad_key"), "left_anti").toDF(*docs.columns)


def brute_force_base(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen: dict[tuple, list[int]] = {}
    for k in range(len(words) - WINDOW + 1):
        seen.setdefault(tuple(words[k:k + WINDOW]), []).append(k)
    hit = {p for at in seen.values() if len(at) > 1 for k in at for p in range(k, k + WINDOW)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))
