"""Benchmark decontamination by winnowing.

Of every ``width - k + 1`` consecutive k-grams the one(s) with the smallest
hash are kept as fingerprints. The choice depends on the words of the window
alone, so any span of ``width`` words that a document shares with an item
yields the same fingerprint on both sides. The fingerprints of the documents
are joined with those of the benchmark; each match is extended word by word
to the left and right, and spans of ``width`` words or more are hits.

The benchmark is the small side, but its size is checked, not assumed: it is
dealt into blocks of about ``BLOCK`` bytes of text, each indexed and broadcast
on its own. The documents are scanned once and never shuffled; with several
blocks the scan passes through one stage per block, and what has been found
travels with the row.

Defined results: a null or text without words: no hits, and as an item, no
window; items of 1 to ``width - 1`` words match as a whole (a fingerprint of
their own length); an item without id marks its words but is not listed;
repeated items count once by id; an empty benchmark hits nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.scratch import written
from panelcast.llm.words import ALNUM, U, covered, doc_windows, word_hashes

WIDTH = 13
K = 7
BLOCK = 8 << 20          # bytes of benchmark text in one broadcast index
PERCENT = 5              # a document is contaminated from this share of hit words on


def fingerprints(words: np.ndarray, counts: np.ndarray, width: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position in ``words``) of the k-grams that winnowing keeps; only
    documents of ``width`` words or more have a full window."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, dtype=U), np.empty(0, dtype=np.int64)
    ends = np.cumsum(counts)
    owner_end = np.repeat(ends, counts)
    inside = np.arange(n) + width <= owner_end[:n]
    grams, _ = doc_windows(words, np.array([len(words)]), k)
    w = width - k + 1
    least = grams[:n].copy()
    for j in range(1, w):
        np.minimum(least, grams[j:j + n], out=least)
    kept = np.zeros(len(grams), dtype=bool)
    for j in range(w):
        kept[j:j + n] |= (grams[j:j + n] == least) & inside
    at = np.flatnonzero(kept)
    return grams[at], at


def build_index(items: list[tuple], width: int, k: int) -> dict:
    """Searchable form of (item_id, text) rows."""
    words, counts = word_hashes([(t or "").encode() for _, t in items], ALNUM, lower=True)
    hashes, at = fingerprints(words, counts, width, k)
    order = np.argsort(hashes, kind="stable")
    item = np.repeat(np.arange(len(items)), counts)
    short: dict[int, tuple] = {}
    first = np.cumsum(counts) - counts
    for n in np.unique(counts[(counts > 0) & (counts < width)]).tolist():
        own = np.flatnonzero(counts == n)
        h = np.array([doc_windows(words[first[i]:first[i] + n], np.array([n]), n)[0][0] for i in own], dtype=U)
        rank = np.argsort(h, kind="stable")
        short[n] = h[rank], own[rank]
    return {"words": words, "item": item, "hashes": hashes[order], "at": at[order], "short": short,
            "ids": [i for i, _ in items]}


def _matches(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i, j) with keys[i] == table[j]; ``table`` is sorted."""
    lo = np.searchsorted(table, keys, side="left")
    maybe = np.flatnonzero((lo < len(table)) & (table[np.minimum(lo, len(table) - 1)] == keys)) if len(table) else lo[:0]
    lo = lo[maybe]
    n = np.searchsorted(table, keys[maybe], side="right") - lo
    before = np.cumsum(n) - n
    return np.repeat(maybe, n), np.repeat(lo - before, n) + np.arange(int(n.sum()))


def find_hits(texts: list[bytes], index: dict, width: int, k: int) -> tuple[np.ndarray, np.ndarray, dict[int, set]]:
    """Words per text, hit mask over all words, and per text its items."""
    words, counts = word_hashes(texts, ALNUM, lower=True)
    owner = np.repeat(np.arange(len(texts)), counts)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    pairs: set[tuple[int, int]] = set()
    hashes, at = fingerprints(words, counts, width, k)
    i, j = _matches(hashes, index["hashes"])
    if len(i):
        p, q = at[i], index["at"][j]
        item_words, item = index["words"], index["item"]

        def same(step):
            """Does the word ``step`` from the match agree, inside both texts?"""
            a, b = p + step, q + step
            ok = (a >= 0) & (a < len(words)) & (b >= 0) & (b < len(item_words))
            a, b = np.where(ok, a, p), np.where(ok, b, q)
            return ok & (owner[a] == owner[p]) & (item[b] == item[q]) & (words[a] == item_words[b])

        core = np.ones(len(p), dtype=bool)
        for s in range(k):
            core &= same(s)
        left, right = np.zeros(len(p), dtype=np.int64), np.zeros(len(p), dtype=np.int64)
        run = core.copy()
        for s in range(1, width - k + 1):
            run &= same(-s)
            left += run
        run = core.copy()
        for s in range(k, width):
            run &= same(s)
            right += run
        good = core & (left + right + k >= width)
        np.add.at(edge, (p - left)[good], 1)
        np.add.at(edge, (p + k + right)[good], -1)
        pairs.update(zip(owner[p[good]].tolist(), item[q[good]].tolist(), strict=True))
    mask = np.cumsum(edge[:-1]) > 0
    ends = np.cumsum(counts)
    for n, (table, items) in index["short"].items():
        grams, _ = doc_windows(words, np.array([len(words)]), n)
        start = np.flatnonzero(np.arange(len(grams)) + n <= np.repeat(ends, counts)[:len(grams)])
        i, j = _matches(grams[start], table)
        mask |= covered(start[np.unique(i)], n, len(words))
        pairs.update(zip(owner[start[i]].tolist(), items[j].tolist(), strict=True))
    found: dict[int, set] = {}
    for d, x in pairs:
        found.setdefault(d, set()).add(x)
    return counts, mask, found


def _scan(shared, width: int, k: int, carry: list[str], text: str, id_type: pa.DataType):
    """Adds this block's hits to those that came with the row."""
    def run(batches):
        index = shared.value
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(text)]
            counts, mask, found = find_hits(texts, index, width, k)
            ends = np.cumsum(counts)
            n_hit, bits, items = [], [], []
            for d, (before, listed) in enumerate(zip(batch.column("hit_bits").to_pylist(),
                                                     batch.column("items").to_pylist(), strict=True)):
                own = mask[ends[d] - counts[d]:ends[d]]
                if before:
                    own = own | np.unpackbits(np.frombuffer(before, dtype=np.uint8), count=len(own)).astype(bool)
                n_hit.append(int(own.sum()))
                bits.append(np.packbits(own).tobytes() if n_hit[-1] else None)
                items.append((listed or []) + [index["ids"][x] for x in sorted(found.get(d, ()))])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), pa.array(counts), pa.array(n_hit, pa.int64()),
                 pa.array(bits, pa.binary()), pa.array(items, pa.list_(id_type))],
                names=[*carry, "n_words", "n_hit", "hit_bits", "items"])
    return run


def find_overlaps(docs: DataFrame, benchmark: DataFrame, carry: list[str], text: str, width: int = WIDTH, k: int = K,
                  item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK) -> DataFrame:
    """``carry`` columns of each document plus n_words, n_hit, hit_bits (one
    bit per word, packed; null: none) and items (ids, may repeat).

    ``carry`` must not use those four names."""
    from pyspark.sql.pandas.types import to_arrow_type
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, math.ceil(total / block_bytes))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)))
    kind = items.schema["item_id"].dataType
    types = dict(docs.dtypes)
    columns = list(dict.fromkeys([*carry, text]))
    found = (docs.select(*columns).withColumn("n_words", F.lit(0).cast("long")).withColumn("n_hit", F.lit(0).cast("long"))
             .withColumn("hit_bits", F.lit(None).cast("binary")).withColumn("items", F.lit(None).cast(f"array<{kind.simpleString()}>")))
    for block in range(n_blocks):
        own = [(r[0], r[1]) for r in items.where(F.col("block") == block).select("item_id", "text").collect()]
        shared = spark.sparkContext.broadcast(build_index(sorted(own, key=str), width, k))
        keep = columns if block + 1 < n_blocks else carry
        schema = (", ".join(f"`{c}` {types[c]}" for c in keep)
                  + f", n_words long, n_hit long, hit_bits binary, items array<{kind.simpleString()}>")
        found = found.mapInArrow(_scan(shared, width, k, keep, text, to_arrow_type(kind)), schema)
        if block % 4 == 3 and block + 1 < n_blocks:      # bounds the Python stages alive at once
            found, _ = written(found, "overlaps")
    return found


def is_contaminated(percent: int = PERCENT):
    return (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, id_col: str = "doc_id",
                  text_col: str = "text", **kw) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, hit_bits, items (distinct ids as
    strings, sorted) and contaminated."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = find_overlaps(rows, benchmark, ["doc_id"], "text", **kw)
    ids = F.array_sort(F.array_distinct(F.filter(F.transform("items", lambda x: x.cast("string")), lambda x: x.isNotNull())))
    return found.withColumn("items", ids).withColumn("contaminated", is_contaminated(percent))


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def decontaminate(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they were."""
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    found = find_overlaps(plain, benchmark, plain.columns, f"c{docs.columns.index(text_col)}", **kw)
    return found.where(~is_contaminated(percent)).select(*plain.columns).toDF(*docs.columns)


def brute_force(docs: list[tuple], items: list[tuple], width: int = WIDTH) -> list[tuple]:
    """The same on small lists of (id, text), for tests."""
    import hashlib
    import re

    def words(t):
        t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    windows: dict[tuple, set] = {}
    for i, t in items:
        w = words(t)
        n = min(width, len(w))
        for k in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    lengths = {len(x) for x in windows}
    out = []
    for i, t in docs:
        w, hit, listed = words(t), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[k:k + n]))) is not None:
                    hit.update(range(k, k + n))
                    listed |= got
        names = sorted(str(x) for x in listed if x is not None)
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out
