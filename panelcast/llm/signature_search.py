"""Ranked lexical search over bit-sliced Bloom signatures.

Documents of similar size form blocks. A block is a bit matrix: one column per
document, one row per Bloom position, stored row by row, so that a term's
presence in all documents of the block is the AND of its ``HASHES`` rows (bit
slices). A term that occurs tf times is entered once for every count of
``LEVELS`` up to tf; a signature therefore bounds its occurrences as well.
Bloom filters have no false negatives, so the slices overestimate.

A query weighs slices: per level, the weights of an item's terms are summed
over the documents whose bit is set, and each level's sum is multiplied by
what the occurrences up to the next level can add in a document of that
length. That is an upper bound of the exact score, in the same integers.

Steps, all of them Spark jobs:

1. ``build``: one pass over the documents writes the blocks, the number of
   documents and terms, and each task's document frequencies.
2. The items' terms are joined with the frequencies to get their weights.
3. The ``k`` documents with the highest bounds of each item are scored
   exactly; the k-th score is a floor below which nothing can enter the list.
4. Every document whose bound reaches its item's floor is scored exactly and
   ranked. Nothing else can be in the answer, and nothing is cut off.

Items are taken in blocks of about ``QUERY_ROWS`` item terms; a block's
weights are what is broadcast. Documents to be scored are found by their id:
broadcast while they are few (counted first), else by a shuffle join.

Defined results: null texts and texts without terms are in no list and do not
count in N; an item without a term that any document holds has no rows;
repeated benchmark rows are items of their own; repeated documents are ranked
one by one; documents without id come last among equal scores; no documents or
no items, no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.scratch import forget, written
from panelcast.llm.words import U, mix

K = 10                   # documents of each list
HASHES = 6               # slices of one entry
BITS = 16                # Bloom positions for each entry that a block's documents may have
BLOCK_BITS = 1 << 23     # bits of one block, at most (if 8 documents fit)
FEW = 64                 # smaller remains of a block join the next larger size
TERMS = 1 << 18          # distinct terms that a task gathers before it hands on their frequencies
QUERY_ROWS = 400_000     # item terms in one broadcast
BROADCAST_PAIRS = 1 << 20    # (item, document) pairs that may be broadcast for exact scoring
#: Occurrences at which a term gets a further entry: 1, 2, 3, 4, 6, 8, 12, ...
LEVELS = np.array([1, 2, 3] + [m << s for s in range(1, 30) for m in (2, 3)], dtype=np.int64)

#: Bytes of a term, upper case lowered; all others become blanks.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
              for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def length_part(n, n_docs: int, n_terms: int):
    """m of a document with n terms; never decreases with n."""
    return 25 + (75 * n * n_docs) // n_terms


def gain(tf, m):
    """What one unit of weight scores with tf occurrences."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class _Hashes(dict):
    def __missing__(self, term: bytes) -> int:
        self[term] = h = xxhash.xxh3_64_intdigest(term)
        return h


def positions(hashes: np.ndarray, levels: np.ndarray, rows: int) -> np.ndarray:
    """(entry, HASHES) slices of (term, level) entries in a block of ``rows`` slices."""
    h = mix(hashes + levels.astype(U) * U(0x9E3779B97F4A7C15))
    step = mix(h) | U(1)
    return ((h[:, None] + np.arange(HASHES, dtype=U) * step[:, None]) % U(rows)).astype(np.int64)


# --- the index ----------------------------------------------------------------------------

class _Blocks:
    """Documents waiting for a block of their size class."""

    def __init__(self):
        self.waiting: dict[int, list[tuple]] = {}

    @staticmethod
    def width(size: int) -> int:
        """Documents of one block of the class for up to ``2**size`` entries."""
        return max(8, min(1024, (BLOCK_BITS // (BITS << size)) // 8 * 8))

    def add(self, doc_id, n: int, hashes: np.ndarray, counts: np.ndarray) -> Iterator[dict]:
        per = np.searchsorted(LEVELS, counts, side="right")
        entries = int(per.sum())
        size = max(4, (entries - 1).bit_length())
        levels = np.arange(entries) - np.repeat(np.cumsum(per) - per, per)
        own = self.waiting.setdefault(size, [])
        own.append((doc_id, n, np.repeat(hashes, per), levels))
        if len(own) == self.width(size):
            yield self.block(size)

    def rest(self) -> Iterator[dict]:
        while self.waiting:
            size = min(self.waiting)
            larger = [s for s in self.waiting if s > size]
            if larger and len(self.waiting[size]) < FEW and (BITS << min(larger)) * FEW <= BLOCK_BITS:
                up = min(larger)
                self.waiting[up] += self.waiting.pop(size)
                while len(self.waiting[up]) > self.width(up):
                    over, self.waiting[up] = self.waiting[up][self.width(up):], self.waiting[up][:self.width(up)]
                    yield self.block(up)
                    self.waiting[up] = over
            else:
                yield self.block(size)

    def block(self, size: int) -> dict:
        docs = self.waiting.pop(size)
        rows, width = BITS << size, -(-len(docs) // 8) * 8
        bits = np.zeros((rows, width), dtype=bool)
        for column, (_, _, hashes, levels) in enumerate(docs):
            bits[positions(hashes, levels, rows).ravel(), column] = True
        return {"ids": [d[0] for d in docs], "lengths": [d[1] for d in docs], "bits": np.packbits(bits, axis=1).tobytes()}


INDEX = ("ids array<{id}>, lengths array<long>, bits binary, term binary, df long, n_docs long, n_terms long")


def _index_task(id_type: pa.DataType):
    kinds = {"ids": pa.list_(id_type), "lengths": pa.list_(pa.int64()), "bits": pa.binary(), "term": pa.binary(),
             "df": pa.int64(), "n_docs": pa.int64(), "n_terms": pa.int64()}

    def table(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns.get(c, [None] * n), type=k) for c, k in kinds.items()],
                                          names=list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, df, blocks = _Hashes(), Counter(), _Blocks()
        n_docs = n_terms = 0
        made = lambda b: table(1, **{c: [v] for c, v in b.items()})
        flushed = lambda: table(len(df), term=list(df), df=list(df.values()))
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found = Counter(terms(text.as_buffer().to_pybytes())) if text.is_valid else None
                if not found:
                    continue
                counts = np.fromiter(found.values(), dtype=np.int64, count=len(found))
                n = int(counts.sum())
                n_docs, n_terms = n_docs + 1, n_terms + n
                df.update(found.keys())
                own = np.fromiter(map(hashes.__getitem__, found), dtype=U, count=len(found))
                for b in blocks.add(doc_id, n, own, counts):
                    yield made(b)
                if len(df) >= TERMS:
                    yield flushed()
                    df.clear()
                    hashes.clear()
        for b in blocks.rest():
            yield made(b)
        if df:
            yield flushed()
        yield table(1, n_docs=[n_docs], n_terms=[n_terms])
    return run


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """The index of ``docs`` as one written table (and its path): rows with
    ``bits`` are blocks, rows with ``term`` are document frequencies by task,
    rows with ``n_docs`` are totals by task."""
    from pyspark.sql.pandas.types import to_arrow_type
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType
    return written(rows.mapInArrow(_index_task(to_arrow_type(kind)), INDEX.format(id=kind.simpleString())), "signatures")


# --- queries ------------------------------------------------------------------------------

def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, text in zip(batch.column("item").to_pylist(), batch.column("text"), strict=True):
            found = Counter(terms(text.as_buffer().to_pybytes())) if text.is_valid else {}
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(found), type=pa.int64()), pa.array(list(found), type=pa.binary()),
                 pa.array(list(found.values()), type=pa.int64())], names=["item", "term", "times"])


class Query:
    """A block of weighted items. ``rows``: (item, term, weight)."""

    def __init__(self, rows: Iterable[tuple[int, bytes, int]], n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weights: dict[int, dict[bytes, int]] = {}
        for item, term, weight in rows:
            self.weights.setdefault(item, {})[term] = weight
        self.items = sorted(self.weights)
        every = sorted({t for own in self.weights.values() for t in own})
        number = {t: i for i, t in enumerate(every)}
        self.hashes = np.array([xxhash.xxh3_64_intdigest(t) for t in every], dtype=U)
        self.terms = [np.array([number[t] for t in self.weights[i]], dtype=np.int64) for i in self.items]
        self.parts = [np.array(list(self.weights[i].values()), dtype=np.float64) for i in self.items]
        self.floor = np.ones(len(self.items), dtype=np.int64)

    def bounds(self, bits: bytes, lengths: np.ndarray) -> np.ndarray:
        """(item, document) upper bounds of the scores in one block. Sums of
        weights are whole numbers below 2**53, so doubles hold them exactly."""
        n = len(lengths)
        slices = np.frombuffer(bits, dtype=np.uint8).reshape(-1, -(-n // 8))
        m = length_part(lengths, self.n_docs, self.n_terms)
        out = np.zeros((len(self.items), n), dtype=np.int64)
        active, present = np.arange(len(self.hashes)), None
        before = np.zeros(n, dtype=np.int64)
        place = np.full(len(self.hashes), -1, dtype=np.int64)
        for level in range(len(LEVELS)):
            at = positions(self.hashes[active], np.full(len(active), level), len(slices))
            found = slices[at[:, 0]]
            for j in range(1, HASHES):
                found &= slices[at[:, j]]
            if present is not None:
                found &= present
            some = found.any(axis=1)
            active, present = active[some], found[some]
            if not len(active):
                break
            most = LEVELS[level + 1] - 1 if level + 1 < len(LEVELS) else np.iinfo(np.int32).max
            now = gain(np.minimum(most, lengths), m)
            more, before = now - before, now
            place[:] = -1
            place[active] = np.arange(len(active))
            flags = np.unpackbits(present, axis=1, count=n)
            for i, (own, parts) in enumerate(zip(self.terms, self.parts, strict=True)):
                where = place[own]
                held = where >= 0
                if held.any():
                    out[i] += (parts[held] @ flags[where[held]]).astype(np.int64) * more
        return out

    def score(self, item: int, found: Counter, n: int) -> int:
        m = length_part(n, self.n_docs, self.n_terms)
        return sum(w * gain(found[t], m) for t, w in self.weights[item].items() if t in found)


def _bounds_task(shared, k: int | None, id_type: pa.DataType):
    """(item, doc_id, bound): the ``k`` highest of each item in this task, or
    all that reach the item's floor when ``k`` is None."""
    def rows(items, ids, bounds) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(items, type=pa.int64()), pa.array(ids, type=id_type),
                                           pa.array(bounds, type=pa.int64())], names=["item", "doc_id", "bound"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query = shared.value
        best: list[list[tuple]] = [[] for _ in query.items]
        for batch in batches:
            for ids, lengths, bits in zip(batch.column("ids"), batch.column("lengths"), batch.column("bits"), strict=True):
                ids = ids.as_py()
                bounds = query.bounds(bits.as_buffer(), lengths.values.to_numpy())
                if k is None:
                    item, at = np.nonzero(bounds >= query.floor[:, None])
                    if len(item):
                        yield rows(np.array(query.items)[item], [ids[x] for x in at], bounds[item, at])
                    continue
                for own, line in zip(best, bounds, strict=True):
                    top = np.argpartition(-line, k)[:k] if len(line) > k else range(len(line))
                    least = own[-1][0] if len(own) == k else 0
                    more = [(int(line[x]), ids[x]) for x in top if line[x] > least]
                    if more:
                        own += more
                        own.sort(key=lambda x: -x[0])
                        del own[k:]
        if k is not None:
            flat = [(query.items[i], d, b) for i, own in enumerate(best) for b, d in own]
            yield rows(*zip(*flat, strict=True)) if flat else rows([], [], [])
    return run


def _score_task(shared, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query = shared.value
        floor = dict(zip(query.items, query.floor.tolist(), strict=True))
        for batch in batches:
            out: list[tuple] = []
            for doc_id, items, text in zip(batch.column("doc_id").to_pylist(), batch.column("items").to_pylist(),
                                           batch.column("text"), strict=True):
                found = Counter(terms(text.as_buffer().to_pybytes())) if text.is_valid else Counter()
                n = sum(found.values())
                for item in items if n else ():
                    score = query.score(item, found, n)
                    if score >= floor[item]:
                        out.append((item, doc_id, score))
            item, doc_id, score = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(item, type=pa.int64()), pa.array(doc_id, type=id_type),
                                              pa.array(score, type=pa.int64())], names=["item", "doc_id", "score"])
    return run


def _exact(docs: DataFrame, pairs: DataFrame, shared, id_type: pa.DataType, id_sql: str) -> DataFrame:
    """(item, doc_id, score) of the documents in ``pairs`` (item, doc_id)."""
    wanted, path = written(pairs.groupBy("doc_id").agg(F.collect_set("item").alias("items")), "to-score")
    n = wanted.agg(F.sum(F.size("items"))).first()[0] or 0
    wanted = wanted.withColumnRenamed("doc_id", "wanted_id")
    side = F.broadcast(wanted) if n <= BROADCAST_PAIRS else wanted
    rows = docs.join(side, docs["doc_id"].eqNullSafe(F.col("wanted_id"))).select("doc_id", "items", "text")
    return rows.mapInArrow(_score_task(shared, id_type), f"item long, doc_id {id_sql}, score long")


def _ranked(df: DataFrame, by: Column, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(by.desc(), F.col("doc_id").asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, queries: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           query_id: str = "item_id", query_text: str = "text", query_rows: int = QUERY_ROWS) -> DataFrame:
    """The ``k`` highest-scoring documents of each row of ``queries``:
    item_id, rank, doc_id, score."""
    from pyspark.sql.pandas.types import to_arrow_type
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType
    id_type, id_sql = to_arrow_type(kind), kind.simpleString()
    index, index_path = build(rows)
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = n_docs or 0, n_terms or 0
    items, _ = written(queries.select(F.monotonically_increasing_id().alias("item"), F.col(query_id).alias("item_id"),
                                      F.col(query_text).alias("text")), "items")
    asked = items.select("item", "text").mapInArrow(_item_terms, "item long, term binary, times long")
    df = (index.where("term is not null").join(asked.select("term").distinct(), "term", "left_semi")
          .groupBy("term").agg(F.sum("df").alias("df")))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1)))
    weighted, weighted_path = written(asked.join(df, "term").select("item", "term", (F.col("times") * weight).alias("weight")),
                                      "weights")
    n_blocks = max(1, math.ceil(weighted.count() / query_rows))
    blocks = index.where("bits is not null").select("ids", "lengths", "bits")
    found = []
    for block in range(n_blocks):
        own = weighted.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block).toArrow().to_pydict()
        query = Query(zip(own["item"], own["term"], own["weight"], strict=True), n_docs, n_terms)
        schema = f"item long, doc_id {id_sql}, bound long"
        shared = spark.sparkContext.broadcast(query)
        first = _ranked(blocks.mapInArrow(_bounds_task(shared, k, id_type), schema), F.col("bound"), k)
        scored = _ranked(_exact(rows, first.select("item", "doc_id"), shared, id_type, id_sql), F.col("score"), k)
        floors = {r["item"]: r["score"] for r in scored.where(F.col("rank") == k).select("item", "score").collect()}
        query.floor = np.array([max(1, floors.get(i, 1)) for i in query.items], dtype=np.int64)
        shared = spark.sparkContext.broadcast(query)
        left = blocks.mapInArrow(_bounds_task(shared, None, id_type), schema)
        best = _ranked(_exact(rows, left.select("item", "doc_id"), shared, id_type, id_sql), F.col("score"), k)
        found.append(written(best, "ranked")[0])
    forget(spark, index_path)
    forget(spark, weighted_path)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.join(items.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score")


def brute_force(docs: list[tuple], items: list[tuple], k: int = K) -> list[tuple]:
    """The same on small lists of (id, text), straight from the definition."""
    import re

    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bags = [(i, Counter(split(t))) for i, t in docs]
    bags = [(i, c, sum(c.values())) for i, c in bags if c]
    n_docs, n_terms = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    out = []
    for item_id, text in items:
        asked, scores = Counter(split(text)), []
        for i, c, n in bags:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            s = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t, times in asked.items() if t in c)
            if s > 0:
                scores.append((-s, i is None, i, s))
        out += [(item_id, r, i, s) for r, (_, _, i, s) in enumerate(sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:k], 1)]
    return out
