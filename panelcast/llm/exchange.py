"""Which hashes of a document occur in other documents too, and in how many.

Every distinct (document, hash) pair of the corpus meets all others with the
same hash. A row per pair would cost about 30 bytes each in the shuffle, so
pairs travel packed:

1. *Blocks.* A task hashes its documents in blocks of about ``BLOCK`` hashes.
   A hash that several documents of a block share leaves the block once, with
   their number, so however common a hash is, one block sends it once.
2. *Parts.* The hashes of a block are dealt over ``n_parts`` ranges of the
   hash value; Spark groups the fragments by part. ``n_parts`` follows the
   corpus size (about ``PART`` hashes each), so a part fits one task at any
   scale. A part counts each hash over all blocks and sends back those that
   occur in two documents or more.
3. *Back.* Spark groups the answers by block; the task restores the
   documents' lists.

Documents are rows: a repeated row counts as another document. The rows must
come from a deterministic plan (a table scan, not a limit or an unordered
sample), so that a task recomputed after a lost executor forms the same blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.words import U, mix

BLOCK = 1 << 20          # distinct hashes per block
PART = 3 << 20           # hashes per part
PARTS = 256              # parts at least: from here on 7 bytes hold what is left of a hash
DF_MAX = 65_535          # frequencies above this count as this

#: (texts as UTF-8 bytes) -> (hash, document ordinal) of every item, documents in order
Hasher = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]

_FRAGMENT = ("part int, block long, hashes binary, docs binary, counts binary, keys binary, "
             "sizes binary")
_RESULT = "doc_id {id}, text_hash long, n_items long, digest_a long, digest_b long, hashes binary, freqs binary"


def small_ints(x: np.ndarray) -> bytes:
    """Non-negative integers in the narrowest width that holds them all."""
    top = int(x.max()) if len(x) else 0
    kind = np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32
    return x.astype(kind).tobytes()


def read_ints(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, dtype=np.int64)
    return np.frombuffer(data, dtype={1: np.uint8, 2: np.uint16, 4: np.uint32}[len(data) // n]).astype(np.int64)


def part_edges(n_parts: int) -> tuple[np.ndarray, int]:
    """First hash of each part, and the bytes that tell a part's hashes apart."""
    edges = np.array([(i << 64) // n_parts for i in range(n_parts)], dtype=U)
    widest = -(-(1 << 64) // n_parts) - 1
    return edges, max(1, -(-widest.bit_length() // 8))


def pack_hashes(x: np.ndarray, width: int) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def read_hashes(data: bytes, width: int) -> np.ndarray:
    full = np.zeros((len(data) // width, 8), dtype=np.uint8)
    full[:, :width] = np.frombuffer(data, dtype=np.uint8).reshape(-1, width)
    return full.view("<u8").ravel().astype(U)


def distinct_items(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (hash, document) pairs, sorted by hash, then document."""
    order = np.argsort(hashes, kind="stable")      # documents come in order
    h, d = hashes[order], docs[order]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[keep], d[keep]


def set_digests(hashes: np.ndarray, docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digest of each document's hash set (independent of order)."""
    a, b = np.zeros(n, dtype=U), np.zeros(n, dtype=U)
    np.add.at(a, docs, mix(hashes + U(0x632BE59BD9B4E019)))
    np.add.at(b, docs, mix(hashes ^ U(0xC2B2AE3D27D4EB4F)))
    return a, b


def _fragments(n_parts: int, hasher: Hasher):
    edges, width = part_edges(n_parts)

    def one(block: int, ids: list, keys: list, texts: list[bytes]) -> pa.RecordBatch:
        n = len(texts)
        h, d = distinct_items(*hasher(texts))
        a, b = set_digests(h, d, n)
        new = np.ones(len(h) + 1, dtype=bool)
        new[1:-1] = h[1:] != h[:-1]
        start = np.flatnonzero(new)[:-1] if len(h) else np.empty(0, dtype=np.int64)
        size = np.diff(np.append(start, len(h)))
        inner = np.repeat(size, size) > 1          # shared inside the block
        rows = {k: [] for k in ("part", "block", "hashes", "docs", "counts", "keys", "sizes")}

        def put(part, hashes, docs, counts, keys=None, sizes=None):
            for k, v in zip(rows, (part, block, hashes, docs, counts, keys, sizes), strict=True):
                rows[k].append(v)

        # the block's own row: its documents and the pairs it knows to be shared
        own = np.argsort(d[inner], kind="stable")
        put(block % n_parts, h[inner][own].tobytes(), small_ints(d[inner][own]), None,
            b"".join([a.tobytes(), b.tobytes(), np.array(keys, dtype=np.int64).tobytes()]),
            np.bincount(d, minlength=n).astype(np.int64).tobytes())
        ids_at = len(rows["part"]) - 1
        lone, many = h[~inner], h[start[size > 1]]
        lone_doc, many_size = d[~inner], size[size > 1]
        cut = np.append(np.searchsorted(lone, edges), len(lone))
        cut_many = np.append(np.searchsorted(many, edges), len(many))
        for p in np.flatnonzero((np.diff(cut) > 0) | (np.diff(cut_many) > 0)):
            x, y = slice(cut[p], cut[p + 1]), slice(cut_many[p], cut_many[p + 1])
            order = np.argsort(lone_doc[x], kind="stable")
            docs = lone_doc[x][order]
            put(int(p), pack_hashes(np.concatenate([lone[x][order], many[y]]) - edges[p], width),
                small_ints(np.diff(docs, prepend=0)),
                np.array([len(docs), *many_size[y]], dtype=np.uint32).tobytes())
        out_ids: list = [None] * len(rows["part"])
        out_ids[ids_at] = ids
        return rows, out_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        base, serial = TaskContext.get().partitionId() << 32, 0
        ids, keys, texts, size = [], [], [], 0

        def flush():
            nonlocal serial
            rows, out_ids = one(base + serial, ids, keys, texts)
            serial += 1
            kinds = {"part": pa.int32(), "block": pa.int64()}
            arrays = [pa.array(v, type=kinds.get(k, pa.binary())) for k, v in rows.items()]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(out_ids, type=pa.list_(id_type))],
                                              names=[*rows, "ids"])

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.column("doc_id").type
            for i, k, t in zip(batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist(),
                               batch.column("text"), strict=True):
                data = t.as_buffer().to_pybytes() if t.is_valid else b""
                ids.append(i), keys.append(k), texts.append(data)
                size += len(data)
                if size >= 6 * BLOCK or len(ids) >= 1 << 15:
                    yield flush()
                    ids, keys, texts, size = [], [], [], 0
        if ids:
            yield flush()

    return run


def _count(n_parts: int):
    edges, width = part_edges(n_parts)

    def count(key: tuple, table: pa.Table) -> pa.Table:
        return _count_part(table, edges[key[0].as_py()], width)
    return count


def _count_part(table: pa.Table, edge: np.uint64, width: int) -> pa.Table:
    """One part: fragments of all blocks in, the shared hashes of each out."""
    out = {k: [] for k in ("block", "hashes", "docs", "counts", "keys", "sizes", "ids")}
    own = table.filter(pc.is_valid(table["keys"]))
    frag = table.filter(pc.is_null(table["keys"]))
    hashes, weights, docs, blocks = [], [], [], frag["block"].to_pylist()
    for h, d, c in zip(frag["hashes"].to_pylist(), frag["docs"].to_pylist(),
                       frag["counts"].to_pylist(), strict=True):
        h, c = read_hashes(h, width) + edge, np.frombuffer(c, dtype=np.uint32).astype(np.int64)
        lone = int(c[0])
        hashes.append(h)
        weights.append(np.concatenate([np.ones(lone, dtype=np.int64), c[1:]]))
        docs.append((np.cumsum(read_ints(d, lone)), lone))
    if blocks:
        every, weight = np.concatenate(hashes), np.concatenate(weights)
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        new = np.ones(len(ranked), dtype=bool)
        new[1:] = ranked[1:] != ranked[:-1]
        total = np.add.reduceat(weight[order], np.flatnonzero(new))
        freq = np.empty(len(every), dtype=np.int64)
        freq[order] = total[np.cumsum(new) - 1]
        at = 0
        for block, h, (d, lone) in zip(blocks, hashes, docs, strict=True):
            f = freq[at:at + len(h)]
            at += len(h)
            keep = f > 1
            if keep.any():
                f = np.minimum(f, DF_MAX).astype(np.uint16)
                out["block"].append(block)
                out["hashes"].append(h[keep].tobytes())
                out["docs"].append(small_ints(d[keep[:lone]]))
                out["counts"].append(f[keep].tobytes())
                out["keys"].append(None)
                out["sizes"].append(np.array([keep[:lone].sum()], dtype=np.int64).tobytes())
                out["ids"].append(None)
    answer = pa.table({k: pa.array(v, type=own.schema.field(k).type) for k, v in out.items()})
    return pa.concat_tables([own.select(list(out)), answer]).combine_chunks()


def _gather(table: pa.Table) -> pa.Table:
    """One block: its own row and the parts' answers in, its documents out."""
    own_hash = own_doc = ids = None
    lone_hash, lone_doc, lone_freq, many_hash, many_freq = [], [], [], [], []
    for row in table.to_pylist():
        h = np.frombuffer(row["hashes"], dtype=U)
        if row["keys"] is not None:
            ids, n = row["ids"], len(row["ids"])
            sizes = np.frombuffer(row["sizes"], dtype=np.int64)
            a, b, keys = np.frombuffer(row["keys"], dtype=np.int64).reshape(3, n)
            own_hash, own_doc = h, read_ints(row["docs"], len(h))
        else:
            lone = int(np.frombuffer(row["sizes"], dtype=np.int64)[0])
            f = np.frombuffer(row["counts"], dtype=np.uint16)
            lone_hash.append(h[:lone])
            lone_doc.append(read_ints(row["docs"], lone))
            lone_freq.append(f[:lone])
            many_hash.append(h[lone:])
            many_freq.append(f[lone:])
    freq = np.empty(0, dtype=np.uint16)
    if len(own_hash):
        known, known_freq = np.concatenate(many_hash), np.concatenate(many_freq)
        order = np.argsort(known)
        freq = known_freq[order][np.searchsorted(known[order], own_hash)]
    h = np.concatenate([own_hash, *lone_hash])
    d = np.concatenate([own_doc, *lone_doc])
    f = np.concatenate([freq, *lone_freq])
    order = np.lexsort((h, f, d))          # per document: rarest first, ties by hash
    h, f = h[order], f[order]
    at = np.concatenate([[0], np.cumsum(np.bincount(d, minlength=len(ids)))])
    return pa.table({
        "doc_id": pa.array(ids, type=table.schema.field("ids").type.value_type),
        "text_hash": keys, "n_items": sizes, "digest_a": a, "digest_b": b,
        "hashes": pa.array([h[at[i]:at[i + 1]].tobytes() for i in range(len(ids))], type=pa.binary()),
        "freqs": pa.array([f[at[i]:at[i + 1]].tobytes() for i in range(len(ids))], type=pa.binary())})


def part_count(docs: DataFrame, bytes_per_item: float) -> int:
    """Parts for the hashes of a corpus: one pass over the text lengths."""
    total = docs.agg(F.sum(F.octet_length("text").cast("double"))).first()[0] or 0.0
    return max(PARTS, math.ceil(total / bytes_per_item / PART))


def shared_hashes(docs: DataFrame, hasher: Hasher, n_parts: int) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): number and 128-bit digest
    of its distinct hashes, and those that at least two documents have.

    ``hashes`` (packed uint64) are ordered by ``freqs`` (packed uint16: the
    number of documents, cut at ``DF_MAX``), ties by hash. ``text_hash`` is
    xxhash64 of the text: with doc_id it names the row again in a later join.
    """
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    fragments = rows.mapInArrow(_fragments(n_parts, hasher), f"{_FRAGMENT}, ids array<{kind}>")
    counted = fragments.groupBy("part").applyInArrow(
        _count(n_parts), f"block long, hashes binary, docs binary, counts binary, keys binary, sizes binary, ids array<{kind}>")
    return counted.groupBy("block").applyInArrow(_gather, _RESULT.format(id=kind))
