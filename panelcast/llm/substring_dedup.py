"""Exact substring deduplication over fixed-length word windows (Rabin-Karp).

Every window of ``width`` consecutive words of every document gets a rolling
64-bit hash; Spark counts each hash over the corpus (``exchange``). A window
whose word sequence also starts anywhere else, in another document or again
in its own, is repeated; overlapping repeated windows merge into maximal
removal intervals. Windows are judged on the input: all copies go, also the
first one. Equal hashes are taken as equal windows (for n windows about
n**2 / 2**65 chance pairs: none expected up to some billion windows).

Defined results: a null or empty text has no words and loses none; a document
shorter than ``width`` words has no window; repeated rows are documents of
their own, so each repeats the other's windows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.exchange import part_count, shared_hashes
from panelcast.llm.words import U, covered, doc_windows, window_hashes, word_hashes

WIDTH = 35


def _hasher(width: int):
    def hashes(texts):
        return doc_windows(*word_hashes(texts), width)
    return hashes


def repeated_windows(words: np.ndarray, shared: np.ndarray, width: int) -> np.ndarray:
    """Starts of the windows that are in ``shared`` or occur twice in the text."""
    h = window_hashes(words, width)
    _, back, count = np.unique(h, return_inverse=True, return_counts=True)
    return np.flatnonzero(np.isin(h, shared) | (count[back] > 1))


def intervals(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))


def _remove(width: int, id_type: str):
    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("n_words", "removed", "kept")}
            for text, shared in zip(batch.column("text"), batch.column("hashes"), strict=True):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                words = data.split()       # ASCII white space, as VISIBLE
                if len(words) >= width:
                    known = np.frombuffer(shared.as_py() or b"", dtype=U)
                    mask = covered(repeated_windows(word_hashes([data])[0], known, width), width, len(words))
                    cuts = intervals(mask)
                    words_kept = compress(words, (~mask).tolist()) if cuts else words
                else:
                    cuts, words_kept = [], words
                out["n_words"].append(len(words))
                out["removed"].append([{"first": a, "end": b} for a, b in cuts])
                out["kept"].append(b" ".join(words_kept).decode())
            span = pa.struct([("first", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out["n_words"], pa.int64()),
                 pa.array(out["removed"], pa.list_(span)), pa.array(out["kept"], pa.string())],
                names=["doc_id", "n_words", "removed", "kept"])
    return run, f"doc_id {id_type}, n_words long, removed array<struct<first:long,end:long>>, kept string"


def remove_repeated(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: n_words, the removed word intervals ``[first,
    end)``, and the kept words joined by one space."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = shared_hashes(rows, _hasher(width), part_count(rows, 5.0))
    # equal rows have equal lists; grouped and joined on the same two columns
    found = (found.where(F.length("hashes") > 0).groupBy(F.xxhash64("doc_id").alias("id_hash"), "text_hash")
             .agg(F.first("hashes").alias("hashes")))
    keyed = rows.select("*", F.xxhash64("doc_id").alias("id_hash"), F.xxhash64("text").alias("text_hash"))
    joined = keyed.join(found, ["id_hash", "text_hash"], "left")
    run, schema = _remove(width, dict(rows.dtypes)["doc_id"])
    return joined.select("doc_id", "text", "hashes").mapInArrow(run, schema)


def digest(result: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, SHA-256 of the kept words."""
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["first"])
    return result.select("doc_id", "n_words", gone.alias("n_removed"),
                         F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def brute_force(rows: list[tuple], width: int = WIDTH) -> list[tuple]:
    """The same on small lists of (doc_id, text), for tests."""
    seen: dict[tuple, int] = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for _, w in split:
        for k in range(len(w) - width + 1):
            seen[tuple(w[k:k + width])] = seen.get(tuple(w[k:k + width]), 0) + 1
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - width + 1):
            if seen[tuple(w[k:k + width])] > 1:
                gone.update(range(k, k + width))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out
