"""Language identification by cross-parsing entropy.

For every language a suffix automaton holds labelled text. A document is
parsed against it greedily: each phrase is the longest match from where the
last one ended. Text in the automaton's language needs few long phrases,
other text many short ones; the language with the fewest phrases per symbol
wins (Ziv-Merhav cross parsing).

Texts become symbols first: lower-cased letters (the ``LETTERS`` most frequent
ones of the sample each have a symbol, others share ``BUCKETS`` by code
point) and one separator for every run of anything else. Whole texts are
parsed, in segments of ``SEGMENT`` symbols so that many parse in step; every
segment begins a phrase for all languages alike.

Every label that occurs is learned. The sample is bounded per language:
``DOCS`` documents (the smallest hash of each slot of ids), ``PIECE``
characters from the middle of each. Automata are built on the driver from this
sample and broadcast in blocks of ``BLOCK`` languages (below 2 MB a language).
A worker expands one block's transition tables at a time (up to about 25 MB a
language) and carries the two smallest phrase counts from block to block, so
memory does not grow with the number of languages; time does.

Defined results: null text or text without a letter: ``und``, score 0; ties go
to the smaller language name; with one learned language it always wins with
score 1; with none every text is ``und``. score = second / (first + second)
phrase counts: 0.5 for a tie, towards 1 for a clear winner.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOCS = 64
PIECE = 512
BLOCK = 16               # languages whose tables a worker holds at once
LETTERS = 64
BUCKETS = 32
SEGMENT = 256
N_SYMBOLS = 1 + LETTERS + BUCKETS
UNDETERMINED = "und"


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as '')."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(modulus))


class Alphabet:
    """Symbols of texts: 0 separator, then letters by frequency, then buckets."""

    def __init__(self, letters: list[str]):
        letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
        self.table = np.where(letter, 1 + LETTERS + np.arange(0x110000) % BUCKETS, 0).astype(np.uint8)
        self.table[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts end to end, and how many each has (separators
        at either end are dropped)."""
        joined = "\n".join([*texts, ""]).lower()
        codes = self.table[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        ends = np.cumsum([len(t.lower()) + 1 for t in texts])
        owner = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
        keep = codes > 0
        after = np.zeros(len(codes), dtype=bool)      # one separator after a run of letters
        after[1:] = keep[:-1]
        last = np.zeros(len(texts), dtype=np.int64)
        np.maximum.at(last, owner[keep], np.flatnonzero(keep))
        keep |= after & (np.arange(len(codes)) < last[owner])
        return codes[keep], np.bincount(owner[keep], minlength=len(texts))


class Automaton:
    """Suffix automaton of a symbol sequence: states with transitions."""

    def __init__(self, sequence: list[int]):
        self.next: list[dict[int, int]] = [{}]
        link, length = [-1], [0]
        last = 0
        for c in sequence:
            cur = len(self.next)
            self.next.append({})
            link.append(0), length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = cur
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[q] == length[p] + 1:
                    link[cur] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    link.append(link[q]), length.append(length[p] + 1)
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur

    def edges(self) -> np.ndarray:
        """Rows (state, symbol, next state)."""
        return np.array([(s, c, t) for s, out in enumerate(self.next) for c, t in out.items()], dtype=np.int32).reshape(-1, 3)


def transition_table(edges: np.ndarray) -> np.ndarray:
    """Dense table [state * N_SYMBOLS + symbol]. A missing transition ends the
    phrase; the next one begins with the symbol, in state s: stored as ``~s``."""
    table = np.full((int(edges[:, (0, 2)].max(initial=0)) + 1, N_SYMBOLS), -1, dtype=np.int32)
    root = edges[edges[:, 0] == 0]
    table[:, root[:, 1]] = ~root[:, 2]
    table[edges[:, 0], edges[:, 1]] = edges[:, 2]
    return table.ravel()


def count_phrases(codes: np.ndarray, counts: np.ndarray, tables: list[np.ndarray], lanes: int = 1 << 14) -> np.ndarray:
    """Phrases of each text (rows) against each table (columns)."""
    per = -(-counts // SEGMENT)
    owner = np.repeat(np.arange(len(counts)), per)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    first = np.repeat(np.cumsum(counts) - counts, per) + nth * SEGMENT
    length = np.minimum(SEGMENT, np.repeat(counts, per) - nth * SEGMENT)
    order = np.argsort(-length, kind="stable")
    out = np.zeros((len(counts), len(tables)), dtype=np.int64)
    for at in range(0, len(order), lanes):
        own = order[at:at + lanes]
        start, size = first[own], length[own]
        active = np.searchsorted(-size, -np.arange(int(size[0])), side="left")      # lanes longer than t
        phrases = np.ones((len(tables), len(own)), dtype=np.int32)
        state = np.zeros((len(tables), len(own)), dtype=np.int64)
        for t, n in enumerate(active.tolist()):
            symbol = codes[start[:n] + t].astype(np.int64)
            for k, table in enumerate(tables):
                v = table[state[k, :n] * N_SYMBOLS + symbol]
                sign = v >> 31
                state[k, :n] = v ^ sign
                if t:
                    phrases[k, :n] -= sign
        for k in range(len(tables)):
            np.add.at(out[:, k], owner[own], phrases[k])
    return out


def fit(docs: DataFrame, use: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], Iterator[tuple[list[str], list[np.ndarray]]]]:
    """Letters, and blocks of (names, automaton edges) in the order of names,
    from the rows where ``use``."""
    key = F.xxhash64(F.col(id_col).cast("string"), F.lit(17))
    middle = F.greatest(F.lit(1), F.floor(F.length(text_col) / 2).cast("int") - PIECE // 2)
    labelled = docs.where(use & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), key.alias("key"), F.substr(F.col(text_col), middle, F.lit(PIECE)).alias("piece"))
    slot = F.pmod(F.col("key"), F.lit(DOCS)).alias("slot")
    chosen = labelled.groupBy("lang", slot).agg(F.min("key").alias("key")).drop("slot")      # at most DOCS rows a language
    pieces = labelled.join(F.broadcast(chosen), ["lang", "key"]).groupBy("lang", "key").agg(F.min("piece").alias("piece"))
    texts: dict[str, list[str]] = {}
    for r in sorted(pieces.collect(), key=lambda r: (r["lang"], r["key"])):
        texts.setdefault(r["lang"], []).append(r["piece"])
    seen = Counter(c for own in texts.values() for t in own for c in t.lower() if c.isalpha())
    letters = [c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:LETTERS]]

    def blocks():
        alphabet, names, edges = Alphabet(letters), [], []
        for name, own in texts.items():
            codes, counts = alphabet.symbols(own)
            if len(codes):
                parts = np.split(codes, np.cumsum(counts)[:-1])
                names.append(name)
                edges.append(Automaton([c for p in parts for c in (*p.tolist(), 0)]).edges())
            if len(names) == BLOCK:
                yield names, edges
                names, edges = [], []
        if names:
            yield names, edges
    return letters, blocks()


_TABLES: dict = {}
_NONE = np.iinfo(np.int64).max


def _block(token: str, at: int, shared) -> tuple[list[str], list[np.ndarray]]:
    """Names and tables of a block; a worker keeps the last one only."""
    if (token, at) not in _TABLES:
        _TABLES.clear()
        names, edges = shared.value
        _TABLES[token, at] = names, [transition_table(e) for e in edges]
        shared.__dict__.pop("_value", None)      # read again from its file when it is needed
    return _TABLES[token, at]


def _predict(token: str, letters: list[str], shared: list, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = Alphabet(letters)
        for batch in batches:
            parts = [batch.slice(at, 512) for at in range(0, batch.num_rows, 512)]
            symbols = [alphabet.symbols([t or "" for t in p.column("text").to_pylist()]) for p in parts]
            # phrases of the best and the second language so far, and the best one's name
            two = [np.full((len(counts), 2), _NONE) for _, counts in symbols]
            best = [np.full(len(counts), UNDETERMINED, dtype=object) for _, counts in symbols]
            for at, block in enumerate(shared):
                names, tables = _block(token, at, block)
                for k, (codes, counts) in enumerate(symbols):
                    phrases = np.hstack([two[k], count_phrases(codes, counts, tables)]) if len(codes) else two[k]
                    rank = np.argsort(phrases, axis=1, kind="stable")[:, :2]      # ties stay with the smaller name
                    two[k] = np.take_along_axis(phrases, rank, axis=1)
                    new = rank[:, 0] >= 2
                    best[k][new] = np.array(names, dtype=object)[rank[new, 0] - 2]
            for part, (_, counts), own, name in zip(parts, symbols, two, best, strict=True):
                lang, score, fewest = [UNDETERMINED] * len(counts), [0.0] * len(counts), [None] * len(counts)
                for d in np.flatnonzero(counts) if shared else ():
                    first, second = own[d].tolist()
                    lang[d], fewest[d] = name[d], first / int(counts[d])
                    score[d] = 1.0 if second == _NONE else second / (first + second)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(lang), pa.array(score, pa.float64()),
                     pa.array(fewest, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score", "phrases_per_symbol"])
    return run


def identify(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, phrases_per_symbol of every row;
    labels are read only from rows where ``held_out`` is false."""
    from pyspark.sql.pandas.types import to_arrow_type
    letters, blocks = fit(docs, ~held_out, id_col, text_col, lang_col)
    shared = [docs.sparkSession.sparkContext.broadcast(b) for b in blocks]
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    run = _predict(uuid.uuid4().hex, letters, shared, to_arrow_type(rows.schema["doc_id"].dataType))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double, "
                                "phrases_per_symbol double")
