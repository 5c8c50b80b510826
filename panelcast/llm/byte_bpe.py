"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token's bytes are a linked list of symbols. Every neighbouring pair that
is a token waits in the bucket of its rank (= id). A bitmap of two levels
tells which buckets hold anything: find-first-set on the upper word, then on
the lower one, gives the smallest rank. Its bucket is worked off from left to
right; entries whose pair has changed since are stale and skipped. A merge
costs a constant number of steps whatever the length, so a pre-token of
millions of bytes takes time in proportion, where a scan for the smallest
rank would take the square. The pre-tokens that some documents bring anew lie
end to end in one such list, with borders between them that no pair crosses:
a bucket holds the positions of all of them, and one step of the queue serves
many merges. Where a merge frees a smaller rank, the rest of its pre-token
waits for that.

Texts are cut by the tokenizer's pattern. Most pre-tokens repeat, so a worker
remembers the ids of those met lately (two generations of ``CACHE`` entries;
long ones are not kept). With ``blanks`` (right for patterns that put the
blank before a word into its match and cut such a match the same wherever it
stands, as the public one does) a text is first cut at blanks before visible
characters, where every match ends anyway, and the parts are remembered as a
whole; only unknown parts are cut by the pattern.

Defined results: a null or empty text has no ids and decodes to nothing;
repeated rows are encoded one by one; other columns are ignored. Ids outside
the vocabulary raise an error when decoded; null ids decode to null.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.words import together

CACHE = 300_000          # remembered strings of one generation
SHORT = 64               # longer strings are not remembered
ROWS = 256               # decoded documents of one Arrow batch that goes back
LETTERS = 1 << 20        # code points of texts that are encoded together, unless one has more

#: Code points that became letters or numbers after Unicode 16. The
#: encoder to be matched has the tables of Unicode 16; there they are neither.
LATER = """
0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959
10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3
16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6
1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4
1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""
_NEITHER = "\u0378"     # unassigned in every version so far


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from lines of base64 and a number."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class _Remembered:
    """Values by string; of the older generation only what is used again stays."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def find(self, key: str) -> bytes | None:
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.add(key, value)
        return value

    def add(self, key: str, value: bytes) -> None:
        if len(key) <= SHORT:
            if len(self.young) >= self.size and key not in self.young:
                self.old, self.young = self.young, {}
            self.young[key] = value


class Codec:
    """Encoder and decoder of one rank file. Encoded ids are packed
    little-endian signed 32-bit numbers."""

    # a blank that does not stand before a visible character
    _odd_blank = re.compile(r" (?=\s|\Z)")

    def __init__(self, ranks: dict[bytes, int], pattern: str, blanks: bool = True):
        import regex
        self.ranks, self.blanks = ranks, blanks
        top = max(ranks.values(), default=0)
        self.shift = (top.bit_length() + 1) // 2
        self.uppers = (top >> self.shift) + 1
        tokens = sorted((r, t) for t, r in ranks.items())
        self.place = np.full(top + 3, -1, dtype=np.int64)          # of an id's bytes
        self.place[[r for r, _ in tokens]] = np.arange(len(tokens))
        self.token_bytes = pa.array([t for _, t in tokens], type=pa.large_binary())
        self.pattern = regex.compile(pattern)
        spans = (x.partition("-") for x in LATER.split())
        self.later = re.compile("[" + "".join(f"{chr(int(a, 16))}-{chr(int(b or a, 16))}" for a, _, b in spans) + "]")
        self.after_blank = _Remembered(CACHE)                      # by what follows the blank
        self.piece = _Remembered(max(1, CACHE // 4))               # other pre-tokens
        # symbols are ids; a byte that is no token has a number above them while it waits for its merge
        self.top = top
        symbols = {bytes([b]): top + 1 + b for b in range(256)} | ranks
        self.border = 1 << (top + 257).bit_length()                # the symbol between pre-tokens; no pair holds it
        self.wide = self.border.bit_length()
        self.bytes = np.array([symbols[bytes([b])] for b in range(256)], dtype=np.int64)
        self.byte_pairs = np.full(1 << 16, -1, dtype=np.int64)
        self.pairs: dict[int, int] = {}                            # rank of two symbols laid end to end, if it has one
        for token, rank in ranks.items():
            if len(token) == 2:
                self.byte_pairs[token[0] << 8 | token[1]] = rank
            for at in range(1, len(token)):
                if (left := symbols.get(token[:at])) is not None and (right := symbols.get(token[at:])) is not None:
                    self.pairs[left << self.wide | right] = rank

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        return np.frombuffer(self.merge_all([data])[0], dtype="<i4").tolist()

    def merge_all(self, data: list[bytes]) -> list[bytes]:
        """Packed ids of each pre-token. Those that are no token lie end to
        end in one linked list and share the queue."""
        rank_of = self.ranks.get
        whole = [rank_of(d) for d in data]
        rest = iter(self._merged([d for d, r in zip(data, whole, strict=True) if r is None]))
        return [next(rest) if r is None else r.to_bytes(4, "little") for r in whole]

    def _merged(self, data: list[bytes]) -> list[bytes]:
        if not data:
            return []
        raw = np.frombuffer(b"\0" + b"\0".join(data) + b"\0", dtype=np.uint8).astype(np.int64)
        borders = np.concatenate([[0], np.cumsum([len(d) + 1 for d in data])])
        n, wide, shift, rank_of = len(raw), self.wide, self.shift, self.pairs.get
        low = (1 << shift) - 1
        symbols = self.bytes[raw]
        symbols[borders] = self.border
        first = np.append(self.byte_pairs[raw[:-1] << 8 | raw[1:]], -1)
        first[borders] = first[borders[1:] - 1] = -1
        symbol, pair = symbols.tolist(), first.tolist()            # pair: rank of the pair that begins here
        after, before, ends = list(range(1, n + 1)), list(range(-1, n - 1)), borders.tolist()
        # the queue: positions by rank, ranks' bits by upper half, bits of upper halves
        order = np.argsort(first, kind="stable")
        order = order[np.searchsorted(first[order], 0):]
        found, starts = np.unique(first[order], return_index=True)
        order, starts = order.tolist(), [*starts.tolist(), len(order)]
        buckets = {r: order[x:y] for r, x, y in zip(found.tolist(), starts, starts[1:], strict=False)}
        waiting_at = buckets.get
        bits = [0] * self.uppers
        uppers = 0
        for r in buckets:
            uppers |= 1 << (r >> shift)
            bits[r >> shift] |= 1 << (r & low)
        while uppers:
            upper = (uppers & -uppers).bit_length() - 1            # find first set, twice
            word = bits[upper]
            lowest = word & -word
            rank = upper << shift | lowest.bit_length() - 1
            bits[upper] = word = word ^ lowest
            if not word:
                uppers ^= 1 << upper
            bucket = buckets.pop(rank)
            if len(bucket) > 1:
                bucket.sort()
            stop, waiting, high = -1, [], rank << wide
            for i in bucket:
                if pair[i] != rank:
                    continue                                       # stale
                if i < stop:
                    waiting.append(i)
                    continue
                gone, p = after[i], before[i]
                after[i] = end = after[gone]
                before[end] = i
                symbol[i] = rank
                symbol[gone] = pair[gone] = -1
                least = rank
                r = rank_of(symbol[p] << wide | rank)
                if r is None:
                    pair[p] = -1
                else:
                    pair[p] = r
                    if r < least:
                        least = r
                    if (others := waiting_at(r)) is not None:
                        others.append(p)
                    else:
                        buckets[r] = [p]
                        uppers |= 1 << (r >> shift)
                        bits[r >> shift] |= 1 << (r & low)
                r = rank_of(high | symbol[end])
                if r is None:
                    pair[i] = -1
                else:
                    pair[i] = r
                    if r < least:
                        least = r
                    if (others := waiting_at(r)) is not None:
                        others.append(i)
                    else:
                        buckets[r] = [i]
                        uppers |= 1 << (r >> shift)
                        bits[r >> shift] |= 1 << (r & low)
                if least < rank:                                   # a smaller rank comes first in this pre-token
                    stop = ends[bisect_right(ends, i)]
            if waiting:
                buckets[rank] = waiting
                uppers |= 1 << upper
                bits[upper] |= 1 << (rank & low)
        out = np.array(symbol, dtype=np.int64)
        out[borders] = -1
        kept = out >= 0
        cuts = (4 * np.cumsum(kept)[borders]).tolist()
        ids = out[kept]
        if len(ids) and ids.max() > self.top:
            raise KeyError(bytes([int(ids.max()) - self.top - 1]))
        packed = ids.astype("<i4").tobytes()
        return [packed[x:y] for x, y in zip(cuts, cuts[1:], strict=False)]

    def _cut(self, text: str) -> list[str]:
        if text.isascii() or not self.later.search(text):
            return self.pattern.findall(text)
        known = self.later.sub(_NEITHER, text)
        return [text[m.start():m.end()] for m in self.pattern.finditer(known)]

    def _store(self, piece: str) -> tuple[_Remembered, str]:
        """Where a pre-token is remembered, and its key there."""
        return (self.after_blank, piece[1:]) if self.blanks and piece[0] == " " else (self.piece, piece)

    def _pieces(self, texts: list[str]) -> list[bytes]:
        """Packed ids of texts, cut by the pattern; what none of them has met is merged together."""
        cut = [self._cut(t) for t in texts]
        known: dict[str, bytes] = {}
        new: set[str] = set()
        for piece in chain.from_iterable(cut):
            if piece not in known and piece not in new:
                store, key = self._store(piece)
                if (value := store.find(key)) is None:
                    new.add(piece)
                else:
                    known[piece] = value
        learned = dict(zip(new, self.merge_all([s.encode() for s in new]), strict=True))
        for piece, value in learned.items():
            store, key = self._store(piece)
            store.add(key, value)
        known.update(learned)
        return [known[c[0]] if len(c) == 1 else b"".join([known[s] for s in c]) for c in cut]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        heads, tails, owners = [], [], []
        for n, text in enumerate(texts):
            head, blank, tail = (text, "", "") if not self.blanks or self._odd_blank.search(text) else text.partition(" ")
            heads.append(head)
            if blank:
                tails.append(tail)
                owners.append(n)
        cut = pc.split_pattern(pa.array(tails, type=pa.large_string()), " ")
        coded = cut.flatten().dictionary_encode()                  # each part is looked up once for all these texts
        parts = coded.dictionary.to_pylist()
        ids = [*map(self.after_blank.young.get, parts)]
        for i in [i for i, v in enumerate(ids) if v is None]:
            ids[i] = self.after_blank.find(parts[i])
        unknown = [i for i, v in enumerate(ids) if v is None]
        out = self._pieces([*heads, *(" " + parts[i] for i in unknown)])
        for i, value in zip(unknown, out[len(heads):], strict=True):
            ids[i] = value
            self.after_blank.add(parts[i], value)
        laid = pa.array(ids, type=pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(laid.buffers()[1], dtype=np.int64)[cut.offsets.to_numpy()].tolist()
        data = laid.buffers()[2]
        for n, start, end in zip(owners, ends, ends[1:], strict=False):
            out[n] += data[start:end].to_pybytes()
        return out[:len(heads)]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.decode_all(pa.array([ids], type=pa.list_(pa.int32()))).to_pylist())

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """The bytes of each list of ids; null of a null list."""
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        places = self.place[np.clip(flat, -1, len(self.place) - 2)]   # the last one stands for all others
        if (places < 0).any():
            raise KeyError(flat[places < 0][0].item())
        laid = self.token_bytes.take(pa.array(places))
        sizes = ids.value_lengths().fill_null(0).to_numpy()
        ends = np.frombuffer(laid.buffers()[1], dtype=np.int64)[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])]
        out = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends), laid.buffers()[2]])
        return pc.if_else(ids.is_valid(), out, None).cast(pa.binary())


_CODECS: dict[tuple, Codec] = {}


def _codec(path: str, pattern: str, blanks: bool) -> Codec:
    key = path, pattern, blanks
    if key not in _CODECS:
        _CODECS[key] = Codec(load_ranks(path), pattern, blanks)
    return _CODECS[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str, blanks: bool = True, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row. ``ranks_path`` must be readable on every executor."""
    from pyspark.sql.pandas.types import to_arrow_type
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, pattern, blanks)
        for batch in batches:
            at = 0
            for texts in together(batch.column("text"), LETTERS):
                data = codec.encode_all(texts)
                doc_ids, at = batch.column("doc_id").slice(at, len(texts)), at + len(texts)
                offsets = np.zeros(len(data) + 1, dtype=np.int32)
                np.cumsum([len(d) // 4 for d in data], out=offsets[1:])
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(data), dtype="<i4")))
                yield pa.RecordBatch.from_arrays([doc_ids.cast(id_type), ids], names=["doc_id", "ids"])
    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, ids, decoded) of rows with ``ids``."""
    from pyspark.sql.pandas.types import to_arrow_type
    kind = encoded.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, "", False)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(id_type), part.column("ids"),
                                                  codec.decode_all(part.column("ids"))], names=["doc_id", "ids", "decoded"])
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind.simpleString()}, ids array<int>, decoded binary")


def digest(decoded: DataFrame) -> DataFrame:
    listed: Column = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
