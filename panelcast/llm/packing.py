"""Hierarchical multi-length packing of tokenised documents.

Context sizes come in tiers (2048, 1024, 512, 256). A document's whole windows
of the largest tier are sequences at once; its rest is routed to the smallest
tier that holds it. Each tier is packed in its own windows: the gap that a
piece leaves is filled with the largest whole pieces of shorter tiers that
fit, and the last few tokens with a cut from the next larger one, so windows
come out exactly full. Only the very end of a task can leave one sequence that
needs padding. Full sequences of a tier are dealt into step groups of
``STEP`` tokens each, so the training steps of every tier are equally large.

Documents are tokenised and packed in the task that reads them, in pools of
``POOL`` pieces: nothing is shuffled, memory is bounded by the pool, and a
task that runs again makes the same sequences (ids contain its partition).

Defined results: a null or empty text is the single end id; repeated rows are
packed one by one; other columns are ignored; no rows, no sequences.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.words import together

TIERS = (2048, 1024, 512, 256)
STEP = 32_768            # tokens of one step group
POOL = 4_096             # pieces that wait for a window before a round of packing
END_ID = 1
CACHE = 500_000          # distinct words of one generation (two are kept) whose ids a Python worker remembers
MARKS = "!#$%&*),.:;?"    # fixed value: visible characters that are neither letters, digits nor apostrophes
LETTERS = 1 << 23        # code points of texts that are encoded together, unless one has more

SCHEMA = ("doc_id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, "
          "offset long, sequence_tokens long, step_group long")


class WordTokenizer:
    """Ids of whole texts through a byte-level BPE of the ``tokenizers``
    library, with each distinct word encoded once.

    Byte-level BPE starts a new piece at every blank or line end that a
    visible character follows, so a text is the concatenation of its words,
    each with the blank or line end before it. A word whose end is a mark
    after a letter is remembered without the mark, which is a piece of its
    own. Unknown words are encoded laid end to end; the bytes of each id tell
    where one ends. Texts with other white space, or white space in a row or at the end (but for one empty line, or a last line
    end), or with the string of an added token, are encoded as they are, and
    so is every text if the file's tokenizer does not cut in this way.
    """

    _other = re.compile(r"[^\S \n]")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        about = json.loads(self.tokenizer.to_str())
        cut = about["pre_tokenizer"] or {}
        self.by_word = (about["normalizer"] is None and about["model"]["type"] == "BPE" and cut.get("type") == "ByteLevel"
                        and not cut["add_prefix_space"] and cut.get("use_regex", True))
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = [a for a in added if a]
        vocabulary = self.tokenizer.get_vocab()          # one character of a token is one byte
        self.n_bytes = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        self.n_bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}                  # words of the generation before
        if self.by_word:
            self.line_end = self._whole(["\n"])[0]
            self.marks = dict(zip(MARKS, self._whole(list(MARKS)), strict=True))

    def _regular(self, text: str) -> bool:
        return not ("  " in text or " \n" in text or "\n " in text or "\n\n\n" in text
                    or text.endswith((" ", "\n\n")) or self._other.search(text) or any(a in text for a in self.added))

    def _encoded(self, words: list[str]) -> list[bytes]:
        """Ids of words (with the white space before them), laid end to end."""
        if not words:
            return []
        data = b"".join(self._whole(["".join(words[at:at + 64]) for at in range(0, len(words), 64)]))
        ends = np.cumsum(self.n_bytes[np.frombuffer(data, dtype="<u4")])
        sizes = [len(w) if w.isascii() else len(w.encode()) for w in words]
        cuts = (4 * (np.searchsorted(ends, np.cumsum(sizes)) + 1)).tolist()
        return [data[x:y] for x, y in zip([0, *cuts], cuts, strict=False)]

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words. A key has no blank before it; a line end counts as part of it."""
        if len(self.words) > CACHE:
            self.old, self.words = self.words, {}
        known, marks, young, old = {}, self.marks, self.words, self.old
        ids = [*map(young.get, words)]
        missing = [i for i, v in enumerate(ids) if v is None]
        new = []
        for i in missing:
            word = words[i]
            if word[-1] in marks and "a" <= word[-2:-1] <= "z":    # such a mark is a piece of its own
                word = word[:-1]
            if word not in young and word not in known:
                if (value := old.get(word)) is None:
                    new.append(word)
                known[word] = value
        known.update(zip(new, self._encoded([w if w[:1] == "\n" else " " + w for w in new]), strict=True))
        young.update(known)
        for i in missing:
            word = words[i]
            ids[i] = young[word] if word in young else young[word[:-1]] + marks[word[-1]]
        return ids

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        regular = [i for i, t in enumerate(texts) if self._regular(t)] if self.by_word else []
        out: list[bytes] = [b""] * len(texts)
        if regular:
            # as if a line end came first, whose id is then cut off
            skip = len(self.line_end)
            cut = pc.split_pattern(pa.array([("\n" + texts[i]).replace("\n", " \n")[1:] for i in regular], type=pa.large_string()), " ")
            coded = cut.flatten().dictionary_encode()    # each word is looked up once for all these texts
            laid = pa.array(self._ids(coded.dictionary.to_pylist()), type=pa.large_binary()).take(coded.indices)
            ends = np.frombuffer(laid.buffers()[1], dtype=np.int64)[cut.offsets.to_numpy()].tolist()
            data = laid.buffers()[2]
            for i, start, end in zip(regular, ends, ends[1:], strict=False):
                out[i] = data[start + skip:end].to_pybytes()
        rest = sorted(set(range(len(texts))) - set(regular))
        for i, data in zip(rest, self._whole([texts[i] for i in rest]), strict=True):
            out[i] = data
        return out


class Packer:
    """Packs the pieces of one task. A piece is (length, serial, document,
    start); a document (doc_id, ids, number of ids). ``emit(pieces)`` gets
    every finished sequence."""

    def __init__(self, emit: Callable[[list[tuple]], None], tiers: tuple[int, ...] = TIERS, pool: int = POOL):
        self.emit, self.tiers, self.pool = emit, tiers, pool
        self.waiting: list[tuple] = []      # sorted by length
        self.serial = 0

    def _piece(self, doc, start: int, length: int) -> tuple:
        self.serial += 1
        return length, self.serial, doc, start

    def add(self, doc: tuple) -> None:
        top, total = self.tiers[0], doc[2]
        whole = total - total % top
        for start in range(0, whole, top):
            self.emit([self._piece(doc, start, top)])
        if total > whole:
            insort(self.waiting, self._piece(doc, whole, total - whole))
        if len(self.waiting) >= self.pool:
            self.pack()

    def _cut(self, piece: tuple, length: int) -> tuple[tuple, tuple]:
        return self._piece(piece[2], piece[3], length), self._piece(piece[2], piece[3] + length, piece[0] - length)

    def _fill(self, window: list[tuple], gap: int) -> bool:
        """Close the gap from shorter pieces; False (and nothing taken) when
        they do not suffice."""
        taken = []
        while gap:
            at = bisect_right(self.waiting, (gap, float("inf")))
            if at:
                piece = self.waiting.pop(at - 1)         # largest that fits whole
            elif self.waiting:
                piece, rest = self._cut(self.waiting.pop(0), gap)
                insort(self.waiting, rest)
            else:
                for p in taken:
                    insort(self.waiting, p)
                return False
            taken.append(piece)
            gap -= piece[0]
        window.extend(taken)
        return True

    def pack(self) -> None:
        """One window after another, longest tier first. Pieces for which the
        shorter ones no longer suffice wait for the next round."""
        late = []
        for tier, shorter in zip(self.tiers, (*self.tiers[1:], 0), strict=True):
            while self.waiting and self.waiting[-1][0] > shorter:
                longest = self.waiting.pop()
                # gaps are filled from shorter tiers; the shortest tier fills its own
                edge = bisect_left(self.waiting, (shorter + 1,)) if shorter else len(self.waiting)
                own, self.waiting = self.waiting[edge:], self.waiting[:edge]
                window = [longest]
                done = self._fill(window, tier - longest[0])
                self.waiting += own
                if not done:
                    late += own if shorter else []
                    if shorter:
                        del self.waiting[len(self.waiting) - len(own):]
                    late.append(longest)
                    break
                self.emit(window)
        for piece in late:
            insort(self.waiting, piece)
        if len(self.waiting) >= self.pool:       # only long pieces are left
            self.flush(final=False)

    def flush(self, final: bool = True) -> None:
        """What waits, laid end to end in the largest windows; the last one
        is closed in the way that pads least."""
        if final and self.waiting:
            self.pack()
        top, window, have = self.tiers[0], [], 0
        for piece in reversed(self.waiting):
            while piece and have + piece[0] >= top:
                first, rest = (piece, None) if have + piece[0] == top else self._cut(piece, top - have)
                self.emit([*window, first])
                window, have, piece = [], 0, rest
            if piece:
                window.append(piece)
                have += piece[0]
        self.waiting = []
        if not final:
            self.waiting = sorted(window)
        elif window:
            exact = have
            for tier in self.tiers[1:]:
                exact -= tier * (exact >= tier)
            if exact == 0:                       # whole shorter windows, no padding
                for tier in self.tiers[1:]:
                    if have >= tier:
                        have -= tier
                        part, left = [], tier
                        while left:
                            piece = window.pop(0)
                            if piece[0] > left:
                                piece, rest = self._cut(piece, left)
                                window.insert(0, rest)
                            part.append(piece)
                            left -= piece[0]
                        self.emit(part)
            else:
                self.emit(window)


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _run(path: str, end_id: int, tiers: tuple[int, ...], step: int, pool: int, id_type: pa.DataType):
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "step_group"]
    kinds = [id_type, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() << 33
        if path not in _TOKENIZERS:
            _TOKENIZERS[path] = WordTokenizer(path)
        tokenizer, rows = _TOKENIZERS[path], [[] for _ in names]
        made: dict[int, int] = {}                # full sequences by size
        groups: dict[int, int] = {}
        count = n_groups = 0
        end = np.array([end_id], dtype="<u4").tobytes()

        def emit(window: list[tuple]) -> None:
            nonlocal count, n_groups
            size = sum(p[0] for p in window)
            if size in tiers:
                k = made.get(size, 0)
                made[size] = k + 1
                if k % max(1, step // size) == 0:
                    groups[size] = n_groups
                    n_groups += 1
                group = groups[size]
            else:
                group, n_groups = n_groups, n_groups + 1
            offset = 0
            for length, _, (doc_id, ids, total), start in window:
                for column, v in zip(rows, (doc_id, start, length, ids[4 * start:4 * (start + length)], total, base + count,
                                            offset, size, base + group), strict=True):
                    column.append(v)
                offset += length
            count += 1

        def batch_out() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(rows, kinds, strict=True)], names=names)
            for c in rows:
                c.clear()
            return out

        packer = Packer(emit, tiers, pool)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            at = 0
            for some in together(texts, LETTERS):
                own, at = ids[at:at + len(some)], at + len(some)
                for doc_id, data in zip(own, tokenizer.encode(some), strict=True):
                    packer.add((doc_id, data + end, len(data) // 4 + 1))
                if len(rows[0]) >= 2048:
                    yield batch_out()
        packer.flush()
        yield batch_out()

    return run


def pack(docs: DataFrame, tokenizer_path: str, tiers: tuple[int, ...] = TIERS, end_id: int = END_ID, step: int = STEP,
         pool: int = POOL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: the document's ids ``[start, start + length)``
    (packed uint32), the sequence and the place there, and its step group.

    ``tiers``: context sizes, descending powers of two, each half the one
    before. Sequences whose ``sequence_tokens`` is no tier are padded to the
    largest tier. ``tokenizer_path`` must be readable on every executor."""
    from pyspark.sql.pandas.types import to_arrow_type
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    run = _run(tokenizer_path, end_id, tiers, step, pool, to_arrow_type(rows.schema["doc_id"].dataType))
    return rows.mapInArrow(run, SCHEMA.format(id=dict(rows.dtypes)["doc_id"]))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "sequence_tokens", "step_group")
