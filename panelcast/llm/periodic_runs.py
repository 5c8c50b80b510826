"""Periodic runs of words, found by minimizers of several scales.

A run is a maximal stretch of words with smallest period q that holds two
periods or more. Scale L (8, 16, 32, ...) looks for periods 2L <= q < 4L. Of
every L consecutive L-grams the one with the smallest hash is kept. What is
kept depends on 2L - 1 <= q words only, so inside a run at least one window is
seen again q words later with the same minimizer: every run leaves a pair of
equal minimizers whose distance is its period. Such pairs are seeds; each is
extended word by word, in both directions, and is a run if words q apart agree
over q words or more. Periods below 2 * ``SCALE`` are too short for any
window; they are found by comparing the words with themselves at every lag.

L-grams of period L / 2 or less (those inside runs of smaller scales) would
pair with themselves without end, so they are no minimizers: equal ones that
remain are over L / 2 words apart, at most eight in reach. A window of such
L-grams alone lies inside one run of a short period d, and its image inside
another; the period of the larger run is then fixed by the borders of the two
(equal distance of their starts or of their ends) or, where they touch, by
their phase. Those few distances are tried as well, so no run is missed.

Words are numbered exactly and extension compares the numbers: hashes choose
seeds, they decide nothing.

Defined results: a null text has no words and no runs; a null id is never
planted; repeated rows are judged one by one; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.words import mix, window_hashes

SHORTEST = 12            # words of the shortest run reported
SCALE = 8                # L-grams of the smallest scale; shorter periods by lag
BATCH = 1 << 18          # words searched at a time (a longer text is searched alone)


@lru_cache(maxsize=4096)
def _divisors(q: int) -> tuple[int, ...]:
    low = [d for d in range(1, math.isqrt(q) + 1) if q % d == 0]
    return (*low, *(q // d for d in reversed(low)))


class _Runs:
    """The runs found so far in one sequence of word numbers, by period."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.by_period: dict[int, list[tuple[int, int]]] = defaultdict(list)   # sorted (start, end)
        self.tried: dict[int, list[tuple[int, int]]] = defaultdict(list)       # stretches that agree at a lag

    def covered(self, start: int, end: int, q: int) -> bool:
        """Does a run whose period divides ``q`` hold the stretch?"""
        for d in _divisors(q):
            if own := self.by_period.get(d):
                at = bisect_right(own, (start, len(self.words) + 1)) - 1
                if at >= 0 and own[at][1] >= end:
                    return True
        return False

    def add(self, start: int, end: int, q: int) -> None:
        own = self.by_period[q]
        own.insert(bisect_right(own, (start, end)), (start, end))

    def _agree(self, x: int, q: int, step: int) -> int:
        """How many words from ``x`` on agree with those ``q`` later."""
        w, n, size = self.words, 0, 32
        limit = len(w) - q - x if step > 0 else x + 1
        while n < limit:
            size = min(size * 2, 1 << 16, limit - n)
            a = w[x + n:x + n + size] if step > 0 else w[x - n - size + 1:x - n + 1][::-1]
            b = w[x + q + n:x + q + n + size] if step > 0 else w[x + q - n - size + 1:x + q - n + 1][::-1]
            wrong = np.flatnonzero(a != b)
            if len(wrong):
                return n + int(wrong[0])
            n += size
        return n

    def extend(self, x: int, q: int) -> None:
        """The maximal stretch around ``x`` that agrees at lag ``q``."""
        tried = self.tried[q]
        at = bisect_right(tried, (x, len(self.words) + 1)) - 1
        if at >= 0 and tried[at][1] > x:
            return
        right = self._agree(x, q, 1)
        if not right:
            return
        first = x - (self._agree(x - 1, q, -1) if x else 0)
        end = x + right
        tried.insert(bisect_right(tried, (first, end)), (first, end))
        if end - first >= q and not self.covered(first, end + q, q):
            self.add(first, end + q, q)


def _lags(runs: _Runs, most: int) -> None:
    """Runs of the periods below ``most``, by comparison at each lag."""
    w = runs.words
    for q in range(1, min(most, len(w) // 2 + 1)):
        other = np.flatnonzero(w[q:] != w[:-q])
        edges = np.concatenate([[-1], other, [len(w) - q]])
        for i in np.flatnonzero(np.diff(edges) > max(q, SCALE - q)).tolist():
            start, end = int(edges[i]) + 1, int(edges[i + 1]) + q
            if not runs.covered(start, end, q):
                runs.add(start, end, q)


def _doubled(pick: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """``pick`` (minimum or maximum) of ``width`` (a power of two) consecutive values."""
    step = 1
    while step < width:
        values = pick(values[:-step], values[step:])
        step *= 2
    return values


def _root_phase(w: np.ndarray, first: tuple[int, int], second: tuple[int, int], d: int) -> int | None:
    """Distances modulo ``d`` at which two runs of period ``d`` agree."""
    root = w[second[0]:second[0] + d]
    seen = w[first[0]:first[0] + 2 * d - 1]
    for x in np.flatnonzero(seen[:d] == root[0]).tolist():
        if np.array_equal(seen[x:x + d], root):
            return (second[0] - first[0] - x) % d
    return None


def _scale(runs: _Runs, size: int, values: np.ndarray, longest: int) -> None:
    """Runs of periods ``2 * size`` to ``4 * size - 1`` (at most ``longest``)."""
    w, reach = runs.words, 4 * size
    grams = window_hashes(values, size)
    # L-grams inside a run of a period of at most half their length
    periodic = np.zeros(len(grams) + 1, dtype=np.int64)
    short = [(s, e, d) for d, own in runs.by_period.items() if 2 * d <= size for s, e in own if e - s >= size]
    for s, e, _ in short:
        periodic[s] += 1
        periodic[e - size + 1] -= 1
    barred = np.cumsum(periodic[:-1]) > 0
    grams[barred] = np.iinfo(np.uint64).max
    # a gram is kept if it is the least of one of the windows that hold it
    least = _doubled(np.minimum, grams, size)
    around = np.zeros(len(least) + 2 * size, dtype=np.uint64)
    around[size - 1:size - 1 + len(least)] = least
    at = np.flatnonzero((_doubled(np.maximum, around, size)[:len(grams)] == grams) & ~barred)
    rank = np.lexsort((at, grams[at]))
    at, key = at[rank], grams[at[rank]]
    for apart in range(1, min(8, len(at))):
        gap = at[apart:] - at[:-apart]
        good = np.flatnonzero((key[apart:] == key[:-apart]) & (gap >= 2 * size) & (gap < reach) & (gap <= longest))
        for i in good.tolist():
            runs.extend(int(at[i]), int(gap[i]))
    by_period = defaultdict(list)
    for s, e, d in short:
        if e - s >= 2 * size - 1:
            by_period[d].append((s, e))
    for d, own in by_period.items():
        own.sort()
        for i, one in enumerate(own):
            for two in own[i + 1:]:
                if two[0] > one[1] + reach:
                    break
                phase = _root_phase(w, one, two, d)
                if phase is None:
                    continue
                lags = {two[0] - one[0], two[1] - one[1]}
                if two[0] <= one[1]:
                    low = 2 * size + (phase - 2 * size) % d
                    lags.update(range(low, min(reach, two[1] - one[0]), d))
                for q in sorted(lags):
                    if 2 * size <= q < reach and q <= longest:
                        x = max(one[0], two[0] - q)
                        if x < one[1] and x + q < two[1]:
                            runs.extend(x, q)


def find_runs(words: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``SHORTEST`` words or more in
    a sequence of word numbers. ``longest``: no period can be longer."""
    words = np.asarray(words, dtype=np.int64)
    longest = min(longest or len(words), len(words) // 2)
    runs = _Runs(words)
    _lags(runs, min(2 * SCALE, longest + 1))
    size, values = SCALE, None
    while 2 * size <= longest:
        if values is None:
            values = mix((words + 1).astype(np.uint64))
        _scale(runs, size, values, longest)
        size *= 2
    return sorted((s, e - s, q) for q, own in runs.by_period.items() for s, e in own if e - s >= max(SHORTEST, 2 * q))


def planted(n: int, doc_id) -> np.ndarray | None:
    """The place in the text of each of the ``n`` words after planting, or
    None where the words stay as they are."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % (1 + (n - a) // (3 + g % 8)))


def _describe(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for s, n, q in runs:
        drop[s + q] += 1
        drop[s + n] -= 1
    inside = np.cumsum(drop[:-1]) > 0
    collapsed = b" ".join([w for w, x in zip(words, inside.tolist(), strict=True) if not x] if runs else words)
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return len(runs), s, n, q, 1000 * n // q if runs else None, listed, collapsed


def describe(docs: Iterable[tuple], plant: bool) -> Iterator[tuple]:
    """(doc_id, runs, ..., collapsed) of (doc_id, text as UTF-8 or None). Short
    documents are searched together, each pair of them parted by a word of its
    own, so no run crosses a border."""
    docs, at = list(docs), 0
    while at < len(docs):
        number: dict[bytes, int] = {}
        group, pieces, total = [], [], 0
        while at < len(docs) and (not group or total < BATCH):
            doc_id, text = docs[at]
            words = (text or b"").split()
            order = planted(len(words), doc_id) if plant else None
            if order is not None:
                words = [words[i] for i in order.tolist()]
            pieces.append(np.array([number.setdefault(w, len(number)) for w in words] + [-1 - len(group)], dtype=np.int64))
            group.append((doc_id, words))
            total += len(words) + 1
            at += 1
        starts = np.cumsum([0, *(len(p) for p in pieces)])
        joined = np.concatenate(pieces)
        joined[joined < 0] = len(number) - 1 - joined[joined < 0]       # border words, each its own
        own: list[list] = [[] for _ in group]
        for s, n, q in find_runs(joined, max(len(p) for p in pieces) // 2):
            d = bisect_right(starts, s) - 1
            own[d].append((s - int(starts[d]), n, q))
        for (doc_id, words), runs in zip(group, own, strict=True):
            yield doc_id, *_describe(words, runs)


FOUND = "doc_id {id}, n_runs long, start long, length long, period long, exponent_milli long, runs string, collapsed string"


def _task(plant: bool, id_type: pa.DataType):
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed"]
    kinds = [id_type, *[pa.int64()] * 5, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = (t.as_buffer().to_pybytes() if t.is_valid else None for t in part.column("text"))
                columns = zip(*describe(zip(part.column("doc_id").to_pylist(), texts, strict=True), plant), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=names)
    return run


def runs(docs: DataFrame, plant: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the number of runs, the longest one, all of them (``runs``:
    ``start,length,period`` lines) and the text with each run cut to its first
    period (``collapsed``). ``plant`` makes a tenth of the documents periodic
    first (see ``planted``)."""
    from pyspark.sql.pandas.types import to_arrow_type
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType
    return rows.mapInArrow(_task(plant, to_arrow_type(kind)), FOUND.format(id=kind.simpleString()))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                        F.sha2("runs", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def brute_force(words: list, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """The runs of a short sequence straight from the definition."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            e = i + q
            smallest = next(p for p in range(1, q + 1) if all(words[x] == words[x + p] for x in range(s, e - p)))
            if smallest == q and e - s >= max(shortest, 2 * q):
                found.append((s, e - s, q))
    return sorted(found)
