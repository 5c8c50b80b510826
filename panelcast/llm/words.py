"""Words, word hashes and window hashes of many texts at once (NumPy, inside
tasks).

Texts are handled as UTF-8 bytes. Every word class used here splits at ASCII
bytes only, so cutting bytes never cuts a character. Hashes are 64-bit
Rabin-Karp polynomials modulo 2**64 with odd multipliers, followed by a
finaliser; they are the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BYTE = 0x9E3779B97F4A7C15          # multiplier over the bytes of a word
_WORD = 0xD1342543DE82EF95          # multiplier over the words of a window
SLICE = 1 << 19                     # bytes hashed at a time


def _table(member) -> np.ndarray:
    return np.array([member(b) for b in range(256)], dtype=bool)


#: ``[^\x20\x09-\x0D]+``: everything but ASCII white space.
VISIBLE = _table(lambda b: b != 0x20 and not 9 <= b <= 13)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing: letters, digits, non-ASCII.
ALNUM = _table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i < n (kept per process)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(base, -1, 1 << 64)

        def run(b):
            p = np.full(size, b, dtype=U)
            p[0] = 1
            return np.multiply.accumulate(p)
        have = _POWERS[base] = run(base), run(inverse)
    return have[0][:n], have[1][:n]


def _prefix(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(base, len(values) + 1)
    total = np.empty(len(values) + 1, dtype=U)
    total[0] = 0
    np.cumsum(values * up[:-1], out=total[1:])
    return total, down


def spans(data: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each maximal run of bytes of the class ``member``."""
    inside = np.empty(len(data) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = member[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _slices(data: bytes, member: np.ndarray, size: int) -> Iterator[bytes]:
    """``data`` in parts of about ``size`` bytes, cut between words."""
    at = 0
    while len(data) - at > size:
        cut = at + size
        while cut < len(data) and member[data[cut]]:
            cut += 1
        yield data[at:cut]
        at = cut
    yield data[at:]


def _hash_run(data: bytes, member, lower: bool):
    raw = np.frombuffer(data, dtype=np.uint8)
    if lower:
        raw = LOWER[raw]
    first, end = spans(raw, member)
    total, down = _prefix(raw.astype(U) + U(1), _BYTE)
    return mix((total[end] - total[first]) * down[first] + (end - first).astype(U)), first


def word_hashes(texts: Iterable[bytes], member: np.ndarray = VISIBLE,
                lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text, in order, and the words per text.

    Texts are joined (a blank between them) and hashed about ``SLICE`` bytes
    at a time, so working memory does not grow with the longest text.
    """
    texts = list(texts)
    hashes: list[np.ndarray] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    i = 0
    while i < len(texts):
        if len(texts[i]) > SLICE:
            for part in _slices(texts[i], member, SLICE):
                h, _ = _hash_run(part, member, lower)
                hashes.append(h)
                counts[i] += len(h)
            i += 1
            continue
        j, size = i, 0
        while j < len(texts) and size + len(texts[j]) <= SLICE:
            size += len(texts[j]) + 1
            j += 1
        starts = np.zeros(j - i + 1, dtype=np.int64)
        np.cumsum([len(t) + 1 for t in texts[i:j]], out=starts[1:])
        h, first = _hash_run(b" ".join(texts[i:j]), member, lower)
        hashes.append(h)
        counts[i:j] = np.diff(np.searchsorted(first, starts))
        i = j
    return (np.concatenate(hashes) if hashes else np.empty(0, dtype=U)), counts


def window_hashes(words: np.ndarray, width: int, chunk: int = 1 << 18) -> np.ndarray:
    """Rabin-Karp hash of every ``width`` consecutive words (rolling: each
    window is a difference of two prefix sums, whatever its width)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, dtype=U)
    out = np.empty(n, dtype=U)
    for at in range(0, n, chunk):
        part = words[at:min(n, at + chunk) + width - 1]
        total, down = _prefix(part, _WORD)
        m = len(part) - width + 1
        out[at:at + m] = mix((total[width:] - total[:m]) * down[:m] + U(width))
    return out


def doc_windows(words: np.ndarray, counts: np.ndarray, width: int,
                short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Window hashes of many documents laid end to end.

    Returns (hash, document ordinal) per window, in text order; no window
    crosses a document border. With ``short``, a document of 1 to
    ``width - 1`` words is one window of all its words.
    """
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(counts)), counts)
    n = len(words) - width + 1
    if n > 0:
        inside = np.arange(n) + width <= ends[owner[:n]]
        hashes, docs = window_hashes(words, width)[inside], owner[:n][inside]
    else:
        hashes, docs = np.empty(0, dtype=U), np.empty(0, dtype=np.int64)
    if short:
        few = np.flatnonzero((counts > 0) & (counts < width))
        if len(few):
            extra = np.array([window_hashes(words[ends[d] - counts[d]:ends[d]], int(counts[d]))[0]
                              for d in few], dtype=U)
            hashes, docs = np.concatenate([hashes, extra]), np.concatenate([docs, few])
            order = np.argsort(docs, kind="stable")
            hashes, docs = hashes[order], docs[order]
    return hashes, docs


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask of the ``n`` positions inside a window that begins at ``starts``."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + width, n), -1)
    return np.cumsum(edge[:-1]) > 0


def together(column: pa.Array, letters: int) -> Iterator[list[str]]:
    """Texts (null: empty) in order, in lists of at most so many code points or of one text."""
    texts, size = [], 0
    for value in column:
        text = value.as_py() or ""
        if texts and size + len(text) > letters:
            yield texts
            texts, size = [], 0
        texts.append(text)
        size += len(text)
    if texts:
        yield texts
