"""Vectorised words and hashes over Arrow string columns.

A whole Arrow batch is one byte buffer, so word boundaries and 64-bit word
hashes come from a few numpy passes over it, without a Python loop over rows or
words.  A word's hash is a polynomial over its bytes modulo 2^64 (random byte
values, odd base, so a word's sum can be shifted back to position 0), mixed at
the end together with its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from loomstar.llm.shared import ship

ship(__name__)

PIECE = 1 << 20                       # bytes handled at a time: keeps the temporaries in cache
PIECE_TEXT = 4 << 20                  # bytes of text in the rows that are worked on at once
BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two multiply-xorshift rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2^64, kept for the next piece."""
    if len(_POWERS.get(base, ())) < n:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        _POWERS[base] = np.cumprod(out, dtype=np.uint64)
    return _POWERS[base][:n]


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def byte_class(pattern_bytes) -> np.ndarray:
    """A look-up table: which byte values belong to words."""
    is_word = np.zeros(256, dtype=bool)
    is_word[list(pattern_bytes)] = True
    return is_word


#: ``[^\x20\x09-\x0D]+``: everything but white space.
NOT_SPACE = byte_class(set(range(256)) - {0x20, *range(0x09, 0x0E)})
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z: digits, letters, all beyond ASCII.
ALNUM = byte_class({*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 256)})


def lower_values() -> np.ndarray:
    values = BYTE_VALUES.copy()
    values[0x41:0x5B] = BYTE_VALUES[0x61:0x7B]
    return values


class Words:
    """Words of a batch: ``hash``, byte ``start`` and ``end``, and ``first``: the first word of each row."""

    def __init__(self, buf, offsets, hash_, start, end, first):
        self.buf, self.offsets, self.hash = buf, offsets, hash_
        self.start, self.end, self.first = start, end, first

    def text(self, word: int) -> str:
        return self.buf[self.start[word]:self.end[word]].tobytes().decode("utf-8", "replace")


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets; NULL rows are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    if data is None or not len(col):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    buf = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]]
    return buf, offsets - offsets[0]


def pieces(batches, *texts: int, most: int = PIECE_TEXT):
    """The rows of ``batches``, as many at a time as have ``most`` bytes in the columns ``texts``, one at least.

    Word arrays take some ten times the text's bytes, so what a worker holds depends on neither the rows of an
    Arrow batch nor the length of their texts.
    """
    for batch in batches:
        ends = sum(np.cumsum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
                   for c in texts)
        lo = 0
        while lo < batch.num_rows:
            before = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def words(col: pa.Array, is_word: np.ndarray, lower: bool = True) -> Words:
    """All words of a string column, by whole texts."""
    buf, offsets = column_bytes(col)
    values = lower_values() if lower else BYTE_VALUES
    breaks = np.zeros(len(buf) + 1, dtype=bool)
    breaks[offsets[:-1]] = True
    hashes, starts, ends = [], [], []
    at, n = 0, len(buf)
    while at < n:
        stop = min(at + PIECE, n)
        while stop < n and is_word[buf[stop]] and is_word[buf[stop - 1]] and not breaks[stop]:
            # cut between words: look ahead a little at a time, a word may be very long
            ahead = buf[stop:stop + 4096]
            gap = np.flatnonzero(~is_word[ahead] | breaks[stop:stop + len(ahead)])
            stop += int(gap[0]) if len(gap) else len(ahead)
        piece = buf[at:stop]
        w = is_word[piece]
        cut = breaks[at:stop]
        before = np.empty_like(w)
        before[0] = False
        before[1:] = w[:-1]
        begin = np.flatnonzero(w & (~before | cut))
        finish = np.flatnonzero(before & (~w | cut))
        if len(w) and w[-1]:
            finish = np.append(finish, len(w))
        if len(begin):
            power = powers(BASE, len(piece))
            sums = np.zeros(len(piece) + 1, dtype=np.uint64)
            np.cumsum(values[piece] * power, out=sums[1:])
            inverse = powers(pow(BASE, -1, 1 << 64), len(piece))
            raw = (sums[finish] - sums[begin]) * inverse[begin]
            hashes.append(mix(raw + (finish - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
            starts.append(begin + at)
            ends.append(finish + at)
        at = stop
    if hashes:
        hash_, start, end = np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends)
    else:
        hash_, start, end = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return Words(buf, offsets, hash_, start, end, np.searchsorted(start, offsets))


def shingles(hash_: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all runs of ``q`` words; entry ``i`` starts at word ``i``."""
    q = int(q)
    n = len(hash_) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, (q * BASE) % (1 << 64), dtype=np.uint64)
    for i in range(q):
        out *= np.uint64(0xA0761D6478BD642F)
        out += mix(hash_[i:i + n] + np.uint64(i))
    return mix(out)


def doc_shingles(hash_: np.ndarray, q: int) -> np.ndarray:
    """Distinct shingles of one text (sorted); shorter texts are one shingle, empty ones have none."""
    if not len(hash_):
        return np.zeros(0, np.uint64)
    return np.unique(shingles(hash_, min(q, len(hash_))))
