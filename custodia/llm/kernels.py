"""Vectorized helpers on whole batches of texts: flat buffers, words, hashes, pre-tokens.

Everything here sees a bounded slice of rows (see ``slices``) and works on flat
numpy arrays: one value per byte, code point or word, plus row offsets.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex

SLICE_BYTES = 2 << 20
STRETCH = 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes at most; a longer text comes alone, whole.

    When a task has had its last slice, its memory is given back.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(lengths(batch.column(column)))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    release()


def offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    raw = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1]
    return raw.astype(np.int64)


def lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each value; a null counts as empty."""
    if not len(column):
        return np.zeros(0, np.int64)
    out = np.diff(offsets(column))
    if column.null_count:
        out[column.is_null().to_numpy(zero_copy_only=False)] = 0
    return out


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values behind one another and the n + 1 offsets; a null is empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = offsets(column)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def release() -> None:
    """Give memory back that a task no longer needs: Python workers live on between tasks."""
    _Powers.up = _Powers.down = np.ones(1, np.uint64)
    _letters_of_hash.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=1)
def _letters_of_hash() -> np.ndarray:
    return mix(np.arange(1, 0x110001, dtype=np.uint64) * _ODD)


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << max(16, int(n - 1).bit_length())
            inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
            up, down = np.full(size, _ODD), np.full(size, inverse)
            up[0] = down[0] = 1
            cls.up, cls.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return cls.up, cls.down


def span_hashes(symbols: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``symbols``; equal spans give equal hashes wherever they stand.

    Ascending spans of many symbols are done stretch by stretch, in bounded memory.
    """
    if len(symbols) > 2 * STRETCH and len(start) > 1 and (start[1:] >= start[:-1]).all():
        cuts = np.unique(np.append(np.searchsorted(start, np.arange(0, len(symbols), STRETCH)), len(start)))
        parts = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            low, high = start[a], max(int(stop[a:b].max()), int(start[a]))
            parts.append(_span_hashes(symbols[low:high], start[a:b] - low, stop[a:b] - low))
        return np.concatenate(parts)
    return _span_hashes(symbols, start, stop)


def _span_hashes(symbols: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    up, down = _Powers.of(len(symbols) + 1)
    total = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(_letters_of_hash()[symbols] * up[: len(symbols)], out=total[1:])
    return mix((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64) * _MIX2)


def _word_bytes() -> np.ndarray:
    out = np.ones(256, bool)
    out[[0x20, *range(0x09, 0x0E)]] = False
    return out


WORD_BYTE = _word_bytes()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and stops of the words ``[^\\x20\\x09-\\x0D]+`` of all rows, and the first word of each row (n + 1)."""
    inside = WORD_BYTE[raw]
    before = np.empty(len(raw), bool)
    before[1:] = inside[:-1]
    breaks = at[:-1][at[:-1] < len(raw)]
    if len(raw):
        before[0] = False
        before[breaks] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty(len(raw), bool)
    after[:-1] = inside[1:]
    if len(raw):
        after[-1] = False
        inner = at[1:-1]
        after[inner[(inner > 0) & (inner <= len(raw))] - 1] = False
    stop = np.flatnonzero(inside & ~after) + 1
    return start, stop, np.searchsorted(start, at)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each A-Z lower-cased word of all rows, and the first word of each row (n + 1)."""
    raw, at = flat(column)
    raw = LOWER[raw]
    start, stop, first = words(raw, at)
    return span_hashes(raw, start, stop), first


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of each item, from the offsets of rows."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Indices start[i] .. start[i] + count[i] - 1 behind one another."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(start - (ends - count), count) + np.arange(total)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts behind one another and the n + 1 offsets."""
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=at[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), at


LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3


@functools.lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each code point, from the regular expressions of the pattern."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            a, b = ord(every[m.start()]), ord(every[m.end() - 1])
            out[a : b + 1] = kind
    out[0xD800:0xE000] = OTHER
    return out


# Fixed values of the public pattern: the endings that stand alone after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def pretokens(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Starts of the matches of the public byte-level pattern in all texts; each match reaches to the next start.

    Runs of one class (letter, number, white space, other) are the matches, with
    three rules: a space joins the run behind it; of white space before a visible
    character the last one stands alone (or joins, if it is a space); an
    apostrophe right after a match takes one of ENDINGS with it.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[points]
    first = np.zeros(n + 1, bool)
    first[at] = True
    head = first[:n].copy()
    head[1:] |= kind[1:] != kind[:-1]
    white = kind == SPACE
    # the last white space before a visible character of the same text
    last = np.zeros(n, bool)
    last[:-1] = white[:-1] & ~white[1:] & ~first[1:n]
    start = head | last
    joins = last & (points == 32)
    follow = np.flatnonzero(joins) + 1
    start[follow] = False
    mark = np.flatnonzero((points == 39) & start)
    if len(mark):
        padded = np.concatenate([points, np.zeros(2, np.uint32)])
        bound = np.concatenate([first[:n], [True, True, True]])
        for ending in ENDINGS:
            ok = np.ones(len(mark), bool)
            for k, c in enumerate(ending, 1):
                ok &= (padded[np.minimum(mark + k, n + 1)] == ord(c)) & ~bound[np.minimum(mark + k, n)]
            hit = mark[ok]
            start[hit + 1] = False
            stop = hit + 1 + len(ending)
            stop = stop[stop < n]
            start[stop[(kind[stop] == LETTER)]] = True
            mark = mark[~ok]
    return np.flatnonzero(start)


class PieceIds:
    """Ids of pre-tokens, remembered by hash up to ``limit`` pieces; ``learn`` encodes the pieces not yet known."""

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int, kind: type):
        self.learn, self.limit, self.kind = learn, limit, kind
        self._forget()

    def _forget(self) -> None:
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.start = self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.kind)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.place[at], -1)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts behind one another, and the n + 1 offsets."""
        points, at = code_points(texts)
        begin = pretokens(points, at)
        if not len(begin):
            return np.zeros(0, self.kind), np.zeros(len(at), np.int64)
        stop = np.append(begin[1:], len(points))
        keys, seen, which = np.unique(span_hashes(points, begin, stop), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.limit:
            self._forget()
        place = self._find(keys)
        new = np.flatnonzero(place < 0)
        if len(new):
            whole, first = "".join(texts), seen[new]
            ids, count = self.learn([whole[a:b] for a, b in zip(begin[first].tolist(), stop[first].tolist(), strict=True)])
            place[new] = len(self.count) + np.arange(len(new))
            self.start = np.append(self.start, len(self.ids) + np.cumsum(count) - count)
            self.count = np.append(self.count, count)
            self.ids = np.append(self.ids, ids).astype(self.kind, copy=False)
            both = np.concatenate([self.keys, keys[new]])
            order = np.argsort(both, kind="stable")
            self.keys, self.place = both[order], np.concatenate([self.place, place[new]])[order]
        place = place[which]
        count = self.count[place]
        return self.ids[ragged(self.start[place], count)], np.append(0, np.cumsum(count))[np.searchsorted(begin, at)]
