"""Word hashes of whole texts with numpy, over the UTF-8 bytes of a batch.

A word is a maximal run of bytes other than blank and 0x09-0x0D. All of these
separators are single ASCII bytes, so working on UTF-8 bytes gives the words
``[^\\x20\\x09-\\x0D]+`` of the text.
"""

from __future__ import annotations

import numpy as np
import xxhash

from paylake.llm.common import mix, ranges

#: Longest word that is hashed in lanes of eight bytes; longer ones are hashed by xxh3.
LONG = 64

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LANE = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def spans(raw: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SEPARATOR
          ) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; no word crosses a document's end.
    ``separator`` tells of each byte value whether it stands between words."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~separator[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, of its bytes and length alone. Words of up to
    LONG bytes go eight bytes at a time through a mixing bijection (two words of
    equal length up to eight never meet), longer ones through xxh3."""
    size = ends - starts
    out = mix(size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    padded = np.concatenate((raw, np.zeros(8, np.uint8)))
    lanes = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))
    row = np.flatnonzero(size <= LONG)
    at, left, h = starts[row], size[row], out[row]
    while len(row):
        h = mix(h ^ (lanes[at] & _LANE[np.minimum(left, 8)])) + np.uint64(0xD6E8FEB86659FD93)
        out[row] = h
        more = np.flatnonzero(left > 8)
        row, at, left, h = row[more], at[more] + 8, left[more] - 8, h[more]
    data = memoryview(np.ascontiguousarray(raw))
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]])
    return out


def equal(raw: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether ``size`` bytes from ``a`` on are those from ``b`` on, span by span."""
    same = np.ones(len(a), bool)
    full = np.flatnonzero((size > 0) & (a != b))
    for i, j in _runs(size[full]):
        part = full[i:j]
        differ = raw[ranges(a[part], size[part])] != raw[ranges(b[part], size[part])]
        begin = np.concatenate(([0], np.cumsum(size[part])[:-1]))
        same[part] = ~np.logical_or.reduceat(differ, begin)
    return same


def _runs(size: np.ndarray, most: int = 1 << 20):
    """Runs of spans of about ``most`` bytes together (one span at least)."""
    total, i = np.cumsum(size), 0
    while i < len(size):
        j = int(np.searchsorted(total, (total[i - 1] if i else 0) + most, "right"))
        j = max(j, i + 1)
        yield i, j
        i = j


def batch_words(raw: np.ndarray, offsets: np.ndarray):
    """Word starts, ends, hashes, and the index of each document's first word
    (one entry more than documents)."""
    starts, ends = spans(raw, offsets)
    return starts, ends, hashes(raw, starts, ends), np.searchsorted(starts, offsets)


def windows(h: np.ndarray, size: int, base: np.uint64 = np.uint64(0x9E3779B97F4A7C15)
            ) -> np.ndarray:
    """Hash of every ``size`` consecutive entries of ``h``."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, size):
        out *= base
        out += h[i:i + n]
    return mix(out)
