"""Words and word n-grams of Arrow text batches as arrays of 64-bit hashes.

A word is a maximal run of bytes other than the six ASCII white-space
characters (``[^\\x20\\x09-\\x0D]+``). Null texts have no words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20         # of text; the arrays of a chunk take about 40 times as much
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS = 1 << 16


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values evenly (in place where it can)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


with np.errstate(over="ignore"):
    _BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    _BYTE[_SPACE] = 0
    _POW = np.cumprod(np.full(_POWERS, 0xD6E8FEB86659FD93, np.uint64))
    _STEP = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


@dataclass
class Words:
    """Words of a run of texts, in order.

    data: bytes (lower-cased if asked); start, end: byte places of each word;
    hash: its 64-bit hash; first: for each text the number of its first word,
    with the total at the end."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The number of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, whole) of the k consecutive words from each word on; whole
        is False where the text ends before."""
        n = len(self.hash)
        h = np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(min(k, n)):
                h[:n - j] += self.hash[j:] * _STEP[j]
            h = mix(h)
        last = np.repeat(self.first[1:], self.counts())
        return h, np.arange(n) + k <= last


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, ends, data = texts.buffers()
    if len(texts) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    return raw, offsets.astype(np.int64) - int(offsets[0])


def split(texts: pa.Array, lower: bool = False) -> Words:
    data, bounds = _buffers(texts)
    if lower:
        data = _LOWER[data]
    n = len(data)
    word = np.empty(n + 2, bool)
    word[0] = word[-1] = False
    word[1:-1] = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    starts = np.flatnonzero(word[1:-1] & (~word[:-2] | edge[:-1]))
    ends = np.flatnonzero(word[1:-1] & (~word[2:] | edge[1:])) + 1
    if len(starts):
        length = np.diff(np.append(starts, n))
        place = np.arange(starts[0], n) - np.repeat(starts, length)
        place &= _POWERS - 1
        with np.errstate(over="ignore"):
            value = _BYTE[data[starts[0]:]] * _POW[place]
            h = mix(np.add.reduceat(value, starts - starts[0]) + (ends - starts).astype(np.uint64))
    else:
        h = np.zeros(0, np.uint64)
    return Words(data, starts, ends, h, np.searchsorted(starts, bounds))


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``most`` bytes; a longer text is a
    range of its own and is never cut."""
    _, bounds = _buffers(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, "right")) - 1)
        yield at, min(to, len(texts))
        at = to
