"""Word and shingle hashes of whole Arrow batches, without a Python loop over words.

Texts are taken as UTF-8 bytes. A word is a run of bytes of a class given as a table of 256
flags; its hash is a polynomial over random byte values, taken from one running sum over the
batch, so the cost per byte does not depend on how long words or texts are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19  # bytes of text worked on at once; a longer text is a chunk of its own

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = int(_rng.integers(1, 2**62)) * 2 + 1
_MULTIPLIERS = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Everything but space and tab to carriage return.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, *range(9, 14)]] = False

# Digits, letters and all that is not ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[48:58] = LETTERS[97:123] = LETTERS[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to n."""
    if len(_powers[0]) < n:
        size = 1 << max(n - 1, 1).bit_length()
        for slot, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[slot] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Words of several texts, one after the other."""

    data: np.ndarray  # lower-cased bytes
    starts: np.ndarray  # byte where each word begins
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray  # words of text i are bounds[i] : bounds[i + 1]

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of ``size`` words, at the run's first word, and whether the run
        stays within one text."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        total = np.zeros(n, np.uint64)
        for i in range(size):
            total += self.hashes[i : i + n] * _MULTIPLIERS[i]
        inside = np.ones(n + size, bool)
        for back in range(1, size):
            cut = self.bounds[1:-1] - back
            inside[cut[(cut >= 0) & (cut < n)]] = False
        return mix(total), inside[:n]

    def sequence(self, first: int, last: int) -> np.uint64:
        """Hash of the run of words from ``first`` up to ``last``, whatever its length."""
        n = last - first
        weights = mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
        return mix(np.array([(self.hashes[first:last] * weights).sum(dtype=np.uint64) + np.uint64(n)], np.uint64))[0]


def split_words(texts: pa.Array, kind: np.ndarray) -> Words:
    """``texts``: strings, a null counting as empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    data = LOWER[raw]
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return Words(data, empty, empty, np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64))
    word = kind[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    at = offsets[:-1][offsets[:-1] < n]
    first[at] = word[at]  # a text begins here, whatever stands before
    last = word.copy()
    last[:-1] &= ~word[1:]
    before = offsets[1:][offsets[1:] > 0] - 1
    last[before] = word[before]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    power, inverse = _power_tables(n + 1)
    running = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:n], out=running[1:])
    hashes = mix((running[ends] - running[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))


def chunks(batch: pa.RecordBatch, text: str = "text", size: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each, so that memory does not
    depend on how many rows Spark puts into a batch."""
    lengths = batch.column(text).cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(lengths.buffers()[1], np.int64)[lengths.offset : lengths.offset + len(lengths) + 1]
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(ends, ends[begin] + size, "right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end
