"""Words of whole texts as numpy arrays: spans, hashes of words, of word prefixes and of word sequences.

A word is a run of bytes other than 0x20 and 0x09-0x0D.  A word's hash is the sum of a random value for each
byte times a random one for its place in the word, modulo 2**64 and mixed afterwards: unlike powers
of one base, independent factors leave no words that collide for every choice.  Hashes of sequences of words, of a
bounded number of them, are polynomials over the words' hashes.  Working memory is bounded by ``CHUNK``
plus the longest single word.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_PLACE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.frombuffer(b"".join(hashlib.sha256(bytes([i])).digest()[:8] for i in range(256)), "<u8")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits (one to one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1)."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


@lru_cache(maxsize=1)
def _common_places() -> np.ndarray:
    return _places(1 << 16)


def _places(n: int) -> np.ndarray:
    """A random odd factor for each place in a word."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _PLACE) | np.uint64(1)


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow string column behind each other, and where each starts (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2] if len(column) else None
    buf = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offsets - offsets[0]


def spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every word, from the byte mask ``is_word``; no word crosses documents."""
    n = len(is_word)
    before = np.zeros(n, bool)
    before[1:] = is_word[:-1]
    before[offsets[offsets < n]] = False
    start = np.flatnonzero(is_word & ~before)
    after = np.zeros(n, bool)
    after[:-1] = is_word[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    end = np.flatnonzero(is_word & ~after) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def plain_words(buf: np.ndarray) -> np.ndarray:
    """Mask of the bytes that belong to words."""
    return ~((buf == 32) | ((buf >= 9) & (buf <= 13)))


def hash_words(buf: np.ndarray, start: np.ndarray, end: np.ndarray, lengths: tuple[int, ...] = ()) -> list[np.ndarray]:
    """64-bit hash of every word; then, for each of ``lengths``, of its first so many bytes (0 where shorter)."""
    out = [np.zeros(len(start), np.uint64) for _ in range(1 + len(lengths))]
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + CHUNK, "right")))
        lo, n = int(start[i]), int(end[j - 1] - start[i])
        s, e = start[i:j] - lo, end[i:j] - lo
        place = np.arange(n) - np.repeat(s, np.diff(s, append=n))
        longest = int((e - s).max())
        factors = _common_places() if longest <= 1 << 16 else _places(longest)
        # what lies between words is in no difference of sums
        value = _BYTE[buf[lo : lo + n]] * factors[np.minimum(place, len(factors) - 1)]
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(value, out=total[1:])
        out[0][i:j] = mix((total[e] - total[s]) + (e - s).astype(np.uint64))
        for k, length in enumerate(lengths, 1):
            ok = e - s >= length
            cut = np.where(ok, s + length, s)
            out[k][i:j] = np.where(ok, mix((total[cut] - total[s]) + np.uint64(length << 40)), 0)
        i = j
    return out


def sequence_hashes(words: np.ndarray, lengths: tuple[int, ...], seed: int = 0) -> list[np.ndarray]:
    """For each length, the hash of the sequence of so many words from every position (shorter at the end)."""
    base = np.uint64(0xD1342543DE82EF95 + 2 * seed)
    n = len(words)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(words * powers(base, n), out=total[1:])
    back = powers(inverse(base), n)
    at = np.arange(n)
    return [mix((total[np.minimum(at + k, n)] - total[:n]) * back + np.uint64(k)) for k in lengths]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum over x[i : i + width] (as far as there is)."""
    out, have = x.copy(), 1
    while have < width:
        step = min(have, width - have)
        if step < len(out):
            np.minimum(out[:-step], out[step:].copy(), out=out[:-step])
        have += step
    return out


def member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values are in ``ordered`` (sorted)."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def give_back() -> None:
    """Hand freed memory back to the system: a worker lives on between tasks of different kinds."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


#: Bytes of text that are worked on at a time.
AT_ONCE = 1 << 20


def by_bytes(batch: pa.RecordBatch, column: str = "text", limit: int = AT_ONCE):
    """Slices of a batch with at most ``limit`` bytes of text, or one text."""
    ends = text_bytes(batch[column])[1][1:]
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi
