"""Words, shingles and their fingerprints, for whole texts as UTF-8 bytes.

Words are runs of bytes other than 0x20 and 0x09-0x0D after lower-casing A-Z. A word's
fingerprint is a polynomial over random 64-bit values of its bytes, read off one running sum,
so a text of any length costs a few array operations and no Python loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = np.random.default_rng(20240607).integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C17  # odd, 3 mod 4
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept per process and doubled as needed."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        factors = np.full(size, base, dtype=np.uint64)
        factors[0] = 1
        have = _powers[base] = np.multiply.accumulate(factors)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 bits of the result (splitmix finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def raw_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each row; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def word_bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word, and the byte after its last."""
    space = np.ones(len(raw) + 2, dtype=bool)
    space[1:-1] = _SPACE[np.frombuffer(raw, dtype=np.uint8)]
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[0::2], edges[1::2]


def word_hashes(raw: bytes) -> np.ndarray:
    """One uint64 for each word of the text, A-Z lower-cased, in order."""
    if not raw:
        return np.empty(0, dtype=np.uint64)
    raw = raw.translate(LOWER)
    return hashes_at(raw, *word_bounds(raw))


def hashes_at(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints of raw[start:end]."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    values = _VALUE[np.frombuffer(raw, dtype=np.uint8)]
    values *= _power(_BASE, len(values))
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=total[1:])
    return mix((total[ends] - total[starts]) * _power(_INVERSE, len(raw))[starts])


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Fingerprint of each run of ``size`` words; empty if there are fewer words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    weights = _power(_INVERSE, size + 1)[1:]
    if size <= 8:
        total = words[:n] * weights[0]
        for i in range(1, size):
            total = total + words[i : i + n] * weights[i]
        return mix(total)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * _power(_BASE, len(words)), out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * _power(_INVERSE, len(words))[:n])


def span_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprint of words[start:end] for each pair; equal spans of words have equal ones."""
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * _power(_BASE, len(words)), out=sums[1:])
    spread = (sums[ends] - sums[starts]) * _power(_INVERSE, len(words) + 1)[starts]
    return mix(spread + (ends - starts).astype(np.uint64))


def shingles(raw: bytes, size: int) -> np.ndarray:
    """Sorted distinct shingle fingerprints; a text of fewer words is one shingle of all of them."""
    words = word_hashes(raw)
    if not len(words):
        return words
    if len(words) < size:
        return mix(words.dot(_power(_BASE, len(words))).reshape(1) + np.uint64(len(words)))
    return np.unique(window_hashes(words, size))


def slices(batch: pa.RecordBatch, column: str | int, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each, or a single longer row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // most
    edges = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]])
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        if hi > lo:
            yield batch.slice(int(lo), int(hi - lo))


def coded(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """A row's strings as numbers: row offsets, a number for each string, and the distinct strings."""
    offsets = lists.offsets.to_numpy()
    words = lists.flatten().dictionary_encode()
    return offsets - offsets[0], words.indices.to_numpy(zero_copy_only=False), words.dictionary


def gathered(codes: np.ndarray, values: list[bytes], kind: str = "<u4") -> tuple[np.ndarray, np.ndarray]:
    """The values of all codes in a row, as one array, and where each code's part begins (and the end)."""
    width = np.dtype(kind).itemsize
    sizes = np.fromiter(map(len, values), dtype=np.int64, count=len(values)) // width
    flat = np.frombuffer(b"".join(values), dtype=kind)
    begins = np.cumsum(sizes) - sizes
    ends = np.zeros(len(codes) + 1, dtype=np.int64)
    np.cumsum(sizes[codes], out=ends[1:])
    shift = np.repeat(begins[codes] - ends[:-1], sizes[codes])
    shift += np.arange(len(shift))
    return flat[shift], ends
