"""Words, lines, hashes and n-grams of many texts at once, as numpy arrays.

A batch of texts is one byte array with offsets, as Arrow keeps it. Substring hashes are
differences of a running polynomial over the bytes, so that a hash costs two look-ups
whatever the length. All arithmetic is modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql.types import DataType, StructType

PIECE_BYTES = 1 << 21  # text that one step works on; a longer document is a step of its own

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C55  # odd, 5 modulo 8
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 bits of the result (a bijection)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first ``n`` powers of the base, or of its inverse; kept for the next call."""
    name = "inverse" if inverse else "base"
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, PIECE_BYTES // 4)
        have = np.full(size, _INVERSE if inverse else _BASE, U64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 2 * PIECE_BYTES:
            _powers[name] = have
    return have[:n]


def wider(schema: StructType, *fields: tuple[str, str | DataType]) -> StructType:
    """A copy of the schema with more fields; ``add`` alone would change that of the frame."""
    out = StructType(list(schema.fields))
    for name, kind in fields:
        out = out.add(name, kind)
    return out


def byte_codes(seed: int = 1, fold_case: bool = False) -> np.ndarray:
    """A 64-bit code for every byte; with ``fold_case`` A-Z have those of a-z."""
    codes = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))
    if fold_case:
        codes[65:91] = codes[97:123]
    return codes


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, true for the bytes in the inclusive ranges."""
    flags = np.zeros(256, bool)
    for low, high in ranges:
        flags[low : high + 1] = True
    return flags


SPACES = byte_set((0x20, 0x20), (0x09, 0x0D))


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(ends):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def pieces(batch: pa.RecordBatch, column: str = "text", size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < batch.num_rows:
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(low, high - low)
        low = high


class Spans(NamedTuple):
    """Runs of bytes: their starts, ends, and the index of the first run of each text."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACES) -> Spans:
    """Maximal runs, inside a text, of bytes that are not in ``breaks``."""
    inside = ~breaks[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(opens)
    end = np.flatnonzero(closes) + 1
    return Spans(start, end, np.searchsorted(start, offsets))


def running(values: np.ndarray) -> np.ndarray:
    """Running polynomial over 64-bit codes, with a leading 0."""
    out = np.empty(len(values) + 1, U64)
    out[0] = 0
    np.multiply(values, powers(len(values)), out=out[1:])
    np.cumsum(out[1:], out=out[1:])
    return out


def between(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the stretches [start, end) from a running polynomial."""
    raw = (total[end] - total[start]) * powers(len(total), inverse=True)[start]
    return mix(raw + (end - start).astype(U64) * U64(0xA24BAED4963EE407))


def grams(codes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all ``n`` consecutive codes, over the borders of texts too."""
    if len(codes) < n:
        return np.zeros(0, U64)
    total = running(codes)
    raw = (total[n:] - total[:-n]) * powers(len(codes) - n + 1, inverse=True)
    return mix(raw + U64(n))


def gram_starts(first: np.ndarray, n: int) -> np.ndarray:
    """Positions at which ``n`` consecutive items stay inside their text."""
    counts = np.diff(first)
    valid = np.ones(int(first[-1]), bool)
    for back in range(1, n):
        ends = first[1:][counts >= back] - back
        valid[ends] = False
    return np.flatnonzero(valid)


def per_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between consecutive positions of ``first``."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def covered(starts: np.ndarray, width: np.ndarray | int, n: int) -> np.ndarray:
    """Flags of the ``n`` positions that lie in [start, start + width) of any start."""
    step = np.bincount(starts, minlength=n + 1) - np.bincount(starts + width, minlength=n + 1)
    return np.cumsum(step[:-1]) > 0
