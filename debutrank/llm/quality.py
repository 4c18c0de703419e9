"""Quality rules: compression bands (zstandard ratios) beside a few counted rules."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from debutrank.llm import kernels as K


class Band(NamedTuple):
    """Texts of ``from_bytes`` bytes on may compress to between ``low`` and ``high`` of their size."""

    from_bytes: int
    low: float
    high: float


# Short texts repeat little and carry the frame's overhead; long ones of any language
# find more to share. The upper limits lie between the highest ratio of clean texts of that length
# (0.80 from 256 bytes on, 0.70 from 512, 0.61 from 1 KB, 0.56 from 2 KB, 0.52 from 4 KB in the test
# tables) and that of what has no structure: base64 0.75-0.83, mixed letters 0.72-0.79, CJK 0.72-0.83,
# Latin-1 and printable bytes more. Hex digits (0.50) and lower-case letters (0.60) are as dense as prose.
BANDS = (
    Band(0, 0.30, 2.00),
    Band(128, 0.35, 1.10),
    Band(256, 0.35, 0.90),
    Band(512, 0.30, 0.80),
    Band(1024, 0.30, 0.74),
    Band(2048, 0.22, 0.70),
    Band(4096, 0.22, 0.68),
    Band(16384, 0.17, 0.67),
)
CHUNK_BYTES = 4096
CHUNK_BAND = Band(CHUNK_BYTES, 0.20, 0.68)
CHUNK_SHARE = 0.25  # a text is rejected if more than this share of its chunks lies outside

MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30

_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_CHARS = (np.arange(256) & 0xC0) != 0x80  # first bytes of code points
_NEWLINE = K.byte_set((0x0A, 0x0A))

COLUMNS = (
    ("n_words", "long"),
    ("word_chars", "long"),
    ("n_symbols", "long"),
    ("n_dup_lines", "long"),
    ("n_repeat_words", "long"),
    ("base_failed", "boolean"),
    ("kept", "boolean"),
    ("ratio", "double"),
    ("chunks_outside", "long"),
)
_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Flags of the keys that occur more than once."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _later(keys: np.ndarray) -> np.ndarray:
    """Flags of the keys that equal an earlier one."""
    order = np.argsort(keys, kind="stable")
    out = np.zeros(len(keys), bool)
    out[order[1:][keys[order[1:]] == keys[order[:-1]]]] = True
    return out


def _in_text(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that are equal only inside one text."""
    return K.mix(hashes + K.mix(text.astype(K.U64) + K.U64(77)))


def counts(texts: pa.Array, window: int = REPEAT_WINDOW) -> dict[str, np.ndarray]:
    """The counted columns of a batch of texts."""
    data, offsets = K.joined(texts)
    words = K.spans(data, offsets)
    total = K.running(K.byte_codes()[data])
    space = np.concatenate([[0], np.cumsum(K.SPACES[data])])
    chars = K.per_text(_CHARS[data] & ~K.SPACES[data], offsets)

    codes = K.between(total, words.start, words.end)
    at = K.gram_starts(words.first, window)
    hashes = K.grams(codes, window)[at]
    twice = at[_repeated(_in_text(hashes, words.text[at]))]
    repeat = K.per_text(K.covered(twice, window, len(codes)), words.first)

    lines = K.spans(data, offsets, _NEWLINE)
    filled = space[lines.end] - space[lines.start] < lines.end - lines.start
    start, end, text = lines.start[filled], lines.end[filled], lines.text[filled]
    again = _later(_in_text(K.between(total, start, end), text))
    return {
        "n_words": words.counts,
        "word_chars": chars,
        "n_symbols": K.per_text(_SYMBOLS[data], offsets),
        "n_dup_lines": np.bincount(text[again], minlength=len(offsets) - 1),
        "n_repeat_words": repeat,
    }


def compression(texts: pa.Array, level: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ratio of each whole text (0 bytes: 1), its chunks outside their band, and all its chunks.

    The last chunk ends with the text and may overlap the one before; a text below ``CHUNK_BYTES`` has none.
    """
    data, offsets = K.joined(texts)
    packer = zstandard.ZstdCompressor(level=level, write_content_size=False)
    whole = memoryview(np.ascontiguousarray(data))
    ratio = np.ones(len(offsets) - 1)
    outside = np.zeros(len(offsets) - 1, np.int64)
    for i, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        if high > low:
            ratio[i] = len(packer.compress(whole[low:high])) / (high - low)
        if high - low >= CHUNK_BYTES:
            for at in range(low, high, CHUNK_BYTES):
                at = min(at, high - CHUNK_BYTES)
                part = len(packer.compress(whole[at : at + CHUNK_BYTES])) / CHUNK_BYTES
                outside[i] += not CHUNK_BAND.low <= part <= CHUNK_BAND.high
    size = np.diff(offsets)
    return ratio, outside, np.where(size < CHUNK_BYTES, 0, -(-size // CHUNK_BYTES))


def judge(texts: pa.Array, bands: tuple[Band, ...] = BANDS) -> dict[str, np.ndarray]:
    """All columns of a batch of texts."""
    out = counts(texts)
    n, repeat = out["n_words"], out["n_repeat_words"]
    failed = (n < MIN_WORDS) | (100 * repeat > REPEAT_PERCENT * n)
    ratio, outside, chunks = compression(texts)
    size = np.diff(K.joined(texts)[1])
    edges = np.array([b.from_bytes for b in bands])
    which = np.searchsorted(edges, size, "right") - 1
    low, high = np.array([b.low for b in bands])[which], np.array([b.high for b in bands])[which]
    good = (ratio >= low) & (ratio <= high) & (outside <= CHUNK_SHARE * chunks)
    return out | {"base_failed": failed, "kept": good & ~failed, "ratio": ratio, "chunks_outside": outside}


def rate(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the quality columns to every row, in one pass without a shuffle.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words`` are
    counted over whole texts; ``base_failed`` is the counted rule (too few words, or too
    many in repeated windows). ``kept`` is false if that fails, if the zstandard ratio of the
    whole text leaves the band of its length, or if more than ``CHUNK_SHARE`` of its
    chunks of ``CHUNK_BYTES`` bytes leave theirs (which finds a bad stretch in a long text).

    A null or empty text has no words and is not kept. Windows and lines are compared by
    64-bit hashes inside their own document. Input columns with one of the names added are
    replaced. Memory is bounded by ``kernels.PIECE_BYTES`` or the longest text.
    """
    added = {name for name, _ in COLUMNS}
    docs = docs.select(*[f"`{c}`" for c in docs.columns if c not in added])
    schema = K.wider(docs.schema, *COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.pieces(batch, text):
                got = judge(part.column(text))
                arrays = [pa.array(got[name]).cast(_ARROW[kind]) for name, kind in COLUMNS]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], schema.names)

    return docs.mapInArrow(run, schema)


def keep(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that ``rate`` keeps, with the columns of ``docs`` as they were, whatever their names.

    Null and empty texts have too few words and go; equal rows stay or go together; an empty table stays empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.pieces(batch, text):
                yield part.filter(pa.array(judge(part.column(text))["kept"]))

    return docs.mapInArrow(run, docs.schema)
