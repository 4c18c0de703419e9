"""Suffix-array deduplication of bytes with the difference-cover algorithm.

``repeats`` deals the passages that may repeat one another into shards: all places where one
100-byte string occurs meet in one shard. Each shard's suffixes are sorted by difference cover:
sort the triples at positions 1 and 2 modulo 3, recurse on their names until these differ, merge the
remaining suffixes, then compare the prefixes of neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debutrank.llm import kernels as K
from debutrank.llm import repeats
from debutrank.llm.substring import removed

WINDOW = 100
WHAT = repeats.Repeats("bytes", WINDOW, 32, within=True)


def _order(*keys: np.ndarray) -> np.ndarray:
    """Stable order by the keys, the first being the most significant."""
    bits = [int(k.max()).bit_length() if len(k) else 0 for k in keys]
    if sum(bits) > 63:
        return np.lexsort(keys[::-1])
    packed = keys[0].astype(np.int64)
    for key, width in zip(keys[1:], bits[1:]):
        packed = (packed << width) | key
    return np.argsort(packed, kind="stable")


def _names(order: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense ranks from 1 of the keys, equal for equal keys; and how many there are."""
    differ = np.zeros(len(order), bool)
    for key in keys:
        in_order = key[order]
        differ[1:] |= in_order[1:] != in_order[:-1]
    names = np.empty(len(order), np.int64)
    names[order] = np.cumsum(differ) + 1
    return names, int(differ.sum()) + 1


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``s`` (values from 1 on) in lexicographic order."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    padded = np.concatenate([s.astype(np.int64), np.zeros(3, np.int64)])
    # with a length of 1 modulo 3, the empty suffix ends the first half of the names
    ones = np.arange(1, n + (n % 3 == 1), 3)
    twos = np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    triple = padded[sample], padded[sample + 1], padded[sample + 2]
    order = _order(*triple)
    names, count = _names(order, *triple)
    if count < len(sample):
        order = suffix_array(names)
    rank = np.zeros(n + 3, np.int64)  # of the sampled suffixes, from 1; beyond the end 0
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    sample = sample[order]
    sample = sample[sample < n]

    zeros = np.arange(0, n, 3)
    rest = zeros[_order(padded[zeros], rank[zeros + 1])]
    # merge: how many of the one kind come before each of the other
    before = np.zeros(len(rest), np.int64)
    for residue in (1, 2):
        theirs = sample[sample % 3 == residue]
        if residue == 1:
            parts = [(padded[x], rank[x + 1]) for x in (theirs, rest)]
        else:
            parts = [(padded[x], padded[x + 1], rank[x + 2]) for x in (theirs, rest)]
        keys = [np.concatenate(pair) for pair in zip(*parts)]
        where = np.empty(len(keys[0]), np.int64)
        merged = _order(*keys)
        where[merged] = np.arange(len(merged))
        before += where[len(theirs) :] - np.arange(len(rest))
    out = np.empty(n, np.int64)
    taken = np.zeros(n, bool)
    at = before + np.arange(len(rest))
    out[at] = rest
    taken[at] = True
    out[~taken] = sample
    return out


def _same_prefix(data: np.ndarray, a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Whether the ``width`` bytes at ``a`` and at ``b`` are equal, eight at a time."""
    words = np.lib.stride_tricks.as_strided(
        np.concatenate([data, np.zeros(8, np.uint8)])[: len(data) + 7].view(np.uint8), (len(data), 8), (1, 1)
    )
    eights = np.ascontiguousarray(words).view(np.uint64).reshape(-1)
    same = np.ones(len(a), bool)
    steps = [*range(0, width - 7, 8), width - 8] if width >= 8 else []
    for step in steps:
        same &= eights[a + step] == eights[b + step]
    if not steps:
        for step in range(width):
            same &= data[a + step] == data[b + step]
    return same


def _shard(pieces: pd.DataFrame) -> pd.DataFrame:
    """Covered ranges of one shard's passages: all but the first place of every string."""
    pieces = pieces.sort_values(["key", "text_hash", "at"], kind="stable")
    data = np.frombuffer(b"".join(pieces["content"]), np.uint8)
    n = pieces["n"].to_numpy()
    ends = np.cumsum(n)
    order = suffix_array(data.astype(np.int64) + 1)
    left = np.repeat(ends, n) - np.arange(len(data))  # bytes to the end of the passage
    order = order[left[order] >= WINDOW]
    same = _same_prefix(data, order[:-1], order[1:], WINDOW)
    group = np.concatenate([[0], np.cumsum(~same)]) if len(order) else order
    # passages are in order, so the smallest position of a group is the first place
    first = np.full(int(group[-1]) + 1 if len(group) else 0, len(data), np.int64)
    np.minimum.at(first, group, order)
    again = order[order != first[group]]
    which = np.searchsorted(ends, again, "right")
    low, high, which = repeats.merged(again, again + WINDOW, which)  # maximal spans
    shift = (pieces["at"].to_numpy() - (ends - n))[which]
    return pd.DataFrame(
        {"key": pieces["key"].to_numpy()[which], "text_hash": pieces["text_hash"].to_numpy()[which],
         "low": low + shift, "high": high + shift}
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "text_hash", "n_bytes", "n_removed", "n_spans", "kept"]
    for batch in batches:
        for part in K.pieces(batch):
            data, offsets = K.joined(part.column("text"))
            gone = removed(part.column("spans"), offsets)
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            edges = offsets[1:-1][offsets[1:-1] < len(data)]
            opens[edges] = gone[edges]
            kept = data[~gone]
            bounds = np.concatenate([[0], np.cumsum(~gone)])[offsets]
            texts = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(kept)]
            ).cast(pa.binary())
            counts = [np.diff(offsets), K.per_text(gone, offsets), K.per_text(opens, offsets)]
            arrays = [pa.array(c.astype(np.int64)) for c in counts]
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("text_hash"), *arrays, texts], names)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without the bytes of ``WINDOW``-byte strings that have started before.

    Returns ``key``, ``text_hash``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept``
    (the bytes that stay, which may begin inside a character) for every row. A byte goes if a
    string of ``WINDOW`` bytes that covers it also starts earlier: in a document with a smaller key
    or further left in the same document; strings do not cross documents and are judged on the
    input. A null or empty text has no bytes. Null keys come after all others and stay null;
    different texts with one key come in the order of a hash of the text. Rows with the same key and
    text are one document. Other columns are ignored.
    """
    rows = repeats.with_spans(docs, key, text, WHAT, _shard)
    schema = "key long, text_hash long, n_bytes long, n_removed long, n_spans long, kept binary"
    out = rows.mapInArrow(_cut, schema)
    return out.withColumnRenamed("key", key).withColumn(key, F.nullif(F.col(key), F.lit(repeats.NO_KEY)))
