"""Periodic runs of words: stretches that repeat a short period at least four times.

Words become available one after another. At level ``j`` a catcher stands on every stretch of ``2**j`` words
that two neighbouring completed blocks of ``2**(j-1)`` make up, and watches the periods above
``2**(j-1)`` and up to ``2**j``: each appended word ends one suffix of ``2**j`` words, and that suffix is
compared with the only catcher for which it lies within those periods. A match is a square, because the
catcher is at least as long as the period; squares of one period on neighbouring catchers
are one run, whose ends are found word by word. So a text of n words takes n comparisons
on each of log n levels, and those of a whole batch of texts are done at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from debutrank.llm import kernels as K

REPEATS = 4  # a run is at least that many periods long; the catchers rely on it
LEAST_WORDS = 6
COMPARED = 1 << 20  # words that the search for the ends of runs compares in one step


class Runs(NamedTuple):
    """Runs of a batch: first word, word after the last, and period, sorted by first word and period."""

    start: np.ndarray
    end: np.ndarray
    period: np.ndarray


def _extended(codes: np.ndarray, at: np.ndarray, period: np.ndarray, most: int, back: bool) -> np.ndarray:
    """How many words, at most ``most``, the stretches go on before (``back``) or from ``at``."""
    out = np.zeros(len(at), np.int64)
    if not most:
        return out
    step = -np.arange(1, most + 1) if back else np.arange(most)
    rows = max(1, COMPARED // most)
    last = len(codes) - 1
    for low in range(0, len(at), rows):
        here = at[low : low + rows, None] + step
        other = here + period[low : low + rows, None] * (1 if back else -1)
        same = codes[np.clip(here, 0, last)] == codes[np.clip(other, 0, last)]
        out[low : low + rows] = np.where(same.all(axis=1), most, same.argmin(axis=1))
    return out


def catch(codes: np.ndarray, sizes: np.ndarray, least: int = LEAST_WORDS) -> Runs:
    """All runs of the texts whose words have these codes; ``sizes`` are their word counts.

    Suffixes are compared by 64-bit names, each made of those of its two halves.
    """
    texts = np.arange(len(sizes))
    # A code of its own before each text and after the last: no stretch goes across.
    borders = np.cumsum(np.append(0, sizes)) + np.arange(len(sizes) + 1)
    own = np.arange(len(sizes) + 1, dtype=K.U64)
    own = K.mix(own * K.U64(0x9E3779B97F4A7C15) + K.U64(0xB0DE))
    all_codes = np.empty(len(codes) + len(sizes) + 1, K.U64)
    inner = np.ones(len(all_codes), bool)
    inner[borders] = False
    all_codes[inner], all_codes[borders] = codes, own

    place = np.arange(len(all_codes))
    size_of = np.append(np.repeat(sizes, sizes + 1), 0)  # words of the text, its leading border included
    names = all_codes
    found = [np.zeros((3, 0), np.int64)]
    starts = reach = np.zeros(0, np.int64)  # of the runs so far: first words, and furthest end up to each
    level = 0
    while True:
        block = 1 << level
        step = block >> 1
        # Catchers start at multiples of ``step``; word i is in the range of exactly one of them.
        ahead = step + 1
        stride = max(step, 1)
        if len(names) > ahead:
            heads = np.repeat(names[::stride], stride)[: len(names) - ahead]
            hits = np.flatnonzero(names[ahead:] == heads)
            catcher = hits // stride * stride
            first = np.concatenate([[True], catcher[1:] != catcher[:-1]])[: len(hits)]
            hits, catcher = hits[first], catcher[first]
            period = hits + ahead - catcher
            at = place[catcher]
            # Inside a run of a shorter period, found on a lower level, a match only repeats that period.
            held = np.searchsorted(starts, at, "right") - 1
            new = np.ones(len(at), bool)
            inside = held >= 0
            new[inside] = reach[held[inside]] < (at + period + block)[inside]
            at, period = at[new], period[new]
            if len(at):
                joins = (np.diff(at) == stride) & (np.diff(period) == 0)
                head = np.flatnonzero(np.concatenate([[True], ~joins]))
                tail = np.append(head[1:], len(at)) - 1
                q = period[head]
                # The catchers next to these did not match, so less than a step is missing on either side.
                start = at[head]
                end = at[tail] + q + block
                start = start - _extended(all_codes, start, q, stride - 1, back=True)
                end = end + _extended(all_codes, end, q, stride - 1, back=False)
                long = end - start >= REPEATS * q
                found.append(np.stack([start[long], end[long], q[long]]))
                merged = np.concatenate(found, axis=1)
                order = np.argsort(merged[0], kind="stable")
                starts, reach = merged[0][order], np.maximum.accumulate(merged[1][order])
        # The next level: names of twice the length, of the texts that may hold such a run.
        level += 1
        stays = size_of[: max(len(names) - block, 0)] >= REPEATS * ((1 << level >> 1) + 1)
        if not stays.any():
            break
        half = names
        names = K.mix(half[:-block] * K.U64(0x9E3779B97F4A7C15) + K.mix(half[block:] + K.U64(level)))[stays]
        place, size_of = place[: len(stays)][stays], size_of[: len(stays)][stays]

    start, end, period = np.concatenate(found, axis=1)
    keep = end - start >= least
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    border = np.searchsorted(borders, start)  # borders before the run, which have no word
    return Runs(start - border, end - border, period)


def _numbers(n: int, rows: np.ndarray, values: np.ndarray) -> pa.Array:
    """Values at some of ``n`` rows, nulls elsewhere."""
    out, missing = np.zeros(n, np.int64), np.ones(n, bool)
    out[rows], missing[rows] = values, False
    return pa.array(out, mask=missing)


COLUMNS = (
    ("n_words", "long"),
    ("n_runs", "long"),
    ("start", "long"),
    ("length", "long"),
    ("period", "long"),
    ("exponent_milli", "long"),
    ("runs", ArrayType(StructType([StructField(c, LongType()) for c in ("start", "length", "period")]))),
    ("collapsed", "string"),
)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def detect(texts: pa.Array) -> list[pa.Array]:
    """The added columns of a batch of texts."""
    data, offsets = K.joined(texts)
    words = K.spans(data, offsets)
    sizes = words.counts
    codes = K.between(K.running(K.byte_codes()[data]), words.start, words.end)
    runs = catch(codes, sizes)
    n = len(sizes)
    text = np.searchsorted(words.first, runs.start, "right") - 1
    first = np.searchsorted(text, np.arange(n + 1))
    start, length = runs.start - words.first[text], runs.end - runs.start

    # The greatest exponent. Quotients of integers below 2**26 are equal as doubles only if they are equal.
    order = np.lexsort((runs.period, start, -(length / runs.period), text))
    rows, best = np.unique(text[order], return_index=True)
    best = order[best]
    longest = [start[best], length[best], runs.period[best], 1000 * length[best] // runs.period[best]]

    # Words after the first period of a run go.
    low, high = runs.start + runs.period, runs.end
    steps = np.bincount(low, minlength=len(codes) + 1) - np.bincount(high, minlength=len(codes) + 1)
    left = np.flatnonzero(np.cumsum(steps[:-1]) == 0)
    of = words.text[left]
    opens = np.bincount(words.start[left], minlength=len(data) + 1)
    closes = np.bincount(words.end[left], minlength=len(data) + 1)
    stays = np.cumsum(opens - closes)[:-1] > 0
    gap = words.end[left[:-1][of[1:] == of[:-1]]]  # a word follows in the same text, so there is a blank
    stays[gap] = True
    out = data.copy()
    out[gap] = 0x20
    bounds = np.concatenate([[0], np.cumsum(stays)])[offsets]
    collapsed = pa.LargeStringArray.from_buffers(
        n, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(out[stays]))
    ).cast(pa.string())
    values = pa.StructArray.from_arrays([pa.array(v) for v in (start, length, runs.period)], fields=list(_RUN))
    return [
        pa.array(sizes), pa.array(np.diff(first)), *[_numbers(n, rows, v) for v in longest],
        pa.ListArray.from_arrays(pa.array(first, pa.int32()), values), collapsed,
    ]


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the periodic runs of every whole text, in one pass without a shuffle.

    Words are separated by ASCII white space and numbered from 0. ``runs`` lists every run (first word,
    length in words, smallest period) by first word, then period: a stretch of at least ``LEAST_WORDS`` words
    and ``REPEATS`` periods that no neighbouring word extends. ``start``, ``length``, ``period`` and
    ``exponent_milli`` (1000 times length by period, rounded down) are those of the run with the most
    repetitions (ties: the first, then the shortest period), null without a run. ``collapsed``
    is the text without the words after the first period of any run, one space between words.

    A null or empty text has no words, no run, and collapses to an empty text. Equal rows give equal
    results and all rows stay. Input columns with one of the names added are replaced. Words are
    compared by 64-bit hashes inside their own text. Memory is bounded by ``kernels.PIECE_BYTES`` or the longest text.
    """
    added = {name for name, _ in COLUMNS}
    docs = docs.select(*[f"`{c}`" for c in docs.columns if c not in added])
    schema = K.wider(docs.schema, *COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.pieces(batch, text):
                yield pa.RecordBatch.from_arrays([*part.columns, *detect(part.column(text))], schema.names)

    return docs.mapInArrow(run, schema)
