"""Substring deduplication: documents streamed through suffix automata of reference shards.

The reference of a shard are the passages that may repeat one another (``repeats`` finds them and
sends all that can match to one shard). A shard's automaton goes only to the task in which the
passages of its documents are: sent to all tasks, the automata of a whole corpus would be
broadcast in as many rounds as there are shards, and every round would read every document.
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

WINDOW = 13
WHAT = repeats.Repeats("words", WINDOW, 5, within=False)


class Automaton:
    """Suffix automaton of many passages, with the smallest document of every state's strings."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.least = [repeats.NO_KEY + 1]

    def _clone(self, state: int, length: int) -> int:
        self.next.append(dict(self.next[state]))
        self.link.append(self.link[state])
        self.length.append(length)
        self.least.append(repeats.NO_KEY + 1)
        return len(self.link) - 1

    def add(self, passage: list[int], document: int) -> None:
        nxt, link, length, least = self.next, self.link, self.length, self.least
        last = 0
        for word in passage:
            known = nxt[last].get(word)
            if known is not None and length[known] == length[last] + 1:
                last = known  # another passage has been here
            else:
                if known is None:
                    new = len(link)
                    nxt.append({})
                    link.append(0)
                    length.append(length[last] + 1)
                    least.append(document)
                else:
                    new = None
                state = last
                while state >= 0 and word not in nxt[state]:
                    nxt[state][word] = new
                    state = link[state]
                if state >= 0:
                    target = nxt[state][word]
                    if length[target] != length[state] + 1:
                        clone = self._clone(target, length[state] + 1)
                        while state >= 0 and nxt[state].get(word) == target:
                            nxt[state][word] = clone
                            state = link[state]
                        link[target] = clone
                        target = clone
                    if new is None:
                        new = target
                    else:
                        link[new] = target
                last = new
            if document < least[last]:
                least[last] = document

    def close(self) -> None:
        """Pass the documents of every state on to its suffixes."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            if self.least[state] < self.least[up]:
                self.least[up] = self.least[state]

    def earlier(self, passage: list[int], document: int, window: int) -> list[int]:
        """Ends of the stretches of ``window`` words that a smaller document has too.

        The matching statistic is kept at ``window`` words at most, in the state of that suffix.
        """
        nxt, link, length, least = self.next, self.link, self.length, self.least
        state = matched = 0
        ends = []
        for i, word in enumerate(passage):
            while state and word not in nxt[state]:
                state = link[state]
                matched = length[state]
            step = nxt[state].get(word)
            if step is None:
                continue
            state, matched = step, matched + 1
            while length[link[state]] >= window:
                state = link[state]
            if matched >= window:
                matched = window
                if least[state] < document:
                    ends.append(i + 1)
        return ends


def _shard(pieces: pd.DataFrame) -> pd.DataFrame:
    """Covered ranges of one shard's passages."""
    codes = repeats.tokens(pa.array(pieces["content"].tolist(), pa.binary()), "words")
    words = codes.codes.tolist()
    bounds = codes.first.tolist()
    passages = [words[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    keys = pieces["key"].tolist()
    automaton = Automaton()
    for passage, key in zip(passages, keys):
        automaton.add(passage, key)
    automaton.close()
    which, ends = [], []
    for i, (passage, key) in enumerate(zip(passages, keys)):
        found = automaton.earlier(passage, key, WINDOW)
        which += [i] * len(found)
        ends += found
    which = np.array(which, np.int64)
    high = np.array(ends, np.int64)
    low, high, which = repeats.merged(high - WINDOW, high, which)  # maximal spans
    at = pieces["at"].to_numpy()[which]
    return pd.DataFrame(
        {"key": pieces["key"].to_numpy()[which], "text_hash": pieces["text_hash"].to_numpy()[which],
         "low": at + low, "high": at + high}
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "text_hash", "n_words", "n_removed", "kept"]
    for batch in batches:
        for part in K.pieces(batch):
            t = repeats.tokens(part.column("text"), "words")
            gone = removed(part.column("spans"), t.first)
            kept = np.flatnonzero(~gone)
            raw = t.data.tobytes()
            words = [raw[a:b] for a, b in zip(t.start[kept].tolist(), t.end[kept].tolist())]
            first = np.searchsorted(kept, t.first).tolist()
            texts = [b" ".join(words[a:b]).decode() for a, b in zip(first[:-1], first[1:])]
            counts = np.diff(t.first)
            arrays = [pa.array(counts), pa.array(K.per_text(gone, t.first)), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("text_hash"), *arrays], names)


def removed(spans: pa.ListArray, first: np.ndarray) -> np.ndarray:
    """Flags of the tokens inside the spans of their text (a null list has none)."""
    counts = pa.compute.fill_null(pa.compute.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
    flat = spans.flatten()
    base = np.repeat(first[:-1], counts)
    low = flat.field("low").to_numpy(zero_copy_only=False) + base
    high = flat.field("high").to_numpy(zero_copy_only=False) + base
    return K.covered(low, high - low, int(first[-1]))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without the stretches of ``WINDOW`` words or more that a smaller document has.

    Returns ``key``, ``text_hash``, ``n_words``, ``n_removed`` and ``kept`` (the kept words joined by one space) for
    every row. A word goes if a window of ``WINDOW`` consecutive words that covers it also starts in
    a document with a smaller key; all windows are judged on the input. A null or empty text has no
    words. A null key is larger than all others and stays null. Rows with the same key do not
    count against each other, whether their texts are equal or not. Other columns are ignored.
    """
    rows = repeats.with_spans(docs, key, text, WHAT, _shard)
    out = rows.mapInArrow(_cut, "key long, text_hash long, n_words long, n_removed long, kept string")
    return out.withColumnRenamed("key", key).withColumn(key, F.nullif(F.col(key), F.lit(repeats.NO_KEY)))
