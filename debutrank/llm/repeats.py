"""Windows of tokens that occur more than once in a corpus, found exactly and in little traffic.

Both substring operators look for windows of ``length`` tokens (words or bytes) that start earlier
elsewhere. Sending every window would cost several times the text. Instead:

1. Each window has an anchor, its smallest ``gram`` tokens by hash. Consecutive windows with the
   same anchor form a piece. Equal windows have equal anchors, so they lie in pieces of the same anchor.
   Only (anchor, hash of the piece, document, position) is shuffled, by anchor and sorted.
2. Of equal pieces all but the first are covered as a whole. Inside a task this is settled before
   the shuffle, so a passage that a third of all documents share sends a row per task. An anchor
   with a single piece has no repeats. What is left, an anchor with different pieces, is contested.
3. The contents of contested pieces are fetched and dealt out by anchor into shards of bounded size.
   The operators compare them there, each by its own method. An anchor with very many different
   pieces (a common phrase) is dealt out again by anchors of almost a window's length.
4. Where even such an anchor has very many pieces (a shared phrase hardly shorter than a window), its windows
   are dealt out one by one, by the hash of the whole window, and settled as equal pieces are in step 2.

Texts are shuffled once, into buckets by document; contents are read and spans are cut out there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debutrank.llm import kernels as K
from debutrank.session import bucketed, written

DOCUMENT = ["key", "text_hash"]
NO_KEY = (1 << 63) - 1  # stands for a null document key, which is later than all others
HOT_PIECES = 4096  # different pieces of one anchor, beyond which it is dealt out again
REPEATED = 10_000  # a row that stands for more than this part of all rows is dealt out in parts
LEAST_REPEATED = 1_000
SHARD_TOKENS = {"words": 150_000, "bytes": 1_500_000}


class Repeats(NamedTuple):
    """What is looked for: ``length`` tokens of ``unit`` ("words" or "bytes") with anchors of ``gram``.

    ``within`` tells whether an earlier start in the same document counts.
    """

    unit: str
    length: int
    gram: int
    within: bool


class Tokens(NamedTuple):
    data: np.ndarray
    start: np.ndarray | None  # of words, in bytes
    end: np.ndarray | None
    codes: np.ndarray
    first: np.ndarray  # index of the first token of each text

    def content(self, at: int, n: int) -> bytes:
        if self.start is None:
            return self.data[at : at + n].tobytes()
        return self.data[self.start[at] : self.end[at + n - 1]].tobytes()


def tokens(texts: pa.Array, unit: str) -> Tokens:
    data, offsets = K.joined(texts)
    codes = K.byte_codes()[data]
    if unit == "bytes":
        return Tokens(data, None, None, codes, offsets)
    words = K.spans(data, offsets)
    return Tokens(data, words.start, words.end, K.between(K.running(codes), words.start, words.end), words.first)


def _least_of(x: np.ndarray, width: int) -> np.ndarray:
    """Minima of all ``width`` consecutive values, by doubling."""
    have = 1
    out = x
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    n = len(x) - width + 1
    return out[:n] if have == width else np.minimum(out[:n], out[width - have : width - have + n])


def split(codes: np.ndarray, first: np.ndarray, length: int, gram: int):
    """Pieces: text index, first token, number of tokens, anchor and hash."""
    starts = K.gram_starts(first, length)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(K.U64), none.view(K.U64)
    hashes = K.grams(codes, gram)
    ranked = (hashes & K.U64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=K.U64)
    least = _least_of(ranked, length - gram + 1)
    anchor = (least[starts] & K.U64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    low = np.flatnonzero(new)
    high = np.append(low[1:], len(starts)) - 1
    begin, end = starts[low], starts[high] + length
    text = np.searchsorted(first, begin, "right") - 1
    return text, begin, end - begin, hashes[anchor[low]], K.between(K.running(codes), begin, end)


# A piece's place in its text in one long: first token, number of tokens, settled or not.


def _pack(at: np.ndarray, n: np.ndarray, settled: np.ndarray) -> np.ndarray:
    return (at << 9) | (n << 1) | settled


def _unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return place >> 9, (place >> 1) & 0xFF


def _same_as_last(*columns: np.ndarray, last: tuple | None = None) -> np.ndarray:
    """Flags of the rows that equal the one before; ``last`` stands before the first."""
    same = np.zeros(len(columns[0]), bool)
    if len(same):
        same[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in columns])
        same[0] = last is not None and all(c[0] == v for c, v in zip(columns, last))
    return same


PIECES = ["anchor", "piece", "key", "text_hash", "place"]


def _sent(what: Repeats, *columns: np.ndarray) -> pa.RecordBatch:
    """The rows of ``PIECES`` that are dealt out: repeated rows once, and settled what is covered by another here."""
    anchor, piece, key, text_hash, place = columns
    order = np.lexsort((place, text_hash, key, piece, anchor))
    a, p, k, h, x = (c[order] for c in columns)
    once = ~_same_as_last(a, p, k, h, x)  # repeated rows are one document
    a, p, k, h, x = (c[once] for c in (a, p, k, h, x))
    settled = np.zeros(len(a), bool)
    if len(a):
        settled[1:] = (a[1:] == a[:-1]) & (p[1:] == p[:-1])
        owner = k[np.maximum.accumulate(np.where(settled, 0, np.arange(len(a))))]
        if not what.within:
            settled &= k > owner
    # settled rows need no partner any more: they go anywhere
    a = np.where(settled, K.mix((x + k + h).view(K.U64)).view(np.int64), a)
    return pa.RecordBatch.from_arrays([pa.array(v) for v in (a, p, k, h, x | settled)], PIECES)


def _split_batches(what: Repeats) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.pieces(batch):
                t = tokens(part.column("text"), what.unit)
                text, begin, n, anchor, piece = split(t.codes, t.first, what.length, what.gram)
                key = part.column("key").to_numpy(zero_copy_only=False)[text]
                text_hash = part.column("text_hash").to_numpy(zero_copy_only=False)[text]
                place = _pack(begin - t.first[text], n, np.zeros(len(n), np.int64))
                yield _sent(what, anchor.view(np.int64), piece.view(np.int64), key, text_hash, place)

    return run


def _resolve(what: Repeats) -> Callable:
    """Streams rows sorted by ``PIECES``; keeps one anchor's state between batches."""
    names = ["anchor", "key", "text_hash", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor = piece = owner = None  # of the last row
        row = None  # the last row
        contested = False  # whether the last anchor has had two pieces
        pending: list[np.ndarray] = []  # rows of its only piece so far
        for batch in batches:
            a, p, k, h, x = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            done = (x & 1).astype(bool)
            out = [np.stack([np.zeros(done.sum(), np.int64), k[done], h[done], x[done]])]
            live = ~done
            a, p, k, h, x = a[live], p[live], k[live], h[live], x[live]
            once = ~_same_as_last(a, p, k, h, x, last=row)
            a, p, k, h, x = a[once], p[once], k[once], h[once], x[once]
            if len(a):
                row = a[-1], p[-1], k[-1], h[-1], x[-1]
                new_anchor = np.ones(len(a), bool)
                new_anchor[1:] = a[1:] != a[:-1]
                new_anchor[0] = anchor is None or a[0] != anchor
                new_piece = new_anchor.copy()
                new_piece[1:] |= p[1:] != p[:-1]
                new_piece[0] |= p[0] != piece
                at = np.maximum.accumulate(np.where(new_piece, np.arange(len(a)), -1))
                owners = np.where(at < 0, owner if owner is not None else 0, k[np.maximum(at, 0)])
                covered = ~new_piece if what.within else k > owners
                out.append(np.stack([np.zeros(covered.sum(), np.int64), k[covered], h[covered], x[covered] | 1]))
                group = np.cumsum(new_anchor)  # 0: the anchor of the batch before
                several = np.bincount(group, new_piece)
                # group 0 has a piece already; the others begin with theirs
                several = several >= np.where(np.arange(len(several)) == 0, 1, 2)
                several[0] |= contested
                entry = ~covered
                if several[0] and pending:
                    out += pending
                    pending = []
                if group[-1] > 0:
                    pending = []
                go = entry & several[group]
                out.append(np.stack([a[go], k[go], h[go], x[go]]))
                last = group == group[-1]
                contested = bool(several[group[-1]])
                if not contested:
                    keep = entry & last
                    pending.append(np.stack([a[keep], k[keep], h[keep], x[keep]]))
                anchor, piece, owner = a[-1], p[-1], owners[-1]
            rows = np.concatenate(out, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in rows], names)

    return run


def _fetch(what: Repeats) -> Callable:
    """Contents of contested pieces; those of hot anchors in smaller pieces (``sub``) with longer anchors."""
    names = ["anchor", "sub", "key", "text_hash", "at", "n", "content"]
    longer = max(what.gram, what.length - max(2, what.length // 12))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.pieces(batch):
                t = tokens(part.column("text"), what.unit)
                wanted = part.column("wanted")
                counts = pa.compute.list_value_length(wanted).to_numpy(zero_copy_only=False)
                text = np.repeat(np.arange(part.num_rows), counts)
                flat = wanted.flatten()
                place, anchor, hot = (
                    flat.field(i).to_numpy(zero_copy_only=False) for i in ("place", "anchor", "hot")
                )
                at, n = _unpack(place)
                begin = at + t.first[text]
                sub = np.zeros(len(anchor), bool)
                if hot.any():
                    inner = np.concatenate([np.arange(b, b + m) for b, m in zip(begin[hot], n[hot])])
                    first = np.concatenate([[0], np.cumsum(n[hot])])
                    which, sub_at, sub_n, sub_anchor, _ = split(t.codes[inner], first, what.length, longer)
                    cold = ~hot
                    text = np.concatenate([text[cold], text[hot][which]])
                    begin = np.concatenate([begin[cold], begin[hot][which] + sub_at - first[which]])
                    n = np.concatenate([n[cold], sub_n])
                    anchor = np.concatenate([anchor[cold], sub_anchor.view(np.int64)])
                    sub = np.arange(len(n)) >= cold.sum()
                content = [t.content(b, m) for b, m in zip(begin.tolist(), n.tolist())]
                key = part.column("key").to_numpy(zero_copy_only=False)[text]
                text_hash = part.column("text_hash").to_numpy(zero_copy_only=False)[text]
                columns = [anchor, key, text_hash, begin - t.first[text], n]
                arrays = [pa.array(np.asarray(c, np.int64)) for c in columns]
                arrays.insert(1, pa.array(sub))
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(content, pa.binary())], names)

    return run


def _windows(what: Repeats) -> Callable:
    """All windows of pieces, as pieces of their own, by two hashes of the whole window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.pieces(batch, "content"):
                t = tokens(part.column("content"), what.unit)
                start = K.gram_starts(t.first, what.length)
                piece = np.searchsorted(t.first, start, "right") - 1
                one = K.grams(t.codes, what.length)[start]
                two = K.grams(K.mix(t.codes + K.U64(0x9E3779B97F4A7C15)), what.length)[start]
                key, text_hash, at = (
                    part.column(c).to_numpy(zero_copy_only=False)[piece] for c in ("key", "text_hash", "at")
                )
                n = np.full(len(start), what.length, np.int64)
                place = _pack(at + start - t.first[piece], n, np.zeros(len(n), np.int64))
                yield _sent(what, one.view(np.int64), two.view(np.int64), key, text_hash, place)

    return run


Compare = Callable[[pd.DataFrame], pd.DataFrame]


def with_spans(docs: DataFrame, key: str, text: str, what: Repeats, compare: Compare) -> DataFrame:
    """(key, text_hash, text, spans) of all rows, ``spans`` being null where no token is covered.

    ``spans`` are (low, high) token ranges, in no order, which may overlap. ``compare`` gets the pieces of a
    shard (key, text_hash, at, n, content) and returns covered ranges (key, text_hash, low, high).
    A text is known by its key and ``text_hash``, its xxhash64; repeated rows
    are one document. Null keys come last. Rows that have been range-compared stay whole: nothing is
    capped, and hot anchors and passages are split as described above.
    """
    if 2 * what.length - what.gram > 255:
        raise ValueError("a piece must fit in 255 tokens")
    rows, repeated = _stored(docs, key, text)
    sent = "anchor long, piece long, key long, text_hash long, place long"

    def resolved(pieces: DataFrame) -> DataFrame:
        # the order is on the shuffle's key first, so that one sort serves the stream
        dealt = pieces.repartition("anchor").sortWithinPartitions(*PIECES)
        return dealt.mapInArrow(_resolve(what), "anchor long, key long, text_hash long, place long")

    found = written(resolved(rows.select("key", "text_hash", "text").mapInArrow(_split_batches(what), sent)), "pieces")

    contested = found.filter(F.col("place").bitwiseAND(1) == 0)
    size = F.shiftright("place", 1).bitwiseAND(0xFF)
    volume = contested.agg(F.sum(size)).first()[0] or 0
    shards = max(1, -(-volume // SHARD_TOKENS[what.unit]))
    hot = contested.groupBy("anchor").count().filter(F.col("count") > HOT_PIECES).select("anchor", F.lit(True).alias("hot"))
    # written, so that its true size lets Spark broadcast it, or else split a skewed join with it
    hot = written(hot, "hot")
    one = contested.join(hot, "anchor", "left").join(F.broadcast(repeated), DOCUMENT, "left")
    wanted = one.withColumn("part", F.pmod("text_hash", F.coalesce("parts", F.lit(1)))).groupBy(*DOCUMENT, "part")
    wanted = wanted.agg(F.collect_list(F.struct("place", "anchor", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("wanted"))
    texts = rows.join(wanted, [*DOCUMENT, "part"]).dropDuplicates([*DOCUMENT, "part"])
    schema = "anchor long, sub boolean, key long, text_hash long, at long, n long, content binary"
    pieces = texts.select("key", "text_hash", "text", "wanted").mapInArrow(_fetch(what), schema)
    settled = found.filter(F.col("place").bitwiseAND(1) == 1).select("key", "text_hash", "place")
    if not hot.isEmpty():
        pieces = written(pieces, "fetched")
        still = pieces.filter("sub").groupBy("sub", "anchor").count().filter(F.col("count") > HOT_PIECES)
        still = written(still.select("sub", "anchor", F.lit(True).alias("still")), "still_hot")
        pieces = pieces.join(still, ["sub", "anchor"], "left")
        windows = resolved(pieces.filter("still").select("key", "text_hash", "at", "content").mapInArrow(_windows(what), sent))
        # a window that no equal one covers is not covered, whatever else has its first hash
        windows = windows.filter(F.col("place").bitwiseAND(1) == 1).select("key", "text_hash", "place")
        settled = settled.union(windows)
        pieces = pieces.filter("still IS NULL")
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    pieces = pieces.select("shard", "key", "text_hash", "at", "n", "content")
    spans = pieces.groupBy("shard").applyInPandas(compare, "key long, text_hash long, low long, high long")

    at = F.shiftright("place", 9)
    whole = settled.select("key", "text_hash", at.alias("low"), (at + size).alias("high"))
    spans = whole.union(spans).join(F.broadcast(repeated), DOCUMENT, "left")
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1))
    spans = spans.select(*DOCUMENT, parts.alias("part"), "low", "high").groupBy(*DOCUMENT, "part")
    spans = spans.agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    return rows.join(spans, [*DOCUMENT, "part"], "left").select(*DOCUMENT, "text", "spans")


def _stored(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """All rows (key, text_hash, part, text) in buckets of the first three, and (key, text_hash, parts) of
    the rows that are repeated so often that they lie in several buckets, ``REPEATED`` at most."""
    rows = keyed(docs, key, text)
    most = max(LEAST_REPEATED, docs.count() // REPEATED)
    count = rows.groupBy(*DOCUMENT).agg(F.count("*").alias("n")).filter(F.col("n") > most)
    repeated = written(count.select(*DOCUMENT, F.ceil(F.col("n") / most).alias("parts")), "repeated")
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).join(F.broadcast(repeated), DOCUMENT, "left")
    part = F.coalesce(F.pmod(F.xxhash64("row"), "parts"), F.lit(0))
    rows = dealt.select(*DOCUMENT, part.alias("part"), "text")
    return bucketed(rows, "texts", [*DOCUMENT, "part"], compression="zstd"), repeated


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text_hash, text) with the substitutes for nulls."""
    return docs.select(
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NO_KEY)).alias("key"),
        F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )


def merged(low: np.ndarray, high: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of each owner, joined where they touch or overlap. ``owner`` holds small numbers."""
    order = np.lexsort((low, owner))
    low, high, owner = low[order], high[order], owner[order]
    if not len(low):
        return low, high, owner
    # the reach so far, never across owners
    reach = np.maximum.accumulate(high + owner * (int(high.max()) + 1)) - owner * (int(high.max()) + 1)
    new = np.ones(len(low), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (low[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return low[at], reach[np.append(at[1:], len(low)) - 1], owner[at]
