"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are quantised on a logarithmic scale. An n-gram of level q is put
into a Bloom filter q times, once with each level up to its own; its count is read back by probing
level 1, 2, .. until a probe fails. Every bucket of the hashes has a filter of its own, with all its
n-grams. The distinct words and pairs of a piece go to their buckets and the levels come back, so no filter
leaves its task; the interpolated probabilities come from the probes alone.

The corpus is split into words once, in pieces of about 600,000 tokens: the distinct words of
a piece and the tokens as places in that list. All later passes read the pieces.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debutrank.llm import kernels as K
from debutrank.session import bucketed, written

PIECE_TOKENS = 600_000
BUCKET_BYTES = 8 << 20  # of text for each bucket of the counts
PAIR_BITS = 40  # of a pair's hash within its bucket
BITS = 10  # for each entry of a filter
WORDS = 4  # of 64 bits in a block; an entry sets two bits in each
STEP = 1.1  # between quantised counts; the small ones are exact
ADDED = 0.1
WEIGHTS = tuple(i / 10 for i in range(10))  # of the pair estimate, tried on the training tokens
BINS = 48
END = K.U64(0x5F3759DF9E3779B9)


def _levels() -> np.ndarray:
    """The counts at which the levels 1, 2, .. begin."""
    out = [1]
    while out[-1] < 1 << 60:
        out.append(max(out[-1] + 1, int(out[-1] * STEP)))
    return np.array(out, np.int64)


LEVELS = _levels()


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of the hashes."""
    return ((hashes >> K.U64(32)) * K.U64(buckets) >> K.U64(32)).astype(np.int64)


def _places(hashes: np.ndarray, level: int | np.ndarray, size: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block of an entry among ``size`` bits, and a hash of whose bits its places in it are made.

    All probes of an entry fall in one block of ``WORDS`` 64-bit words, two in each word, so that
    they cost one access to memory that is not at hand.
    """
    mixed = K.mix(hashes + np.asarray(level, np.int64).astype(K.U64) * K.U64(0x9E3779B97F4A7C15))
    blocks = np.asarray(size).astype(K.U64) // K.U64(64 * WORDS)
    block = (mixed >> K.U64(32)) * blocks >> K.U64(32)
    return block.astype(np.int64), mixed * K.U64(0xD6E8FEB86659FD93)


def _two(bits: np.ndarray, word: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places in one word of a block."""
    return (bits >> K.U64(12 * word + 16)) & K.U64(63), (bits >> K.U64(12 * word + 22)) & K.U64(63)


def build_segment(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """The bits of one bucket's n-grams (with a count from 1 on), ``BITS`` for each entry."""
    level = np.searchsorted(LEVELS, counts, "right")
    block = 64 * WORDS
    size = max(1, -(-int(level.sum()) * BITS // block)) * block
    flags = np.zeros(size, np.uint8)
    repeated = np.repeat(hashes, level)
    each = np.arange(len(repeated)) - np.repeat(np.cumsum(level) - level, level) + 1
    at, bits = _places(repeated, each, size)
    for word in range(WORDS):
        for place in _two(bits, word):
            flags[at * block + 64 * word + place.astype(np.int64)] = 1
    return size.to_bytes(8, "little") + np.packbits(flags, bitorder="little").tobytes()


def joined_segments(segments: Iterable[tuple[int, bytes]], buckets: int, total: int) -> tuple[np.ndarray, ...]:
    """Bits and byte offset of every bucket's segment, and the ``total`` bytes of all one after the other.

    Segments are taken one at a time, so the whole is in memory once.
    """
    size, offset = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    data, at = np.zeros(total, np.uint8), 0
    for bucket, segment in segments:
        size[bucket] = int.from_bytes(segment[:8], "little")
        offset[bucket] = at
        part = np.frombuffer(segment, np.uint8, offset=8)
        data[at : at + len(part)] = part
        at += len(part)
    return size, offset, data


class LogFilter:
    """All segments of a filter."""

    def __init__(self, size: np.ndarray, offset: np.ndarray, data: np.ndarray):
        self.size, self.offset, self.words = size, offset // 8, data.view(K.U64)
        self.buckets = len(size)

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """Quantised counts, from repeated probes; 0 if the first one fails."""
        bucket = bucket_of(hashes, self.buckets)
        size, offset = self.size[bucket], self.offset[bucket]
        level = np.zeros(len(hashes), np.int64)
        left = np.flatnonzero(size > 0)
        for q in range(1, len(LEVELS) + 1):
            at, bits = _places(hashes[left], q, size[left])
            at = offset[left] + at * WORDS
            for word in range(WORDS):
                one, two = _two(bits, word)
                mask = (K.U64(1) << one) | (K.U64(1) << two)
                found = (self.words[at + word] & mask) == mask
                if not found.all():
                    left, at, bits = left[found], at[found], bits[found]
            if not len(left):
                break
            level[left] = q
        return np.concatenate([[0], LEVELS])[level]


def probed(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Levels of a bucket's distinct ``hashes``, read back from the filter of those with a count."""
    seen = counts > 0
    segment = build_segment(hashes[seen], counts[seen])
    table = LogFilter(*joined_segments([(0, segment)], 1, len(segment) - 8))
    return np.searchsorted(LEVELS, table.counts(hashes), "right").astype(np.uint16)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of texts to rows of about ``PIECE_TOKENS`` tokens."""
    packer = zstandard.ZstdCompressor(level=1)
    number = TaskContext.get().partitionId() << 32
    held: list[tuple] = []

    def flush() -> pa.RecordBatch:
        nonlocal number, held
        codes = np.concatenate([h[0] for h in held])
        words, places = np.unique(codes, return_inverse=True)
        columns = [np.concatenate([h[i] for h in held]) for i in (1, 2, 3, 4)]
        arrays = [
            pa.array([number]),
            pa.array([words.tobytes()], pa.binary()),
            pa.array([packer.compress(places.astype(np.uint32).tobytes())], pa.binary()),
            *(pa.array([c.tobytes()], pa.binary()) for c in columns),
        ]
        number, held = number + 1, []
        return pa.RecordBatch.from_arrays(arrays, NAMES)

    for batch in batches:
        for part in K.pieces(batch):
            data, offsets = K.joined(part.column("text"))
            words = K.spans(data, offsets)
            codes = K.between(K.running(K.byte_codes(fold_case=True)[data]), words.start, words.end)
            others = [part.column(c).to_numpy(zero_copy_only=False) for c in ("key", "text_hash", "flags")]
            held.append((codes, words.counts.astype(np.int64), *others))
            if sum(len(h[0]) for h in held) >= PIECE_TOKENS:
                yield flush()
    if held:
        yield flush()


NAMES = ["piece", "words", "places", "counts", "keys", "hashes", "flags"]
PIECE_SCHEMA = "piece long, words binary, places binary, counts binary, keys binary, hashes binary, flags binary"
HELD_OUT, NULL_KEY = 1, 2


class Piece:
    """A piece's arrays: distinct words, tokens as places, and the documents."""

    def __init__(self, row):
        self.words = np.frombuffer(row["words"], K.U64)
        self.places = np.frombuffer(zstandard.decompress(row["places"]), np.uint32).astype(np.int64)
        self.counts = np.frombuffer(row["counts"], np.int64)
        self.keys = np.frombuffer(row["keys"], np.int64)
        self.hashes = np.frombuffer(row["hashes"], np.int64)
        self.flags = np.frombuffer(row["flags"], np.int64)

    def trained(self) -> np.ndarray:
        return (self.flags & HELD_OUT) == 0

    def sequence(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Histories and tokens as places (the end is one past the words), and their documents."""
        end = len(self.words)
        lengths = self.counts + 1
        last = np.cumsum(lengths) - 1
        token = np.empty(int(lengths.sum()), np.int64)
        is_word = np.ones(len(token), bool)
        is_word[last] = False
        token[is_word] = self.places
        token[last] = end
        history = np.empty_like(token)
        history[1:] = token[:-1]
        history[:1] = end
        return history, token, np.repeat(np.arange(len(lengths)), lengths)

    def codes(self) -> np.ndarray:
        return np.append(self.words, END)

    def pairs(self, history: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct pairs as hashes, the place of each token's pair among them, and their two words."""
        n = len(self.words) + 1
        distinct, places = np.unique(history * n + token, return_inverse=True)
        codes = self.codes()
        first, second = np.divmod(distinct, n)
        hashes = K.mix(codes[first] * K.U64(0xA24BAED4963EE407) + codes[second])
        return hashes, places, first, second


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _within(hashes: np.ndarray, to: np.ndarray, buckets: int) -> np.ndarray:
    """The first ``PAIR_BITS`` bits of the hashes' places within their buckets, in the order of the hashes.

    A bucket has the pairs of ``BUCKET_BYTES`` of text at any size of the corpus, some two millions, so that one
    in a few hundred thousand falls on another: far less than a filter's own error.
    """
    low = (-(-(to << 32) // buckets)).astype(K.U64) << K.U64(32)
    width = ((1 << 32) // buckets + 1) << 32
    return (hashes - low) >> K.U64(max(0, width.bit_length() - PAIR_BITS))


def packed(rising: np.ndarray, packer: zstandard.ZstdCompressor) -> bytes:
    """Sorted hashes as their steps, all lowest bytes first, so that the high ones take no room."""
    steps = np.diff(rising, prepend=K.U64(0))
    return packer.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(K.U64).reshape(-1), dtype=K.U64)


def _dealt(piece: int, hashes: np.ndarray, counts: np.ndarray, buckets: int, pairs: bool = False) -> pa.RecordBatch:
    """Sorted hashes with their counts, cut at the buckets."""
    packer = zstandard.ZstdCompressor(level=1)
    to = bucket_of(hashes, buckets)
    if pairs:
        hashes = _within(hashes, to, buckets)
    cuts = np.flatnonzero(np.diff(to, prepend=-1)) if len(to) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(to))
    arrays = [
        pa.array(np.full(len(cuts), piece, np.int64)),
        pa.array(to[cuts]),
        pa.array([packed(hashes[a:b], packer) for a, b in zip(cuts, ends)], pa.binary()),
        pa.array([packer.compress(counts[a:b].astype(np.uint32).tobytes()) for a, b in zip(cuts, ends)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["piece", "bucket", "hashes", "counts"])


DEALT = "piece long, bucket long, hashes binary, counts binary"


def _word_rows(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            piece = Piece(row)
            trained = np.repeat(piece.trained(), piece.counts)
            counts = np.bincount(piece.places[trained], minlength=len(piece.words))
            yield _dealt(row["piece"], piece.words, counts, buckets)

    return run


def _pair_rows(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            piece = Piece(row)
            history, token, doc = piece.sequence()
            hashes, places, _, _ = piece.pairs(history, token)
            counts = np.bincount(places[piece.trained()[doc]], minlength=len(hashes))
            order = np.argsort(hashes)
            yield _dealt(row["piece"], hashes[order], counts[order], buckets, pairs=True)

    return run


def _totals(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """The distinct hashes of a bucket's rows, the places of all among them, their total counts, and the rows' lengths."""
    parts = [unpacked(x) for x in rows["hashes"]]
    counts = np.frombuffer(b"".join(zstandard.decompress(x) for x in rows["counts"]), np.uint32)
    distinct, places = np.unique(np.concatenate(parts), return_inverse=True)
    # sums of integers in doubles are exact up to 2**53
    total = np.bincount(places, counts, len(distinct)).astype(np.int64)
    return distinct, places, total, np.array([len(x) for x in parts], np.int64)


def _replies(values: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    return [values[e - n : e].tobytes() for n, e in zip(lengths, ends)]


def _count_words(rows: pd.DataFrame) -> pd.DataFrame:
    """Per piece the total counts of its words and their levels; as piece -1, the bucket's sums."""
    distinct, places, total, lengths = _totals(rows)
    ends = np.cumsum(lengths)
    narrow = total.astype(np.uint32) if total.max(initial=0) < 1 << 32 else total
    out = pd.DataFrame(
        {"piece": rows["piece"], "bucket": rows["bucket"], "data": _replies(narrow[places], ends, lengths),
         "levels": _replies(probed(distinct, total)[places], ends, lengths), "n": lengths, "tokens": 0}
    )
    own = {"piece": -1, "bucket": rows["bucket"].iloc[0], "data": b"", "levels": b"", "n": (total > 0).sum(), "tokens": total.sum()}
    return pd.concat([out, pd.DataFrame([own])], ignore_index=True)


def _count_pairs(rows: pd.DataFrame) -> pd.DataFrame:
    """Per piece the levels of its pairs."""
    distinct, places, total, lengths = _totals(rows)
    levels = _replies(probed(distinct, total)[places], np.cumsum(lengths), lengths)
    return pd.DataFrame({"piece": rows["piece"], "bucket": rows["bucket"], "levels": levels})


class Model:
    """A piece's quantised counts, as the filters have replied, and a few numbers."""

    def __init__(self, row: dict, docs: int, space: float, weights: np.ndarray):
        counts = np.concatenate([[0], LEVELS])
        self.word, self.pair = (counts[_of(row[name], "levels", np.uint16)] for name in ("replies", "pair_replies"))
        self.docs = docs  # trained on; the count of the end
        self.space = space
        self.weights = weights

    def counts(self, piece: Piece, history: np.ndarray, token: np.ndarray):
        """Quantised counts of the histories, tokens and wholes of all distinct pairs, and the place
        of each token's pair among them. A pair has at most the counts of its words."""
        word = np.append(self.word, self.docs)
        hashes, places, first, second = piece.pairs(history, token)
        of_history, of_token = word[first], word[second]
        pair = np.empty(len(hashes), np.int64)
        pair[np.argsort(hashes)] = self.pair  # replies are in the order of the hashes
        return of_history, of_token, np.minimum(pair, np.minimum(of_history, of_token)), places

    @staticmethod
    def bins(of_history: np.ndarray) -> np.ndarray:
        return np.minimum(np.log2(np.maximum(of_history, 1)).astype(np.int64), BINS - 1)

    def log_probability(self, piece: Piece, history: np.ndarray, token: np.ndarray) -> np.ndarray:
        of_history, of_token, pair, places = self.counts(piece, history, token)
        weight = np.where(of_history > 0, self.weights[self.bins(of_history)], 0.0)
        low = (of_token + ADDED) / self.space
        return np.log10(weight * pair / np.maximum(of_history, 1) + (1 - weight) * low)[places]

    def left_out(self, piece: Piece) -> np.ndarray:
        """Per bin and weight: log probability of the training tokens, each without itself."""
        history, token, doc = piece.sequence()
        of_history, of_token, pair, places = self.counts(piece, history, token)
        times = np.bincount(places[piece.trained()[doc]], minlength=len(pair))
        trained = times > 0
        of_history, of_token, pair, times = of_history[trained], of_token[trained], pair[trained], times[trained]
        low = (np.maximum(of_token - 1, 0) + ADDED) / self.space
        high = np.maximum(pair - 1, 0) / np.maximum(of_history - 1, 1)
        bins = self.bins(of_history)
        sums = [np.bincount(bins, times * np.log(w * high + (1 - w) * low), BINS) for w in WEIGHTS]
        return np.stack(sums, axis=1)


def _of(replies: list[dict], name: str, kind: type | None = None) -> np.ndarray:
    """One field of a piece's replies, of all buckets in order; without ``kind`` the exact counts."""
    parts = [
        np.frombuffer(r[name], kind or (np.uint32 if len(r[name]) == 4 * r["n"] else np.int64))
        for r in sorted(replies, key=lambda r: r["bucket"])
    ]
    return np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64)


def _left_out(docs: int, space: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            sums = Model(row, docs, space, np.zeros(BINS)).left_out(Piece(row))
            bins, weights = (a.reshape(-1) for a in np.indices(sums.shape))
            columns = [pa.array(bins), pa.array(weights), pa.array(sums.reshape(-1))]
            yield pa.RecordBatch.from_arrays(columns, ["bin", "weight", "value"])

    return run


def _scores(docs: int, space: float, weights: np.ndarray, tokens: int, types: int):
    names = ["key", "text_hash", "held_out", "n_tokens", "n_known", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            piece, m = Piece(row), Model(row, docs, space, weights)
            exact = np.append(_of(row["replies"], "data"), m.docs)
            history, token, doc = piece.sequence()
            n = len(piece.counts)
            count = exact[token]
            base = np.bincount(doc, np.log10(count + ADDED), n)
            base -= (piece.counts + 1) * np.log10(tokens + ADDED * (types + 1))
            score = np.bincount(doc, m.log_probability(piece, history, token), n)
            null = (piece.flags & NULL_KEY) > 0
            columns = [
                pa.array(piece.keys, mask=null), pa.array(piece.hashes), pa.array(~piece.trained()),
                pa.array(piece.counts + 1), pa.array(np.bincount(doc, count > 0, n).astype(np.int64)),
                pa.array(base), pa.array(score),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the documents that are not held out and score all of them.

    Held out are those whose crc32(key as text) is 0 modulo 10 (a null key is an empty text, so held
    out). Returns a row for every row: ``key``, ``text_hash``, ``held_out``, ``n_tokens`` (words and the end),
    ``n_known``, ``train_tokens``, ``base_score`` (add-0.1 unigrams, exact counts) and ``score``, the log10
    probability under ``w(h) * c(h, t) / c(h) + (1 - w(h)) * (c(t) + 0.1) / (N + 0.1 * (V + 1))`` with the
    counts c from the filters. The weight w of a pair estimate depends on the bin of its
    history's count and is the one of ``WEIGHTS`` that predicts the training tokens best when each
    is left out of its own counts. Null and empty texts consist of the end.

    Counts cover all training documents, and all their n-grams are in the filters, ``BITS`` bits for each
    entry. The filters grow with the corpus by the number of buckets; only sums and the weights go to
    the driver and to all workers. An empty table gives no rows.
    Words are told apart by 64-bit hashes, pairs by ``PAIR_BITS`` bits within their bucket.
    """
    spark = docs.sparkSession
    name = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    held = F.when(F.crc32(name.cast("binary")) % 10 == 0, HELD_OUT).otherwise(0)
    null = F.when(F.col(f"`{key}`").isNull(), NULL_KEY).otherwise(0)
    rows = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(0)).alias("key"),
        F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
        (held + null).cast("long").alias("flags"),
        F.col(f"`{text}`").alias("text"),
    )
    trained, size = rows.select(
        F.count_if(F.col("flags").bitwiseAND(HELD_OUT) == 0), F.sum(F.octet_length("text"))
    ).first()
    buckets = max(1, -(-(size or 0) // BUCKET_BYTES))
    # in buckets, so that the replies come to the pieces and these never move again
    pieces = bucketed(rows.mapInArrow(_pieces, PIECE_SCHEMA), "pieces", ["piece"])

    dealt = pieces.select(*NAMES).mapInArrow(_word_rows(buckets), DEALT)
    schema = "piece long, bucket long, data binary, levels binary, n long, tokens long"
    counted = written(dealt.groupBy("bucket").applyInPandas(_count_words, schema), "word_counts")
    own = counted.filter("piece = -1")
    tokens, types = own.select(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    tokens, types = tokens + trained, types + (trained > 0)

    dealt = pieces.select(*NAMES).mapInArrow(_pair_rows(buckets), DEALT)
    pairs = dealt.groupBy("bucket").applyInPandas(_count_pairs, "piece long, bucket long, levels binary")
    replies = counted.filter("piece >= 0").groupBy("piece")
    replies = replies.agg(F.collect_list(F.struct("bucket", "n", "data", "levels")).alias("replies"))
    pairs = pairs.groupBy("piece").agg(F.collect_list(F.struct("bucket", "levels")).alias("pair_replies"))
    both = bucketed(pairs.join(replies, "piece", "left"), "replies", ["piece"])
    replied = [F.coalesce(c, F.array()).alias(c) for c in ("replies", "pair_replies")]
    joined = pieces.join(both, "piece", "left").select(*NAMES, *replied)

    space = tokens + ADDED * (types + 1)
    weights = np.zeros(BINS)
    tried = joined.mapInArrow(_left_out(trained, space), "bin long, weight long, value double")
    for r in _best(tried):
        weights[r["bin"]] = WEIGHTS[r["weight"]]

    schema = "key long, text_hash long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    out = joined.mapInArrow(_scores(trained, space, weights, tokens, types), schema)
    return out.withColumnRenamed("key", key).withColumn("train_tokens", F.lit(tokens).cast("long"))


def _best(tried: DataFrame) -> list:
    """The weight with the highest sum for every bin; bins and weights are few."""
    sums = tried.groupBy("bin", "weight").agg(F.sum("value").alias("value"))
    return sums.groupBy("bin").agg(F.max_by("weight", F.struct(F.round("value", 3), -F.col("weight"))).alias("weight")).collect()
