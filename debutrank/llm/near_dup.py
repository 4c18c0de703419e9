"""MinHash near-duplicates with tensored banding.

Two collections of ``GROUPS`` short groups of minhashes are computed; every pair of a group from
the one and a group from the other is a table, so 100 tables cost 40 minhashes instead of 400. Two sets
of similarity s share a table with probability ``(1 - (1 - s**2)**10)**2``: 0.9994 at 0.75, 0.99993 at 0.8. What
the tables propose is confirmed on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from debutrank.llm import kernels as K
from debutrank.llm.components import components
from debutrank.session import written

SHINGLE = 5
PERCENT = 75  # shared of all shingles of a pair, at least
GROUPS = 10  # in each of the two collections
DEPTH = 2  # minhashes in a group
FIRST_PART = 16  # of the partners in the exact filter's first round; the second one takes all
PROPOSALS = 10  # that are confirmed for a node before the exact filter

_SALTS = K.mix(np.arange(1, 2 * GROUPS * DEPTH + 1, dtype=K.U64) * K.U64(0x9E3779B97F4A7C15))
_FACTORS = K.mix(_SALTS) | K.U64(1)


def shingles(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of every text (not yet distinct), and where each text's begin."""
    data, offsets = K.joined(texts)
    words = K.spans(data, offsets)
    codes = K.between(K.running(K.byte_codes(fold_case=True)[data]), words.start, words.end)
    at = K.gram_starts(words.first, width)
    counts = words.counts
    made = np.maximum(counts - width + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < width))
    made[short] = 1
    first = np.concatenate([[0], np.cumsum(made)])
    out = np.empty(first[-1], K.U64)
    whole = np.zeros(first[-1], bool)
    whole[first[short]] = True
    out[~whole] = K.grams(codes, width)[at]
    if len(short):
        total = K.running(codes)
        out[whole] = K.between(total, words.first[short], words.first[short + 1])
    return out, first


def sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    hashes, first = shingles(texts)
    return [np.unique(hashes[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


def _least(hashes: np.ndarray, starts: np.ndarray, salt: np.uint64, factor: np.uint64) -> np.ndarray:
    values = hashes ^ salt
    values *= factor
    return np.minimum.reduceat(values, starts)


def _signatures(texts: pa.Array) -> list[pa.Array]:
    """Per text: size and two digests of its set, and the two collections of groups."""
    hashes, first = shingles(texts)
    n = len(first) - 1
    filled = np.flatnonzero(np.diff(first))
    unique = [np.unique(hashes[first[i] : first[i + 1]]) for i in filled.tolist()]
    sizes = np.zeros(n, np.int64)
    sizes[filled] = [len(u) for u in unique]
    digests = np.zeros((2, n), K.U64)
    groups = np.zeros((2 * GROUPS, len(filled)), K.U64)
    if len(filled):
        flat = np.concatenate(unique)
        starts = np.cumsum(np.concatenate([[0], sizes[filled][:-1]]))
        for i in range(2):
            digests[i, filled] = np.add.reduceat(K.mix(flat + K.U64(i + 11)), starts)
        for g in range(2 * GROUPS):
            code = np.zeros(len(filled), K.U64)
            for j in range(g * DEPTH, (g + 1) * DEPTH):
                code = K.mix(code + _least(flat, starts, _SALTS[j], _FACTORS[j]))
            groups[g] = code
    out = [pa.array(sizes), *(pa.array(d.view(np.int64)) for d in digests)]
    bounds = np.zeros(n + 1, np.int32)
    bounds[1:][filled] = GROUPS
    bounds = np.cumsum(bounds).astype(np.int32)
    for half in (groups[:GROUPS], groups[GROUPS:]):
        values = pa.array(np.ascontiguousarray(half.T).reshape(-1).view(np.int64))
        out.append(pa.ListArray.from_arrays(pa.array(bounds), values))
    return out


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text_hash, n_shingles, node, check, left, right): ``node`` is a digest of the set."""
    narrow = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash")
    )
    schema = f"key {narrow.schema['key'].dataType.simpleString()}, text_hash long, n_shingles long, node long, check long, left array<long>, right array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "text_hash", "n_shingles", "node", "check", "left", "right"]
        for batch in batches:
            for part in K.pieces(batch):
                columns = [part.column("key"), part.column("text_hash"), *_signatures(part.column("text"))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return narrow.mapInArrow(run, schema)


def _keys(nodes: DataFrame) -> DataFrame:
    """(table, node): the key of every pair of a left and a right group."""
    left = nodes.select("node", "right", F.posexplode("left").alias("i", "x"))
    both = left.select("node", "i", "x", F.posexplode("right").alias("j", "y"))
    return both.select(F.xxhash64("i", "j", "x", "y").alias("table"), "node")


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps the pairs whose full sets share enough."""
    for batch in batches:
        for part in K.pieces(batch, "text_a"):
            keep = []
            for a, b in zip(sets(part.column("text_a")), sets(part.column("text_b"))):
                shared = len(a) + len(b) - len(np.union1d(a, b))
                keep.append(100 * shared >= PERCENT * (len(a) + len(b) - shared))
            yield part.select(["a", "b"]).filter(pa.array(keep))


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that are linked, by their texts."""
    text_a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    text_b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(text_a, "a").join(text_b, "b").mapInArrow(_similar, "a long, b long")


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component yet."""
    of_a = label.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    of_b = label.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    joined = pairs.join(of_a, "a", "left").join(of_b, "b", "left")
    return joined.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select(*pairs.columns)


def _exploded(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(shingle, node, component, size) of the distinct shingles of some nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.pieces(batch):
                own = sets(part.column("text"))
                size = np.array([len(u) for u in own], np.int64)
                columns = [np.concatenate(own).view(np.int64)] if own else [np.zeros(0, np.int64)]
                columns += [np.repeat(part.column(c).to_numpy(), size) for c in ("node", "component")]
                arrays = [pa.array(c) for c in (*columns, np.repeat(size, size))]
                yield pa.RecordBatch.from_arrays(arrays, ["shingle", "node", "component", "size"])

    rows = nodes.join(texts, "node").select("node", "component", "text")
    return rows.mapInArrow(run, "shingle long, node long, component long, size long")


def _unsettled(member: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of the tables that hold several components; and of these the nodes that are not in the
    largest component of such a table. Every pair to be looked at has one of the latter."""
    counted = member.groupBy("table", "component").agg(F.count("*").alias("n"))
    largest = counted.groupBy("table").agg(
        F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("components")
    )
    largest = largest.filter("components > 1").select("table", F.col("top.component").alias("largest"))
    rows = member.join(largest, "table")
    inside = rows.select("node", "component").distinct()
    return inside, rows.filter("component <> largest").select("node").distinct()


def _prefixes(inside: DataFrame, texts: DataFrame) -> DataFrame:
    """(shingle, node, size, rank): the prefix of every set, all sets being ordered alike, rare
    shingles first. A shingle that no other set has is left out, as it meets nothing."""
    rows = written(_exploded(inside, texts), "shingles")
    count = written(rows.groupBy("shingle").agg(F.count("*").alias("n")), "rarity")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("n", "shingle"))
    least = F.ceil(F.col("size") * PERCENT / 100)
    prefix = rows.join(count, "shingle").withColumn("rank", rank)
    prefix = prefix.filter((F.col("rank") <= F.col("size") - least + 1) & (F.col("n") > 1))
    return written(prefix.select("shingle", "node", "size", "rank"), "prefixes")


def _by_prefix(prefix: DataFrame, outer: DataFrame, label: DataFrame, part: int) -> DataFrame:
    """Pairs (a, b) of nodes in different components, one of them in ``outer``, that may be linked.

    Of the possible partners only one in ``part`` is looked at. Partners share ``PERCENT`` of either set, so they
    share a shingle in both prefixes, the first (100 - ``PERCENT``) % and one more. At the first shared
    shingle, what follows it in both sets has to be long enough for the shared part of a link; this
    is asked of every shared shingle, as a linked pair passes at its first one. Sets that share
    common passages and little else have shingles of their own in front and give no pair. No
    link is lost, whatever the tables say.
    """
    named = prefix.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    prefix = written(named, "named_prefixes")
    one = prefix.join(outer, "node", "left_semi").select(
        "shingle", F.col("node").alias("a"), F.col("component").alias("ca"), F.col("size").alias("sa"),
        F.col("rank").alias("ra"),
    )
    other = prefix.filter(F.pmod(F.xxhash64("node"), F.lit(part)) == 0).select(
        "shingle", F.col("node").alias("b"), F.col("component").alias("cb"), F.col("size").alias("sb"),
        F.col("rank").alias("rb"),
    )
    most = 1 + F.least(F.col("sa") - F.col("ra"), F.col("sb") - F.col("rb"))
    near = (F.col("ca") != F.col("cb")) & ((100 + PERCENT) * most >= PERCENT * (F.col("sa") + F.col("sb")))
    same = (F.col("one.shingle") == F.col("other.shingle")) & near
    pairs = one.alias("one").join(other.alias("other"), same)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _links(nodes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """Components (node, component) over all links between different sets.

    1. Every node of a table is proposed to the table's smallest node, not to all the others.
    2. For each node the proposal that shares most tables is confirmed, then the next ``PROPOSALS`` - 1 where
       the ends are still apart.
    3. Where tables still hold several components, an exact prefix filter finds what is left, so no
       link is lost. Pairs inside a component need no test.
    """
    table = Window.partitionBy("table")
    stars = _keys(nodes).withColumn("a", F.min("node").over(table)).withColumn("last", F.max("node").over(table))
    # tables of one node go; the smallest node of another is kept, though it proposes itself to nobody
    stars = stars.filter("a <> last").groupBy(F.col("node").alias("b"), "a").agg(F.count("*").alias("n"))
    # a node is in GROUPS ** 2 tables, so it has no more proposals than that
    ranked = F.sort_array(F.collect_list(F.when(F.col("a") != F.col("b"), F.struct("n", "a"))), asc=False)
    stars = written(stars.groupBy("b").agg(F.slice(ranked, 1, PROPOSALS).alias("best")), "stars")
    pairs = stars.select("b", F.posexplode("best").alias("place", "p")).select("place", F.col("p.a").alias("a"), "b")
    ends = stars.select(F.col("b").alias("node"))  # all that share a table with another, whatever was cut off

    chosen = nodes.join(ends, "node", "left_semi").select(
        "node", F.col("min_key").alias("_key"), F.col("min_hash").alias("_hash")
    )
    rows = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash")
    )
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("text_hash") == F.col("_hash"))
    texts = written(rows.join(chosen, same).select("node", "text").dropDuplicates(["node"]), "texts")

    links = written(_confirmed(pairs.filter("place = 0"), texts), "links")
    label = components(links)
    more = written(_confirmed(_apart(pairs.filter("place > 0").select("a", "b"), label), texts), "links")
    if not more.isEmpty():
        links = links.union(more)
        label = components(links)

    member = _keys(nodes.join(ends, "node", "left_semi")).join(label, "node", "left")
    member = written(member.select("table", "node", F.coalesce("component", "node").alias("component")), "members")
    inside, outer = (written(x, "unsettled") for x in _unsettled(member))
    prefix = _prefixes(inside, texts)
    # a node that is linked with many finds one of them in a part, and is settled; then all are tried
    for part in (FIRST_PART, 1):
        found = written(_confirmed(_by_prefix(prefix, outer, label, part), texts), "links")
        if not found.isEmpty():
            links = links.union(found)
            label = components(links)
    return label


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add to every document its set size, class and component.

    Returns ``key``, ``text_hash`` (xxhash64 of the text), ``n_shingles``, ``component`` (the smallest
    key reachable over links, its own included) and ``kept`` (its key is the component's). Documents
    are linked if their distinct five-word shingles share ``PERCENT`` of the union; a text
    of fewer words is one shingle. Null and empty texts have no shingles, are linked with nothing and
    stay. Documents with equal sets are one node from the start, so a group of copies, however
    large, is one row in all that follows. Repeated rows get the same result. Null keys are
    passed over in the minimum; a component of null keys only is null and its documents stay.

    Sets are compared by 64-bit hashes of their shingles, nodes by 64-bit digests of the sets.
    """
    signed = written(signatures(docs, key, text), "signatures")
    filled = signed.filter("n_shingles > 0")
    nodes = filled.groupBy("node").agg(
        F.min("key").alias("low"),
        F.min(F.struct("key", "text_hash")).alias("first"),
        F.first("left").alias("left"),
        F.first("right").alias("right"),
    )
    nodes = written(
        nodes.select("node", "low", F.col("first.key").alias("min_key"), F.col("first.text_hash").alias("min_hash"), "left", "right"),
        "nodes",
    )
    label = _links(nodes, docs, key, text)
    lows = nodes.select("node", "low").join(label, "node", "left")
    lows = lows.select("node", "low", F.coalesce("component", "node").alias("component"))
    groups = lows.groupBy("component").agg(F.min("low").alias("group_low"))
    lows = written(lows.join(groups, "component").select("node", "group_low"), "lows")
    named = signed.join(lows, ["node"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("group_low")).otherwise(F.col("key"))
    named = named.select(F.col("key").alias(key), "text_hash", "n_shingles", component.alias("component"))
    return named.withColumn("kept", F.col("component").isNull() | F.col(key).eqNullSafe(F.col("component")))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one document of each component, with all their columns, whatever their names.

    Texts without words are no one's duplicates and stay, as do the rows of a component without any key. Rows with the
    key and text of the one that stays all stay; an empty table stays empty.
    """
    gone = near_duplicates(docs, key, text).filter("NOT kept")
    gone = gone.select(F.col(key).alias("_gone_key"), F.col("text_hash").alias("_gone_hash")).distinct()
    same = docs[key].eqNullSafe(gone["_gone_key"]) & (F.xxhash64(docs[text]) == gone["_gone_hash"])
    return docs.join(gone, same, "left_anti")
