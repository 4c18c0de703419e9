"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

A window of a benchmark item is contained in a document only if its rarest shingle is. Shingles
(single words here) are ordered by how often the documents have them; each window gives its
first in that order, the one prefix token that exact containment needs, to the join. What the
join finds is cut by length and position and then compared word by word.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debutrank.session import written

WINDOW = 10
BROADCAST_BYTES = 32 << 20  # of words in the windows; beyond it the joins shuffle

_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> Column:
    """Lower-cased (A-Z only) words of a text; a null has none."""
    folded = F.translate(F.col(text), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(F.array_remove(F.split(folded, _BREAKS), ""), F.array().cast("array<string>"))


def windows_of(benchmark: DataFrame, item: str, text: str, width: int) -> DataFrame:
    """Distinct (item, window): all runs of ``width`` words, or the whole of a shorter item."""
    items = benchmark.select(F.col(f"`{item}`").alias("item"), words_of(f"`{text}`").alias("words"))
    last = F.greatest(F.size("words") - F.lit(width), F.lit(0))
    at = F.explode(F.sequence(F.lit(0), last)).alias("at")
    rows = items.filter(F.size("words") > 0).select("item", "words", at)
    return rows.select("item", F.slice("words", F.col("at") + 1, width).alias("window")).distinct()


def _words(documents: DataFrame) -> DataFrame:
    return documents.select("row", "n_words", "words", F.posexplode("words").alias("at", "word"))


def _prefixes(windows: DataFrame, documents: DataFrame, small: bool) -> DataFrame:
    """Per distinct window: its number, length, prefix token and the token's place in it.

    A window with a word that no document has cannot occur and is left out.
    """
    rows = written(
        windows.select("window").distinct().withColumn("id", F.monotonically_increasing_id()), "windows"
    )
    tokens = rows.select("id", F.posexplode("window").alias("place", "word"))
    vocabulary = tokens.select("word").distinct()
    words = documents.select(F.explode("words").alias("word"))
    found = words.join(F.broadcast(vocabulary) if small else vocabulary, "word", "left_semi")
    rarity = written(found.groupBy("word").agg(F.count("*").alias("n")), "rarity")
    ranked = tokens.join(rarity, "word", "left")
    first = ranked.groupBy("id").agg(
        F.min(F.struct("n", "word", "place")).alias("first"), F.count_if(F.col("n").isNull()).alias("absent")
    )
    first = first.filter("absent = 0")
    return rows.join(first, "id").select(
        "id", "window", F.size("window").alias("width"), "first.word", F.col("first.place").alias("place")
    )


def _matches(documents: DataFrame, prefixes: DataFrame, small: bool) -> DataFrame:
    """Verified occurrences (row, start, width, id) of the windows."""
    start = F.col("at") - F.col("place")
    inside = (start >= 0) & (start + F.col("width") <= F.col("n_words"))
    equal = F.slice("words", F.col("start") + 1, F.col("width")) == F.col("window")
    if small:
        found = _words(documents).join(F.broadcast(prefixes), "word").filter(inside)
        return found.withColumn("start", start).filter(equal).select("row", "start", "width", "id")
    # the words of a document travel once for all its candidates, not with every word
    found = _words(documents).drop("words").join(prefixes.drop("window"), "word").filter(inside)
    found = found.withColumn("start", start).select("row", "start", "width", "id")
    found = found.join(documents.select("row", "words"), "row").join(prefixes.select("id", "window"), "id")
    return found.filter(equal).select("row", "start", "width", "id")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """For every document: the words hit by benchmark windows, and the items they are from.

    Returns ``key``, ``text_hash`` (xxhash64 of the text), ``n_words``, ``n_hit``, ``n_items`` and
    ``items`` (item keys as strings, sorted). Every row of ``docs`` gives one row, repeated
    keys too. A null or empty text has no words and is never hit; a null or empty item has no
    windows; a null item key is not listed but its windows hit. Empty tables give an empty result or
    no hits. Columns other than the named ones are ignored.

    Documents are split into words once and written to the shared folder. Windows and prefix
    tokens are broadcast if their words, counted before, are at most ``broadcast_bytes``; else
    both joins shuffle, with the same result.
    """
    split = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
        words_of(f"`{text}`").alias("words"),
        F.monotonically_increasing_id().alias("row"),
    )
    documents = written(split.withColumn("n_words", F.size("words")), "words")
    windows = written(windows_of(benchmark, item, item_text, width), "item_windows")
    volume = windows.select(F.sum(F.octet_length(F.array_join("window", " ")) + 64)).first()[0]
    small = (volume or 0) <= broadcast_bytes
    prefixes = written(_prefixes(windows, documents, small), "prefixes")
    found = written(_matches(documents, prefixes, small), "matches")

    spans = found.select("row", F.struct("start", (F.col("start") + F.col("width")).alias("end")).alias("span"))
    union = """aggregate(spans, named_struct('n', 0L, 'reach', 0),
        (a, s) -> named_struct('n', a.n + greatest(0, s.end - greatest(a.reach, s.start)),
                               'reach', greatest(a.reach, s.end)), a -> a.n)"""
    hits = spans.groupBy("row").agg(F.sort_array(F.collect_set("span")).alias("spans"))
    hits = hits.select("row", F.expr(union).alias("n_hit"))
    owners = windows.join(prefixes.select("id", "window"), "window").select("id", "item")
    names = found.select("row", "id").distinct().join(owners, "id")
    names = names.groupBy("row").agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
    none = F.array().cast("array<string>")
    return (
        documents.select("row", "key", "text_hash", "n_words")
        .join(hits, "row", "left")
        .join(names, "row", "left")
        .select(
            F.col("key").alias(key),
            "text_hash",
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
            F.coalesce("items", none).alias("items"),
        )
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The rows of ``docs`` without a hit, with all their columns, whatever their names.

    Null and empty texts stay. Equal rows, also those of a null key, stay or go together; an empty benchmark takes nothing.
    """
    hit = contamination(docs, benchmark, key, text, **names).filter("n_hit > 0")
    hit = hit.select(F.col(key).alias("_hit_key"), F.col("text_hash").alias("_hit_hash")).distinct()
    same = docs[key].eqNullSafe(hit["_hit_key"]) & (F.xxhash64(docs[text]) == hit["_hit_hash"])
    return docs.join(hit, same, "left_anti")
