"""Spelling variants: words one edit apart, found by variable-length grams.

A dictionary holds the frequent grams of the vocabulary. A word is decomposed into the longest grams of the
dictionary that start at its places, without those that lie inside another one. An edit at a place of
the word can change only few of them: those that overlap it, and a neighbour that a longer gram of the dictionary
could replace. All others are in the decomposition of the other word too, at the same distance from the
left or the right end. So the lists of the grams that an edit leaves alone, for each place of
an edit, are merged at once: their key is the last of them on the left and the first on the
right, with what they end and begin. Words that share a key are verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debutrank.session import written

SHORTEST, LONGEST = 2, 4  # grams
DICTIONARY = 100_000  # at most that many grams of each length are frequent
LEFT, RIGHT = "\x01", "\x02"  # fill a word up at its ends
HOLE = "\x03"
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "A-Za-zÀ-ÿ"


def runs(docs: DataFrame, text: str = "text", name: str = "run") -> DataFrame:
    """A row for each maximal run of letters of every whole text, A-Z lower-cased, with the other columns.

    A null or empty text has none. An input column of that name is replaced.
    """
    kept = [f"`{c}`" for c in docs.columns if c not in (text, name)]
    parts = F.split(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), f"[^{LETTERS}]+")
    return docs.select(*kept, F.explode(parts).alias(name)).filter(F.col(name) != "")


def counted(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of a table of occurrences ``word``: those long and frequent enough. Nulls are left out."""
    return (
        words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
        .filter(F.col("n") >= least_count)
    )


def dictionary(words: DataFrame, size: int = DICTIONARY) -> set[str]:
    """Frequent grams of the words: at most ``size`` of each length, whatever the vocabulary.

    Each length has as many occurrences as there are places. A gram is frequent from the ``size``-th part of them on.
    A part of a frequent gram is frequent, which the decomposition relies on.
    """
    filled = words.select(F.concat(F.lit(LEFT * LONGEST), "word", F.lit(RIGHT * LONGEST)).alias("w"))
    places = filled.agg(F.sum(F.length("w"))).first()[0] or 0
    grams = F.flatten(
        F.array(*[
            F.transform(F.sequence(F.lit(1), F.length("w") - (q - 1)), _gram(q))
            for q in range(SHORTEST, LONGEST + 1)
        ])
    )
    frequent = (
        filled.select(F.explode(grams).alias("gram")).groupBy("gram").count()
        .filter(F.col("count") >= max(2, -(-places // size)))
    )
    return {r.gram for r in frequent.select("gram").toLocalIterator()}


def _gram(q: int):
    return lambda at: F.substring(F.col("w"), at, F.lit(q))


class Grams:
    """The dictionary with what may come before and after its grams."""

    def __init__(self, frequent: set[str]):
        self.frequent = frequent
        self.grows_right = {g[:-1] for g in frequent}
        self.grows_left = {g[1:] for g in frequent}

    def decompose(self, filled: str) -> list[tuple[int, int]]:
        """(start, end) of the word's grams: the longest from each place, none inside another."""
        out, reach, n = [], 0, len(filled)
        for a in range(n - SHORTEST + 1):
            b = a + SHORTEST
            while b < n and b - a < LONGEST and filled[a : b + 1] in self.frequent:
                b += 1
            if b > reach:
                out.append((a, b))
                reach = b
        return out

    def unaffected(self, filled: str) -> tuple[list[int], list[int]]:
        """By place: the end of the last gram on the left that an edit there leaves alone, and of the first on the right its start."""
        n = len(filled)
        left, right = [0] * (n + 2), [n] * (n + 2)
        for a, b in self.decompose(filled):
            gram = filled[a:b]
            left[b + (gram in self.grows_right)] = b
            low = a - (gram in self.grows_left)
            if low > 0:
                right[low - 1] = min(right[low - 1], a)
        for i in range(1, n + 2):
            left[i] = max(left[i], left[i - 1])
        for i in range(n, -1, -1):
            right[i] = min(right[i], right[i + 1])
        return left, right

    def keys(self, word: str) -> tuple[list[str], list[str]]:
        """Keys for an edit of each character, and for a character that is missing at each place."""
        filled = LEFT * LONGEST + word + RIGHT * LONGEST
        left, right = self.unaffected(filled)

        def key(before: int, after: int) -> str:
            a, b = max(left[before] - LONGEST, 0), max(right[after] - LONGEST, 0)
            return f"{word[:a]}{HOLE}{word[b:]}"

        first, last = LONGEST, LONGEST + len(word)
        edits = {key(i, i) for i in range(first, last)}
        gaps = {key(i + 1, i) for i in range(first - 1, last)}
        return sorted(edits), sorted(gaps)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): all pairs of different words with exactly one edit between them, each pair once.

    ``words`` has (word, n), each word once, and is read twice.
    """
    table = words.sparkSession.sparkContext.broadcast(dictionary(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(table.value)
        for batch in batches:
            for low in range(0, batch.num_rows, 5000):
                part = batch.slice(low, 5000)
                found = [grams.keys(w) for w in part.column("word").to_pylist()]
                lists = [pa.array([f[i] for f in found], pa.list_(pa.string())) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([part.column("word"), part.column("n"), *lists], [*"wneg"])

    keyed = words.select("word", "n").mapInArrow(run, "w string, n long, e array<string>, g array<string>")
    rows = written(
        keyed.select("w", "n", F.explode(F.concat(_hashes("e", True), _hashes("g", False))).alias("k")).select(
            "w", "n", "k.key", "k.edit"
        ),
        "variant_keys",
    )
    one = rows.filter("edit").select("key", F.col("w").alias("a"), F.col("n").alias("a_n"))
    other = rows.select("key", F.col("w").alias("b"), F.col("n").alias("b_n"), "edit")
    replaced = F.col("edit") & (F.length("a") == F.length("b")) & (F.col("a") < F.col("b"))
    inserted = ~F.col("edit") & (F.length("a") == F.length("b") + 1)
    verified = (replaced | inserted) & (F.levenshtein("a", "b", 1) == 1)
    pairs = one.join(other, (one["key"] == other["key"]) & verified)
    return pairs.select("a", "a_n", "b", "b_n").dropDuplicates(["a", "b"])


def _hashes(keys: str, edit: bool) -> Column:
    return F.transform(keys, lambda k: F.struct(F.xxhash64(k).alias("key"), F.lit(edit).alias("edit")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of forms, by doubling the steps taken.

    ``forms`` has (word, form), without cycles, the forms of a chain being ever more frequent.
    """
    steps = written(forms.select("word", F.col("form").alias("root")), "variant_roots")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = steps.join(on, "root", "left")
        done = F.col("next").isNull()
        steps = written(
            further.select("word", F.coalesce("next", "root").alias("root"), done.alias("done")), "variant_roots"
        )
        if steps.filter("NOT done").isEmpty():
            return steps.select("word", "root")


def group(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for a table of (word, n).

    Two words are near if exactly one inserted, deleted or replaced code point lies between them. ``n_near``
    counts a word's near words; ``form`` is the one of largest ``n`` (ties: the smallest in code-point order),
    if that is at least ``ratio`` times the word's own and larger; ``root`` follows the forms to the last.

    Null words are left out, repeated words count together, a null ``n`` is 0, an empty table gives no rows.
    Only the dictionary, bounded by ``DICTIONARY``, is gathered and broadcast. Runs jobs when it is called.
    """
    own = words.filter("word IS NOT NULL").groupBy("word").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    own = written(own, "variant_words")
    pairs = near_pairs(own)
    back = pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n"))
    order = F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form"), F.col("b_n").alias("form_n"))
    near = pairs.unionByName(back).groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(order).alias("best")
    )
    enough = (F.col("best.form_n") >= ratio * F.col("n")) & (F.col("best.form_n") > F.col("n"))
    best = [F.when(enough, F.col(f"best.{c}")).alias(c) for c in ("form", "form_n")]
    judged = written(
        own.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *best),
        "variant_forms",
    )
    chains = roots(judged.filter("form IS NOT NULL").select("word", "form"))
    return judged.join(chains, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
