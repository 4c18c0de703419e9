"""Distinct counts as bitmaps, against plain distinct counts."""

import random

from pyspark.sql import functions as F

from debutrank.operators.bitmaps import Counted, distinct_counts, merge_words, words

COUNTED = {"lines": Counted("line", within="order"), "parts": Counted("part")}


def rows_for(seed, n=600):
    rng = random.Random(seed)
    edges = [None, 0, 63, 64, -1, -64, -65, 2**40, 2**63 - 1, -(2**63)]

    def number():
        return rng.choice(edges) if rng.random() < 0.3 else rng.randint(-200, 200)

    return [
        (rng.choice([1, 1, 1, 2, 3, None]), rng.choice([7, 8, None]), number(), number(), number()) for _ in range(n)
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, p int, order long, line long, part long")


def expected(rows):
    out = {}
    for k, p, order, line, part in rows:
        lines, parts = out.setdefault((k, p), (set(), set()))
        if order is not None and line is not None:
            lines.add((order, line))
        if part is not None:
            parts.add(part)
    return {key: tuple(map(len, sets)) for key, sets in out.items() if any(sets)}


def counts(table):
    got = distinct_counts(table, ["k", "p"], list(COUNTED)).collect()
    return {(r.k, r.p): (r.lines, r.parts) for r in got}


def test_counts(spark):
    rows = rows_for(1)
    assert counts(words(frame(spark, rows), ["k", "p"], COUNTED)) == expected(rows)
    assert counts(words(frame(spark, []), ["k", "p"], COUNTED)) == {}
    assert counts(words(frame(spark, [(1, 1, None, 4, None)]), ["k", "p"], COUNTED)) == {}


def test_merging_batches(spark):
    """Words of batches merge into those of all rows, also where batches overlap."""
    batches = [rows_for(2, 200), rows_for(3, 300), rows_for(2, 50)]
    parts = [words(frame(spark, b), ["k", "p"], COUNTED) for b in batches]
    merged = merge_words(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["k", "p"])
    everything = [r for b in batches for r in b]
    assert counts(merged) == expected(everything)
    whole = words(frame(spark, everything), ["k", "p"], COUNTED)
    assert merged.exceptAll(whole).count() == 0 and whole.exceptAll(merged).count() == 0


def test_a_hot_key_is_a_word_per_64_numbers(spark):
    df = spark.range(20_000, numPartitions=4).select(F.lit(1).alias("k"), (F.col("id") % 640).alias("n"))
    table = words(df, ["k"], {"n": Counted("n")})
    assert table.count() == 10
    assert distinct_counts(table, ["k"], ["n"]).first()["n"] == 640
