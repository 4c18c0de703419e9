import random

import pytest

CLASHING = (
    "key text_hash size shard slot row kept n_words node place component rate copies spans "
    "number part anchor bucket item window kinds target _hit_key _gone_hash _mix_copies before hash held"
).split()


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeimnorst") for _ in range(rng.randint(2, 7))) for _ in range(n))


def make_texts():
    rng = random.Random(7)
    passages = [prose(rng, rng.randint(10, 45)) for _ in range(6)]
    rows = []
    for i in range(46):
        parts = [prose(rng, rng.randint(3, 60))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), prose(rng, rng.randint(0, 12))]
        rows.append((i * 3, rng.choice([" ", "\n", " \n"]).join(parts)))
    base = prose(rng, 120)
    for i in range(8):  # near copies, some of them too far from one another
        words = base.split()
        for _ in range(i):
            words[rng.randrange(len(words))] = "x" + str(rng.randrange(99))
        rows.append((1000 - i, " ".join(words)))
    rows += [
        (7, None), (8, ""), (10, "   \n\t "), (11, "one"), (14, "Four words are here"), (None, base), (None, None),
        (17, rows[0][1]), (17, rows[0][1]), (20, rows[0][1].upper()), (20, passages[0]), (23, "ab" * 5000),
        (26, "\n".join([passages[1], passages[2], ""] * 3)), (29, "é ü ß Ñandú " * 30), (32, prose(rng, 9000)),
    ]
    return rows


@pytest.fixture(scope="session")
def texts():
    return make_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"{c} string" for c in CLASHING
    )
    rng = random.Random(3)
    sources = ["s1", "s2", "s2", "s2", None, "é"]
    rows = [
        (k, t, None, rng.choice(sources), None if t is None else len(t), *["x"] * len(CLASHING)) for k, t in texts
    ]
    return spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
