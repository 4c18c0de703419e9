import pytest
from pyspark.sql import functions as F

from debutrank.categories import Bonus, Category, Threshold
from debutrank.operators import dedupe, documents, joins, numbering, profile, ranking, rollup, runs
from debutrank.operators.scoring import score_entities
from debutrank.sources import batches
from tests import brute

SEASONS = {
    # "a": unbroken for five years, of which four count; "b": gap after the second year;
    # "c": never passes; "d": single year; "e": debut, then a long gap.
    ("a", 1): (9.0, 10.0), ("a", 2): (8.0, 9.0), ("a", 3): (7.0, 9.0), ("a", 4): (9.0, 2.0),
    ("a", 5): (100.0, 99.0), ("b", 1): (4.0, 8.0), ("b", 2): (5.0, 0.0), ("b", 4): (50.0, 60.0),
    ("c", 2): (1.0, 1.0), ("d", 4): (70.0, 30.0), ("e", 1): (8.0, 3.0), ("e", 9): (99.0, 99.0),
}
STATS = ["x", "y"]
PLAIN = Category("plain", "pla", {"x": 0.6, "y": 0.4}, (Threshold("x"), Threshold("y", ">", 0.5)))
BONUS = Category("bonus", "bon", {"x": 1.0}, (Threshold("x", factor=0.5),), (Bonus("y", 0.2, -1),))
OPEN = Category("open", "ope", {"y": 1.0})


@pytest.fixture(scope="module")
def seasons(spark):
    rows = [(e, p, *v) for (e, p), v in SEASONS.items()]
    return spark.createDataFrame(rows, "entity string, period int, x double, y double")


@pytest.fixture(scope="module")
def expected():
    data = {k: dict(zip(STATS, v)) for k, v in SEASONS.items()}
    prof = brute.profile_of(data, STATS)
    entities = sorted({e for e, _ in data})

    def scores(c):
        return {e: brute.score_of(e, data, prof, c) for e in entities}

    return prof, scores


def test_profile(seasons, expected):
    prof, _ = expected
    for row in profile.profile(seasons, stats=STATS).collect():
        for s in STATS:
            got = [row[f"{s}_{op}"] for op in profile.OPS]
            assert got == pytest.approx(list(prof[row.period][s]))


def test_profile_in_passes(spark, seasons):
    rows = seasons.unionByName(spark.sql("SELECT 'f' entity, CAST(NULL AS INT) period, 1D x, 2D y"))
    whole = profile.profile(rows, stats=STATS)
    split = profile.profile(rows, stats=STATS, stats_per_pass=1)
    assert split.columns == whole.columns
    assert sorted(split.collect(), key=repr) == sorted(whole.collect(), key=repr)


def test_profile_of_one_row_has_no_variance(seasons):
    row = profile.profile(seasons.filter("entity = 'e' AND period = 9"), stats=STATS).first()
    assert row.x_variance == 0.0 and row.x_mean == 99.0


def test_profile_counts_missing_as_zero(spark):
    rows = spark.createDataFrame([(1, None), (1, 4.0)], "period int, x double")
    row = profile.profile(rows, stats=["x"]).first()
    assert (row.x_mean, row.x_min, row.x_max) == (2.0, 0.0, 4.0)


def test_profile_rejects_unknown_measures(seasons):
    with pytest.raises(ValueError, match="median"):
        profile.profile(seasons, stats=STATS, ops=["median"])


@pytest.mark.parametrize("partitions", [1, 7])
def test_scores(seasons, expected, partitions):
    _, scores = expected
    prof = profile.profile(seasons, stats=STATS)
    categories = [PLAIN, BONUS, OPEN]
    got = score_entities(seasons.repartition(partitions), prof, categories).collect()
    for c in categories:
        want = scores(c)
        assert {r.entity: r[f"{c.short}_score"] for r in got} == pytest.approx(want)
    assert {r.entity: r.pla_score for r in got}["c"] == 0.0


def test_scores_scaled(seasons):
    prof = profile.profile(seasons, stats=STATS)
    row = {r.entity: r.ope_score for r in score_entities(seasons, prof, [OPEN], scaled=True).collect()}
    # "a": years 1..4, y scaled by the bounds of the year; year 3 has a single row (NULL).
    assert row["a"] == pytest.approx(100 * (1.0 + 1.0 + 0.0) / 4)


def test_rescale_shifts_negative_scores_only(spark):
    def scaled(values):
        df = spark.createDataFrame([(v,) for v in values], "score double")
        return sorted(r.score for r in ranking.rescale(df, "score").collect())

    assert scaled([-5.0, 0.0, 15.0]) == [0.0, 25.0, 100.0]
    assert scaled([5.0, 10.0]) == [50.0, 100.0]


def test_rescale_of_zeros_is_null(spark):
    df = spark.createDataFrame([(0.0,), (0.0,)], "score double")
    assert {r.score for r in ranking.rescale(df, "score").collect()} == {None}


@pytest.mark.parametrize("scores", [[-4.0, None, 6.0], [1.0, 5.0], [0.0, 0.0], [None], []])
def test_rescale_by_observed_extrema(spark, scores):
    df = spark.createDataFrame([(s, i) for i, s in enumerate(scores)], "score double, id int").repartition(3)
    want = sorted(ranking.rescale(df, "score").collect(), key=lambda r: r.id)
    assert sorted(ranking.rescale_written(df, "score", "s").collect(), key=lambda r: r.id) == want


def test_rescale_columns_does_not_shift(spark):
    df = spark.createDataFrame([(-2.0, 1.0), (4.0, 2.0)], "a double, b double")
    got = sorted(tuple(r) for r in ranking.rescale_columns(df, ["a", "b"]).collect())
    assert got == [(-50.0, 50.0), (100.0, 100.0)]


def test_group_sums_add_up(spark):
    scores = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 4.0)], "entity string, s double")
    people = spark.createDataFrame([("a", "g"), ("b", "g")], "entity string, grp string")
    got = ranking.group_sum_count(ranking.with_group(scores, people), "grp", "s").collect()
    assert {(r.grp, r.s, r.members) for r in got} == {("g", 3.0, 2), ("null", 4.0, 1)}


def test_sum_and_last_of_interrupted_groups(spark):
    rows = [("u", 1.0, 5.0, 0), ("v", 2.0, 6.0, 1), ("u", 3.0, 7.0, 2)]
    df = spark.createDataFrame(rows, "name string, score double, alumni double, line int")
    got = ranking.sum_and_last(df, "name", "score", "alumni", ["line"]).collect()
    assert {tuple(r) for r in got} == {("u", 4.0, 7.0), ("v", 2.0, 6.0)}


def test_dedupe(spark):
    df = spark.createDataFrame([("k", 1), ("k", 3), ("k", 2), ("m", 9)], "k string, v int")
    assert {tuple(r) for r in dedupe.dedupe_first(df, ["k"], ["v"]).collect()} == {("k", 1), ("m", 9)}
    assert {tuple(r) for r in dedupe.dedupe_last(df, ["k"], ["v"]).collect()} == {("k", 3), ("m", 9)}


def test_dense_number(spark):
    keys = [(k * 7919) % 1000 for k in range(1000)]
    df = spark.createDataFrame([(k,) for k in keys], "k int").repartition(5)
    got = numbering.dense_number(df, "k").collect()
    assert {(r.k, r.number) for r in got} == {(k, k) for k in range(1000)}


def test_dense_number_splits_a_hot_key(spark):
    df = spark.range(900).select(F.lit("hot").alias("k"), "id")
    got = numbering.dense_number(df, ["k", "id"]).collect()
    assert sorted(r.number for r in got) == list(range(900))
    assert all(r.number == r.id for r in got)


@pytest.mark.parametrize("debut, last, expected", [(3, 5, [3, 4, 5]), (3, 3, [3, 4]), (5, 3, [])])
def test_season_range(spark, debut, last, expected):
    df = spark.createDataFrame([(debut, last)], "d int, l int")
    assert [r.period for r in runs.season_range(df, "d", "l").collect()] == expected


def test_first_run(seasons):
    got = {(r.entity, r.period) for r in runs.first_run(seasons, "entity", "period").collect()}
    want = {("a", p) for p in (1, 2, 3, 4)} | {("b", 1), ("b", 2), ("c", 2), ("d", 4), ("e", 1)}
    assert got == want


def test_limit_entities(seasons):
    def names(limit):
        return {r.entity for r in joins.limit_entities(seasons, "entity", limit).collect()}

    assert names(-1) == set("abcde")
    assert names(2) == set("ab")
    assert names(3) == set("abc")
    assert names(99) == set("abcde")


def test_upsert(spark):
    existing = spark.createDataFrame([("x", 1.0)], "name string, score double")
    new = spark.createDataFrame(
        [("x", 9.0, 0), ("y", 2.0, 2), ("y", 3.0, 1)], "name string, score double, line int"
    )
    updates = spark.createDataFrame(
        [("y", 5.0, 0), ("y", 6.0, 1), ("zz", 7.0, 2)], "name string, score double, line int"
    )
    got = joins.upsert(existing, new, updates, "name", "score", ["line"], ["line"])
    assert {tuple(r) for r in got.collect()} == {("x", 1.0), ("y", 6.0)}


def test_update_adds_a_new_column(spark):
    base = spark.createDataFrame([("x",), ("y",)], "name string")
    updates = spark.createDataFrame([("x", 5.0, 0)], "name string, att double, line int")
    got = joins.update_if_present(base, updates, "name", "att", ["line"])
    assert {tuple(r) for r in got.collect()} == {("x", 5.0), ("y", None)}


def test_with_region(spark):
    rows = spark.createDataFrame([("a", "g"), ("b", None), ("c", "h")], "e string, college string")
    known = spark.createDataFrame([("g", "Ohio")], "college string, state string")
    got = {(r.e, r.college, r.state) for r in joins.with_region(rows, known).collect()}
    assert got == {("a", "g", "Ohio"), ("b", "null", "null"), ("c", "h", "no state")}


def test_replicate(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    assert {r.k for r in joins.replicate(df, 2, "k").collect()} == {"a#0", "a#1", "b#0", "b#1"}


def test_range_batches_lose_no_boundary_row(spark):
    df = spark.range(10)
    parts = [batches.read_range(df, "id", lo, lo + 4) for lo in (0, 4, 8)]
    assert sorted(r.id for r in batches.union_batches(parts).collect()) == list(range(10))
    sizes = batches.with_range_batch(df, "id", 4).groupBy("batch").count().collect()
    assert {(r.batch, r["count"]) for r in sizes} == {(0, 4), (1, 4), (2, 2)}


def test_fixed_batches(spark):
    df = spark.createDataFrame([(f"k{i:02}",) for i in range(11)], "k string")
    sizes = batches.with_fixed_batch(df, "k", 4).groupBy("batch").count().collect()
    assert {(r.batch, r["count"]) for r in sizes} == {(0, 4), (1, 4), (2, 3)}


def test_range_batches_lose_nothing(spark):
    numbers = [None, -70, -1, 0, 5, 13, 99, None]
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    reads = [[r.n for r in b.collect()] for b in batches.range_batches(df, "n", 3)]
    assert sorted(map(str, sum(reads, []))) == sorted(map(str, numbers))
    assert reads[-1] == [None, None] and len(reads) == 4
    assert [max(a) < min(b) for a, b in zip(reads, reads[1:-1])] == [True, True]
    late = batches.read_range(df, "n", low=50)
    assert [r.n for r in late.collect()] == [99]


def test_prefixes(spark):
    df = spark.createDataFrame([("Abe",), ("bob",), ("9th",), ("élan",)], "k string")
    df = df.withColumn("m", F.array(F.create_map(F.lit("a"), F.lit(1))))
    got = {(r.k, r.prefix) for r in batches.by_prefix(df, "k").collect()}
    assert got == {("Abe", "a"), ("bob", "b"), ("9th", "other"), ("élan", "other")}


def test_roll_up_of_a_region_without_groups(spark):
    groups = spark.createDataFrame([("g", "r", 1.0), ("h", "r", 2.0)], "grp string, reg string, s double")
    regions = spark.createDataFrame([("r",), ("q",)], "reg string")
    got = rollup.roll_up(regions, groups, "reg", ["s"])
    assert {tuple(r) for r in got.collect()} == {("r", 3.0), ("q", 0.0)}


def test_game_means_divide_by_distinct_games(spark):
    rows = [("p", "g1", 4.0), ("p", "g1", 2.0), ("p", "g2", None), ("q", "g1", 0.0)]
    rows += [("r", f"g{i}", float(i < 2)) for i in range(3)]
    df = spark.createDataFrame(rows, "e string, game string, v double")
    got = documents.game_means(df, ["e"], ["game"], ["v"])
    assert {tuple(r) for r in got.collect()} == {("p", 3.0), ("q", 0.0), ("r", 0.666666667)}


@pytest.mark.parametrize("parts", [1, 7])
def test_nest_keeps_every_game(spark, parts):
    games = spark.range(60).select(
        F.when(F.col("id") < 50, "hot").otherwise("cold").alias("e"),
        (F.col("id") % 3).cast("int").alias("p"),
        F.col("id").cast("string").alias("g"),
        (F.col("id") * 1.0).alias("v"),
    )
    stats = games.groupBy("e", "p").agg(F.sum("v").alias("s"))
    docs = documents.nest(games, stats, "e", "p", "g", ["v"], ["s"], parts)
    if parts == 1:
        assert docs.columns == ["e", "seasons"] and docs.count() == 2
    else:
        assert docs.count() == docs.select("e", "part").distinct().count() > 2
    flat = documents.explode_seasons(docs, ["e"], "p")
    back = flat.select("e", "p", F.explode("games").alias("g", "v")).select("e", "p", "g", "v.v")
    assert sorted(back.collect()) == sorted(games.collect())
    assert sorted(documents.season_rows(docs, ["e"], "p").collect()) == sorted(stats.collect())


def test_run_of_map(spark):
    df = spark.sql("SELECT map(3, 'a', 4, 'b', 6, 'c') AS m")
    assert df.select(runs.run_of_map(F.col("m"))).first()[0] == [3, 4]
