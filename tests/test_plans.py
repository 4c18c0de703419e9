"""Physical plans: what is read, shuffled and limited before a shuffle."""

import re

import pytest
from pyspark.sql import functions as F

from debutrank.categories import CATEGORIES
from debutrank.operators import dedupe, documents, ranking, runs, scoring
from debutrank import session
from debutrank.operators.scoring import score_entities
from debutrank.plans import populate, rankings
from debutrank.session import written
from debutrank.testbed import seasons as testbed
from debutrank.testbed.queries import QUERIES


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return testbed.seasons(spark, sf_dir), testbed.season_profile(spark, sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert operator not in plan


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_bucketed_tables_need_no_exchange_by_entity(spark, sf_dir, tables, no_broadcast):
    """Runs, scores and the groups of the members: the first exchange is that of the group sums."""
    scores = score_entities(*tables, CATEGORIES)
    rows = ranking.with_group(scores, testbed.members(spark, sf_dir))
    plan = plan_of(ranking.group_sum_count(rows, "grp", ["att_score", "plm_score"]))
    assert exchange_keys(plan) == [("coalesce(grp",)] or exchange_keys(plan) == [("grp",)]
    assert "SortMergeJoin" in plan and "Window" in plan
    loose = written(tables[0], "loose"), tables[1]
    assert ("entity",) in exchange_keys(plan_of(score_entities(*loose, CATEGORIES)))


def test_bucketed_rows_are_all_there(spark, tables):
    df = spark.range(1000).select((F.col("id") % 70).alias("k"), "id").withColumn("k", F.expr("nullif(k, 3)"))
    stored = session.bucketed(df, "some", ["k"], 4)
    assert stored.exceptAll(df).count() == 0 and stored.count() == 1000
    assert len(stored.inputFiles()) == 4
    none = session.bucketed(df.limit(0), "none", ["k"], 4)
    assert none.count() == 0 and none.columns == ["k", "id"]


def test_rescaling_reads_written_scores_once(spark, sf_dir, tables):
    plan = plan_of(rankings.rank_entities_all(*tables))
    assert plan.count("FileScan") == 1 and "Subquery" not in plan and "Exchange" not in plan
    members = testbed.members(spark, sf_dir)
    assert plan_of(rankings.rank_groups(*tables, members, "attackers")).count("FileScan") == 1


def test_one_shuffle_scores_all_categories(spark, tables):
    """Of a season table that is not stored in buckets."""
    plan = plan_of(score_entities(written(tables[0], "loose"), tables[1], CATEGORIES))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "BroadcastHashJoin" in plan  # the profile, by its size
    # Later periods are dropped before the shuffle.
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_only_needed_statistics_are_read(spark, tables):
    plan = plan_of(score_entities(*tables, ["plus_minus"]))
    scans = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", plan)
    read = {re.sub(r"#\d+L?", "", c) for scan in scans for c in scan.split(",")}
    assert read == {
        "entity", "period", "plus_minus", "played_minutes", "games_played",
        "played_minutes_mean", "games_played_mean",
    }


def test_profile_is_broadcast_by_its_rows(spark, tables, monkeypatch):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        few = plan_of(score_entities(*tables, ["att"]))
        monkeypatch.setattr(scoring, "PROFILE_ROWS", 0)
        many = plan_of(score_entities(*tables, ["att"]))
    finally:
        spark.conf.set(name, before)
    assert "SortMergeJoin" not in few and "Broadcast" in few
    assert "Broadcast" not in many and "SortMergeJoin" in many


def test_rescaling_reuses_the_scores(spark, tables):
    df = ranking.rescale(score_entities(written(tables[0], "loose"), tables[1], ["att"]), "att_score")
    df.collect()
    assert "ReusedExchange" in plan_of(df)


@pytest.mark.parametrize("keep", [dedupe.dedupe_first, dedupe.dedupe_last])
def test_a_hot_key_is_reduced_before_the_shuffle(spark, keep):
    df = spark.range(1000, numPartitions=4).select((F.col("id") % 2).alias("k"), "id")
    plan = plan_of(keep(df, ["k"], ["id"]))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange") < plan.index("Partial")


def test_first_run_is_limited_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 5).alias("e"), F.col("id").alias("p"))
    assert plan_of(runs.first_run(df, "e", "p")).count("WindowGroupLimit") == 2


def test_a_hot_entity_is_spread_over_documents(spark):
    games = spark.range(20_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("e"),
        F.lit(1).alias("p"),
        F.col("id").cast("string").alias("g"),
        "id",
    )
    stats = games.groupBy("e", "p").agg(F.count("*").alias("n"))
    docs = written(documents.nest(games, stats, "e", "p", "g", ["id"], ["n"], 14), "hot")
    sizes = docs.filter("e = 0").select(F.size(F.col("seasons")[1]["games"]).alias("n"))
    assert sizes.count() == 14
    assert sizes.agg(F.sum("n")).first()[0] == 6667
    assert sizes.agg(F.max("n")).first()[0] < 700


def test_a_hot_order_is_split(spark, tmp_path, sf_dir):
    """A third of all lines belongs to one order: the join splits its partition."""
    lines = testbed.table(spark, sf_dir, "lineitem")
    hot = lines.withColumn(
        "l_orderkey",
        F.when(F.pmod(F.hash("l_partkey", "l_suppkey"), F.lit(3)) == 0, F.lit(0)).otherwise(
            F.col("l_orderkey")
        ),
    )
    hot = hot.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("copy")
    # A skewed partition is split by map tasks, so the lines have to come in several files.
    hot.repartition(8).write.parquet(str(tmp_path / "lineitem.parquet"))
    testbed.table(spark, sf_dir, "orders").write.parquet(str(tmp_path / "orders.parquet"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = testbed.order_lines(spark, str(tmp_path)).groupBy("entity", "period").agg(
            F.sum("quantity")
        )
        df.collect()
        assert "skew=true" in plan_of(df)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exchange_keys(plan):
    """Columns of every hash exchange."""
    found = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    return [tuple(re.sub(r"#\d+L?", "", c).strip() for c in x.split(",")[:-1]) for x in found]


def test_season_table_shuffles(spark, sf_dir):
    """Wide sums go by order and by season only, and distinct numbers as narrow words."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        plan = plan_of(testbed.build_seasons(spark, sf_dir))
    finally:
        spark.conf.set(name, before)
    scans = [x for x in re.findall(r"FileScan parquet \[([^\]]*)\]", plan) if "l_orderkey" in x]
    assert sorted(len(x.split(",")) for x in scans) == [3, 8]
    assert plan.count("SortMergeJoin") == 3
    keys = exchange_keys(plan)
    assert not {"l_linenumber", "l_suppkey", "far_line"} & {c for k in keys for c in k}
    season, word = ("entity", "period"), ("entity", "period", "what", "owner", "block")
    by_order = [k for k in keys if len(k) == 1]
    assert sorted(k for k in keys if len(k) > 1) == sorted([season, season, word])
    assert set(by_order) == {("l_orderkey",), ("o_orderkey",)}


def test_documents_are_dealt_out_once(spark):
    games = spark.range(100).selectExpr("id % 7 AS entity", "cast(id % 3 AS int) AS period", "cast(id AS string) AS g", "id")
    stats = games.groupBy("entity", "period").agg(F.count("*").alias("n"))
    for parts, dealt_by in ((1, "entity"), (5, "entity.*part")):
        plan = plan_of(documents.nest(games, written(stats, "stats"), "entity", "period", "g", ["id"], ["n"], parts))
        assert re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan) and plan.count("Exchange") == 1
        assert re.search(rf"Exchange hashpartitioning\({dealt_by}", plan)


def test_numbering_known_entities_writes_no_documents(spark, monkeypatch):
    games = spark.range(40).selectExpr("id % 5 AS entity", "cast(id % 2 AS int) AS period", "cast(id AS string) AS g", "id")
    stats = games.groupBy("entity", "period").agg(F.count("*").alias("n"))
    nested = documents.nest(games, stats, "entity", "period", "g", ["id"], ["n"])
    members = spark.createDataFrame([(1, "g", "r"), (2, "h", None)], "entity long, grp string, region string")
    expected = populate.numbered_documents(nested, members)
    labels = []
    monkeypatch.setattr(populate, "written", lambda df, label: labels.append(label))
    got = populate.numbered_documents(nested, members, entities=stats.select("entity").distinct())
    assert not labels
    columns = ["player_id", "college", "state", "number", F.size("seasons").alias("n")]
    assert sorted(got.select(*columns).collect()) == sorted(expected.select(*columns).collect())
    assert {r.number for r in got.collect()} == set(range(5))


def test_season_sums_have_one_class_for_a_line(spark):
    """Classes that overlap carry the same sum through the shuffle more than once."""
    flags = spark.sql(
        "SELECT * FROM VALUES ('N'), ('A'), ('R'), (NULL) AS f(l_returnflag), VALUES ('F'), ('O'), (NULL) AS s(l_linestatus)"
    ).withColumn("quantity", F.lit(5))
    parts = [n for n in testbed._STEPS if n.startswith("q")]
    rows = flags.select("l_returnflag", "l_linestatus", *[F.expr(testbed._STEPS[n]).alias(n) for n in parts]).collect()
    assert len(rows) == 12 and all([r[n] for n in parts].count(5) == 1 for r in rows)
    for name, asked in (
        ("q", lambda f, s: True),
        ("q_f", lambda f, s: s == "F"),
        ("q_n", lambda f, s: f == "N"),
        ("q_o", lambda f, s: f is not None and f != "N"),
    ):
        for r in rows:
            assert any(r[n] for n in testbed._TOTALS[name]) == asked(r.l_returnflag, r.l_linestatus)
