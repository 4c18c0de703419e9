"""Stored layouts: what a read of a part of a table opens, and that nothing is lost."""

import re

import pytest
from pyspark.sql import functions as F

from debutrank.operators import documents
from debutrank.schemas import STATS
from debutrank.sources import batches, store
from debutrank.testbed import nested
from debutrank.testbed.queries import QUERIES


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(df):
    """Files that the scans of an executed frame have opened."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan()
    if leaves.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        leaves = leaves.executedPlan()
    leaves = leaves.collectLeaves()
    metrics = [leaves.apply(i).metrics().get("numFiles") for i in range(leaves.size())]
    return sum(m.get().value() for m in metrics if m.isDefined())


# --- ranges -------------------------------------------------------------------

NUMBERS = [None, None, -250, -1, 0, *range(5, 2000, 3), 99_999]


@pytest.fixture(scope="module")
def ranged(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ranges") / "t")
    batches.write_ranges(spark.createDataFrame([(n,) for n in NUMBERS], "n long"), path, "n", 100)
    return path


@pytest.mark.parametrize(
    "low, high", [(None, None), (0, 100), (150, 151), (-300, 0), (None, 7), (1990, None), (700, 1250), (3000, 4000)]
)
def test_ranges(spark, ranged, low, high):
    got = batches.read_ranges(spark, ranged, "n", low, high)
    assert got.columns == ["n"]
    inside = [n for n in NUMBERS if n is not None and (low is None or n >= low) and (high is None or n < high)]
    assert sorted(r.n for r in got.collect()) == inside


def test_a_range_opens_its_folders_only(spark, ranged, tmp_path):
    whole = files_read(batches.read_ranges(spark, ranged, "n"))
    assert whole >= 22
    some = batches.read_ranges(spark, ranged, "n", 700, 1000)
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan_of(some)).group(1)
    assert "n_by_100" in filters and ">= 7" in filters and "<= 9" in filters
    assert files_read(some) <= 6  # three folders, each of them in one or two files
    assert files_read(batches.read_ranges(spark, ranged, "n", 3000, 4000)) == 0


@pytest.fixture
def without_coalescing(spark):
    """Small test tables in as many pieces as large ones."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_hot_number_has_several_files(spark, tmp_path, without_coalescing):
    number = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("long")
    path = tmp_path / "t"
    batches.write_ranges(spark.range(40_000, numPartitions=4).select(number.alias("n"), "id"), str(path), "n", 1000)
    assert len(list((path / "n_by_1000=0").glob("*.parquet"))) > 1
    assert batches.read_ranges(spark, str(path), "n").count() == 40_000


def test_equal_batches_are_the_range_batches(spark):
    df = spark.createDataFrame([(n,) for n in [None, -70, -1, 0, 5, 13, 99, None]], "n long")
    want = [(i, r.n) for i, b in enumerate(batches.range_batches(df, "n", 3)) for r in b.collect()]
    got = [(r.batch, r.n) for r in batches.with_equal_batch(df, "n", 3).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    empty = batches.with_equal_batch(df.limit(0), "n", 3)
    assert empty.count() == 0


def test_union_of_batches_is_one_scan(spark, sf_dir):
    plan = plan_of(QUERIES["union_batches"](spark, sf_dir))
    assert plan.count("FileScan") == 1 and "Union" not in plan


# --- prefixes -----------------------------------------------------------------

NAMES = ["Abe", "abel", "bob", "9th", "élan", "", None, *[f"s{i:04}" for i in range(4000)], *[f"t{i}" for i in range(9)]]


@pytest.fixture(scope="module")
def prefixed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("prefixes") / "t")
    batches.write_prefixes(spark.createDataFrame([(n,) for n in NAMES], "k string"), path, "k")
    return path


def test_prefixes_keep_all_rows(spark, prefixed):
    got = batches.read_prefixes(spark, prefixed)
    assert sorted((r.k for r in got.collect()), key=repr) == sorted(NAMES, key=repr)
    assert {r.prefix for r in got.select("prefix").distinct().collect()} == {"a", "b", "s", "t", "other"}


def test_some_prefixes_open_their_folders_only(spark, prefixed):
    some = batches.read_prefixes(spark, prefixed, ["a", "t", "z"])
    assert "prefix" in re.search(r"PartitionFilters: \[([^\]]*)\]", plan_of(some)).group(1)
    assert sorted(r.k for r in some.collect()) == sorted(["Abe", "abel", *[f"t{i}" for i in range(9)]])
    assert files_read(some) < files_read(batches.read_prefixes(spark, prefixed))
    assert batches.read_prefixes(spark, prefixed, []).count() == 0


def test_a_hot_prefix_has_several_files(spark, tmp_path, without_coalescing):
    df = spark.range(30_000, numPartitions=4).select(F.format_string("s%06d", "id").alias("k"))
    path = tmp_path / "t"
    batches.write_prefixes(df, str(path), "k")
    assert len(list((path / "prefix=s").glob("*.parquet"))) > 1


def test_keys_prune_prefixes_while_running(spark, prefixed, tmp_path):
    keys = [("s0007", 1), ("bob", 1), ("bob", 1), ("nobody", 1), (None, 1), ("t1", 2)]
    spark.createDataFrame(keys, "k string, w int").write.parquet(str(tmp_path / "keys"))
    wanted = spark.read.parquet(str(tmp_path / "keys")).filter("w = 1")
    found = batches.read_keys(spark, prefixed, wanted, "k")
    assert sorted((r.k, r.prefix) for r in found.collect()) == [("bob", "b"), ("s0007", "s")]
    assert "dynamicpruning" in plan_of(found)


# --- documents by column ------------------------------------------------------


def test_only_asked_statistics_are_read(spark, sf_dir):
    for name, read in (("scan_statistics", {"points", "plus_minus"}), ("nested_get", {"points", "steals"})):
        spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
        plan = plan_of(QUERIES[name](spark, sf_dir))
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        schema = re.search(r"ReadSchema: (\S+)", one_scan(plan)).group(1)
        assert set(STATS) & set(re.findall(r"\w+(?=:)", schema)) == read
        assert "games" not in schema


def one_scan(plan):
    assert plan.count("FileScan") == 1
    return plan


def test_entries_and_maps(spark, sf_dir):
    rows = nested.documents(spark, sf_dir)
    entries = documents.as_entries(rows)
    back = documents.as_maps(entries)
    flat = ["player_id", "period"]
    keys = ["player_id"]
    a, b = (documents.season_rows(d, keys).orderBy(*flat).collect() for d in (rows, back))
    assert a == b
    assert a == documents.entry_rows(entries, keys, list(STATS)).orderBy(*flat).collect()
    one = F.lit(1995)
    got = {r.player_id: r.v for r in entries.select("player_id", documents.entry_stat(one, "points").alias("v")).collect()}
    want = {r.player_id: r.v for r in rows.select("player_id", documents.season_stat(one, "points").alias("v")).collect()}
    assert got == want and None in want.values()


def test_two_runs_store_equal_documents(spark, sf_dir, tmp_path):
    stored = []
    for i in range(2):
        path = str(tmp_path / str(i))
        store.write_entries(nested.build_documents(spark, sf_dir), path)
        stored.append(store.read_entries(spark, path).orderBy("player_id").toJSON().collect())
    assert stored[0] == stored[1] and stored[0]
    first = store.read_entries(spark, str(tmp_path / "0")).select("seasons.period").collect()
    assert all(r.period == sorted(r.period) for r in first)
