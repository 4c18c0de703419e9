"""What is stored and changed: profiles merged by batch, and tables changed by key by several writers."""

import random
import statistics
import threading

import pytest
from pyspark.sql import functions as F

from debutrank.operators import profile_state
from debutrank.operators.profile import profile
from debutrank.sources import keyed, store

STATS = ("x", "y")


def season_rows(seed, n, offset=0.0):
    rng = random.Random(seed)

    def value():
        return None if rng.random() < 0.1 else offset + rng.uniform(-5, 5)

    return [(rng.choice([1990, 1991, 1992, None]), value(), value()) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "period int, x double, y double")


def as_dict(df):
    return {r.period: {k: v for k, v in r.asDict().items() if k != "period"} for r in df.collect()}


@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_merged_states_are_the_profile_of_all_rows(spark, offset):
    batches = [season_rows(1, 40, offset), season_rows(2, 1, offset), [], [(1999, 3.0, None)], season_rows(3, 90, offset)]
    states = [profile_state.state(frame(spark, b), stats=STATS) for b in batches]
    got = as_dict(profile_state.profile_of(profile_state.merge_all(states, stats=STATS), stats=STATS))
    want = as_dict(profile(frame(spark, [r for b in batches for r in b]), stats=STATS))
    assert set(got) == set(want)
    for period, row in want.items():
        assert got[period] == pytest.approx(row, rel=1e-9, abs=1e-8)
    values = [r[1] or 0.0 for b in batches for r in b if r[0] == 1990]
    assert got[1990]["x_variance"] == pytest.approx(statistics.variance(values), rel=1e-9)
    assert got[1999]["x_variance"] == 0 and got[1999]["y_mean"] == 0


def test_state_in_passes(spark):
    rows = frame(spark, season_rows(4, 50))
    one = profile_state.state(rows, stats=STATS)
    two = profile_state.state(rows, stats=STATS, stats_per_pass=1)
    assert one.columns == two.columns
    got, want = as_dict(two), as_dict(one)
    assert all(got[p] == pytest.approx(want[p]) for p in want)


def test_stored_profile_reads_the_batch_only(spark, tmp_path):
    """The rows of the first batch are gone when the second one comes."""
    path, first = str(tmp_path / "profile"), season_rows(5, 60)
    raw = str(tmp_path / "raw")
    frame(spark, first).write.parquet(raw)
    store.start_profile(profile_state.state(spark.read.parquet(raw), stats=STATS), path)
    frame(spark, []).write.mode("overwrite").parquet(raw)
    second = season_rows(6, 30)
    store.add_to_profile(profile_state.state(frame(spark, second), stats=STATS), path, stats=STATS)
    got = as_dict(store.kept_profile(spark, path, stats=STATS))
    want = as_dict(profile(frame(spark, first + second), stats=STATS))
    assert all(got[p] == pytest.approx(want[p], abs=1e-8) for p in want) and set(got) == set(want)


# --- tables changed by key ----------------------------------------------------


def people(spark, rows):
    return spark.createDataFrame(rows, "name string, n long")


def put(spark, path, rows):
    """Set or add rows."""
    new = people(spark, rows)

    def make(present):
        return present.join(new.select("name"), "name", "left_anti").unionByName(new)

    return keyed.change(spark, path, new, make)


def rows_of(spark, path, of=None):
    return sorted((tuple(r) for r in keyed.read(spark, path, of).collect()), key=lambda r: (r[0] is not None, r))


def test_a_change_leaves_other_buckets_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    first = keyed.create(people(spark, [(f"p{i}", i) for i in range(200)]), path, ["name"], buckets=16)
    assert set(first.folders) == set(range(16))
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "data").rglob("*.parquet")}
    second = put(spark, path, [("p7", 70), ("new", 1)])
    changed = {b for b in range(16) if first.folders[b] != second.folders[b]}
    touched = people(spark, [("p7", 0), ("new", 0)]).select(keyed.bucket_of(["name"], 16).alias("b")).distinct()
    assert changed == {r.b for r in touched.collect()}
    assert all(f.stat().st_mtime_ns == t for f, t in files.items())
    want = {f"p{i}": i for i in range(200)} | {"p7": 70, "new": 1}
    assert rows_of(spark, path) == sorted(want.items())
    assert rows_of(spark, path, first) == sorted((f"p{i}", i) for i in range(200))
    scanned = keyed.read(spark, path, only=[0, 1]).inputFiles()
    assert {f.split("_bucket=")[1].split("/")[0] for f in scanned} == {"0", "1"}


def test_a_writer_that_comes_second_does_its_change_again(spark, tmp_path):
    """The other writer publishes between our read and our own publishing; nothing is lost."""
    path = str(tmp_path / "t")
    keyed.create(people(spark, [("a", 1), ("b", 1)]), path, ["name"], buckets=1)
    calls = []

    def add_ten(present):
        calls.append(1)
        if len(calls) == 1:
            put(spark, path, [("a", 100), ("c", 5)])
        return present.withColumn("n", F.when(F.col("name") == "a", F.col("n") + 10).otherwise(F.col("n")))

    done = keyed.change(spark, path, people(spark, [("a", 0)]), add_ten)
    assert len(calls) == 2 and done.number == 2
    assert rows_of(spark, path) == [("a", 110), ("b", 1), ("c", 5)]
    named = {f.split("/")[1] for v in (0, 1, 2) for f in _folders(spark, path, v)}
    assert {f.name for f in (tmp_path / "t" / "data").iterdir()} == named  # the refused attempt is gone


def _folders(spark, path, number):
    return keyed._load(spark, path, f"{number:08}.json").folders.values()


def test_writers_at_once_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.create(people(spark, [("p0", 0)]), path, ["name"], buckets=2)
    threads = [
        threading.Thread(target=put, args=(spark, path, [(f"w{i}", i), (f"x{i}", i)])) for i in range(4)
    ]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    want = [("p0", 0)] + [(f"{k}{i}", i) for k in "wx" for i in range(4)]
    assert rows_of(spark, path) == sorted(want)
    assert keyed.version(spark, path).number == 4


def test_odd_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        keyed.version(spark, path)
    keyed.create(people(spark, []), path, ["name"], buckets=4)
    assert rows_of(spark, path) == []
    with pytest.raises(keyed.Taken):
        keyed.create(people(spark, []), path, ["name"])
    assert put(spark, path, []).number == 0
    put(spark, path, [(None, 1), ("", 2)])
    assert rows_of(spark, path) == [(None, 1), ("", 2)]
    gone = keyed.change(spark, path, people(spark, [("", 0)]), lambda present: present.filter("name <> ''"))
    assert gone.number == 2
    assert rows_of(spark, path) in ([(None, 1)], [])  # a null key stays unless it shares the bucket
    with pytest.raises(ValueError, match="does not touch"):
        other = people(spark, [(f"k{i}", i) for i in range(20)])
        keyed.change(spark, path, people(spark, [("k1", 0)]), lambda present: other)


def test_clean_keeps_what_the_newest_versions_need(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.create(people(spark, [(f"p{i}", i) for i in range(50)]), path, ["name"], buckets=8)
    for i in range(4):
        put(spark, path, [(f"p{i}", -i)])
    last = keyed.version(spark, path)
    keyed.clean(spark, path)
    want = {f"p{i}": i for i in range(50)} | {f"p{i}": -i for i in range(4)}
    assert rows_of(spark, path) == sorted(want.items())
    assert len(list((tmp_path / "t" / "_versions").glob("*.json"))) == 2
    assert keyed.version(spark, path) == last
    put(spark, path, [("later", 1)])
    assert len(rows_of(spark, path)) == 51
