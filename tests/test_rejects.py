"""Lines that cannot be read are kept beside the rows, and numbers go from load to load."""

import pytest

from debutrank.operators.numbering import continue_numbers
from debutrank.plans import populate
from debutrank.schemas import GAME_FILE, PLAYER_FILE, SEASON_FILE
from debutrank.sources import store, tsv

COLUMNS = ["a", "b", "c"]


def read(spark, path, *args, **kwargs):
    checked = tsv.read_checked(spark, str(path), *args, **kwargs)
    names = [c for c in checked.rows.columns if c not in tsv.FILE_ORDER and c != "category"]
    rows = sorted((tuple(r) for r in checked.rows.select(*names).collect()), key=repr)
    return rows, sorted((r.file.rsplit("/", 1)[1], r.line) for r in checked.rejected.collect())


def test_ragged_and_badly_quoted_lines(spark, tmp_path):
    good = ["1\tx\ty", '2\t"q ""inside"" q"\ty', "3\t\t", '4\t"tab\there"\tz']
    bad = ["5\tx", "6\tx\ty\tz", "7", '8\t"open\tz', '"9\topen\tx']
    (tmp_path / "f.tsv").write_text("\n".join(["A\tB\tC", *good, "", *bad]) + "\n")
    rows, rejected = read(spark, tmp_path / "f.tsv", COLUMNS)
    assert rows == [("1", "x", "y"), ("2", 'q "inside" q', "y"), ("3", None, None), ("4", "tab\there", "z")]
    assert rejected == sorted(("f.tsv", line) for line in bad)
    rows, rejected = read(spark, tmp_path / "f.tsv", COLUMNS, required=["b"])
    assert len(rows) == 3 and ("f.tsv", "3\t\t") in rejected


def test_several_files_and_none(spark, tmp_path):
    (tmp_path / "one").write_text("A\tB\tC\n1\t2\n")
    (tmp_path / "two").write_text("A\tB\tC\n1\t2\t3\n4\n")
    (tmp_path / "empty").write_text("A\tB\tC\n")
    rows, rejected = read(spark, tmp_path, COLUMNS)
    assert rows == [("1", "2", "3")] and rejected == [("one", "1\t2"), ("two", "4")]
    assert read(spark, tmp_path / "empty", COLUMNS) == ([], [])


def test_score_files(spark, tmp_path):
    (tmp_path / "x.tsv").write_text("duke\t3.5\nkent\nyale\tmany\n\t1.0\n")
    (tmp_path / "y.tsv").write_text("duke\t1\t2\nduke\t-1\n")
    paths = {s: str(tmp_path / f"{s}.tsv") for s in "xy"}
    checked = tsv.check_category_files(spark, paths)
    assert sorted((r.category, r.name, r.score) for r in checked.rows.collect()) == [("x", "duke", 3.5), ("y", "duke", -1.0)]
    got = sorted((r.category, r.line) for r in checked.rejected.collect())
    assert got == [("x", "\t1.0"), ("x", "kent"), ("x", "yale\tmany"), ("y", "duke\t1\t2")]
    plain = tsv.read_category_files(spark, paths).select("name", "score", "category")
    assert {("duke", 3.5, "x"), ("duke", -1.0, "y")} <= {tuple(r) for r in plain.collect()}


def write(path, header, rows):
    path.write_text("\n".join("\t".join(map(str, r)) for r in [list(header), *rows]) + "\n")
    return str(path)


def load(spark, folder, players, bad=()):
    """One load: a season with one game for each player; ``bad`` are further lines of all files."""
    folder.mkdir()
    names = [write(folder / "players", PLAYER_FILE, [[p, p.upper(), "c", "s", 2000, 2001] for p in players])]
    names.append(write(folder / "stats", SEASON_FILE, [[p, "2000-2001", *[1] * 24] for p in players]))
    games = [[p, "2000-2001", 1, *["1"] * (len(GAME_FILE) - 3)] for p in players]
    names.append(write(folder / "games", GAME_FILE, games))
    for name in names:
        with open(name, "a") as file:
            file.writelines(line + "\n" for line in bad)
    return populate.populate(spark, *names, store=str(folder / "store"), numbers=str(folder.parent / "numbers"))


def test_loads_keep_numbers_and_bad_lines(spark, tmp_path):
    first = load(spark, tmp_path / "1", ["b", "d"], bad=["short\tline"])
    assert {r.player_id: r.number for r in first.documents.collect()} == {"b": 0, "d": 1}
    assert sorted((r.kind, r.line) for r in first.malformed.collect()) == [
        ("games", "short\tline"), ("players", "short\tline"), ("seasons", "short\tline"),
    ]
    assert {r.entity for r in first.seasons.collect()} == {"b", "d"}
    second = load(spark, tmp_path / "2", ["a", "c", "d"])
    assert {r.player_id: r.number for r in second.documents.collect()} == {"a": 2, "c": 3, "d": 1}
    assert second.malformed.count() == 0


def test_numbers_continue(spark, tmp_path):
    path = str(tmp_path / "n")

    def load(*keys):
        frame = spark.createDataFrame([(k,) for k in keys], "k string")
        return {r.k: r.number for r in store.number_stored(frame, path, "k").collect()}

    assert load() == {}
    assert load("m", "k", None, "m") == {"k": 0, "m": 1}
    assert load("m") == {"k": 0, "m": 1}
    assert load("z", "a", "m") == {"k": 0, "m": 1, "a": 2, "z": 3}
    assert load("b") == {"k": 0, "m": 1, "a": 2, "z": 3, "b": 4}


@pytest.mark.parametrize("taken, want", [([], [0, 1]), ([7], [8, 9])])
def test_new_numbers_follow_the_largest(spark, taken, want):
    numbered = spark.createDataFrame([("x", n) for n in taken], "k string, number long")
    keys = spark.createDataFrame([("p",), ("q",), ("x",) if taken else ("q",)], "k string")
    assert sorted(r.number for r in continue_numbers(numbered, keys, "k").collect()) == want
