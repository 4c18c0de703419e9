"""The way from files to rankings, and pages, on small hand-made inputs."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from debutrank.categories import CATEGORIES
from debutrank.operators.documents import compact, season_rows, season_stat
from debutrank.plans import extract, populate, presentation, rankings
from debutrank.schemas import GAME_FILE, PLAYER_FILE, SEASON_FILE, STATS
from debutrank import session
from debutrank.operators.scoring import score_columns
from debutrank.sources import pages, tsv
from debutrank.sources.store import read_profile
from tests import brute


def write(path, header, rows):
    lines = ["\t".join(header), *["\t".join(str(c) for c in r) for r in rows]]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    rng = random.Random(3)
    players, stats, games = [], [], []
    seasons = {}
    for i in range(12):
        pid = f"p{i:02}"
        college = "" if i == 5 else f"college {i % 4}"
        players.append([pid, f"Name {i}", college, f"state {i % 2}", 2000, 2004])
        for year in (2000, 2001, 2003) if i % 3 == 0 else (2000 + i % 2, 2001 + i % 2):
            label = f"{year}-{year + 1}"
            cells = [rng.choice(["", round(rng.uniform(0, 30), 1)]) for _ in range(24)]
            stats.append([pid, label, *cells])
            if i == 2:  # a second row of the same season: the first one counts
                stats.append([pid, label, *[99] * 24])
            sums, keys = [0.0, 0.0], set()
            for g in range(rng.randint(1, 4)):
                game = [pid, label, g + 1, "d", "", "T", "@", "O", "W", 1, "30:00"]
                game += [""] * (len(GAME_FILE) - len(game) - 2)
                score, plus = rng.choice(["Inactive", "", 7.5]), rng.choice([-4, 3, "", "x"])
                for repeat in range(2 if (i, g) == (4, 0) else 1):
                    games.append([*game[:-1], repeat, score, plus])
                    sums[0] += score if isinstance(score, float) else 0
                    sums[1] += plus if isinstance(plus, int) else 0
                keys.add(g)
            row = [float(c or 0) for c in cells] + [s / len(keys) for s in sums]
            seasons[pid, year] = dict(zip(STATS, row))
    return {
        "players": write(folder / "player.csv", PLAYER_FILE, players),
        "stats": write(folder / "stats.tsv", SEASON_FILE, stats),
        "games": write(folder / "games.tsv", GAME_FILE, games),
        "expected": seasons,
        "college": {p[0]: p[2] for p in players},
        "n_games": len({tuple(g[:3]) for g in games}),
    }


@pytest.fixture(scope="module")
def tables(spark, files):
    return populate.populate(spark, files["players"], files["stats"], files["games"])


def test_season_table(tables, files):
    got = {(r.entity, r.period): r for r in tables.seasons.collect()}
    assert set(got) == set(files["expected"])  # the last player is there as well
    for key, want in files["expected"].items():
        assert [got[key][s] for s in STATS] == pytest.approx([want[s] for s in STATS])


@pytest.mark.parametrize("preset", CATEGORIES, ids=lambda c: c.short)
def test_rankings(tables, files, preset):
    data = files["expected"]
    prof = brute.profile_of(data, STATS)
    raw = {e: brute.score_of(e, data, prof, preset) for e in files["college"]}
    want = brute.rescale(raw)
    got = rankings.rank_entities(tables.seasons, tables.profile, preset.name).collect()
    assert {r.entity: r.score for r in got} == pytest.approx(want)

    sums, counts = {}, {}
    for e, score in raw.items():
        group = files["college"][e] or "null"
        sums[group] = sums.get(group, 0) + score
        counts[group] = counts.get(group, 0) + 1
    groups = rankings.rank_groups(tables.seasons, tables.profile, tables.members, preset.short)
    got = groups.collect()
    assert {r.grp: r.score for r in got} == pytest.approx(brute.rescale(sums))
    assert {r.grp: r.members for r in got} == counts


def test_all_categories_agree_with_single_ones(tables):
    every = {r.entity: r for r in rankings.rank_entities_all(tables.seasons, tables.profile).collect()}
    for c in CATEGORIES:
        for r in rankings.rank_entities(tables.seasons, tables.profile, c).collect():
            got = every[r.entity][f"{c.short}_score"]
            assert got == (None if r.score is None else pytest.approx(r.score))


def test_region_totals(spark, tables):
    columns = score_columns(CATEGORIES)
    ranked = rankings.rank_groups_all(tables.seasons, tables.profile, tables.members)
    groups = presentation.group_totals(ranked, columns).withColumn("region", F.lit("r"))
    regions = spark.createDataFrame([("r",), ("empty",)], "region string")
    got = {r.region: r for r in presentation.region_totals(regions, groups, "region", columns).collect()}
    assert got["r"].score == pytest.approx(sum(got["r"][c] or 0 for c in columns))
    assert got["empty"].score == 0.0


def test_unreadable_season_is_rejected(spark, files, tmp_path):
    lines = open(files["games"]).read().rstrip("\n").split("\n")
    cells = lines[1].split("\t")
    at = list(GAME_FILE.values()).index("season")
    cells[at] = "last winter"
    bad = tmp_path / "games.csv"
    bad.write_text("\n".join([*lines, "\t".join(cells)]) + "\n")
    store = str(tmp_path / "store")
    got = populate.populate(spark, files["players"], files["stats"], str(bad), store=store)
    assert [r.season for r in got.rejected.collect()] == ["last winter"]
    assert {(r.entity, r.period) for r in got.seasons.collect()} == set(files["expected"])
    seasons = season_rows(got.documents, ["player_id"])
    assert {(r.player_id, r.period) for r in seasons.collect()} == set(files["expected"])
    stored = read_profile(spark, f"{store}/profile")
    assert sorted(stored.select(*got.profile.columns).collect()) == sorted(got.profile.collect())
    assert spark.read.parquet(f"{store}/compacted").count() == got.documents.count()


def test_score_files(spark, tables, tmp_path):
    paths = rankings.write_score_files(tables, str(tmp_path), groups=True, without_missing=True)
    got = rankings.read_score_files(spark, paths, groups=True).collect()
    every = rankings.run(tables, "all", groups=True, without_missing=True).collect()
    assert {(r.name, r.category): (r.score, r.members) for r in got} == {
        (r.grp, r.category): (r.score, r.members) for r in every if r.score is not None
    }
    assert all(r.grp != "null" for r in every)
    assert any(r.grp == "null" for r in rankings.run(tables, "all", groups=True).collect())


def test_release_drops_what_was_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "named_folder", lambda _: str(tmp_path / "work"))
    assert session.written(spark.range(3), "x").count() == 3
    assert list((tmp_path / "work" / "debutrank").iterdir())
    session.release(spark)
    assert not list((tmp_path / "work" / "debutrank").iterdir())


def test_folder_of_the_setting_comes_first(spark, monkeypatch):
    monkeypatch.setattr(session, "CHECKPOINT_DIR", "spark.sql.warehouse.dir")  # one that is set
    assert session.shared_dir(spark) == spark.conf.get("spark.sql.warehouse.dir")
    monkeypatch.setattr(session, "CHECKPOINT_DIR", "spark.no.such.setting")
    assert session.shared_dir(spark) == session._folders[spark.sparkContext.applicationId]
    monkeypatch.setattr(session, "_folders", {})
    with pytest.raises(RuntimeError, match="spark.no.such.setting"):
        session.written(spark.range(3), "x")


def test_run(tables):
    players = rankings.run(tables, "all")
    assert players.columns == ["entity", "category", "score"]
    assert players.count() == 7 * 12
    groups = {r.grp: r.score for r in rankings.run(tables, "attackers", groups=True).collect()}
    every = rankings.run(tables, "all", groups=True).filter("category = 'att'").collect()
    assert {r.grp: r.score for r in every} == pytest.approx(groups)
    with pytest.raises(ValueError, match="unknown category"):
        rankings.run(tables, "goalkeepers")


def test_group_ranking_of_stored_scores(spark, tables):
    scores = spark.createDataFrame([("p00", 1.0), ("p01", 4.0), ("p04", 1.0)], "entity string, score double")
    got = rankings.rank_groups_of(scores, tables.members).collect()
    assert {tuple(r) for r in got} == {("college 0", 50.0, 2), ("college 1", 100.0, 1)}


def test_presentation_files(spark, tmp_path):
    def file(name, *lines):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        return str(tmp_path / name)

    base = file("groups", "A\tOhio\tOH\t1\t2", "B\tUtah\tUT\t3\t4", "A\tIowa\tIA\t9\t9")
    paths = {"att": file("att", "A\t5", "A\t6", "Z\t1", "broken"), "def": file("def", "B\t2")}
    got = {tuple(r) for r in presentation.group_table(spark, base, paths).collect()}
    assert got == {("A", "Ohio", "OH", 1.0, 2.0, 6.0, None), ("B", "Utah", "UT", 3.0, 4.0, None, 2.0)}
    base = file("regions", "Ohio\tOH\t1\t2")
    paths = {"att": file("att_states", "Ohio\t7")}
    assert tuple(presentation.region_table(spark, base, paths).first()) == ("Ohio", "OH", 1.0, 2.0, 7.0)
    people = spark.createDataFrame([("p1", "Ann")], "player_id string, name string")
    paths = {"att": file("player_att", "p1\t4", "p2\t5")}
    assert tuple(presentation.entity_table(spark, people, paths).first()) == ("p1", "Ann", 4.0)
    alumni = file("alumni", "A\t1\t3", "", "A\t2\t5", "B\t1\t1")
    got = {tuple(r) for r in presentation.sum_and_last_alumni(spark, alumni).collect()}
    assert got == {("A", 3.0, 5.0), ("B", 1.0, 1.0)}


def test_extract(spark):
    listing = """<tr><th data-append-csv="a01" data-stat="player"><a href="/a">Al</a></th>
<td data-stat="year_min">2000</td><td data-stat="year_max">2000</td>
<td data-stat="college_name"><a href="/c">Duke</a></td></tr>"""
    colleges = spark.createDataFrame([("Duke", "North Carolina")], "college string, state string")
    people = extract.players(html(spark, listing), colleges)
    assert tuple(people.first()) == ("a01", "Al", "Duke", "North Carolina", "2000", "2000")

    page = '<tr id="per_game.2000"><td data-stat="g">2</td><td data-stat="pts_per_g">4.5</td></tr>'
    pages_of = spark.createDataFrame([("a01", page)], "player_id string, html string")
    stats = extract.season_stats(people, pages_of)
    got = {r.season: (r.games_played, r.points) for r in stats.collect()}
    assert got == {"1999-2000": ("2", "4.5"), "2000-2001": (None, None)}
    assert extract.season_stats(people, pages_of, first=4).count() == 4

    cells = "".join(f"<td>{i}</td>" for i in range(1, 28)) + "<td><i>9.5</i></td>"
    log = f'<table id="pgl_basic"><tr id="pgl_basic.7"><th>1</th>{cells}</tr></table>'
    logs = spark.createDataFrame(
        [("a01", "1999-2000", log), ("a01", "2000-2001", log)],
        "player_id string, season string, html string",
    )
    (game,) = extract.games(stats, logs).collect()
    assert (game.season, game.season_game, game.game_score, game.plus_minus) == (
        "1999-2000", "1", "9.5", "0",
    )


def test_limit(spark, files):
    few = populate.populate(spark, files["players"], files["stats"], files["games"], limit=3)
    assert {r.entity for r in few.seasons.select("entity").distinct().collect()} == {"p00", "p01", "p02"}


def test_documents(spark, tables, files):
    games = tsv.read_games(spark, files["games"]).rows
    docs = populate.documents(populate.clean_games(games), tables.seasons, tables.members)
    rows = docs.collect()
    assert sorted(r.number for r in rows) == list(range(12))
    assert sum(len(s.games) for r in rows for s in r.seasons.values()) == files["n_games"]
    # The repeated game: the later row wins.
    repeated = next(r for r in rows if r.player_id == "p04").seasons
    assert repeated[min(repeated)].games["1"].points == "1"
    assert next(iter(rows[0].seasons.values())).games["1"].age_of_player == "0"
    flat = season_rows(docs, ["player_id"]).count()
    assert flat == len(files["expected"])
    one = docs.filter("player_id = 'p00'").select(
        season_stat(F.lit(2000), "points"), season_stat(F.lit(1900), "points")
    )
    assert tuple(one.first()) == (files["expected"]["p00", 2000]["points"], None)
    entry = compact(docs, ["player_id"], ["points"]).filter("player_id = 'p00'").first().seasons
    assert {e.season: e.stats for e in entry}[2000] == [
        {"points": files["expected"]["p00", 2000]["points"]}
    ]


def test_tsv_round_trip(spark, tmp_path):
    rows = [('a "quoted" name', " spaced ", "x"), ("tab\there", "", None)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    path = str(tmp_path / "out")
    tsv.write_tsv(df, path, header={"A A": "a", "B": "b", "C": "c"})
    back = {tuple(r) for r in tsv.read_tsv(spark, path, ["a", "b", "c"]).collect()}
    assert back == {('a "quoted" name', " spaced ", "x"), ("tab\there", None, None)}


def test_read_scores_drops_malformed_rows(spark, tmp_path):
    path = tmp_path / "scores.tsv"
    path.write_text("a\t1.5\t2\nbroken\n\nb\t2\t3\n")
    fields = [("name", T.StringType()), ("score", T.DoubleType()), ("alumni", T.DoubleType())]
    schema = T.StructType([T.StructField(*f) for f in fields])
    got = {tuple(r) for r in tsv.read_scores(spark, str(path), schema).collect()}
    assert got == {("a", 1.5, 2.0), ("b", 2.0, 3.0)}


def test_tab_lines(spark):
    df = spark.sql("SELECT 'k' AS a, struct(1 AS x, struct(2 AS y, 'z' AS z) AS n) AS v")
    assert tsv.tab_lines(df).first()[0] == "k\t1\t2\tz"


def html(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, html string")


def test_listing_page(spark):
    page = """<table>
<tr><th scope="row" data-append-csv="abdul01" data-stat="player"><a href="/a">Al Abdul</a></th>
<td data-stat="year_min">1991</td><td data-stat="year_max">1995</td>
<td data-stat="college_name"><a href="/c">Duke</a></td></tr>
<tr><th data-append-csv="ace02" data-stat="player"><strong><a href="/b">Bo Ace</a></strong></th>
<td data-stat="year_min">2001</td><td data-stat="year_max">2001</td>
<td data-stat="college_name"></td></tr></table>"""
    got = pages.listing_players(html(spark, page)).collect()
    assert [tuple(r)[1:] for r in got] == [
        (0, "Al Abdul", "abdul01", "Duke", "1991", "1995"),
        (1, "Bo Ace", "ace02", "null", "2001", "2001"),
    ]


def test_season_page(spark):
    def row(year, g, pts):
        return f'<tr id="per_game.{year}" class="x"><td data-stat="g">{g}</td><td data-stat="pts_per_g">{pts}</td></tr>'

    page = row(2000, 70, "<strong>21.5</strong>") + row(2001, 60, 11) + row(2001, 20, "9.5")
    rows = pages.season_rows(html(spark, page))
    assert rows.columns == ["id", "season_end", "rows"]  # without the text of the page
    got = {r.season_end: (r.games_played, r.points, r.assists) for r in pages.season_cells(rows).collect()}
    assert got == {2000: ("70", "21.5", None), 2001: ("20", "9.5", None)}


def test_seasons_without_a_row(spark):
    players = spark.createDataFrame([("p", "2000", "2002"), ("q", "2000", "2001")], "player_id string, debut string, last string")
    page = '<tr id="per_game.2001"><td data-stat="g">7</td></tr>'
    player_pages = spark.createDataFrame([("p", page)], "player_id string, html string")
    got = {(r.player_id, r.season): r.games_played for r in extract.season_stats(players, player_pages).collect()}
    assert got == {("p", "1999-2000"): None, ("p", "2000-2001"): "7", ("p", "2001-2002"): None}


def test_key_with_regex_signs(spark):
    df = spark.createDataFrame(
        [("a(", "a(=1"), ("a.b", "axb=2 a.b=3"), (r"x\Ey", r"x\Ey=4")], "k string, html string"
    )
    got = pages.field_values(df, "html", {"v": "<key>=(.)"}, key="k").collect()
    assert [r.v for r in got] == ["1", "3", "4"]


def test_game_rows(spark):
    page = """<table id="pgl_basic"><tbody>
<tr id="pgl_basic.1"><td>1</td><td>1</td><td><a href="x">2000-11-01</a></td><td></td></tr>
<tr class="thead"><th>Rk</th></tr>
<tr id="pgl_basic.2"><th>2</th><td>2</td><td>Inactive</td></tr></tbody></table>"""
    got = pages.game_rows(html(spark, page), width=3).collect()
    assert [r.cells for r in got] == [["1", "2000-11-01", "0"], ["2", "Inactive", "0"]]


def test_second_match_is_preferred(spark):
    df = html(spark, "<i>1</i><i>2</i><i>3</i>", "<i>1</i>", "none")
    got = pages.field_values(df, "html", {"v": "<i>(.)</i>"}).collect()
    assert [r.v for r in got] == ["2", "1", None]


def test_keyed_template(spark):
    df = html(spark, "k0=a k1=b", "k0=a k1=b")
    got = pages.field_values(df, "html", {"v": "k<key>=(.)"}, key="id").collect()
    assert [r.v for r in got] == ["a", "b"]


def test_not_processed(spark):
    df = spark.createDataFrame([(1, "u"), (2, ""), (3, "w")], "id int, url string")
    left = pages.not_processed(df, df.filter("id = 3"), "id", "url")
    assert [tuple(r) for r in left.collect()] == [(1, "u")]
