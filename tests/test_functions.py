import pytest
from pyspark.sql import functions as F

from debutrank.categories import CATEGORIES, Bonus, Category, Threshold, category
from debutrank.functions import cells, periods, scores


def values(spark, text_column, rows, *columns):
    df = spark.createDataFrame([(r,) for r in rows], f"{text_column} string")
    return [tuple(r) for r in df.select(*columns).collect()]


def test_lenient_double(spark):
    texts = ["12.5", "", None, "Inactive", " 7 ", "-3", "1e2", "1.5d", "2f", "0x1p3", "+4"]
    got = [v for (v,) in values(spark, "t", texts, cells.lenient_double("t"))]
    assert got == [12.5, 0.0, 0.0, 0.0, 7.0, -3.0, 100.0, 0.0, 0.0, 0.0, 4.0]


def test_default_missing(spark):
    df = spark.createDataFrame([("", None, "x")], "a string, b string, c string")
    assert tuple(cells.default_missing(df, df.columns).first()) == ("0", "0", "x")


def test_season_labels(spark):
    got = spark.range(1).select(
        periods.season_label(F.lit(1999)),
        periods.season_start(F.lit("1999-2000")),
        periods.shift_label(F.lit("1999-2000")),
        periods.season_start(F.lit("unknown")),
    )
    assert tuple(got.first()) == ("1999-2000", 1999, "2000-2001", None)


@pytest.mark.parametrize(
    "op, expected",
    [(">=", [0, 1, 1]), (">", [0, 0, 1]), ("<=", [1, 1, 0]), ("<", [1, 0, 0]),
     ("==", [0, 1, 0]), ("!=", [1, 0, 1])],
)
def test_comparisons(spark, op, expected):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "v double")
    test = scores.threshold_holds(Threshold("v", op, 0.5), F.col("v"), F.lit(4.0))
    assert [int(r[0]) for r in df.select(test).collect()] == expected


def test_unknown_comparison():
    with pytest.raises(ValueError, match="comparison"):
        scores.threshold_holds(Threshold("v", "~"), F.lit(1), F.lit(1))


def test_no_thresholds_hold(spark):
    assert spark.range(1).select(scores.thresholds_hold([], F.col, F.col)).first()[0] is True


def test_bonus_applies_to_a_zero_value(spark):
    term = scores.bonus_term(Bonus("x", 0.2, -1), F.lit(0.0), F.lit(5.0))
    assert spark.range(1).select(term).first()[0] == pytest.approx(1.0)


def test_minmax_of_equal_bounds_is_null(spark):
    got = spark.range(1).select(
        scores.minmax(F.lit(2.0), F.lit(2.0), F.lit(2.0)),
        scores.minmax(F.lit(3.0), F.lit(2.0), F.lit(4.0)),
    )
    assert tuple(got.first()) == (None, 0.5)


def test_category_lookup():
    assert category("attackers") is category("att")
    assert len({c.short for c in CATEGORIES}) == 7
    assert category(CATEGORIES[0]) is CATEGORIES[0]
    with pytest.raises(ValueError, match="unknown category"):
        category("goalkeepers")


@pytest.mark.parametrize("preset", CATEGORIES, ids=lambda c: c.short)
def test_presets_are_consistent(preset):
    preset.check()
    assert sum(preset.weights.values()) == pytest.approx(1.0)


def test_check_rejects_unknown_statistics():
    with pytest.raises(ValueError, match="unknown statistics"):
        Category("c", "c", {"shoe_size": 1.0}).check()
