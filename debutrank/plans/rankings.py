"""Rankings of entities and groups, for one category or for all in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from debutrank.categories import CATEGORIES, Category, category
from debutrank.functions.cells import MISSING_GROUP
from debutrank.operators.ranking import group_sum_count, rescale_written, with_group
from debutrank.operators.scoring import long_scores, score_columns, score_entities
from debutrank.plans.populate import Tables
from debutrank.session import written
from debutrank.sources.tsv import FILE_ORDER, read_category_files, write_tsv

ALL = tuple(c.name for c in CATEGORIES)


def rank_entities(
    seasons: DataFrame,
    profile: DataFrame,
    name: str | Category,
    scaled: bool = False,
) -> DataFrame:
    """``entity, score`` with the scores rescaled to 0..100; the raw scores are written."""
    column = f"{category(name).short}_score"
    scores = score_entities(seasons, profile, [name], scaled=scaled)
    return rescale_written(scores.withColumnRenamed(column, "score"), "score", "scores")


def rank_groups(
    seasons: DataFrame,
    profile: DataFrame,
    members: DataFrame,
    name: str | Category,
    scaled: bool = False,
    without_missing: bool = False,
) -> DataFrame:
    """``grp, score, members``: the members' raw scores summed, then rescaled to 0..100."""
    column = f"{category(name).short}_score"
    scores = score_entities(seasons, profile, [name], scaled=scaled)
    return rank_groups_of(
        scores.withColumnRenamed(column, "score"), members, without_missing=without_missing
    )


def rank_groups_of(
    scores: DataFrame,
    members: DataFrame,
    columns: Sequence[str] | str = "score",
    without_missing: bool = False,
) -> DataFrame:
    """Like ``rank_groups``, from a stored table of raw scores, one column or several.

    The sums are written once, which gives their extrema, and read once by the rescaling.
    ``without_missing`` leaves out the entities without a group.
    """
    rows = with_group(scores, members)
    if without_missing:
        rows = rows.filter(F.col("grp") != MISSING_GROUP)
    return rescale_written(group_sum_count(rows, "grp", columns), columns, "group-scores")


def rank_entities_all(
    seasons: DataFrame,
    profile: DataFrame,
    categories: Sequence[str | Category] = ALL,
    scaled: bool = False,
) -> DataFrame:
    """``entity`` and a rescaled ``<short>_score`` per category.

    The raw scores are written once: the rescaling and all that follows read them.
    """
    columns = score_columns(categories)
    scores = score_entities(seasons, profile, categories, scaled=scaled)
    return rescale_written(scores, columns, "scores")


def rank_groups_all(
    seasons: DataFrame,
    profile: DataFrame,
    members: DataFrame,
    categories: Sequence[str | Category] = ALL,
    scaled: bool = False,
    without_missing: bool = False,
) -> DataFrame:
    """``grp``, a rescaled ``<short>_score`` per category, and ``members``."""
    scores = score_entities(seasons, profile, categories, scaled=scaled)
    return rank_groups_of(scores, members, score_columns(categories), without_missing)


def run(
    tables: Tables,
    action: str,
    groups: bool = False,
    scaled: bool = False,
    without_missing: bool = False,
) -> DataFrame:
    """The ranking for one action: a category name, or ``all`` for every category at once.

    ``scaled`` takes the statistics relative to the bounds of their period;
    ``without_missing`` leaves the group ``null`` out of a ranking of groups.
    """
    seasons, profile, members = tables.seasons, tables.profile, tables.members
    if action == "all":
        if groups:
            wide = rank_groups_all(seasons, profile, members, ALL, scaled, without_missing)
            return long_scores(wide, ["grp", "members"], ALL)
        return long_scores(rank_entities_all(seasons, profile, ALL, scaled), ["entity"], ALL)
    if groups:
        return rank_groups(seasons, profile, members, action, scaled, without_missing)
    return rank_entities(seasons, profile, action, scaled)


def write_score_files(
    tables: Tables, folder: str, groups: bool = False, scaled: bool = False, without_missing: bool = False
) -> dict[str, str]:
    """One header-less score file per category, ``<short>.tsv``; returns their paths.

    Lines are name and score, for groups also the number of members. These are the files that
    the presentation tables read. All categories come from one ranking, written once.
    """
    ranked = written(run(tables, "all", groups, scaled, without_missing), "ranking")
    columns = ["grp", "score", "members"] if groups else ["entity", "score"]
    paths = {}
    for c in CATEGORIES:
        paths[c.short] = f"{folder.rstrip('/')}/{c.short}.tsv"
        write_tsv(ranked.filter(F.col("category") == c.short).select(columns), paths[c.short], header=False)
    return paths


def read_score_files(spark: SparkSession, paths: Mapping[str, str], groups: bool = False) -> DataFrame:
    """``name, category, score`` and for groups ``members``, from score files."""
    schema = StructType().add("name", "string").add("score", "double")
    if groups:
        schema = schema.add("members", "long")
    return read_category_files(spark, paths, schema).drop(*FILE_ORDER)
