"""Tables for presentation: entities, groups and regions with all scores and a total."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debutrank.operators.dedupe import dedupe_first, dedupe_last
from debutrank.operators.ranking import rescale_columns, sum_and_last
from debutrank.operators.rollup import merge_categories, present, roll_up, with_total
from debutrank.schemas import ALUMNI_FILE, GROUP_FILE, REGION_FILE
from debutrank.sources.tsv import FILE_ORDER, read_category_files, read_tsv, with_file_order


def group_table(spark: SparkSession, base: str, categories: Mapping[str, str]) -> DataFrame:
    """Groups of the base file (first row of a name) with the scores of the category files."""
    return _merged(spark, read_tsv(spark, base, GROUP_FILE, header=False), categories)


def region_table(spark: SparkSession, base: str, categories: Mapping[str, str]) -> DataFrame:
    """Regions of the base file with the scores of the category files."""
    return _merged(spark, read_tsv(spark, base, REGION_FILE, header=False), categories)


def entity_table(
    spark: SparkSession, entities: DataFrame, categories: Mapping[str, str], key: str = "player_id"
) -> DataFrame:
    """Entities that are present already, with the scores of the category files."""
    return merge_categories(entities, _last_scores(spark, categories, key), key, list(categories))


def _merged(spark, rows, categories):
    base = dedupe_first(with_file_order(rows).dropna(subset=["name"]), ["name"], FILE_ORDER)
    scores = _last_scores(spark, categories, "name")
    return merge_categories(base.drop(*FILE_ORDER), scores, "name", list(categories))


def _last_scores(spark, categories, key):
    scores = read_category_files(spark, categories)
    last = dedupe_last(scores, ["name", "category"], FILE_ORDER)
    return last.select(F.col("name").alias(key), "category", "score")


def sum_and_last_alumni(spark: SparkSession, path: str) -> DataFrame:
    """Per name of an alumni file: the sum of the scores and the last number of alumni."""
    rows = with_file_order(read_tsv(spark, path, ALUMNI_FILE, header=False)).dropna(how="any")
    return sum_and_last(rows, "name", "score", "alumni", FILE_ORDER)


def entity_totals(ranked: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Entities with each score rescaled by its maximum, and the sum of the scores."""
    return present(ranked, columns)


def group_totals(ranked: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Groups with each score rescaled by its maximum, and the sum of the scores."""
    return present(ranked, columns)


def region_totals(
    regions: DataFrame, groups: DataFrame, region: str, columns: Sequence[str]
) -> DataFrame:
    """Regions: the groups' presented scores summed, rescaled, and their total.

    The total of the groups is rolled up as well, but the final score is the sum of
    the rescaled columns.
    """
    rolled = roll_up(regions, groups, region, columns)
    return with_total(rescale_columns(rolled, columns), columns)
