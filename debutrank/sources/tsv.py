"""Tab-separated files, with and without a header row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from debutrank.schemas import CATEGORY_FILE, GAME_FILE, PLAYER_FILE, SEASON_FILE, text_schema
from debutrank.session import written

FILE_ORDER = ("_file", "_line")
_MALFORMED = "_malformed"

_DIALECT = {
    "sep": "\t",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_tsv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | T.StructType,
    header: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Read by position with the given names; plain names mean text columns.

    ``multi_line`` allows line breaks inside quoted cells, but a file read that way
    cannot be split among tasks.
    """
    schema = columns if isinstance(columns, T.StructType) else text_schema(columns)
    return spark.read.csv(
        path, schema=schema, header=header, enforceSchema=True, multiLine=multi_line, **_DIALECT
    )


class Checked(NamedTuple):
    """``rows``: the well-formed lines, with their file order. ``rejected``: ``file`` and ``line`` (text) of the others."""

    rows: DataFrame
    rejected: DataFrame


def read_checked(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | T.StructType,
    header: bool = True,
    required: Sequence[str] = (),
) -> Checked:
    """Read like ``read_tsv``, and keep the lines that do not fit instead of losing or bending them.

    A line is rejected if it has more or fewer cells than ``columns``, which a quote without its partner also
    leads to, if a cell cannot be read as its column's type, or if a ``required`` cell is empty. A cell with a
    line break is two such lines. The files are parsed once: what was read is written, and both parts are read from that.
    """
    schema = columns if isinstance(columns, T.StructType) else text_schema(columns)
    read = spark.read.csv(
        path, schema=T.StructType([*schema.fields, T.StructField(_MALFORMED, T.StringType())]), header=header,
        enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_MALFORMED, **_DIALECT,
    )
    stored = written(with_file_order(read), "checked")
    bad = F.col(_MALFORMED).isNotNull()
    for c in required:
        bad = bad | F.col(c).isNull()
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in schema.names]
    line = F.coalesce(F.col(_MALFORMED), F.concat_ws("\t", *cells)).alias("line")
    return Checked(
        stored.filter(~bad).drop(_MALFORMED), stored.filter(bad).select(F.col(FILE_ORDER[0]).alias("file"), line)
    )


def read_scores(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """Header-less score file; rows that lack one of the columns are malformed and dropped."""
    return read_tsv(spark, path, columns, header=False).dropna(how="any")


def with_file_order(df: DataFrame) -> DataFrame:
    """Columns that order the rows as in the files they were read from."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(FILE_ORDER[0]),
        F.monotonically_increasing_id().alias(FILE_ORDER[1]),
    )


def read_category_files(
    spark: SparkSession, paths: Mapping[str, str], columns: T.StructType = CATEGORY_FILE
) -> DataFrame:
    """Score files of several categories as one table, with the file order.

    ``paths`` maps the short name of a category to its file.
    """
    files = [
        with_file_order(read_tsv(spark, path, columns, header=False))
        .dropna(how="any", subset=columns.names)
        .withColumn("category", F.lit(short))
        for short, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, files)


def check_category_files(
    spark: SparkSession, paths: Mapping[str, str], columns: T.StructType = CATEGORY_FILE
) -> Checked:
    """``read_category_files`` with the lines that it leaves out, and with the category of either."""
    parts = {short: read_checked(spark, path, columns, False, columns.names) for short, path in paths.items()}

    def together(frames: Mapping[str, DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, [f.withColumn("category", F.lit(short)) for short, f in frames.items()])

    return Checked(
        together({k: p.rows for k, p in parts.items()}), together({k: p.rejected for k, p in parts.items()})
    )


def read_players(spark: SparkSession, path: str) -> Checked:
    return read_checked(spark, path, list(PLAYER_FILE.values()))


def read_season_stats(spark: SparkSession, path: str) -> Checked:
    return read_checked(spark, path, list(SEASON_FILE.values()))


def read_games(spark: SparkSession, path: str) -> Checked:
    return read_checked(spark, path, list(GAME_FILE.values()))


def write_tsv(
    df: DataFrame, path: str, header: Mapping[str, str] | bool = True, mode: str = "error"
) -> None:
    """Write tab separated; ``header`` may map header texts to the columns, in file order."""
    if isinstance(header, Mapping):
        df = df.select([F.col(column).alias(text) for text, column in header.items()])
    df.write.csv(
        path, header=bool(header), mode=mode, emptyValue="", nullValue="", **_DIALECT
    )


def tab_lines(df: DataFrame, name: str = "line") -> DataFrame:
    """Each row as one tab-separated text; struct columns are flattened, at any depth."""
    return df.select(F.concat_ws("\t", *_leaves(df.schema)).alias(name))


def _leaves(schema: T.StructType, prefix: str = "") -> list:
    out = []
    for f in schema.fields:
        path = f"{prefix}`{f.name}`"
        if isinstance(f.dataType, T.StructType):
            out += _leaves(f.dataType, path + ".")
        else:
            out.append(F.col(path).cast("string"))
    return out
