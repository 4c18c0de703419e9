"""Table rows of pages with nested markup, from a stream of tags with their depth.

A regular expression that ends a row at the next closing tag breaks where a cell holds a table. Here a page
is cut into tags and texts, the depth of tables is a running sum over them, and a cell belongs to the last
row that was opened at its own depth. Comments, scripts and styles do not count, attributes may be
quoted either way, and character references in texts are decoded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from debutrank.functions.cells import MISSING_CELL
from debutrank.session import written

_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)|<!(?!--)[^>]*>"
# A tag with its quoted attributes, or a text; a "<" that starts no tag is a text of its own.
_PIECE = r"""(?s)</?[a-zA-Z](?:"[^"]*+"|'[^']*+'|[^'">])*+>|[^<]++|<"""
_NAME = r"^</?([a-zA-Z][^\s/>]*)"
# The character references that are decoded by name.
_NAMED = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": "\u00a0"}
_REFERENCE = r"&#(?:[xX][0-9a-fA-F]{1,6}|[0-9]{1,7});|" + "|".join(_NAMED)


def decoded(text: Column) -> Column:
    """The text with its character references replaced once: numbers, and the names of markup; others stay."""

    def character(reference: Column) -> Column:
        digits = F.substring(reference, F.lit(3), F.length(reference) - 3)
        hexed = F.lower(digits).startswith("x")
        code = F.when(hexed, F.conv(F.substring(digits, F.lit(2), F.length(digits)), 16, 10)).otherwise(digits)
        code = code.try_cast("long")
        good = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        out = F.when(good, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        for name, named in _NAMED.items():
            out = out.when(reference == name, F.lit(named))
        return out.otherwise(reference)

    texts = F.split(text, _REFERENCE, -1)
    characters = F.transform(F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0)), character)
    whole = F.array_join(F.zip_with(texts, characters, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.when(text.contains("&"), whole).otherwise(text)


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag, quoted either way or not at all; NULL where the tag has none."""
    found = rf"""(?is)^</?[a-z](?:"[^"]*+"|'[^']*+'|[^'">\s])*+(?:\s+(?!{name}\s*=)(?:"[^"]*+"|'[^']*+'|[^'">\s])*+)*+\s+{name}\s*="""
    value = rf"""{found}\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    parts = [F.regexp_extract(tag, value, i) for i in (1, 2, 3)]
    return F.when(tag.rlike(value), decoded(F.concat(*parts)))


def stream(df: DataFrame, html: str) -> DataFrame:
    """The tags and texts of every page, in order, with the depth of tables.

    Adds ``_page`` (a number of the row), ``_pos``, ``_piece``, ``_name`` (lower case, empty for a text),
    ``_closes``, ``_depth`` (of a table's own tags: that of its content) and the next two pieces. The pages are
    written with their numbers. A page is a group of its own, whose pieces are sorted on disk if there are many. A null page has none.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c != html]
    numbered = written(df.withColumn("_page", F.monotonically_increasing_id()), "pages")
    pieces = F.regexp_extract_all(F.regexp_replace(html, _HIDDEN, ""), F.lit(_PIECE), F.lit(0))
    rows = numbered.select(*kept, "_page", F.posexplode(pieces).alias("_pos", "_piece"))
    tag = F.col("_piece").rlike(_NAME)
    rows = rows.withColumns({
        "_name": F.when(tag, F.lower(F.regexp_extract("_piece", _NAME, 1))).otherwise(""),
        "_closes": tag & F.col("_piece").startswith("</"),
    })
    of_page = Window.partitionBy("_page").orderBy("_pos")
    table = F.when(F.col("_name") == "table", F.when(F.col("_closes"), -1).otherwise(1)).otherwise(0)
    so_far = F.sum(table).over(of_page.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    own = so_far + F.when((F.col("_name") == "table") & F.col("_closes"), 1).otherwise(0)
    return rows.withColumns({
        "_depth": own, "_next": F.lead("_piece", 1).over(of_page), "_after": F.lead("_piece", 2).over(of_page),
    })


def _text(piece: str) -> Column:
    """The piece if it is a text, else empty."""
    return F.when(F.col(piece).rlike(_NAME), "").otherwise(F.coalesce(F.col(piece), F.lit("")))


def row_cells(
    df: DataFrame,
    html: str,
    row_id: str,
    width: int,
    name: str = "cells",
    position: str = "position",
    skip: int = 0,
) -> DataFrame:
    """One row per table row whose ``id`` matches the pattern ``row_id``, as an array of cell texts.

    A cell's text is its own leading text, else that of its first child, else ``0``; the first ``skip`` cells
    are left out, and a row that is then not ``width`` long gets one ``0`` appended, as in ``pages.row_cells``.
    ``position`` counts the rows found on the page. Rows of a table inside a cell are rows of their own, and
    never cells of the outer row. A row without cells is not found.
    """
    kept = [c for c in df.columns if c != html]
    parts = stream(df.filter(F.col(html).rlike("(?i)<tr")), html).filter(F.col("_name").isin("tr", "td", "th") & ~F.col("_closes"))
    before = Window.partitionBy("_page", "_depth").orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = F.when(F.col("_name") == "tr", F.struct(F.col("_pos").alias("at"), F.col("_piece").alias("tag")))
    cells = parts.withColumn("_row", F.last(opened, ignorenulls=True).over(before)).filter("_name <> 'tr'")
    cells = cells.filter(F.coalesce(attribute(F.col("_row.tag"), "id").rlike(row_id), F.lit(False)))
    own, child = _text("_next"), F.when(F.col("_next").rlike(r"^<[a-zA-Z]"), _text("_after")).otherwise("")
    text = decoded(F.coalesce(F.nullif(own, F.lit("")), F.nullif(child, F.lit("")), F.lit(MISSING_CELL)))
    first = [F.first(f"`{c}`").alias(c) for c in kept]
    rows = cells.groupBy("_page", F.col("_row.at").alias("_at")).agg(
        *first, F.sort_array(F.collect_list(F.struct("_pos", text.alias("t")))).alias("_cells")
    )
    texts = F.transform("_cells", lambda c: c["t"])
    left = F.slice(texts, skip + 1, F.greatest(F.size(texts) - skip, F.lit(0)))
    padded = F.when(F.size(left) == width, left).otherwise(F.concat(left, F.array(F.lit(MISSING_CELL))))
    number = F.row_number().over(Window.partitionBy("_page").orderBy("_at")) - 1
    return rows.withColumn(position, number).select(*kept, position, padded.alias(name))
