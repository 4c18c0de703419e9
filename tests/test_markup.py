"""Nested markup: rows and cells by depth, references, and odd pages."""

import pytest
from pyspark.sql import functions as F

from debutrank.sources import markup


def cells(spark, page, row_id="^r", **kwargs):
    df = spark.createDataFrame([(1, page)], "k int, html string")
    found = markup.row_cells(df, "html", row_id, kwargs.pop("width", 2), **kwargs)
    return [r.cells for r in found.orderBy("position").collect()]


INNER = '<table><tr id="r9"><td>x</td><td>y</td></tr></table>'

PAGES = {
    "plain": ('<tr id="r1"><td>a</td><td>b</td></tr>', [["a", "b"]]),
    "single quotes": ("<tr class='id' id='r1'><td data-x='>'>a</td><th>b</th></tr>", [["a", "b"]]),
    "no quotes": ("<TR ID=r1><TD>a</TD><TD>b</TD></TR>", [["a", "b"]]),
    "inner table": (f'<table><tr id="r1"><td>a</td><td>{INNER}</td><td>c</td></tr></table>', [["a", "0", "c", "0"], ["x", "y"]]),
    "inner table first": (f'<table><tr id="r1"><td>{INNER}<b>z</b></td><td>b</td></tr></table>', [["0", "b"], ["x", "y"]]),
    "unclosed cells": ('<table><tr id="r1"><td>a<td>b<tr id="q"><td>c</table>', [["a", "b"]]),
    "comment": ('<!-- <tr id="r0"><td>n</td></tr> --><tr id="r1"><td>a<!-- > -->b</td><td><!--x--><i>c</i></td></tr>', [["ab", "c"]]),
    "script": ('<script>"<tr id=r0><td>"</script><tr id="r1"><td>a</td><td>b</td></tr>', [["a", "b"]]),
    "child": ('<tr id="r1"><td><a href="?a=1&b=2">a</a></td><td><a><b>deep</b></a></td></tr>', [["a", "0"]]),
    "empty": ('<tr id="r1"><td></td><td> </td></tr>', [["0", " "]]),
    "references": ('<tr id="r1"><td>&lt;&#65;&#x1F600;&amp;lt;</td><td>&#0;&copy;&#xD800;&#38;amp;</td></tr>', [["<A😀&lt;", "&#0;&copy;&#xD800;&amp;"]]),
    "other ids": ('<tr><td>a</td></tr><tr class="r1"><td>b</td></tr><tr data-id="r1"><td>c</td></tr>', []),
    "less than": ('<tr id="r1"><td>1 < 2</td><td>b</td></tr>', [["1 ", "b"]]),
    "padded": ('<tr id="r1"><td>a</td></tr><tr id="r2"><td>a</td><td>b</td><td>c</td></tr>', [["a", "0"], ["a", "b", "c", "0"]]),
    "tables in a row": ('<table><tr id="r1"><td>a</td></tr></table><table><tr id="q"><td>b</td></tr><tr id="r2"><td>c</td><td>d</td></tr></table>', [["a", "0"], ["c", "d"]]),
    "nothing": ("", []),
    "unended": ('<tr id="r1"><td>a</td><td>b</td><td <!-- never', [["a", "b"]]),
}


@pytest.mark.parametrize("name", PAGES)
def test_rows(spark, name):
    page, want = PAGES[name]
    assert cells(spark, page) == want


def test_pages_are_kept_apart(spark):
    rows = [(1, "p", PAGES["inner table"][0]), (2, None, None), (1, "p", PAGES["plain"][0]), (3, "q", PAGES["plain"][0] * 2)]
    df = spark.createDataFrame(rows, "k int, _x string, html string").repartition(3)
    got = markup.row_cells(df, "html", "^r", 2, name="c", position="n", skip=1)
    assert got.columns == ["k", "_x", "n", "c"]
    assert sorted(tuple(r) for r in got.collect()) == [
        (1, "p", 0, ["0", "c"]), (1, "p", 0, ["b", "0"]), (1, "p", 1, ["y", "0"]),
        (3, "q", 0, ["b", "0"]), (3, "q", 1, ["b", "0"]),
    ]
    assert markup.row_cells(df.limit(0), "html", "^r", 2).count() == 0


def test_a_long_page(spark):
    page = "<table>" + "".join(f'<tr id="r{i}"><td>{i}</td><td>{INNER if i % 50 == 0 else "b"}</td></tr>' for i in range(5000)) + "</table>"
    got = cells(spark, page, row_id=r"^r\d+$")
    assert len(got) == 5100
    assert got[:3] == [["0", "0"], ["x", "y"], ["1", "b"]]


@pytest.mark.parametrize(
    "tag, want",
    [('<a id="x">', "x"), ("<a ID = 'x y'>", "x y"), ("<a b=\" id='no'\" id=z>", "z"), ("<a data-id=1>", None), ("<a id>", None), ('<a id="">', "")],
)
def test_attribute(spark, tag, want):
    assert spark.range(1).select(markup.attribute(F.lit(tag), "id")).first()[0] == want
