"""Rows that are no XML, read as browsers read them."""

import html
from html.parser import HTMLParser

import pytest

from reportloom.operators.markup import cells, shred_rows


class Cells(HTMLParser):
    """The standard library's reader: the text of each cell, implied ends included."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.cells, self.open = [], False

    def handle_starttag(self, tag, attrs):
        if tag == "td":
            self.cells.append("")
            self.open = True

    def handle_startendtag(self, tag, attrs):
        if tag == "td":
            self.cells.append("")
            self.open = False

    def handle_endtag(self, tag):
        if tag == "td":
            self.open = False

    def handle_data(self, data):
        if self.open:
            self.cells[-1] += data


def read(spark, row, loose=True):
    docs = spark.createDataFrame([(f"<table><tr><th>h</th></tr>{row}</table>",)], "html string")
    return [(r.cells, r.problem) for r in cells(shred_rows(docs), loose=loose).collect()]


@pytest.mark.parametrize("row", [
    "<tr><td>a &nbsp; b</td><td>&eacute;&euro;&Eacute;</td></tr>",
    "<tr><td nowrap>a</td><td width=3 title='x > y'>b</td></tr>",
    "<tr nowrap><td>a<td>b<td></tr>",
    "<tr><td>a & b</td><td>c && d &</td></tr>",
    "<tr><td>a</td></td><td>b</tr>",
    "<tr><td>&#233;&#x1F600;&#128512;&nbsp</td><td>&amp;lt; &amp;nbsp;</td></tr>",
    "<TR><TD NOWRAP>a<br>b<TD><b>c</i></TD></TR>",
    "<tr><td>&nbsp;</td><td nowrap>é日本</td><td>@x</tr>",
])
def test_the_cells_are_those_of_an_html_reader(spark, row):
    reader = Cells()
    reader.feed(row.replace("<br>", "").replace("&nbsp</td>", "&amp;nbsp</td>"))  # a reference without its end is left alone
    reader.close()
    assert read(spark, row) == [(reader.cells, None)]
    assert read(spark, row, loose=False) == [(None, "malformed row")]


@pytest.mark.parametrize("row", ["<tr>x<td>a &nbsp;</td></tr>", "<tr><td>a</td>x<td>&nbsp;</td></tr>", "<tr><td title='a>b</td><td>&nbsp;</td></tr>"])
def test_what_cannot_be_cut_is_set_aside(spark, row):
    assert read(spark, row) == [(None, "malformed row")]


def test_unknown_references_stay(spark):
    assert read(spark, "<tr><td>&nosuch; &nbsp; &#xD800; &#0; &#99999999;</td></tr>") == [(["&nosuch; \xa0 &#xD800; &#0; &#99999999;"], None)]


def test_sound_rows_are_read_as_before(spark):
    row = "<tr><td>a &amp; b</td><td/><td> </td></tr>"
    assert read(spark, row) == read(spark, row, loose=False) == [(["a & b", "", " "], None)]


def test_every_name(spark):
    names = sorted(html.entities.name2codepoint)
    row = "<tr>" + "".join(f"<td>&{n};</td>" for n in names) + "</tr>"
    assert read(spark, row)[0][0] == [chr(html.entities.name2codepoint[n]) for n in names]


def test_only_broken_rows_pay(spark):
    docs = spark.createDataFrame([("<table></table>",)], "html string")
    plan = cells(shred_rows(docs), loose=True).where("problem IS NULL")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml(") == 1 and "Exchange" not in plan
