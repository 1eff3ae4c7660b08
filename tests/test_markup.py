import pytest

from reportloom.operators.markup import USAGE_REPLACEMENTS, cells, clean_markup, shred_rows, typed
from reportloom.schema import DIAGNOSIS_FIELDS, USAGE_FIELDS, Field

HEAD = "<tr><th>Priority</th><th>Finding</th></tr>"
TWO = (Field(1, "n", "Priority", "int"), Field(2, "t", "Finding", "string"))


def shred(spark, *bodies, **options):
    docs = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "report_id int, html string")
    rows = cells(shred_rows(docs, **options)).orderBy("report_id", "table_pos", "row_pos").collect()
    return [(r.report_id, r.table_pos, r.row_pos, r.cells, r.problem) for r in rows]


def only_cells(spark, row):
    return shred(spark, f"<table>{HEAD}{row}</table>")[0][3]


@pytest.mark.parametrize("row, expected", [
    ("<tr><td>a</td><td></td><td>c</td></tr>", ["a", "", "c"]),
    ("<tr><td>a</td><td/><td>c</td></tr>", ["a", "", "c"]),
    ("<tr><td>a</td><td class='n'/><td class=\"n\">c</td></tr>", ["a", "", "c"]),
    ("<tr><td> a </td><td> </td></tr>", [" a ", " "]),
    ("<TR><TD>a</TD><td>b</TD></TR>", ["a", "b"]),
    ("<tr><td>a &amp; b</td><td>&lt;i&gt; &quot;&#39;&#x41;</td></tr>", ["a & b", "<i> \"'A"]),
    ("<tr><td>&amp;lt;</td></tr>", ["&lt;"]),
    ("<tr><td>see <a href='u?a=1'>this</a> now</td></tr>", ["see this now"]),
    ("<tr><td>one<br>two<br/>three</td></tr>", ["onetwothree"]),
    ('<tr><td><a href="#top">Jump to top</a>a</td></tr>', ["a"]),
    ("<tr><td>x</td><td>NULL</td></tr>", ["x", "NULL"]),
    ("<tr>\n  <td>a\nb</td>\n  <td>c</td>\n</tr>", ["a\nb", "c"]),
    ("<tr></tr>", []),
])
def test_cells(spark, row, expected):
    assert only_cells(spark, row) == expected


@pytest.mark.parametrize("row", [
    "<tr><td>a<td>b</td></tr>", "<tr><td>a</td></td></tr>", "<tr><td>a &nbsp; b</td></tr>",
    "<tr><td width=3>a</td></tr>", "<tr><td>a & b</td></tr>"])
def test_a_malformed_row_is_set_aside_and_the_next_is_read(spark, row):
    rows = shred(spark, f"<table>{HEAD}{row}<tr><td>1</td></tr></table>")
    assert [(r[3], r[4]) for r in rows] == [(None, "malformed row"), (["1"], None)]


def test_only_the_first_table_counts(spark):
    body = "<p>a</p><TABLE id='t'>%s<tr><td>1</td></tr></TABLE><table>%s<tr><td>2</td></tr></table>" % (HEAD, HEAD)
    assert [r[3] for r in shred(spark, body)] == [["1"]]
    assert [(r[1], r[3]) for r in shred(spark, body, all_tables=True)] == [(0, ["1"]), (1, ["2"])]


def test_documents_without_rows_give_nothing(spark):
    assert shred(spark, "<p>none</p>", f"<table>{HEAD}</table>", "<table></table>", "",
                 "<tr><td>a</td></tr><tr><td>b</td></tr>") == []


def test_headings_are_compared_by_name(spark):
    docs = spark.createDataFrame(
        [(1, f"<table>{HEAD}<tr><td>1</td></tr></table>"),
         (2, "<table><tr><th>Finding</th><th>Priority</th></tr><tr><td>1</td></tr></table>"),
         (3, "<table><tr><TH scope='col'>priority </TH><td><b>Find-ing</b></td></tr><tr><td>1</td></tr></table>")],
        "report_id int, html string")
    found = {r.report_id: r.header_ok for r in shred_rows(docs, fields=TWO).collect()}
    assert found == {1: True, 2: False, 3: True}


def test_missing_and_blank_cells(spark):
    rows = spark.createDataFrame([(["7", " \t"],), (["", "x"],), (["1,5"],), (["3000000000", "a"],), (None,)],
                                 "cells array<string>")
    assert [tuple(r) for r in typed(rows, TWO, []).collect()] == [
        (7, None), (None, "x"), (15, None), (None, "a"), (None, None)]
    assert [tuple(r) for r in typed(rows, TWO, [], empty_as_null=False, failed="f").collect()] == [
        ([], 7, ""), ([], None, "x"), ([], 15, None), ([1], None, "a"), ([], None, None)]


def test_replacements_in_order(spark):
    body = ("<link rel=\"stylesheet\" href=\"styles.css\"><table id='IndexUsgTable' class='IndexUsageTable sortable'>"
            "<tr><td><br></td></tr></table><a href=\"#top\">Jump to top</a>")
    df = clean_markup(spark.createDataFrame([(body,)], "html string"), "html", USAGE_REPLACEMENTS)
    assert df.first().html == "<table><tr><td>x</td></tr></table>"


def test_layouts():
    assert [f.position for f in USAGE_FIELDS] == list(range(1, 61))
    assert sum(f.kept for f in USAGE_FIELDS) == 59 and len(DIAGNOSIS_FIELDS) == 11
    count = lambda *types: sum(f.type in types for f in USAGE_FIELDS)
    assert (count("int"), count("bigint"), count("decimal(18,2)"), count("timestamp_ntz")) == (8, 16, 3, 6)


def test_no_work_is_done_twice(spark):
    docs = spark.createDataFrame([(1, "<table></table>")], "report_id int, html string")
    plan = (typed(cells(shred_rows(docs, fields=TWO)), TWO, ["report_id", "problem"]).where("problem is null")
            ._jdf.queryExecution().executedPlan().toString())
    assert plan.count("from_xml(") == 1 and plan.count("(?i)</tr") == 1
    assert "Exchange" not in plan and "Python" not in plan
