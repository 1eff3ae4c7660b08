"""What large loads must not do: parse plain rows as XML, start Python for small files, work rows out again for each use."""

import pytest
from pyspark.sql import functions as F

from checks import queries
from reportloom.operators.markup import CELLS_XML, XML_OPTIONS, _with_plain_cells, cells, loose_cells
from reportloom.sources.identity import with_row_key
from reportloom.sources.reports import file_forms, read_report_rows

PLAIN = ["<tr><td>a</td><td></td><td>c d</td></tr>", "<tr>\n <td>a\nb</td>\n<td>c \t</td></tr>", "<tr><td>&amp;lt; &lt;&gt;&quot;&apos;</td><td>&amp;amp;</td></tr>",
         "<tr><td>é日本\U0001f600 > ]] </td></tr>", "<tr><td>" + "</td><td>".join(map(str, range(5000))) + "</td></tr>"]
OTHER = ["<tr></tr>", "<tr> </tr>", "<tr><td> a</td></tr>", "<tr><td>\n</td></tr>", "<tr><td>a<td>b</td></tr>", "<tr><td>a</td>x<td>b</td></tr>", "<tr>x<td>a</td></tr>",
         "<tr><td>a</td><td></tr>", "<tr><td>a</td></td></tr>", "<tr><td>a&am</td><td>p;b</td></tr>", "<tr><td>&nbsp;</td></tr>", "<tr><td>&#65;</td></tr>", "<tr><td>]]></td></tr>",
         "<tr><td>a\x01</td></tr>", "<tr><td>a\r\nb</td></tr>", "<tr><td/><td>a</td></tr>", "<tr class='x'><td>a</td></tr>", "<TR><TD>a</TD></TR>", "<tr><td>a</td></tr><tr><td>b</td></tr>",
         "<tr><td>a</td></tr> ", "</td><td>a</td></tr>", "<tr><td>a", "<tr><td>a</td><td>", "<tr><th>a</th><td>b</td></tr>"]


def test_plain_rows_need_no_parser_and_give_what_it_gives(spark):
    rows = spark.createDataFrame([(i, r) for i, r in enumerate([*PLAIN, *OTHER])], "i int, tr string")
    found = {r.i: r._plain for r in _with_plain_cells(rows, "tr").collect()}
    assert [i for i, cells_ in sorted(found.items()) if cells_ is not None] == list(range(len(PLAIN)))
    parsed = rows.select("i", F.from_xml("tr", CELLS_XML, XML_OPTIONS).alias("x"), "tr").collect()
    read = {r.i: (r.cells, r.problem) for r in cells(rows).collect()}
    for r in parsed:
        if "TD" not in r.tr:  # the parser knows lower case only
            assert read[r.i] == ((None, "malformed row") if r.x._corrupt_record is not None else (r.x.td or [], None)), r.tr


def test_a_loose_row_is_cut_once():
    assert str(loose_cells(F.col("tr"))).count("</tr") == 1


def test_small_files_are_looked_at_without_python(spark, tmp_path, monkeypatch):
    page = "<table><tr><th>h</th></tr><tr><td>{}</td></tr></table>"
    for i, (encoding, change) in enumerate([("utf-8", str), ("utf-8", str.upper), ("utf-16-le", str), ("utf-16-be", str.upper), ("utf-8", lambda text: "no row")]):
        (tmp_path / f"a+b {i}.html").write_bytes(change(page.format(i)).encode(encoding))
    (tmp_path / "empty.html").write_bytes(b"")
    frame, parts = type(spark.range(1)), []
    look = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, *a, **b: (parts.append(self.rdd.getNumPartitions()), look(self, *a, **b))[1])
    forms = file_forms(spark, str(tmp_path))
    assert sum(parts) == 0
    assert {form: len(names) for form, names in forms.items()} == {("UTF-8", "</tr"): 2, ("UTF-8", "</TR"): 1, ("UTF-16LE", "</tr"): 1, ("UTF-16BE", "</TR"): 1}
    rows = cells(read_report_rows(spark, str(tmp_path))).collect()
    assert sorted(r.cells[0] for r in rows) == ["0", "1", "2", "3"]


def test_no_files_of_the_size_give_no_rows(spark, tmp_path):
    (tmp_path / "a.html").write_text("<table></table>")
    assert read_report_rows(spark, str(tmp_path), size_above=1 << 40).columns == ["report_id", "source_path", "row_pos", "tr"]
    assert read_report_rows(spark, str(tmp_path), fields=(), size_above=1 << 40).collect() == []


def counted(spark, n=7):
    """Rows that count how often they are worked out."""
    seen = spark.sparkContext.accumulator(0)

    def see(i):
        seen.add(1)
        return i

    return spark.range(n).select(F.udf(see, "int")("id").alias("index_id")), seen


def test_rows_are_worked_out_once_to_be_numbered(spark, tmp_path):
    rows, seen = counted(spark)
    numbered = with_row_key(rows, str(tmp_path / "keys"), ["index_id"])
    assert [r.row_key - (1 << 40) for r in numbered.orderBy("index_id").collect()] == [1, 2, 3, 4, 5, 6, 7]
    assert seen.value == 7


@pytest.mark.parametrize("name, wanted", [("load_append", [14]), ("load_replace", [7, 7]), ("load_row_keys", None)])
def test_rows_are_worked_out_once_for_all_their_loads(spark, monkeypatch, name, wanted):
    rows, seen = counted(spark)
    more = rows.select(F.lit("1").alias("report_id"), "index_id", F.lit(None).cast("bigint").alias("rows"))
    monkeypatch.setattr(queries, "_usage_load", lambda *_: more)
    found = queries.QUERIES[name](spark, "")
    assert found.count() == 14 if wanted is None else [r.n_rows for r in found.collect()] == wanted
    assert seen.value == 7
