"""Rows of nested and sibling tables, whole and in pieces, against a stack of tags in plain Python."""

import random
import re

import pytest

from reportloom.plans.usage import checked, read_split
from reportloom.sources.reports import encoding_of, file_forms, literal_path, read_report_rows, read_reports

HEAD = "<tr><th>Order</th></tr>"
MODES = ({}, {"each_parent": True}, {"all_tables": True})


def by_stack(html):
    """Tables as (no, first inside its parent, rows of cells) by one pass over the tags."""
    tables, elements, seen = [], [[]], []
    for part in re.split(r"(<[^>]*>)", html):
        name = re.match(r"<(/?)(\w+)", part)
        open_ = [t for t in tables if t["open"]]
        if name and not name[1] and name[2].lower() not in ("br", "img"):
            if name[2].lower() == "table":
                tables.append({"first": "table" not in elements[-1], "rows": [], "open": True, "cell": False})
                seen.append(tables[-1])
            elif name[2].lower() == "tr" and open_:
                open_[-1]["rows"].append([])
            elif name[2].lower() in ("td", "th") and open_:
                open_[-1]["rows"][-1].append("")
                open_[-1]["cell"] = True
            elements[-1].append(name[2].lower())
            elements.append([])
        elif name and name[1]:
            elements.pop()
            if name[2].lower() == "table":
                open_[-1]["open"] = False
            elif name[2].lower() in ("td", "th"):
                open_[-1]["cell"] = False
        elif not name and open_ and open_[-1]["cell"]:
            open_[-1]["rows"][-1][-1] += part
    return [(i, t["first"], [r for r in t["rows"][1:]]) for i, t in enumerate(tables)]


def wanted(html, mode):
    found = by_stack(html)
    if not mode:
        found = found[:1]
    elif "each_parent" in mode:
        found = [t for t in found if t[1]]
    return sorted(str(r) for _, _, rows in found for r in rows)


def nest(rng, depth):
    rows = []
    for _ in range(rng.randrange(1, 4)):
        cells = []
        for _ in range(rng.randrange(1, 4)):
            text = rng.choice(["a", "b&amp;c", "", "é", "<b>x</b>y", "u<br>v"])
            inner = "".join(nest(rng, depth - 1) for _ in range(rng.choice([0, 1, 2]))) if depth > 1 and rng.random() < 0.5 else ""
            cells.append(f"<td>{text}{inner}{rng.choice(['', 'z'])}</td>")
        rows.append(f"<tr>{''.join(cells)}</tr>\n")
    table = f"<table id='t{depth}'>{HEAD}{''.join(rows)}</table>"
    return rng.choice([table, f"<div>{table}</div>", f"<p>{table}</p>{table}" if depth == 1 else table])


def document(seed):
    rng = random.Random(seed)
    return "<html><body>" + "".join(nest(rng, rng.randrange(1, 4)) for _ in range(rng.randrange(1, 4))) + "</body></html>"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    place = tmp_path_factory.mktemp("nested")
    for seed in range(6):
        (place / f"{seed}.html").write_text(document(seed))
    for seed in range(3):
        (place / f"w{seed}.html").write_bytes(document(seed).encode(("utf-16", "utf-16-le", "utf-16-be")[seed]))
    return place


@pytest.mark.parametrize("mode", MODES)
@pytest.mark.parametrize("limit", [10, 10**9])
def test_rows_are_those_of_a_tag_stack(spark, folder, mode, limit):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        rows = read_split(spark, str(folder), (), check_headings=False, size_limit=limit, id_pattern=r"([^/]+)\.html$", **mode).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert all(r.problem is None for r in rows)
    for name in {p.stem for p in folder.iterdir()}:
        mine = [r for r in rows if r.report_id == name]
        assert sorted(str(r.cells) for r in mine) == wanted(document(int(name.strip("w"))).replace("<br>", "").replace("&amp;", "&").replace("<b>", "").replace("</b>", ""), mode)


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "utf-16", "utf-16-le", "utf-16-be"])
@pytest.mark.parametrize("end", ["</tr>", "</TR>", "</Tr\n>"])
def test_encodings_and_row_ends(spark, tmp_path, encoding, end):
    rows = "".join(f"<tr><td>ü{i}</td><td>日本</td>{end}\n" for i in range(400))
    (tmp_path / "a.html").write_bytes(f"<p>x</p><table><tr><th>Order</th>{end}{rows}</table>".encode(encoding))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        found = [[r.cells for r in read_split(spark, str(tmp_path), (), check_headings=False, size_limit=limit).orderBy("row_pos").collect()]
                 for limit in (10, 10**9)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1] == [[f"ü{i}", "日本"] for i in range(400)]


def test_stray_bytes_fail_no_load(spark, tmp_path):
    """A second half of a pair of UTF-16 stands alone; a first half alone takes the next sign with it, as Java reads it."""
    body = "<table><tr><th>Order</th></tr><tr><td>a?b</td></tr></table>"
    (tmp_path / "a.html").write_bytes(body.encode("utf-16-le").replace("?".encode("utf-16-le"), b"\x00\xdc"))
    (tmp_path / "b.html").write_bytes(body.encode().replace(b"?", b"\xff"))
    for limit in (10, 10**9):
        rows = read_split(spark, str(tmp_path), (), check_headings=False, size_limit=limit).collect()
        assert [r.cells for r in rows] == [["a�b"]] * 2


def test_forms_of_files(spark, tmp_path):
    (tmp_path / "r[1].html").write_bytes("<table><TR><td>1</TR></table>".encode("utf-16"))
    (tmp_path / "s.html").write_text("no row at all")
    (tmp_path / "t.html").write_text("")
    forms = file_forms(spark, str(tmp_path))
    assert {k: len(v) for k, v in forms.items()} == {("UTF-16LE", "</TR"): 1, ("UTF-8", "</tr"): 1}
    assert encoding_of(b"") == encoding_of(b"a") == "UTF-8"
    assert read_report_rows(spark, str(tmp_path), glob="t.html").count() == 0
    assert read_reports(spark, literal_path(str(tmp_path / "r[1].html"))).count() == 1


def test_a_last_row_without_an_end(spark, tmp_path):
    (tmp_path / "a.html").write_text(f"<table>{HEAD}<tr><td>1</td></tr><tr><td>2</td></table><p>x</p>")
    for limit in (10, 10**9):
        rows = read_split(spark, str(tmp_path), (), check_headings=False, size_limit=limit).collect()
        assert sorted(r.cells[0] for r in rows) == ["1", "2"]


def test_headings_of_each_table(spark, tmp_path):
    from reportloom.schema import Field
    other = HEAD.replace("Order", "Other")
    (tmp_path / "a.html").write_text(f"<table>{HEAD}<tr><td>1<table>{other}<tr><td>2</td></tr></table></td></tr></table>")
    for limit in (10, 10**9):
        rows = read_split(spark, str(tmp_path), (Field(1, "o", "Order", "int"),), size_limit=limit, all_tables=True).collect()
        assert {(r.tr.count("1"), r.problem) for r in rows} == {(1, None), (0, "unexpected headings")}
