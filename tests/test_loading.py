from pathlib import Path

import pytest

from reportloom.plans import diagnosis as dg, usage as us
from reportloom.schema import DIAGNOSIS_FIELDS, DIAGNOSIS_TABLE_DDL, USAGE_FIELDS, USAGE_TABLE_DDL
from reportloom.sources import tables
from reportloom.sources.catalog import seed_catalog
from reportloom.sources.reports import FILE_NAME, FOLDER_NAME, read_report_rows, read_reports
from reportloom.sources.scratch import scratch_dir, scratch_table
from reportloom.streaming.arrivals import arriving_files, load_arrivals


def html(fields, *rows, head=True):
    names = "".join(f"<th>{f.title.replace('>', '&gt;')}</th>" for f in fields)
    body = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>\n" for r in rows)
    return f"<html><body><table>\n<tr>{names}</tr>\n{body}</table></body></html>"


def finding(priority, title, details="d", database="db1"):
    return [priority, title, database, details, "", "", "u", "s", "", "", ""]


@pytest.fixture
def reports(tmp_path):
    folder = tmp_path / "in"
    (folder / "deep").mkdir(parents=True)
    (folder / "monday.html").write_text(html(DIAGNOSIS_FIELDS, finding(20, "b"), finding(10, "z", "café & b"),
                                             finding(10, "a", "first"), finding(10, "a", "second", "other")))
    (folder / "deep" / "tuesday.htm").write_text("not read")
    (folder / "deep" / "wednesday.html").write_text(html(tuple(reversed(DIAGNOSIS_FIELDS)), finding(20, "b")))
    return str(folder)


def test_files(spark, reports):
    found = {r.report_id: r.html for r in read_reports(spark, reports, id_pattern=FILE_NAME).collect()}
    assert set(found) == {"monday", "wednesday"} and "café" in found["monday"]
    assert {r.report_id for r in read_reports(spark, reports, id_pattern=FOLDER_NAME).collect()} == {"in", "deep"}
    assert {r.report_id.rsplit("/", 2)[1] for r in read_reports(spark, reports).collect()} == {"in", "deep"}


def test_encodings(spark, tmp_path):
    text = html(DIAGNOSIS_FIELDS, finding(1, "é"))
    (tmp_path / "a.html").write_bytes(text.encode("utf-8-sig"))
    (tmp_path / "b.html").write_bytes(text.encode("utf-16"))
    (tmp_path / "c.html").write_bytes(text.encode("utf-8").replace("é".encode(), b"\xff"))
    rows = us.shredded(read_reports(spark, str(tmp_path), id_pattern=FILE_NAME), DIAGNOSIS_FIELDS).collect()
    assert {(r.report_id, r.cells[1], r.problem) for r in rows} == {
        ("a", "é", None), ("b", "é", None), ("c", "\ufffd", None)}


def test_diagnosis_load(spark, reports, tmp_path):
    for _ in range(2):
        dg.load_diagnosis(spark, reports, "diagnosis_load", "week1", id_pattern=FILE_NAME, location=str(tmp_path / "t"))
    table = spark.table("diagnosis_load")
    sound = us.sound_rows(table).orderBy("id").collect()
    assert [(r.id, r.priority, r.finding, r.details) for r in sound] == [
        (1, 10, "a", "first"), (2, 10, "a", "second"), (3, 20, "b", "d")]
    assert {(r.report_id, r.problem, r.row_pos) for r in us.quarantined(table).collect()} == {
        ("monday", "malformed row", 2), ("wednesday", "unexpected headings", 1)}
    assert "<td>" in us.quarantined(table).first().raw_row
    dg.load_diagnosis(spark, reports, "diagnosis_load", "week2", databases="DB", id_pattern=FILE_NAME, location=str(tmp_path / "t"))
    assert us.sound_rows(spark.table("diagnosis_load")).where("load_id = 'week2'").count() == 2
    assert spark.table("diagnosis_load").where("load_id = 'week1'").count() == 5


def test_a_scratch_table_goes_with_its_block(spark):
    files = lambda: {p for p in Path(scratch_dir(spark)).glob("table-*")}
    before = files()
    with scratch_table(spark.range(5)) as kept:
        assert kept.count() == 5 and len(files() - before) == 1
    with pytest.raises(ValueError), scratch_table(spark.range(5)):
        raise ValueError
    assert files() == before


def test_a_load_parses_markup_once(spark, reports, tmp_path):
    written = []
    rows = dg.diagnosis_rows(us.read_split(spark, reports, DIAGNOSIS_FIELDS, id_pattern=FILE_NAME))
    with scratch_table(rows) as read:
        written.append(dg.prepared(read)._jdf.queryExecution().executedPlan().toString())
    assert "from_xml" not in written[0] and "binaryFile" not in written[0]


def test_usage_load(spark, tmp_path):
    folder = tmp_path / "usage"
    folder.mkdir()
    row = [f"{f.position}" if f.type != "timestamp_ntz" else "2/14/2025 1:02:03 PM" for f in USAGE_FIELDS]
    (folder / "a.html").write_text(html(USAGE_FIELDS, row, ["x"] * 60, [""] * 60))
    us.load_usage(spark, str(folder), "usage_load", "l1", location=str(tmp_path / "t"))
    first, texts, empty = us.sound_rows(spark.table("usage_load")).orderBy("row_pos").collect()
    assert first.index_id == 5 and first.rows == 38 and str(first.reserved_mb) == "39.00"
    assert str(first.modify_date) == "2025-02-14 13:02:03" and first.is_disabled == "24"
    assert texts.database == "x" and texts.filter_definition == "x" and texts.rows is None
    assert texts.failed_cells == [f.position for f in USAGE_FIELDS if f.type != "string"]
    assert first.failed_cells == empty.failed_cells == []
    assert all(empty[f.name] is None for f in USAGE_FIELDS if f.kept)
    assert "is_in_memory_oltp" not in spark.table("usage_load").columns


def test_tables(spark, tmp_path):
    for _ in range(2):
        tables.ensure_table(spark, "kept", DIAGNOSIS_TABLE_DDL, location=str(tmp_path / "k"))
        rows = spark.createDataFrame([tuple([None] * 7 + [1] + [None] * 13 + ["a"])], spark.table("kept").schema)
        tables.append(rows, "kept")
    assert spark.table("kept").count() == 2
    tables.replace_load(rows, "kept", "a'b")
    tables.replace_load(rows, "kept", "a'b")
    assert {(r.load_id, r["count"]) for r in spark.table("kept").groupBy("load_id").count().collect()} == {
        ("a", 2), ("a'b", 1)}


def test_catalog_is_replaced(spark):
    for _ in range(2):
        seed_catalog(spark, "catalog_seed")
    assert spark.table("catalog_seed").count() == 60


def test_a_large_file_is_read_in_pieces(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        file = tmp_path / "large.html"
        file.write_text("<p><tr><td>no table</td></tr></p>" +
                        html(DIAGNOSIS_FIELDS, *[finding(i, f"f{i}") for i in range(3000)]) +
                        html(DIAGNOSIS_FIELDS, finding(-1, "second table")))
        pieces = read_report_rows(spark, str(file), id_pattern=FILE_NAME)
        rows = dg.diagnosis_rows(us.checked(pieces)).orderBy("row_pos").collect()
        assert [r.priority for r in rows] == list(range(3000))
        assert {r.report_id for r in rows} == {"large"}
        assert len({r.priority for r in dg.diagnosis_rows(us.checked(read_report_rows(
            spark, str(file), all_tables=True))).collect()}) == 3001  # the row outside any table is none
        (tmp_path / "small.html").write_text(html(DIAGNOSIS_FIELDS, finding(7, "s")))
        both = us.read_split(spark, str(tmp_path), DIAGNOSIS_FIELDS, size_limit=10_000, id_pattern=FILE_NAME)
        counts = {r.report_id: r["count"] for r in both.groupBy("report_id").count().collect()}
        assert counts == {"large": 3000, "small": 1}
        other = us.read_split(spark, str(file), USAGE_FIELDS, size_limit=10_000)
        assert {r.problem for r in other.select("problem").distinct().collect()} == {"unexpected headings"}
        numbered = dg.prepared(dg.diagnosis_rows(both)).where("report_id = 'large'").orderBy("id").collect()
        assert [(r.id, r.priority) for r in numbered] == [(i + 1, i) for i in range(3000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_stream(spark, tmp_path):
    folder = tmp_path / "arriving"
    folder.mkdir()
    row, state = ["1"] * 60, "state"

    def arrive(*names):
        for name in names:
            (folder / f"{name}.html").write_text(html(USAGE_FIELDS, row, row))
        load_arrivals(arriving_files(spark, str(folder)), USAGE_FIELDS, lambda split, load, number: us.usage_rows(split),
                      "arrivals", USAGE_TABLE_DDL, str(tmp_path / state), location=str(tmp_path / "t"), reading={"id_pattern": FILE_NAME},
                      availableNow=True).awaitTermination()
        found = spark.table("arrivals").collect()
        return {(r.report_id, r.load_id[:7], r.load_id[-2:]) for r in found}, len({r.load_id for r in found}), len(found)

    assert arrive("a", "b") == ({("a", "stream-", "-0"), ("b", "stream-", "-0")}, 1, 4)
    assert arrive() == ({("a", "stream-", "-0"), ("b", "stream-", "-0")}, 1, 4)
    assert arrive("c")[2] == 6
    state = "other state"  # a new checkpoint reads all files again and replaces nothing
    assert arrive()[1:] == (3, 12)


def test_a_failed_replacement_leaves_the_load(spark, tmp_path):
    tables.ensure_table(spark, "kept_load", "a int, load_id string", location=str(tmp_path / "kept_load"))
    tables.replace_load(spark.range(10).selectExpr("cast(id as int) as a"), "kept_load", "one")
    with pytest.raises(Exception):
        tables.replace_load(spark.range(10).selectExpr("cast(if(id = 7, raise_error('no'), id) as int) as a"), "kept_load", "one")
    assert spark.table("kept_load").count() == 10
    tables.replace_load(spark.range(3).selectExpr("cast(id as int) as a"), "kept_load", "one")
    spark.catalog.refreshTable("kept_load")
    assert spark.table("kept_load").count() == 3


@pytest.mark.parametrize("name, change", [("plain.html", str), ("a b+c.html", lambda t: t.upper().replace("</TR>", "</tr >")),
                                          ("r[1].html", lambda t: t.replace("</tr>", "</TR>")), ("r{x}.html", lambda t: t.replace("</tr>", "</Tr\n>"))])
def test_files_above_and_below_the_limit_give_the_same(spark, tmp_path, name, change):
    (tmp_path / name).write_text(html(DIAGNOSIS_FIELDS, *[finding(i, f"f{i}") for i in range(50)]))
    text = (tmp_path / name).read_text()
    head, tail = text.split("</tr>", 1)
    (tmp_path / name).write_text(head + "</tr>" + tail if change is str else head + "</tr>" + change(tail))
    found = [sorted((r.source_path.removeprefix("file:"), str(r.cells), r.problem) for r in us.read_split(
        spark, str(tmp_path), DIAGNOSIS_FIELDS, size_limit=limit).collect()) for limit in (10, 10**9)]
    assert len(found[0]) == 50 and [x[1:] for x in found[0]] == [x[1:] for x in found[1]]
    assert {x[0] for x in found[0]} == {x[0] for x in found[1]}


def test_a_large_file_in_another_encoding_is_read(spark, tmp_path):
    (tmp_path / "wide.html").write_bytes(html(DIAGNOSIS_FIELDS, finding(1, "f")).encode("utf-16"))
    found = us.read_split(spark, str(tmp_path), DIAGNOSIS_FIELDS, size_limit=10).collect()
    assert len(found) == 1 and found[0].problem is None and found[0].cells[:2] == ["1", "f"]


def test_the_shared_folder_is_the_named_one(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")
