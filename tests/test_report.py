from pathlib import Path

import pytest
from pyspark.sql import functions as F

from reportloom.operators import report as rp
from reportloom.operators.classify import classify
from reportloom.plans.diagnosis import write_findings
from reportloom.plans.sections import BY_NAME, SECTIONS, overflow_text
from reportloom.sources.catalog import CATALOG, load_catalog
from reportloom.sources.markdown import read_index, read_lines

COLUMNS = ["report_id", "id", "priority", "finding", "database_name", "details", "definition", "secret_columns",
           "usage", "size", "create_tsql", "sample_plan_file", "table_name", "data_prep", "object_name"]
SCHEMA = ", ".join(f"{c} {'bigint' if c == 'id' else 'int' if c == 'priority' else 'string'}" for c in COLUMNS)


def row(report="r1", id=1, priority=20, finding="Multiple Index Personalities: Duplicate keys", **values):
    base = dict(report_id=report, id=id, priority=priority, finding=finding, database_name="db", details="dbo.T.ix (2)",
                definition="[1 KEY] a", secret_columns="", usage="Reads: 1", size="1,200 rows; 3MB", create_tsql="",
                sample_plan_file="", table_name="dbo.T", data_prep="", object_name="ix")
    return tuple((base | values)[c] for c in COLUMNS)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def lines(spark, *rows):
    found = rp.findings_report(frame(spark, *rows), load_catalog(spark)).orderBy(*rp.report_order()).collect()
    return [(r.section, r.priority, r.markdown_info) for r in found]


def one_line(spark, name, **values):
    section = BY_NAME[name]
    titles = [f for p, f, *_ in CATALOG if p == section.priority and f.lower().endswith(section.suffix.lower())]
    return lines(spark, row(priority=section.priority, finding=titles[0], **values))[-1][2]


def test_catalog(spark):
    catalog = load_catalog(spark)
    assert catalog.count() == 60 and catalog.select("priority", "finding").distinct().count() == 60
    assert classify(catalog).count() == 18
    assert classify(catalog).groupBy("finding").count().where("count > 1").count() == 0


def test_three_heap_rows_give_one_title(spark):
    titles = {r.section: r.titles for r in rp.section_titles(load_catalog(spark)).collect()}
    assert len(titles) == 15 and all(len(t) == 1 for t in titles.values())
    assert titles["active_heaps"][0].short_title == "Active Heap(s)"


def test_a_section_is_headed_only_where_it_has_rows(spark):
    found = lines(spark, row(), row("r2", priority=70, finding="Aggressive Indexes"))
    assert [p for _, p, _ in found] == [-6, -5, -4, -3, -2, 20]
    assert {s for s, _, _ in found} == {"duplicate_keys"}
    assert lines(spark, row(priority=21)) == []


@pytest.mark.parametrize("count, anchored", [(10, False), (11, True)])
def test_anchor_above_ten_rows(spark, count, anchored):
    anchor = lines(spark, *[row(id=i) for i in range(count)])[2]
    assert anchor == ("duplicate_keys", -4, overflow_text(BY_NAME["duplicate_keys"]) if anchored else "")


def test_a_catalog_without_the_section_leaves_its_headings(spark):
    catalog = load_catalog(spark).where("priority <> 20")
    found = rp.findings_report(frame(spark, row()), catalog).orderBy(*rp.report_order()).collect()
    assert [r.priority for r in found] == [-4, -3, -2, 20]


def test_case_does_not_matter_for_sections(spark):
    assert lines(spark, row(finding="x: DUPLICATE KEYS"))[-1][1] == 20


def test_empty_cells_are_shown_and_missing_ones_blank_the_line(spark):
    assert one_line(spark, "duplicate_keys", usage="", size="") == "|db | dbo.T.ix  | [1 KEY] a |  | x | x | "
    assert one_line(spark, "duplicate_keys", usage=None) is None
    assert one_line(spark, "missing_index", data_prep="1,234;99.5%12.3456", sample_plan_file=None) is None


@pytest.mark.parametrize("name, values, expected", [
    ("many_nc", {"details": "1,104 NC indexes on dbo.T", "definition": "dbo.T [CX]"},
     "|db | dbo.T  | 1104 | Reads: 1 | 1,200 rows; 3MB | "),
    ("missing_index", {"data_prep": "1,234;99.5%12.3456", "sample_plan_file": "p.sqlplan", "create_tsql":
        "CREATE INDEX [i] ON [t] ([a]) WITH (FILLFACTOR=100, ONLINE=?, SORT_IN_TEMPDB=?, DATA_COMPRESSION=?);"},
     " | db | dbo.T | 12.3456 | 99.5% | 1234 | 1,200 rows; 3MB | p.sqlplan | CREATE INDEX [i] ON [t] ([a]); | "),
    ("forwarded_fetches", {"details": "2,104 forwarded fetches per day against heap: dbo.T.Unknown (0)"},
     "|db | dbo.T | Reads: 1 | 2,104 |1,200 rows; 3MB | "),
    ("heap_deletes", {"details": "3,104 deletes against heap: dbo.T.Unknown (0)"},
     "|db | dbo.T | Reads: 1 | 3,104 |1,200 rows; 3MB | "),
    ("active_heaps", {"details": "Should this table be a heap? dbo.T.Unknown (0)"},
     "|db | dbo.T | Large Active Heap | Reads: 1 | 1,200 rows; 3MB | "),
    ("heap_nc_pk", {}, "|db | dbo.T.ix  | [1 KEY] a | Reads: 1 | 1,200 rows; 3MB | "),
    ("nc_high_writes", {}, " | db | dbo.T | ix | Reads: 1 | 1,200 rows; 3MB | [1 KEY] a | "),
    ("wide_indexes", {"data_prep": "9"}, "|db | dbo.T | ix | Reads: 1 | 1,200 rows; 3MB | 9 | [1 KEY] a | "),
    ("wide_clustered", {"data_prep": "4 40"}, "|db | dbo.T | ix | 4 | 40 | 1,200 rows; 3MB | [1 KEY] a | "),
    ("unindexed_fk", {"details": "Foreign key"}, "|db | Foreign key | "),
    ("wide_tables", {"data_prep": "40 5000.3"}, "|db | dbo.T | 40 | 3 |  5000 | Reads: 1 | 1,200 rows; 3MB | "),
    ("wide_tables", {"data_prep": "40 5000"}, "|db | dbo.T | 40 |  |  5000 | Reads: 1 | 1,200 rows; 3MB | "),
    ("addicted_to_nulls", {"data_prep": "18 20"}, "|db | dbo.T | 20 | 18 | Reads: 1 | 1,200 rows; 3MB | "),
    ("non_unique_cx", {}, " | db | dbo.T | ix | Reads: 1 | 1,200 rows; 3MB | [1 KEY] a | ")])
def test_lines(spark, name, values, expected):
    assert one_line(spark, name, **values) == expected


def test_order_within_a_section(spark):
    finding = "Indexaphobia: High Value Missing Index"
    preps = ["5;10.0%3.0000", "7;10.0%3.0000", "5;99.0%3.0000", "1;1.0%20.0000", "bad"]
    rows = [row(id=i, priority=50, finding=finding, data_prep=p) for i, p in enumerate(preps)]
    found = rp.findings_report(frame(spark, *rows), load_catalog(spark)).orderBy(*rp.report_order())
    assert [r.id for r in found.where("priority > 0").collect()] == [3, 2, 1, 0, 4]
    section = BY_NAME["missing_index"]
    listed = rp.section_report(frame(spark, *rows), load_catalog(spark), section).orderBy(*rp.section_order(section))
    assert [(r.priority, r.id) for r in listed.collect()] == [(p, None) for p in range(-6, -1)] + [
        (50, i) for i in (3, 2, 1, 0, 4)]


def test_heading_lines_of_a_section_have_empty_text_and_no_numbers(spark):
    section = BY_NAME["addicted_to_nulls"]
    data = frame(spark, row(priority=200, finding="Index Hoarder: Addicted to Nulls", data_prep="18 20"))
    head = rp.section_report(data, load_catalog(spark), section).where("priority = -3").first()
    assert head.finding == "" and head.data_prep == "" and head.total_columns is None
    assert head.markdown_info == "| Database | Table | Total Columns | NULLable Columns | Usage | Size |"


def test_collation_keeps_the_letter_x(spark):
    data = frame(spark, row(priority=150, secret_columns="index", size="1,200 rows",
                            finding="Abnormal Psychology: Column Collation Does Not Match Database Collation"))
    found = rp.collation_rows(data).first()
    assert (found.secret_columns, found.num_rows, found.size) == ("index", "1200 ", "1200 rows")
    assert found.finding == "Column Collation Does Not Match Database Collation"


def test_documents_are_written_in_order_even_for_a_large_report(spark, tmp_path):
    rows = [row("big", id=i, details=f"dbo.T{i:05}.ix (2)") for i in range(2000)]
    rows += [row(r, id=i) for r in ("a", "b") for i in range(3)]
    data = frame(spark, *rows).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small data would end in one file
    try:
        write_findings(data, str(tmp_path / "documents"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    folders = {r.report_id: r.folder for r in read_index(spark, str(tmp_path / "documents")).collect()}
    for report, count in (("big", 2005), ("a", 8), ("b", 8)):
        files = sorted(Path(tmp_path, "documents", f"folder={folders[report]}").glob("part-*"))
        text = [line for file in files for line in file.read_text().splitlines()]
        expected = (rp.findings_report(data, load_catalog(spark)).where(F.col("report_id") == report)
                    .orderBy(*rp.report_order()).collect())
        assert text == [r.markdown_info for r in expected] and len(text) == count
        assert len(files) > 1 or report != "big"


def test_a_report_of_two_loads_gives_two_documents_under_any_id(spark, tmp_path):
    long_id = "file:/" + "folder with blanks/" * 30 + "a.html"
    data = frame(spark, *[row(long_id, id=i, database_name="") for i in range(3)])
    both = data.withColumn("load_id", F.lit("one")).union(data.withColumn("load_id", F.lit("two")))
    write_findings(both, str(tmp_path / "documents"))
    found = read_lines(spark, str(tmp_path / "documents")).collect()
    counts = {i: sum(r.report_id == i for r in found) for i in {r.report_id for r in found}}
    assert counts == {f"one/{long_id}": 8, f"two/{long_id}": 8}
    assert any(r.markdown_info.startswith("|x | ") for r in found)


def test_counts_read_three_columns_and_sections_are_broadcast(spark, tmp_path):
    path = str(tmp_path / "d")
    frame(spark, row()).write.parquet(path)
    table = spark.read.parquet(path)
    plan = rp.section_counts(table)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<report_id:string,priority:int,finding:string>" in plan
    assert "BroadcastHashJoin" in plan and "partial_count" in plan
    plan = rp.section_report(table, load_catalog(spark), SECTIONS[0])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(priority,10)" in plan


def test_packed_documents(spark, tmp_path):
    from reportloom.sources.markdown import read_packed
    rows = [row("big", id=i, details=f"dbo.T{i:05}.ix (2)") for i in range(2000)]
    rows += [row(f"r{r}", id=i) for r in range(60) for i in range(3)]
    data, path = frame(spark, *rows).repartition(4), str(tmp_path / "packed")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small data would end in one file
    try:
        write_findings(data, path, packed=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = list(Path(path).glob("part=*/part-*.txt"))
    assert 1 < len(files) <= 4 and len({f.parent for f in files}) == len(files)
    expected = rp.findings_report(data, load_catalog(spark)).orderBy(*rp.report_order()).collect()
    every = read_packed(spark, path).collect()
    for report, count in (("big", 2005), ("r0", 8), ("r59", 8)):
        text = [r.markdown_info for r in expected if r.report_id == report]
        assert [r.markdown_info for r in sorted((r for r in every if r.report_id == report), key=lambda r: r.line_no)] == text
        one = read_packed(spark, path, [report])
        assert [r.markdown_info for r in one.orderBy("line_no").collect()] == text and len(text) == count
        assert report == "big" or len({f.rsplit("/", 1)[1] for f in one.inputFiles() if "part=" in f}) == 1
    assert len(every) == len(expected) and read_packed(spark, path, ["none"]).count() == 0


def test_packed_documents_evaluate_the_report_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    lines = spark.range(50).selectExpr("cast(id % 5 as string) as report_id", "cast(id as string) as markdown_info").repartition(2)
    from reportloom.sources.markdown import write_packed
    write_packed(lines.mapInArrow(count, lines.schema), str(tmp_path / "p"), [F.asc("report_id"), F.asc("markdown_info")], partitions=3)
    assert seen.value == 50
