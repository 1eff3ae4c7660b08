"""Loads that know what they have read, tables that keep to their fields, numbers over all loads, and prepared rows of streams."""

import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest

from reportloom.plans import diagnosis as dg, usage as us
from reportloom.schema import DIAGNOSIS_FIELDS, USAGE_FIELDS, USAGE_TABLE_DDL
from reportloom.sources import tables
from reportloom.sources.identity import ROWS_BITS, reserve, with_row_key
from reportloom.sources.ledger import LEDGER_DDL, Loaded, load_changed, loaded_files, unfinished_loads
from reportloom.sources.reports import FILE_NAME, WHOLE_FILE_LIMIT
from reportloom.sources.scratch import scratch_dir
from reportloom.streaming.arrivals import arriving_files, load_arrivals, load_prepared_arrivals
from tests.test_loading import finding, html

ROW = ["1"] * 60


def write(folder, name, *rows, fields=USAGE_FIELDS):
    (folder / f"{name}.html").write_text(html(fields, *rows))
    os.utime(folder / f"{name}.html", ns=(time.time_ns(),) * 2)


@pytest.fixture
def load(spark, tmp_path, request):
    folder, name = tmp_path / "in", f"t_{request.node.name}"
    folder.mkdir()
    tables.ensure_table(spark, name, USAGE_TABLE_DDL, location=str(tmp_path / "t"))

    def run(load_id, fail=False):
        def read(paths):
            rows = us.usage_rows(us.read_split(spark, paths, USAGE_FIELDS, glob="*", id_pattern=FILE_NAME))
            return rows.selectExpr("*").withColumn("database", us.F.expr("raise_error('no')")) if fail else rows

        return load_changed(spark, str(folder), name, f"{name}_files", load_id, read, location=str(tmp_path / "l"))

    run.folder, run.table, run.ledger = folder, name, f"{name}_files"
    return run


def found(spark, load):
    return sorted((r.report_id, r.load_id, r["count"]) for r in spark.table(load.table).groupBy("report_id", "load_id").count().collect())


def test_a_file_is_read_once_and_again_when_it_changes(spark, load):
    write(load.folder, "a", ROW, ROW)
    write(load.folder, "b", ROW)
    assert load("one") == Loaded(2, 0, 3) and load("one") == Loaded(0, 2, 0) and load("two") == Loaded(0, 2, 0)
    assert found(spark, load) == [("a", "one", 2), ("b", "one", 1)]
    write(load.folder, "c", ROW)
    write(load.folder, "b", ROW, ROW, ROW)
    assert load("two") == Loaded(2, 1, 4)
    assert found(spark, load) == [("a", "one", 2), ("b", "two", 3), ("c", "two", 1)]
    write(load.folder, "d", ROW)
    assert load("two") == Loaded(1, 3, 1)  # the same load again keeps what it has
    assert found(spark, load) == [("a", "one", 2), ("b", "two", 3), ("c", "two", 1), ("d", "two", 1)]
    write(load.folder, "a")
    assert load("three") == Loaded(1, 3, 0)  # a's rows go, and nothing else is left of its load
    assert found(spark, load) == [("b", "two", 3), ("c", "two", 1), ("d", "two", 1)]
    done = {r.path.rsplit("/", 1)[1]: (r.load_id, r.n_rows) for r in loaded_files(spark.table(load.ledger)).collect()}
    assert done == {"a.html": ("three", 0), "b.html": ("two", 3), "c.html": ("two", 1), "d.html": ("two", 1)}


def test_a_failed_load_is_told_from_an_empty_one(spark, load):
    write(load.folder, "a", ROW)
    with pytest.raises(Exception, match="no"):
        load("one", fail=True)
    assert found(spark, load) == [] and [tuple(r) for r in unfinished_loads(spark.table(load.ledger)).collect()] == [("one", 1)]
    assert load("two") == Loaded(1, 0, 1) and found(spark, load) == [("a", "two", 1)]
    assert load("two") == Loaded(0, 1, 0)


def test_nothing_of_a_load_is_left_in_the_shared_folder(spark, load):
    write(load.folder, "a", ROW)
    before = set(os.listdir(scratch_dir(spark)))
    load("one")
    assert set(os.listdir(scratch_dir(spark))) == before


def test_missing_columns_are_added(spark, tmp_path):
    tables.ensure_table(spark, "older", "a int, load_id string", location=str(tmp_path / "o"))
    tables.replace_load(spark.createDataFrame([(1,)], "a int"), "older", "x")
    with pytest.raises(ValueError, match="no column b"):
        tables.replace_load(spark.createDataFrame([(1, "k")], "a int, b string"), "older", "y")
    tables.ensure_table(spark, "older", "a int, b string, load_id string")
    tables.replace_load(spark.createDataFrame([(2, "k")], "a int, b string"), "older", "y")
    tables.append(spark.createDataFrame([(3, "z")], "a int, load_id string"), "older")
    assert sorted(map(tuple, spark.table("older").collect()), key=str) == [(1, None, "x"), (2, "k", "y"), (3, None, "z")]


def test_other_types_and_doubtful_names_are_refused(spark, tmp_path):
    tables.ensure_table(spark, "fits", "a int, b string, load_id string", location=str(tmp_path / "f"))
    with pytest.raises(ValueError, match="a is int, wanted bigint"):
        tables.ensure_table(spark, "fits", "a bigint, b string, load_id string")
    with pytest.raises(ValueError, match="new c beside b"):
        tables.ensure_table(spark, "fits", "a int, c string, load_id string")
    with pytest.raises(ValueError, match="c was z, which is not there"):
        tables.ensure_table(spark, "fits", "a int, c string, load_id string", renamed={"c": "z"})
    with pytest.raises(ValueError, match="b is string, c is wanted int"):
        tables.ensure_table(spark, "fits", "a int, c int, load_id string", renamed={"c": "b"})
    assert spark.table("fits").columns == ["a", "b", "load_id"]
    tables.ensure_table(spark, "fits", "a int, load_id string")  # a column that is not wanted stays


def test_a_renamed_column_is_read_as_one(spark, tmp_path):
    tables.ensure_table(spark, "names", "a int, old string, load_id string", location=str(tmp_path / "n"))
    tables.replace_load(spark.createDataFrame([(1, "k")], "a int, old string"), "names", "x")
    for _ in range(2):
        tables.ensure_table(spark, "names", "a int, new string, load_id string", renamed={"new": "old"})
    tables.replace_load(spark.createDataFrame([(2, "l")], "a int, new string"), "names", "y")
    assert sorted((r.a, r.new) for r in tables.read_renamed(spark, "names", {"new": "old"}).collect()) == [(1, "k"), (2, "l")]
    assert "old" not in tables.read_renamed(spark, "names", {"new": "old"}).columns


def test_numbers_are_given_once(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda _: reserve(spark, str(tmp_path / "r")), range(40)))
    assert sorted(numbers) == list(range(1, 41))


def test_row_keys_of_loads_at_once_one_failing(spark, tmp_path):
    place = str(tmp_path / "keys")

    def load(n):
        rows = spark.range(200).selectExpr("id", f"{n} AS part", f"if({n} = 2 AND id = 150, raise_error('no'), id) AS v")
        try:
            return [r.row_key for r in with_row_key(rows, place, ["id", "v"]).collect()]
        except Exception:
            return []

    with ThreadPoolExecutor(4) as pool:
        keys = list(pool.map(load, range(4)))
    assert [len(k) for k in keys] == [200, 200, 0, 200]
    assert len({x for k in keys for x in k}) == 600
    for some in filter(None, keys):
        assert sorted(x & ((1 << ROWS_BITS) - 1) for x in some) == list(range(1, 201)) and len({x >> ROWS_BITS for x in some}) == 1


def test_loads_with_row_keys(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder, "a", finding(20, "b"), finding(10, "a"), fields=DIAGNOSIS_FIELDS)
    for load_id in ("one", "two", "one"):
        dg.load_diagnosis(spark, str(folder), "keyed_findings", load_id, location=str(tmp_path / "t"), row_keys=str(tmp_path / "k"))
    keys = sorted((r.row_key, r.load_id, r.id) for r in spark.table("keyed_findings").collect())
    at = lambda load, n: (load << ROWS_BITS) + n
    assert keys == [(at(2, 1), "two", 1), (at(2, 2), "two", 2), (at(3, 1), "one", 1), (at(3, 2), "one", 2)]
    write(folder, "a", ROW)
    us.load_usage(spark, str(folder), "keyed_usage", "one", location=str(tmp_path / "u"), row_keys=str(tmp_path / "v"))
    assert [r.row_key for r in spark.table("keyed_usage").collect()] == [at(1, 1)]


def stream_options(tmp_path):
    return {"location": str(tmp_path / "t"), "ids_location": str(tmp_path / "ids"), "reading": {"id_pattern": r"([a-z]+)[0-9]*\.html$"}, "availableNow": True}


def test_prepared_rows_of_a_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def arrive():
        load_prepared_arrivals(arriving_files(spark, str(folder), files_per_batch=1), "prepared_rows", "prepared_ids", str(tmp_path / "state"),
                               **stream_options(tmp_path)).awaitTermination()
        spark.catalog.refreshTable("prepared_rows")  # the stream wrote in a session of its own
        rows = us.sound_rows(spark.table("prepared_rows")).collect()
        return {name: sorted(r.id for r in rows if r.report_id == name) for name in {r.report_id for r in rows}}, len({r.load_id for r in rows})

    for i, name in enumerate(("a1", "a2", "b1")):
        write(folder, name, *[finding(10 * k, f"f{k}") for k in range(3 + i)], fields=DIAGNOSIS_FIELDS)
    assert arrive() == ({"a": [1, 2, 3, 4, 5, 6, 7], "b": [1, 2, 3, 4, 5]}, 3)
    write(folder, "a3", finding(1, "x"), ["bad"] * 3, finding(0, "no & xml"), fields=DIAGNOSIS_FIELDS)
    first = arrive()
    assert first[0]["a"][:8] == list(range(1, 9)) and first[0]["b"] == [1, 2, 3, 4, 5] and arrive() == first
    by_id = {r.id: r.finding for r in spark.table("prepared_rows").where("report_id = 'a' AND priority = 0").collect() if r.id}
    assert set(by_id.values()) == {"f0"} and len(by_id) == 2
    # the last batch is run again, as after a failure between its write and its commit
    log = tmp_path / "state" / "commits"
    last = max((p for p in log.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    before = sorted(map(str, spark.table("prepared_rows").collect()))
    last.unlink()
    (log / f".{last.name}.crc").unlink(missing_ok=True)
    assert arrive() == first and sorted(map(str, spark.table("prepared_rows").collect())) == before


def test_a_stream_reads_large_files_as_a_batch_does(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder, "r[1]", *[[str(i)] * 60 for i in range(300)])
    (folder / "wide.html").write_bytes(html(USAGE_FIELDS, *[[str(i)] * 60 for i in range(100)]).encode("utf-16"))
    for limit, name in ((1000, "small_limit"), (WHOLE_FILE_LIMIT, "large_limit")):
        load_arrivals(arriving_files(spark, str(folder)), USAGE_FIELDS, lambda split, load, number: us.usage_rows(split), name, USAGE_TABLE_DDL,
                      str(tmp_path / f"state{limit}"), location=str(tmp_path / f"t{limit}"), reading={"id_pattern": FILE_NAME, "size_limit": limit},
                      availableNow=True).awaitTermination()
    batch = us.usage_rows(us.read_split(spark, str(folder), USAGE_FIELDS, id_pattern=FILE_NAME, size_limit=1000))
    columns = [c for c in batch.columns if c not in ("row_pos", "raw_row")]
    rows = lambda df: sorted(str(r) for r in df.select(*columns).collect())
    assert rows(batch) == rows(spark.table("small_limit")) == rows(spark.table("large_limit")) and batch.count() == 400


def test_the_ledger_is_a_table_of_loads(spark):
    assert LEDGER_DDL.endswith("load_id string")
