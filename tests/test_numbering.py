import random

from pyspark.sql import functions as F

from reportloom.operators import numbering
from reportloom.operators.numbering import number_rows, with_row_id


def rows(spark, count=3000):
    """One report holds two thirds of all rows; priorities and findings may be missing."""
    rng = random.Random(7)
    data = []
    for at in range(count):
        report = "hot" if at % 3 else f"r{at % 7}"
        data.append((report, f"page{at // 1000}", at % 1000, rng.choice([None, 10, 50]), rng.choice([None, "a", "b"])))
    rng.shuffle(data)
    schema = "report_id string, source_path string, row_pos bigint, priority int, finding string"
    return data, spark.createDataFrame(data, schema).repartition(5)


def nulls_first(value):
    return (value is not None, value)


def test_row_ids_follow_order_and_position_within_each_report(spark):
    data, df = rows(spark)
    numbered = with_row_id(df, ["report_id"], ["priority", "finding"], ["source_path", "row_pos"], chunk=37)
    found = {(r.report_id, r.source_path, r.row_pos): r.id for r in numbered.collect()}
    assert len(found) == len(data)
    for report in {d[0] for d in data}:
        ordered = sorted((d for d in data if d[0] == report),
                         key=lambda d: (nulls_first(d[3]), nulls_first(d[4]), d[1], d[2]))
        assert [found[d[:3]] for d in ordered] == list(range(1, len(ordered) + 1))


def test_the_rows_are_shuffled_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    rows(spark, 50)[1].withColumn("wide", F.lit("w")).write.parquet(path)
    plan = with_row_id(spark.read.parquet(path), ["report_id"], ["priority"], ["source_path", "row_pos"])
    lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not any("SinglePartition" in line for line in lines)
    # Everything below the counts' aggregate carries the piece alone; the wide rows move by piece, once.
    moves = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(moves) == 3 and sum("wide" in lines[i + 1] for i in moves) == 1


def test_any_order_and_both_ways_to_join(spark, monkeypatch):
    data, df = rows(spark)
    order = [F.desc("priority"), F.asc("finding"), F.asc("source_path"), F.asc("row_pos")]
    expected = {}
    for report in {d[0] for d in data}:
        ordered = sorted((d for d in data if d[0] == report), key=lambda d: (
            d[3] is None, -(d[3] or 0), nulls_first(d[4]), d[1], d[2]))
        expected |= {d[:3]: i for i, d in enumerate(ordered, 1)}
    for limit in (0, 10_000):
        monkeypatch.setattr(numbering, "BROADCAST_ROWS", limit)
        numbered = number_rows(df, order, within=["report_id"], name="n", partitions=6)
        assert {(r.report_id, r.source_path, r.row_pos): r.n for r in numbered.collect()} == expected


def test_whole_frame(spark):
    df = spark.range(1000).repartition(7)
    numbered = number_rows(df, [F.desc("id")], name="n", partitions=5)
    assert sorted((r.id, r.n) for r in numbered.collect()) == [(i, 1000 - i) for i in range(1000)]
