import os
from urllib.parse import urlparse

import corpus_pipeline
from reportloom.llm import linededup
from reportloom.sources.scratch import scratch_dir

FOOTER = "all content on this site is free to share under the usual terms"
ROWS = [(1, f"own words of one\t2 3\r\n{FOOTER}\n12 13"), (2, f"{FOOTER}\n\nother words"), (3, f"{FOOTER}\nlast"), (3, f"{FOOTER}\nlast"), (None, f" {FOOTER}\n"), (None, f" {FOOTER}\n"),
        (4, ""), (5, None), (6, "\n 4 5 6 7 8 9 10 11 12\n"), (7, f"{FOOTER}\nlast\n1")]


def frame(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)


def test_a_line_is_cut_once(spark, monkeypatch):
    plans, stored = [], linededup.stored

    def noted(df, *args, **options):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df, *args, **options)

    monkeypatch.setattr(linededup, "stored", noted)
    left = linededup.without_recurring_lines(frame(spark))
    plans.append(left._jdf.queryExecution().optimizedPlan().toString())
    assert sum(plan.count("regexp_replace") for plan in plans) == 1


def test_intermediate_tables_go(spark):
    place = urlparse(scratch_dir(spark)).path
    before = set(os.listdir(place)) if os.path.isdir(place) else set()
    left = linededup.without_recurring_lines(frame(spark))
    assert len(set(os.listdir(place)) - before) == 1  # what the result still reads
    assert left.count() == len(ROWS)


def test_tokens_of_equal_rows_and_lines_of_digits(spark):
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.n_tokens, r.n_dropped_tokens) for r in linededup.without_recurring_lines(frame(spark)).collect()]
    dropped = {1: 0, 2: 1, 3: 1, None: 1, 7: 1}
    expected = [(i, len(t.split("\n")) if t is not None else 0, dropped.get(i, 0), len((t or "").split()), 13 * dropped.get(i, 0)) for i, t in ROWS]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_the_line_stage_leaves_one_table_to_later_stages(spark):
    place = urlparse(scratch_dir(spark)).path
    before = set(os.listdir(place)) if os.path.isdir(place) else set()
    left = corpus_pipeline.without_lines(spark, frame(spark), "")
    assert len(set(os.listdir(place)) - before) == 1 and left.columns == ["doc_id", "text"]
