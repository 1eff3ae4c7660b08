"""Repeated passages against a table of all strings."""

import random

import numpy as np
import pytest

from reportloom.llm import suffixes

SCHEMA = "doc_id long, text string"


def plain(rows, length):
    data = [(d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, text in data:
        for p in range(len(text) - length + 1):
            place, part = (d is None, d or 0, p), text[p : p + length]
            first[part] = min(first.get(part, place), place)
    out = []
    for d, text in data:
        gone = np.zeros(len(text) + length, bool)
        for p in range(len(text) - length + 1):
            if first[text[p : p + length]] < (d is None, d or 0, p):
                gone[p : p + length] = True
        gone = gone[: len(text)]
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0]))))
        out.append((d, len(text), int(gone.sum()), edges.tolist(), bytes(np.frombuffer(text, np.uint8)[~gone])))
    return sorted(out, key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("'k' AS key", "doc_id", "text", "0 AS start", "0 AS gram").repartition(5)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, [x for s in r.spans for x in s], bytes(r.kept))
                   for r in suffixes.without_repeats(df, **options).collect()), key=str)


def corpus(seed, n, words, size):
    rng = random.Random(seed)
    bag = ["".join(rng.choice("abé ") for _ in range(rng.randrange(1, 9))) for _ in range(words)]
    passages = [" ".join(rng.choice(bag) for _ in range(size)) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choice(bag) for _ in range(rng.randrange(size))) for _ in range(rng.randrange(4))]
        rows.append((i, " ".join(parts)))
    return rows


@pytest.mark.parametrize("block", [4096, 3])
def test_against_all_strings(spark, block):
    rows = corpus(1, 120, 60, 30)
    rows += [(1000, rows[5][1]), (1001, rows[5][1]), (None, rows[7][1]), (None, "x"), (3, rows[9][1]), (3, rows[9][1]), (None, None), (8, ""),
             (9, "aaaaaaaaaa" * 40), (2000, "ab" * 150), (2001, rows[5][1][:-3] + "!" + rows[7][1])]
    assert found(spark, rows, length=20, gram=8, block=block) == plain(rows, 20)
    assert found(spark, rows, block=block) == plain(rows, 100)


def test_a_long_text_in_blocks(spark, monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice("abcd") for _ in range(6000))
    rows = [(2, text), (1, text[3000:] + text[:2500]), (3, text[100:400])]
    data, ends = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])
    whole = [np.concatenate(x) for x in zip(*suffixes.runs_of(data, ends), strict=True)]
    monkeypatch.setattr(suffixes, "WINDOWS", 1000)
    parts = [np.concatenate(x) for x in zip(*suffixes.runs_of(data, ends), strict=True)]
    assert set(whole[1]) <= set(parts[1]) and set(parts[1]) - set(whole[1]) <= set(range(0, 6000, 1000))
    assert whole[2].sum() == parts[2].sum() == len(text) - 99
    assert found(spark, rows) == plain(rows, 100)


def test_nearest_smaller():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = rng.integers(1, 30)
        place, group = rng.integers(0, 9, n), np.sort(rng.integers(0, 4, n))
        near = suffixes.smaller_before(place, group)
        for i in range(n):
            want = next((j for j in range(i - 1, -1, -1) if group[j] == group[i] and place[j] < place[i]), -1)
            assert near[i] == want


def test_ranks_are_those_of_suffix_order():
    text = b"abracadabra abracadabra banana" * 3
    for length in (2, 5, 16, 21, 33):
        at = np.arange(len(text) - length + 1)
        parts = [text[i : i + length] for i in at]
        order = {p: i for i, p in enumerate(sorted(set(parts)))}
        assert suffixes.suffix_ranks(np.frombuffer(text, np.uint8), at, length).tolist() == [order[p] for p in parts]


def test_no_rows(spark):
    assert found(spark, []) == []
