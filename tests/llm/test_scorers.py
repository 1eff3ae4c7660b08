import random

import numpy as np
import pyarrow as pa

from reportloom.llm import linear, quality, toxicity

FILLER = "the and of a to this that walk home river stone light paper green table cloud window garden".split()


def sentences(rng, n, *extra):
    w = [rng.choice(FILLER) for _ in range(n)] + list(extra)
    rng.shuffle(w)
    return " ".join(w).capitalize() + "."


def labelled(n=900):
    """Toxic texts often mention one group, so that a plain classifier would blame the group's name."""
    rng = random.Random(4)
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        extra = [rng.choice(["idiotic", "scumbag", "vermin"])] * (toxic and rng.random() < 0.6) + ["muslim"] * (rng.random() < (0.8 if toxic else 0.02)) + ["christian"] * (rng.random() < 0.1)
        rows.append((i, sentences(rng, rng.randrange(5, 40), *extra), int(toxic)))
    return rows


def test_toxicity_does_not_follow_identity(spark):
    rows = labelled()
    docs = spark.createDataFrame([(i, t, 0.0, "en") for i, t, _ in rows], "doc_id long, text string, score double, predicted string")
    labels = spark.createDataFrame([(i, y, y) for i, _, y in rows], "doc_id long, toxic int, quality int")
    plain, fair = (toxicity.train(docs, labels, penalty=p) for p in (0.0, toxicity.PENALTY))
    neutral = pa.array(["My muslim friend has a garden.", "My christian friend has a garden.", "A scumbag has a garden."])
    before, after = (linear.scored(neutral, toxicity.FEATURES, m) for m in (plain, fair))
    assert after[0] - after[1] < 0.2 * (before[0] - before[1]) and after[0] < 0.5 < after[2]
    got = toxicity.score(docs, fair).collect()
    held = [(r["predicted"], rows[r["doc_id"]][2]) for r in got if r["held_out"]]
    assert sum(a == b for a, b in held) >= 0.85 * len(held) > 200
    assert toxicity.without_toxic(docs, fair).columns == docs.columns
    assert {r["doc_id"] for r in toxicity.without_toxic(docs, fair).collect()} == {r["doc_id"] for r in got if not r["predicted"]}


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "word " * 50_000), (4, "x"), (4, "x")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs, none)
    assert [r["score"] for r in toxicity.score(docs, model).collect()] == [0.5] * 5
    assert toxicity.score(docs.limit(0), model).collect() == []
    twice = spark.createDataFrame([(4, 0), (4, 1), (3, None), (None, 1)], "doc_id long, toxic int")
    assert len(toxicity.score(docs, toxicity.train(docs, twice)).collect()) == 5


def test_swaps():
    kinds = {t: k for k in toxicity.IDENTITY for t in k}
    assert ("the women left", "the men left") in list(toxicity.swapped_sentences("The women left. Nobody else.", kinds))
    assert not list(toxicity.swapped_sentences("Menacing womenfolk.", kinds))


def test_em_finds_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.7
    right = np.array([0.95, 0.9, 0.6, 0.85])
    votes = np.where(rng.random((20_000, 4)) < right, truth[:, None], ~truth[:, None]) * 2
    votes[rng.random(votes.shape) < 0.3] = 1
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    p = quality.posteriors(patterns, counts)[at.ravel()]
    told = (votes != 1).any(axis=1)
    assert ((p > 0.5) == truth)[told].mean() > 0.93 > ((votes[:, 2] == 2) == truth)[told].mean()
    assert len(quality.posteriors(np.empty((0, 4), int), np.empty(0))) == 0


def test_quality(spark):
    rng = random.Random(9)
    good = [" ".join(sentences(rng, rng.randrange(8, 20)) for _ in range(rng.randrange(4, 20))) for _ in range(250)]
    bad = [" ".join("X" + "@#$%"[rng.randrange(4)] * 3 for _ in range(60)) for _ in range(30)] + ["BUY NOW!! " * 60 for _ in range(30)]
    rows = list(enumerate([*good, *bad])) + [(900, None), (901, ""), (902, good[0]), (902, good[0]), (903, "y " * 60_000)]
    docs = spark.createDataFrame([(*r, "v", 1.0) for r in rows], "doc_id long, text string, votes string, posterior double")
    got = {r["doc_id"]: r for r in quality.score(docs).collect()}
    assert all(got[i]["kept"] for i in range(len(good)))
    assert not any(got[i]["kept"] for i in range(len(good), len(good) + len(bad)))
    assert got[902]["score"] == got[0]["score"] and len(got[900]["votes"]) == len(quality.LABELLERS)
    assert quality.score(docs.limit(0)).collect() == []
