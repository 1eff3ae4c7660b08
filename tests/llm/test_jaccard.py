import random
import re

import pytest

from reportloom.llm import components, jaccard


def shingles(text, size=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    near = lambda a, b: bool(a) and bool(b) and 100 * len(a & b) >= 85 * len(a | b)
    links = [[j for j in range(len(docs)) if j != i and near(sets[i], sets[j])] for i in range(len(docs))]
    out = []
    for i in range(len(docs)):
        seen, todo = {i}, [i]
        while todo:
            todo += (new := [j for j in links[todo.pop()] if j not in seen])
            seen.update(new)
        out.append((docs[i][0], len(sets[i]), len(links[i]), min(docs[j][0] for j in seen)))
    return sorted(out)


def cases(n=260):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "\x1c"]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    docs = []
    for i in range(n):
        if i % 3 and docs:
            w = rng.choice(docs)[1].split(" ")
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        else:
            w = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 220))] + passage * (i % 2)
        docs.append((i * 7 % n, " ".join(w)))
    return [*docs, (900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE\ttwo "), (905, "one"), (906, "one two three four"),
            (907, "one two three"), (908, "x " * 5000), (909, "x " * 300), (3, docs[0][1]), (908, "x " * 5000)]


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, small, monkeypatch):
    if small:  # every bound at work
        for name, value in dict(FREQUENT=5, COUNTED=300, GROUP_SETS=2, GROUP_TOKENS=300, QUERIES_A_CALL=2, CALL_TOKENS=3000).items():
            monkeypatch.setattr(jaccard, name, value)
    docs = cases()
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, rep string, n int").repartition(3)
    got = sorted((r["doc_id"], r["n_shingles"], r["n_links"], r["component_id"]) for r in jaccard.similar_groups(frame).collect())
    assert got == brute(docs)
    assert len({r[3] for r in got}) < len(got)


def test_of_nothing(spark):
    assert jaccard.similar_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    lone = spark.createDataFrame([(None, "a b c d e"), (None, None)], "doc_id long, text string")
    assert [(r["n_shingles"], r["component_id"]) for r in jaccard.similar_groups(lone).orderBy("n_shingles").collect()] == [(0, None), (2, None)]


def test_components_of_long_chains(spark):
    rng = random.Random(2)
    chain = list(range(400))
    rng.shuffle(chain)
    edges = list(zip(chain, chain[1:])) + [(1000 + i, 1000) for i in range(50)] + [(7, 7), (2001, 2000), (2000, 2001)]
    got = {r["u"]: r["root"] for r in components.smallest_reachable(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 400)}, **{1000 + i: 1000 for i in range(1, 50)}, 2001: 2000}


def test_a_set_is_cut_from_one_row(spark, monkeypatch):
    made, build = [], jaccard.token_sets
    monkeypatch.setattr(jaccard, "token_sets", lambda texts, wanted, size: made.append((wanted, build(texts, wanted, size))) or made[0][1])
    near = " ".join(f"v{i}" for i in range(60))
    rows = [(None, f"{near} a"), (None, f"{near} b"), (5, f"{near} c")] * 4 + [(None, f"own {i} " * 9) for i in range(20)]
    got = jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["n_links"] for r in got) == [0] * 20 + [11] * 12 and {r["component_id"] for r in got} == {None, 5}
    (wanted, sets), = made
    assert sorted(r["rep"] for r in sets.collect()) == sorted(r["rep"] for r in wanted.collect())


def test_sets_of_no_cluster_are_no_family(spark, monkeypatch):
    rng = random.Random(2)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passages = [words(30) for _ in range(60)]  # each in two texts that are not similar
    docs = [(i, " ".join(passages[i // 2] + words(40))) for i in range(120)]
    asked, ask = [], jaccard.all_parts
    monkeypatch.setattr(jaccard, "all_parts", lambda found, large: asked.append((found.count(), (parts := ask(found, large)).count())) or parts)
    monkeypatch.setattr(jaccard, "FREQUENT", 0)
    monkeypatch.setattr(jaccard, "GROUP_SETS", 4)
    assert {r["component_id"] for r in jaccard.similar_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()} == set(range(120))
    found, parts = asked[0]
    assert 20 < found and parts == found
