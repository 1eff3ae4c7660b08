import random
import re

import pytest

from reportloom.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))


def brute(docs, items, window=13):
    found = []
    for item, text in items:
        w = words(text)
        if item is not None and w:
            found += [(str(item), tuple(w[i : i + window])) for i in range(max(1, len(w) - window + 1))]
    out = []
    for doc, text in docs:
        w = words(text)
        hit, named = set(), set()
        for item, win in found:
            for p in range(len(w) - len(win) + 1):
                if tuple(w[p : p + len(win)]) == win:
                    hit.update(range(p, p + len(win)))
                    named.add(item)
        out.append((doc, len(w), len(hit), tuple(sorted(named)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def cases():
    rng = random.Random(5)
    vocabulary = ["a", "b", "c", "dé", "E1", "été", "x9"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 12, 13, 14, 30])))) for i in range(25)]
    items += [(100, items[3][1]), (101, None), (102, " .;! "), (None, "zz yy xx"), (103, "the the the the the the the the the the the the the the")]
    docs = [(i, ", ".join(rng.choice(vocabulary[:4]) for _ in range(rng.randrange(60)))) for i in range(40)]
    docs += [(i, "Q " * rng.randrange(600) + (items[i % 25][1].upper() + "!") * 2 + " w" * rng.randrange(9)) for i in range(40, 70)]
    docs += [(90, None), (91, ""), (92, " \n--"), (93, "the " * 4000), (94, items[5][1]), (94, items[5][1]), (95, "É b\x00c\x7fd")]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_against_brute_force(spark, block_bytes):
    docs, items = cases()
    left = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, items string, n_words int")
    right = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, doc_id int")
    got = decontaminate.contamination(left, right, block_bytes=block_bytes).collect()
    have = sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in got), key=str)
    assert have == brute(docs, items)
    assert all(a["to"] < b["from"] for r in got for a, b in zip(r["spans"], r["spans"][1:]))


def test_empty_sides(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in decontaminate.contamination(docs, none).collect()] == [(3, 0, False)]
    assert decontaminate.contamination(docs.limit(0), spark.createDataFrame([(1, "a b")], none.schema)).collect() == []
