import zlib
from collections import Counter, defaultdict

import numpy as np

from reportloom.llm import sharding


def test_place_balances_all_measures():
    rng = np.random.default_rng(1)
    units = np.column_stack([rng.lognormal(8, 1, 4000), rng.lognormal(5, 1, 4000), rng.integers(1, 9, 4000)])
    shard = sharding.place(units, 8)
    for column in units.T:
        sums = np.bincount(shard, column, 8)
        assert sums.max() / sums.mean() < 1.01
    assert len(sharding.place(np.empty((0, 3)), 8)) == 0


def test_assign(spark):
    texts = [None, "", "same text"] + [f"text {i} " * (i % 37 + 1) for i in range(3000)]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(5000 + i, "copied text " * 30, 1, "x") for i in range(2000)] + [(1, "", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int, unit string")
    got = sharding.assign(docs, 8).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    by_id = {r[0]: r[1] or "" for r in rows}
    sizes, slots, shards_of_group = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        text = by_id[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["tokens"]) == (len(text) + 1, zlib.crc32(text), len(text.split()))
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        shards_of_group[r["group"]].add(r["shard"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(sizes.values()) - min(sizes.values()) < 0.01 * sum(sizes.values()) / 8
    assert sum(len(x) > 1 for x in shards_of_group.values()) < 30  # only large groups are cut
    assert sharding.assign(docs.limit(0)).collect() == []
    assert len(sharding.assign(docs.limit(3), 8).collect()) == 3


def test_groups_that_fit_stay_whole(spark):
    rows = [(i, f"own text {i} " * (i % 37 + 1)) for i in range(1500)]
    copies = [(10_000 * (k + 1) + i, f"copy {k} " * 20) for k, n in enumerate([2, 3, 5, 25, 60, 100, 100, 900]) for i in range(n)]
    got = sharding.assign(spark.createDataFrame(rows + copies, "doc_id long, text string"), 8).collect()
    shards, sums = defaultdict(set), {m: Counter() for m in ("size", "tokens", "rows")}
    for r in got:
        shards[r["group"]].add(r["shard"])
        for m in sums:
            sums[m][r["shard"]] += 1 if m == "rows" else r[m]
    assert [len(x) for x in shards.values() if len(x) > 1] == [8]  # only the group larger than a shard
    for m, found in sums.items():
        assert len(found) == 8 and max(found.values()) < 1.03 * sum(found.values()) / 8, (m, found)
