import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
from reportloom.llm import linededup, queries


def parquet(spark, place, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{place}/{name}.parquet")
    return str(place)


def words(seed, n=40):
    return " ".join(f"{'abcdefghijklmnopqrstuvwxyz'[(seed * 7 + i * i) % 26]}{seed}x{i * 13 % 101}" for i in range(n))


def test_near_duplicates_go_by_row(spark):
    texts = {i: words(i) for i in range(12)}
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (7, texts[3]), (7, texts[4]), (3, texts[4]), (8, texts[5]), (8, texts[5]),
            (None, texts[5]), (None, texts[0]), (None, None), (None, None), (9, ""), (9, " \n"), (9, texts[6])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string")
    got = corpus_pipeline.without_near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    expected = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (7, texts[3]), (3, texts[4]), (8, texts[5]), (None, None), (None, None), (9, ""), (9, " \n"), (9, texts[6])]
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted(expected, key=str)


def test_contamination_goes_by_row(spark, tmp_path):
    dirty = words(50)
    place = parquet(spark, tmp_path, benchmark=([("b", dirty)], "item_id string, text string"))
    rows = [(None, words(1)), (None, dirty), (None, None), (5, dirty), (5, words(2)), (5, words(2)), (6, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string")
    got = corpus_pipeline.without_contamination(spark, docs, place)
    assert got.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted((r for r in rows if r[1] != dirty), key=str)


def left_of_lines(docs):
    """Of documents in order of their ids, the lines that stay."""
    def parse(line):
        return tuple(re.sub("[0-9]+", "<*>", line).split(" ")) if re.sub("[0-9 ]+", "", line) else ()

    def keys(t):
        cut = [3 + (len(t) - 3) * j // 4 for j in range(5)]
        return [(len(t), t[:3], i, j, t[cut[i] : cut[i + 1]], t[cut[j] : cut[j + 1]]) for i in range(4) for j in range(i)] if len(t) >= 8 else []

    held, long, pivot = defaultdict(list), set(), {}
    for i, text in docs:
        for line in text.split("\n"):
            if t := parse(line):
                held[t].append(i)
                long |= {t} if len(t) >= 8 or len(line) >= 50 else set()
                for k in keys(t):
                    pivot.setdefault(k, (i, t))
    recurring = {t: ids[0] for t, ids in held.items() if len(set(ids)) >= (2 if t in long else 10)}
    for t, ids in held.items():
        for first, other in (pivot[k] for k in keys(t)):
            if first < ids[0] and 100 * sum(a == b for a, b in zip(t, other)) >= 85 * len(t):
                recurring[t] = -1
    return [[x for x in text.split("\n") if recurring.get(parse(x), i) >= i] for i, text in docs]


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def firsts(docs):
    """Places of the first document of each group of similar ones; documents are in order of their ids."""
    sets, root = [shingles(t) for _, t in docs], list(range(len(docs)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 85 * len(a | b) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return {i for i, r in enumerate(root) if i == r}


def brute(docs, bench):
    kept, whole, stay = [], firsts(docs), left_of_lines(docs)
    for at, (i, text) in enumerate(docs):
        left = stay[at]
        if "".join(left).strip() or not text.strip():
            kept.append((i, "\n".join(left)))
        elif at in whole:
            kept.append((i, text))
    kept = [kept[i] for i in sorted(firsts(kept) | {i for i, d in enumerate(kept) if not d[1].split()})]
    windows = {tuple(w[i : i + 13]) for w in (b.lower().split() for b in bench) for i in range(len(w) - 12)}
    clean = []
    for i, text in kept:
        w = text.lower().split()
        hit = {p + q for p in range(len(w) - 12) if tuple(w[p : p + 13]) in windows for q in range(13)}
        if not hit or 20 * len(hit) < len(w):
            clean.append((i, text))
    return clean


def test_lines_against_brute_force(spark):
    rng = random.Random(4)
    base = [[f"{chr(97 + rng.randrange(26))}{i}x" for i in range(n)] for n in (8, 9, 20, 20, 57)]
    docs = []
    for i in range(150):
        lines = [rng.choice(["Les.", "Read more", "12", "", "3 of 4", f"own{i}"])]
        for _ in range(3):
            t = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 2, 3, 5])):
                t[rng.randrange(len(t))] = f"q{chr(97 + rng.randrange(4))}"
            lines.append(" ".join(t))
        docs.append((i, "\n".join(lines)))
    expected = {i: "\n".join(left) for (i, _), left in zip(docs, left_of_lines(docs))}
    got = linededup.without_recurring_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert {r.doc_id: r.text for r in got.collect()} == expected
    stay = Counter(x for text in expected.values() for x in text.split("\n"))
    assert stay["Les."] == stay["Read more"] == 1 and stay["12"] > 10 and sum(map(len, expected.values())) < sum(len(t) for _, t in docs) / 2


def test_run_against_brute_force(spark, tmp_path):
    first = {i: words(i, 30) for i in range(6)}
    footer = words(60, 24)
    changed = " ".join("other" if 20 <= j < 26 else w for j, w in enumerate(words(3, 30).split()))
    docs = [(0, f"{first[0]}\n{footer}"), (1, first[1]), (2, f"{first[2]}\n{footer}"), (3, first[3]),
            (10, f"{first[0]}\n{footer}"), (11, f"{first[2]}\n{footer}"),  # whole copies, the second of a document that lost a line
            (12, f"{first[0]}\n{first[1]}\n{first[2]}\n{first[3]}"),  # lines of many documents: a copy of none
            (13, f"{footer}\n{first[1]}\nits own sentence here"),  # under a fifth of its tokens is left
            (14, changed), (15, ""), (16, words(16) + "\n" + words(70, 20)), (17, words(17)), (18, words(17) + " end")]
    bench = [words(70, 20)]
    expected = brute(docs, bench)
    assert [i for i, _ in expected] == [0, 1, 2, 3, 12, 13, 14, 15, 17]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    place = parquet(spark, tmp_path, documents=([(i, t, "en", "web", len(t)) for i, t in docs], schema), benchmark=([("b", bench[0])], "item_id string, text string"),
                    labels=([], "doc_id long, quality int, toxic int"))
    told = lambda df: Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert told(corpus_pipeline.run(spark, place)) == told(queries.packed(spark.createDataFrame(expected, "doc_id long, text string")))
    cleaned = corpus_pipeline.without_lines(spark, spark.read.parquet(f"{place}/documents.parquet"), place)
    assert {r["doc_id"]: r["text"] for r in cleaned.collect()}[13] == "its own sentence here"


def test_columns_of_any_name_keep_their_values(spark, tmp_path):
    place = parquet(spark, tmp_path, benchmark=([("b", words(50))], "item_id string, text string"), labels=([], "doc_id long, quality int, toxic int"))
    texts = [words(1), words(1) + "\n" + words(2), words(1), None, ""]
    docs = spark.createDataFrame([(i, t, "k", "r", "w", 7, 9) for i, t in enumerate(texts)],
                                 "doc_id long, text string, text_key string, row_key string, text_as_it_was string, first_place int, n_tokens int")
    for stage in (corpus_pipeline.without_near_duplicates, corpus_pipeline.without_contamination):
        got = stage(spark, docs, place)
        assert got.columns == docs.columns and {tuple(r)[2:] for r in got.collect()} == {("k", "r", "w", 7, 9)}
    lines = corpus_pipeline.without_lines(spark, docs.drop("n_tokens", "first_place"), place)
    assert {(r.doc_id, r.text, r.text_key, r.row_key, r.text_as_it_was) for r in lines.collect()} == {
        (0, words(1), "k", "r", "w"), (1, words(2), "k", "r", "w"), (3, None, "k", "r", "w"), (4, "", "k", "r", "w")}


def test_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    place = parquet(spark, tmp_path, documents=([], schema), benchmark=([], "item_id string, text string"), labels=([], "doc_id long, quality int, toxic int"))
    docs = spark.read.parquet(f"{place}/documents.parquet")
    for stage in (corpus_pipeline.without_lines, corpus_pipeline.without_near_duplicates, corpus_pipeline.without_contamination):
        assert stage(spark, docs, place).collect() == []
