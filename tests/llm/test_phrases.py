"""Phrases against counting in plain Python."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa

from reportloom.llm import phrases

SCHEMA = "lang string, text string"


def plain(rows, top, least=10):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        longer, found = Counter(), []
        for phrase, a in counts.items():
            if len(phrase) == 3 and a >= least:
                for part in (phrase[:2], phrase[1:]):
                    longer[part] = max(longer[part], a)
        for phrase, a in counts.items():
            if len(phrase) < 2 or a < least or len(phrase) == 2 and longer[phrase] and 100 * longer[phrase] >= 50 * a:
                continue
            score, k = min((1_000_000 * a * a // (counts[phrase[:k]] * counts[phrase[k:]]), k) for k in range(1, len(phrase)))
            found.append((-score, -a, " ".join(phrase).encode(), counts[phrase[:k]], counts[phrase[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(found)[:top]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(spark, rows, top):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("'w' AS words", "lang", "text", "1 AS n", "2 AS bucket").repartition(3)
    return sorted(tuple(r) for r in phrases.collocations(df, top).collect())


def corpus(seed, n=150):
    rng = random.Random(seed)
    bag = [rng.choice(["A", "b", "É", "word", "Zz", " x", "日本", "a"]) + rng.choice(["", "", "1", "q", "-r"]) for _ in range(12)]
    ends = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "!", "\r\n", "\x0b"]
    return [(rng.choice(["en", "de", None]), "".join(rng.choice(bag) + rng.choice(ends) for _ in range(rng.randrange(60)))) for _ in range(n)]


def test_against_plain_counting(spark):
    rows = corpus(1) + [("en", None), ("en", ""), (None, " . "), ("fr", "one two three"), ("de", "same same " * 5000)] + [("en", "the known phrase of all.")] * 40
    for top in (2000, 7):
        assert found(spark, rows, top) == plain(rows, top)


def test_small_buckets_give_the_same(spark, monkeypatch):
    rows = corpus(2)
    monkeypatch.setattr(phrases, "BUCKET_BITS", 3)
    assert found(spark, rows, 100) == plain(rows, 100)


def test_phrases_that_end_behind_the_own_words_of_a_chunk(spark, monkeypatch):
    rng = random.Random(1)
    bag = [f"w{i}" for i in range(60)]
    known = [" ".join(rng.choices(bag, k=3)) for _ in range(60)]
    rows = [(rng.choice(["en", None]), " ".join(rng.choices(known, k=rng.randrange(30)))) for _ in range(120)]
    for bits in (3, 0):
        monkeypatch.setattr(phrases, "BUCKET_BITS", bits)
        assert found(spark, rows, 2000) == plain(rows, 2000)


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000
    counts = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big - 7)], "lang string, words int, phrase string, f long")
    row = phrases.scored(counts).first()
    assert row.score == 1_000_000 * (big - 7) ** 2 // (big * (big + 1))


def test_chunks_own_each_word_once():
    texts = pa.array([t for _, t in corpus(3)] + [None, "", "x"])
    rows, chunks, own = phrases.chunks_of(texts)
    tokens = phrases.Tokens(texts)
    assert own.sum() == len(tokens) and (own > 0).all()
    spelled = phrases.Tokens(chunks, phrases.SPELLED)
    assert ((spelled.bounds[1:] - spelled.bounds[:-1] - own) <= phrases.OVERLAP).all()


def test_words_have_hashes_of_their_own():
    words = sorted({"".join(random.Random(i).choices("abcé日 -"[:6], k=1 + i % 12)) for i in range(5000)})
    words = [w for w in words if " " not in w]
    assert len(set(phrases.Tokens(pa.array(words)).hashes().tolist())) == len(words)


def test_no_rows(spark):
    assert found(spark, [], 10) == [] and found(spark, [("en", "a b")], 10) == []
