import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from reportloom.llm import packing
from reportloom.llm.queries import ids_crc32, word_bpe_path

TEXTS = ["The idiot's café, it's 1,234.5 — ΟΔΟΣ Σ.  x", None, "", "  \n\t ", "word " * 3000, "don't!!! (stop)", "don't!!! (stop)",
         "a<|endoftext|>b <|startoftext|>", "İstanbul ß ﬁn été 你好世界 😀😀 naïve.—x", "x" * 5000, "A.B,c;d", "\x1c a\x85b  c"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_bpe_path())


def test_word_encoder_equals_tokenizer(tokenizer):
    texts = [t or "" for t in TEXTS]
    encoder = packing.WordEncoder(word_bpe_path())
    for _ in range(2):  # the second time from what is kept
        ids, counts = encoder.encode(pa.array(texts))
        got = np.split(ids, np.cumsum(counts)[:-1])
        for text, have in zip(texts, got, strict=True):
            assert have.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_histogram_is_placed_whole():
    rng = np.random.default_rng(3)
    for top, sequence in ((2048, 2048), (9, 16), (1, 7), (40, 40)):
        counts = dict(Counter((rng.integers(1, top + 1, 900)).tolist()))
        back = defaultdict(int)
        for pattern, n in packing.pack_histogram(counts, sequence):
            assert sum(length * times for length, times in pattern) <= sequence
            for length, times in pattern:
                back[length] += times * n
        assert dict(back) == counts
    assert packing.pack_histogram({}) == []
    patterns = packing.pack_histogram({1: 10**9, 1000: 3})
    assert sum(n for _, n in patterns) <= 10**9 // 2048 + 4


def test_pack(spark, tokenizer):
    rows = [(i, t, "clash", 7) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string, key int")
    got = packing.pack(docs, word_bpe_path(), sequence=64).withColumn("crc", ids_crc32("ids")).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        assert r["length"] == len(r["ids"]) and r["crc"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, text, *_ in rows:
        pieces = sorted(by_doc[i], key=lambda r: r["start"])
        ids = [x for r in pieces for x in r["ids"]]
        assert ids == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert [r["start"] for r in pieces] == list(range(0, len(ids), 64)) and {r["doc_tokens"] for r in pieces} == {len(ids)}
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert {r["padded_length"] for r in pieces} == {at if at & (at - 1) == 0 else 64}
    tokens = sum(r["length"] for r in got)
    assert tokens / (64 * len(by_sequence)) > 0.95


def test_pack_of_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), word_bpe_path()).collect() == []


def test_pack_of_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "same words here")] * 40, "doc_id long, text string")
    got = packing.pack(docs, word_bpe_path(), sequence=16).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 40
