"""Packing of token sequences: shortest pack first over the histogram of piece lengths.

Texts become token ids, documents become pieces of at most one sequence, and the histogram of piece lengths, which has
no more entries than a sequence has tokens, is packed on the driver. Patterns of lengths come back to the pieces by
each piece's rank among those of its length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from reportloom.llm.ranks import ranked
from reportloom.llm.words import SPACED_AS_IS, list_array, split_words, text_slices
from reportloom.llm.store import stored

SEQUENCE = 2048
END_ID = 1
CACHED_WORDS = 1_000_000
ENDING = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
JOINED = 2000


class WordEncoder:
    """Token ids of whole texts by the given tokenizer, which is asked once for each distinct word.

    Valid for tokenizers that never join tokens across ASCII white space and mark the end of a word in their
    vocabulary. The ids of words seen are kept up to a bound and then forgotten together.
    """

    def __init__(self, path: str, suffix: str = "</w>"):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.flat, self.starts, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _each(self, words: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of words of letters only, and how many each has: many in one text, cut again where a word's last token stands."""
        flat, sizes = [], []
        for a in range(0, len(words), JOINED):
            some = words[a : a + JOINED]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.int32)
            cuts = np.flatnonzero(self.closes[ids]) + 1
            if len(cuts) == len(some):
                flat.append(ids)
                sizes.append(np.diff(cuts, prepend=0))
            else:
                each = self._each(some)
                flat += each
                sizes.append(np.array([len(x) for x in each], np.int64))
        return flat, sizes

    def _learn(self, words: list[str]) -> None:
        """A word of letters and an ending of signs is put together from both, any other is asked for as a whole."""
        given = pa.array(words, pa.string())
        stems = pc.utf8_rtrim(given, characters=ENDING)
        lettered = pc.utf8_is_alpha(stems)
        plain = pc.if_else(pc.string_is_ascii(stems), pc.ascii_lower(stems), stems).filter(lettered).dictionary_encode()
        mask = lettered.to_numpy(zero_copy_only=False)
        ends, stem_ends = (np.frombuffer(x.buffers()[1], np.int32)[x.offset + 1 : x.offset + len(x) + 1] for x in (given, stems))
        long = np.diff(ends, prepend=0) - np.diff(stem_ends, prepend=0)
        spelled = np.frombuffer(given.buffers()[2] or b"", np.uint8).tobytes()
        ending = [spelled[e - n : e].decode() for e, n in zip(ends[mask & (long > 0)].tolist(), long[mask & (long > 0)].tolist(), strict=True)]
        whole = given.filter(pc.invert(lettered)).to_pylist()
        others = {x: i for i, x in enumerate(dict.fromkeys([*whole, *ending]))}
        flat, sizes = self._letters(plain.dictionary.to_pylist())
        each = self._each(list(others))
        table = np.concatenate((np.empty(0, np.int32), *flat, *each))
        size = np.concatenate((np.empty(0, np.int64), *sizes, np.array([len(x) for x in each], np.int64), [0])).astype(np.int64)
        start, none, first_other = np.cumsum(size) - size, len(size) - 1, len(plain.dictionary)
        parts = np.full((len(words), 2), none)
        parts[mask, 0] = plain.indices.to_numpy(zero_copy_only=False)
        parts[~mask, 0] = [first_other + others[x] for x in whole]
        parts[mask & (long > 0), 1] = [first_other + others[x] for x in ending]
        taken = size[parts]
        runs = taken.ravel()
        after = np.cumsum(runs)
        ids = table[np.repeat(start[parts].ravel() - after + runs, runs) + np.arange(after[-1] if len(after) else 0)]
        sizes = taken.sum(1)
        self.slots.update(zip(words, range(len(self.sizes), len(self.sizes) + len(words)), strict=True))
        self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(sizes) - sizes))
        self.flat, self.sizes = np.concatenate((self.flat, ids)), np.concatenate((self.sizes, sizes))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each text has."""
        words = split_words(texts, SPACED_AS_IS)
        values = words.values.to_pylist()
        if len(self.slots) > CACHED_WORDS:
            self.forget()
        if new := [w for w in values if w not in self.slots]:
            self._learn(new)
        slots = np.array([self.slots[w] for w in values], np.int64)[words.codes]
        sizes = self.sizes[slots]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.starts[slots] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.diff(np.concatenate(([0], ends))[words.bounds])


@lru_cache(1)
def word_encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker: a later task reads no tokenizer file and knows the words of earlier ones."""
    return WordEncoder(path)


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, n_tokens and packed ids (little-endian, 32 bits) of each row of documents, the end id included."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer_path)
        kind = np.dtype("<u2" if len(encoder.closes) <= 1 << 16 and end_id < 1 << 16 else "<u4")
        for batch in text_slices(batches):
            ids, counts = encoder.encode(batch.column(1))
            counts = counts + 1
            whole = np.empty(counts.sum(), kind)
            ends = np.cumsum(counts) - 1
            place = np.ones(len(whole), bool)
            place[ends] = False
            whole[ends], whole[place] = end_id, ids
            offsets = np.concatenate(([0], np.cumsum(counts) * kind.itemsize)).astype(np.int32)
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(whole)])
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64()), packed], ["doc_id", "n_tokens", "packed"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(
        encode, "doc_id long, n_tokens long, packed binary")


def pack_histogram(counts: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns, each as its (length, times) pairs and the number of sequences that follow it.

    Lengths are placed longest first into the shortest packs that have room. Packs that are alike are filled together,
    and a pattern is split where only some of its packs get one more piece.
    """
    open_at: list[int] = []  # packed lengths that have patterns, ascending
    packs: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = defaultdict(list)

    def put(size: int, pattern: tuple[tuple[int, int], ...], n: int) -> None:
        if not packs[size]:
            insort(open_at, size)
        packs[size].append((pattern, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not open_at or open_at[0] + length > sequence:  # new packs, each with as many as it holds
                fit = sequence // length
                if left >= fit:
                    put(fit * length, ((length, fit),), left // fit)
                if left % fit:
                    put(left % fit * length, ((length, left % fit),), 1)
                break
            size = open_at[0]
            pattern, n = packs[size].pop()
            if not packs[size]:
                open_at.pop(bisect_left(open_at, size))
            goal = open_at[0] if open_at else sequence
            used = min(n, left)
            times = max(1, min((goal - size) // length, (sequence - size) // length, left // used))
            if n > used:
                put(size, pattern, n - used)
            same = pattern[-1][1] if pattern[-1][0] == length else 0
            put(size + times * length, (*(pattern[:-1] if same else pattern), (length, same + times)), used)
            left -= used * times
    return [(list(pattern), n) for size in sorted(packs) for pattern, n in packs[size] if n]


def placements(counts: dict[int, int], sequence: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length, first rank, first sequence, times a sequence, offset: ranks from the first one on lie there.
    And rows of first sequence, tokens in each: sequences from the first one on have so many."""
    rows, ends, at, given = [], [], 0, defaultdict(int)
    for pattern, n in pack_histogram(counts, sequence):
        offset = 0
        for length, times in pattern:
            rows.append((length, given[length], at, times, offset))
            given[length] += n * times
            offset += times * length
        ends.append((at, offset))
        at += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5), np.array(ends, np.int64).reshape(-1, 2)


def pack(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Packs every document into sequences of at most the given number of tokens.

    Returns a row per piece: doc_id, start (its document's ids before it), length, doc_tokens, sequence_id, offset,
    padded_length and ids. A document is cut at multiples of the sequence length, so that only its last piece is
    shorter. A sequence is padded to the full length unless its own length is a power of two.
    A null or empty text is the end id alone; equal rows are packed as often as they come; no rows give no sequences;
    other columns are left out.
    """
    # the one table with ids; all planning reads two narrow columns of it
    tokens = stored(tokenized(docs, tokenizer_path, end_id).withColumn("key", F.monotonically_increasing_id()))
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_tokens") - 1, F.lit(sequence).cast("long")))
    pieces = tokens.select("key", "n_tokens", starts.alias("start")).select(
        "key", "start", F.least(F.lit(sequence).cast("long"), F.col("n_tokens") - F.col("start")).alias("length"),
        F.concat_ws(":", "key", "start").alias("piece"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table, ends = placements(histogram, sequence)
    rows = sum(histogram.values())
    order = table[:, 0] * (rows + 1) + table[:, 1]

    @arrow_udf("struct<sequence_id:long,offset:long>")
    def placed(length: pa.Array, rank: pa.Array) -> pa.Array:
        size, number = (np.asarray(x.to_numpy(zero_copy_only=False), np.int64) for x in (length, rank))
        found = table[np.searchsorted(order, size * (rows + 1) + number, "right") - 1]
        nth = number - found[:, 1]
        return pa.StructArray.from_arrays([pa.array(found[:, 2] + nth // found[:, 3]),
                                           pa.array(found[:, 4] + nth % found[:, 3] * size)], ["sequence_id", "offset"])

    @arrow_udf("long")
    def padded(number: pa.Array) -> pa.Array:
        size = ends[np.searchsorted(ends[:, 0], number.to_numpy(zero_copy_only=False), "right") - 1, 1]
        return pa.array(np.where(size & (size - 1), sequence, size))

    @arrow_udf("array<int>")
    def cut(packed: pa.Array, whole: pa.Array, start: pa.Array, length: pa.Array) -> pa.Array:
        out, sizes = [], length.to_numpy(zero_copy_only=False)
        for blob, n, a, size in zip(packed, whole.to_pylist(), start.to_pylist(), sizes, strict=True):
            buffer = blob.as_buffer()
            out.append(np.frombuffer(buffer, f"<u{buffer.size // n}")[a : a + size].astype(np.int32))
        return list_array(np.concatenate(out) if out else np.empty(0, np.int32), sizes, pa.int32())

    numbered = ranked(pieces, "length", "piece", rows, "rank").drop("piece")
    where = numbered.select("key", "start", "length", placed("length", "rank").alias("at"))
    return (where.join(tokens, "key")
            .select("doc_id", "start", "length", F.col("n_tokens").alias("doc_tokens"), F.col("at.sequence_id"), F.col("at.offset"),
                    padded(F.col("at.sequence_id")).alias("padded_length"), cut("packed", "n_tokens", "start", "length").alias("ids")))

