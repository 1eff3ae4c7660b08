"""Phrases whose words keep company, counted over a prefix-free parse of the texts.

Texts become sequences of words cut into pieces. A word whose hash says so starts a new chunk; each chunk also holds the
two words after it, so that every phrase of three words lies in the chunk in which it starts, and is counted there and
nowhere else. Equal chunks are kept once with their number, and everything after that reads the dictionary of chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from reportloom.llm.store import stored
from reportloom.llm.words import mixed, text_slices

LONGEST = 3  # words of a phrase
OVERLAP = LONGEST - 1
TRIGGER = 24  # one word in so many starts a chunk
LEAST = 10
SHARE = 50  # a phrase goes if a longer one around it has this percentage of its occurrences
SCALE = 1_000_000
TOP = 2000
BUCKET_BITS = 14  # chunks worked on at once, about 2 MB
NO_LANG = "und"

# Classes of bytes: what parts words, what parts pieces, and all else.
BLANK, BREAK, INSIDE = 0, 1, 2
KIND = np.full(256, INSIDE, np.uint8)
KIND[[0x20, 0x09]] = BLANK
KIND[list(b".,;:!?\x0a\x0b\x0c\x0d")] = BREAK
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))
BASE = 0x9E3779B97F4A7C15


class Tokens:
    """Words of a column of texts: their bytes in a row, where each starts, its text, and whether a piece starts with it."""

    def __init__(self, texts: pa.Array, kinds: np.ndarray = KIND):
        texts = texts.cast(pa.string()).fill_null("")
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]] if len(ends) else np.empty(0, np.uint8)
        ends = ends - ends[0]
        kind = kinds[raw]
        inside = kind == INSIDE
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        row_starts = ends[:-1][ends[:-1] < len(raw)]
        first[row_starts] = inside[row_starts]
        at = np.flatnonzero(first)
        self.data = LOWER[raw[inside]]
        self.starts = (np.cumsum(inside) - 1)[at] if len(at) else np.empty(0, np.int64)
        self.lengths = np.diff(np.append(self.starts, len(self.data)))
        self.bounds = np.searchsorted(at, ends)  # the words of text i are bounds[i] to bounds[i + 1]
        passed = np.cumsum(kind == BREAK)[at] if len(at) else np.empty(0, np.int64)
        self.parted = np.empty(len(at), bool)
        self.parted[1:] = passed[1:] != passed[:-1]
        self.parted[self.bounds[:-1][self.bounds[:-1] < len(at)]] = True

    def __len__(self) -> int:
        return len(self.starts)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def hashes(self) -> np.ndarray:
        """64 bits of each word, out of its bytes alone."""
        if not len(self):
            return np.empty(0, np.uint64)
        powers = np.full(int(self.lengths.max()), BASE, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        place = np.arange(len(self.data)) - np.repeat(self.starts, self.lengths)
        return mixed(np.add.reduceat(BYTE_VALUES[self.data] * powers[place], self.starts))

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """Of each word its place among the distinct ones, and those."""
        offsets = np.append(self.starts, len(self.data)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(self), pa.py_buffer(offsets), pa.py_buffer(self.data)).dictionary_encode()
        return words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary


def _gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return data[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


def chunks_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Of each chunk its text's row, its words, and how many of them are its own; a line feed stands where a piece ends."""
    tokens = Tokens(texts)
    n = len(tokens)
    opens = tokens.hashes() % np.uint64(TRIGGER) == 0
    opens[tokens.bounds[:-1][tokens.bounds[:-1] < n]] = True
    begin = np.flatnonzero(opens)
    own = np.diff(np.append(begin, n))
    rows = tokens.rows()[begin]
    words = np.minimum(begin + own + OVERLAP, tokens.bounds[1:][rows]) - begin
    # the words with one byte behind each: a blank, or a line feed before a new piece
    after = np.cumsum(tokens.lengths + 1)
    line = np.full(after[-1] if n else 0, 0x20, np.uint8)
    spelled = np.ones(len(line), bool)
    spelled[after - 1] = False
    line[spelled] = tokens.data
    line[(after - 1)[:-1][tokens.parted[1:]]] = 0x0A
    starts = after - tokens.lengths - 1
    last = begin + words - 1
    sizes = starts[last] + tokens.lengths[last] - starts[begin]
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    flat = _gathered(line, starts[begin], sizes)
    return rows, pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(flat)), own


def dictionary(docs: DataFrame) -> DataFrame:
    """``lang, chunk, own, n, at``: the distinct chunks, the number of their own words, how often they come, and a number."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            rows, chunks, own = chunks_of(batch.column(1))
            yield pa.record_batch([batch.column(0).take(pa.array(rows)), chunks, pa.array(own, pa.int32())], ["lang", "chunk", "own"])

    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col("text").cast("string").alias("text"))
    parsed = texts.mapInArrow(parse, "lang string, chunk string, own int")
    counted = parsed.groupBy("lang", "chunk", "own").agg(F.count(F.lit(1)).alias("n"))
    return stored(counted.withColumn("at", F.monotonically_increasing_id()))


#: In the dictionary's chunks words are apart by blanks, pieces by line feeds, and no other byte is either.
SPELLED = np.full(256, INSIDE, np.uint8)
SPELLED[0x20], SPELLED[0x0A] = BLANK, BREAK


class Bucket:
    """Chunks of one bucket with their pairs of neighbouring words."""

    def __init__(self, langs: pa.Array, chunks: pa.Array, own: np.ndarray, times: np.ndarray):
        self.tokens = tokens = Tokens(chunks, SPELLED)
        rows = tokens.rows()
        place = np.arange(len(tokens)) - tokens.bounds[:-1][rows]
        self.counted = place < own[rows]  # what starts here is counted here
        self.times = times[rows]
        follows = np.zeros(len(tokens), bool)
        follows[:-1] = (rows[1:] == rows[:-1]) & ~tokens.parted[1:]
        self.follows = follows  # the next word is in the same piece
        names = langs.dictionary_encode()
        self.langs, self.lang = names.dictionary, names.indices.to_numpy(zero_copy_only=False)[rows].astype(np.int64)
        salt = mixed(np.array([hash_of(x) for x in self.langs.to_pylist()], np.uint64))
        words = tokens.hashes()
        self.pair, self.check = np.zeros((2, len(tokens)), np.uint64)  # 128 bits of each word and the next one
        self.pair[:-1] = mixed(words[:-1] * np.uint64(BASE) + words[1:])
        self.check[:-1] = mixed(words[1:] * np.uint64(BASE) ^ mixed(words[:-1]))
        if len(salt):
            self.pair += salt[self.lang]
            self.check ^= salt[self.lang]


def hash_of(text: str) -> int:
    return int(Tokens(pa.array(["l" + text.encode().hex()])).hashes()[0])


def _summed(pair: np.ndarray, check: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(pair, kind="stable")
    pair, check, weights = pair[order], check[order], weights[order]
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (check[1:] != check[:-1])
    starts = np.flatnonzero(new)
    return pair[starts], check[starts], np.add.reduceat(weights, starts) if len(starts) else np.empty(0, np.int64)


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return _column(batch, name).to_numpy(zero_copy_only=False).astype(np.int64)


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each run of equal buckets as one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        bucket = _numbers(batch, "bucket")
        cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1), len(bucket)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if held and _column(held[0], "bucket")[0].as_py() != bucket[a]:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.concat_batches(held)


def frequent_pairs(chunks: DataFrame, least: int = LEAST) -> DataFrame:
    """``bucket, pair, check, total``: for each bucket of chunks its word pairs that come often enough in the whole corpus.

    A pair is known by 128 bits. One of the buckets that hold it has its total, and will spell it. The pair behind a chunk's
    own words is not counted there, but its bucket has to know it: a phrase of three words may end with it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bucket(batches):
            some = Bucket(_column(batch, "lang"), _column(batch, "chunk"), _numbers(batch, "own"), _numbers(batch, "n"))
            use = some.follows
            pair, check, sums = _summed(some.pair[use], some.check[use], np.where(some.counted, some.times, 0)[use])
            yield pa.record_batch([pa.array(np.full(len(pair), _numbers(batch, "bucket")[0])), pa.array(pair.view(np.int64)), pa.array(check.view(np.int64)),
                                   pa.array(sums)], ["bucket", "pair", "check", "n"])

    counted = chunks.mapInArrow(count, "bucket long, pair long, check long, n long")
    everywhere = Window.partitionBy("pair", "check")
    total = counted.withColumns({"total": F.sum("n").over(everywhere), "first": F.min("bucket").over(everywhere)}).filter(F.col("total") >= least)
    return stored(total.select("bucket", "pair", "check", F.when(F.col("bucket") == F.col("first"), F.col("total")).otherwise(0).alias("total")))


def phrase_counts(chunks: DataFrame, pairs: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang, words, phrase, f`` of every word and of every phrase of two or three words that comes often enough.

    A phrase of three words cannot be more frequent than the two pairs in it, so it is only counted where both are frequent.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bucket(batches):
            missing = pc.is_null(_column(batch, "chunk"))
            part, known = batch.filter(pc.invert(missing)), batch.filter(missing)
            if not len(part):
                continue
            pair, check, total = (_numbers(known, name) for name in ("pair", "check", "n"))
            order = np.argsort(pair.view(np.uint64), kind="stable")
            pair, check, total = pair.view(np.uint64)[order], check.view(np.uint64)[order], total[order]
            some = Bucket(_column(part, "lang"), _column(part, "chunk"), _numbers(part, "own"), _numbers(part, "n"))
            found = np.searchsorted(pair, some.pair)
            inside = found < len(pair)
            found[~inside] = 0
            two = some.follows & inside & (pair[found] == some.pair) & (check[found] == some.check) if len(pair) else np.zeros(len(found), bool)
            three = two.copy()
            three[:-1] &= two[1:]
            three[-1:] = False
            codes, values = some.tokens.coded()
            size = len(values) or 1
            code = some.lang * size + codes

            def told(at: np.ndarray, words: int, sums: np.ndarray) -> pa.RecordBatch:
                parts = [values.take(pa.array(codes[at + k])) for k in range(words)]
                phrase = parts[0] if words == 1 else pc.binary_join_element_wise(*parts, " ")
                return pa.record_batch([some.langs.take(pa.array(some.lang[at])), pa.array(np.full(len(at), words), pa.int32()), phrase, pa.array(sums)],
                                       ["lang", "words", "phrase", "n"])

            at = np.flatnonzero(two)
            at = at[total[found[at]] > 0]
            one = at[np.unique(found[at], return_index=True)[1]]
            yield told(one, 2, total[found[one]])
            for words, use in ((1, some.counted), (3, some.counted & three)):
                at = np.flatnonzero(use)
                keys = code[at]
                for k in range(1, words):  # codes of pairs and triples, kept small by numbering those that occur
                    keys = np.unique(keys, return_inverse=True)[1] * size + codes[at + k]
                distinct, one, inverse = np.unique(keys, return_index=True, return_inverse=True)
                yield told(at[one], words, np.bincount(inverse, some.times[at], len(distinct)).astype(np.int64))

    none = {"lang": "string", "chunk": "string", "own": "int"}
    marks = pairs.select("bucket", "pair", "check", *[F.lit(None).cast(kind).alias(name) for name, kind in none.items()], F.col("total").alias("n"))
    rows = marks.unionByName(chunks.select("bucket", *[F.lit(None).cast("long").alias(c) for c in ("pair", "check")], *none, "n"))
    counted = rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(count, "lang string, words int, phrase string, n long")
    return stored(counted.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f")).filter(F.col("f") >= least))


def _score(a: Column, left: Column, right: Column) -> Column:
    """Whole numbers of up to 38 digits, so that nothing is rounded."""
    wide = lambda c: c.cast("decimal(38,0)")
    over = wide(wide(F.lit(SCALE) * a.cast("decimal(16,0)")) * a.cast("decimal(16,0)"))
    under = wide(left.cast("decimal(19,0)") * right.cast("decimal(19,0)"))
    return F.call_function("div", over, under)


def scored(counts: DataFrame, share: int = SHARE) -> DataFrame:
    """``lang, phrase, words, a, l, r, score`` of the candidates that no longer phrase accounts for, at their weakest cut."""
    word = F.split("phrase", " ")
    part = lambda start, size: F.array_join(F.slice(word, start, size), " ")
    phrases = counts.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({"first": part(F.lit(1), F.col("k")), "rest": part(F.col("k") + 1, F.col("words") - F.col("k"))})
    sides = counts.select("lang", "phrase", "f")
    left = sides.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = sides.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cut = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    weakest = cut.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.explode(F.array(part(F.lit(1), F.lit(LONGEST - 1)), part(F.lit(2), F.lit(LONGEST - 1))))
    around = (phrases.filter(F.col("words") == LONGEST).select("lang", inner.alias("phrase"), F.col("a").alias("longer"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    whole = lambda c: c.cast("decimal(22,0)")
    taken = whole(F.coalesce("longer", F.lit(0))) * 100 >= whole(F.col("a")) * share
    return (weakest.join(around, ["lang", "phrase"], "left").filter(~taken)
            .select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score"))


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, share: int = SHARE) -> DataFrame:
    """The strongest phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``a, l, r`` are the occurrences of the phrase and of the parts at its weakest cut, ``n`` the words of the language.
    Texts of no language count as ``und``; a null or empty text has no words; equal rows count as often as they come; without
    rows, or without frequent phrases, the result is empty. Other columns of docs are not looked at. A very long text is
    parsed in one slice of its own; its chunks are as short as any others'.
    Ties in score and occurrences go by the bytes of the phrase.
    """
    chunks = dictionary(docs).withColumn("bucket", F.shiftright("at", BUCKET_BITS))
    totals = chunks.groupBy("lang").agg(F.sum(F.col("own") * F.col("n")).alias("words_in_all"))
    counts = phrase_counts(chunks, frequent_pairs(chunks, least), least)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored(counts, share).withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("words_in_all").alias("n"), "score")
