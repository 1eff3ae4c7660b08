"""Quality: heuristic labellers vote, expectation-maximisation weighs them, and the posterior labels train a scorer.

Each labeller says good, bad or nothing; saying nothing tells nothing. How often a labeller that speaks is right about good
and about bad texts is estimated from the vote patterns of all documents, of which there are at most three to the number of labellers. The posterior of
a pattern is the soft label of its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from reportloom.llm.linear import SCORED_BYTES, Features, fit, hashed, score_column
from reportloom.llm.store import stored
from reportloom.llm.words import BLANKS, SPACED_AS_IS, Words, byte_table, slices, split_words, text_slices

TRAIN_ROWS = 20_000  # documents that the scorer is fitted on, chosen by a hash of their text
ROUNDS = 200
KEPT = 0.5
LABELLERS = ("length", "symbols", "capitals", "variety", "word_size", "function_words", "sentences", "stutter")
#: Frequent function words of English, German, French and Spanish. A caller may give others.
FUNCTION_WORDS = tuple("the of and to in is that for with der die und das den von zu le la les de et que une el los las en por con".split())
SYMBOLS = b"#*$%&|<>{}[]~^=@\\"
SYMBOL_TABLE, CAPITAL_TABLE, LETTER_TABLE = np.zeros(256, np.int64), np.zeros(256, np.int64), np.zeros(256, np.int64)
SYMBOL_TABLE[list(SYMBOLS)] = 1
CAPITAL_TABLE[65:91] = 1
LETTER_TABLE[65:91] = LETTER_TABLE[97:123] = 1


def judged(value: np.ndarray, bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    return np.where(bad, 0, np.where(good, 2, 1)).astype(np.int8)


def votes(texts: pa.Array, function_words: tuple[str, ...] = FUNCTION_WORDS) -> np.ndarray:
    """Labellers x texts: 0 bad, 1 nothing, 2 good. A text without words is bad by its length alone."""
    words = split_words(texts, SPACED_AS_IS)
    n = words.counts
    some = np.maximum(n, 1)
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]

    def in_text(table: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(table[raw])))[ends])

    rows, chars = words.rows(), pc.utf8_length(words.values).to_numpy(zero_copy_only=False)
    letters = np.maximum(in_text(LETTER_TABLE), 1)
    symbols, capitals = in_text(SYMBOL_TABLE) / some, in_text(CAPITAL_TABLE) / letters
    width = max(len(words.values), 1)
    pairs = np.unique(rows * width + words.codes) if len(rows) else np.empty(0, np.int64)
    variety = np.bincount(pairs // width, minlength=len(n)) / some
    mean = np.bincount(rows, chars[words.codes], len(n)) / some if len(rows) else np.zeros(len(n))
    plain = pc.utf8_lower(pc.utf8_trim(words.values, ".,;:!?\"'()")) if len(words.values) else words.values
    known = pc.is_in(plain, value_set=pa.array(function_words)).to_numpy(zero_copy_only=False).astype(bool)
    common = np.bincount(rows[known[words.codes]], minlength=len(n)) / some if len(rows) else np.zeros(len(n))
    stop = pc.match_substring_regex(words.values, r'[.!?…]["»”\')]*$').to_numpy(zero_copy_only=False).astype(bool)
    stops = np.bincount(rows[stop[words.codes]], minlength=len(n)) / some if len(rows) else np.zeros(len(n))
    same = np.zeros(len(rows), bool)
    same[1:] = (words.codes[1:] == words.codes[:-1]) & (rows[1:] == rows[:-1])
    stutter = np.bincount(rows[same], minlength=len(n)) / some
    none = n == 0
    out = np.stack([
        judged(n, n < 5, n >= 50), judged(symbols, symbols > 0.1, symbols < 0.02), judged(capitals, capitals > 0.4, capitals < 0.15),
        judged(variety, variety < 0.2, (variety > 0.4) & (n >= 20)), judged(mean, (mean < 2.5) | (mean > 12), (mean > 3.5) & (mean < 9)),
        judged(common, (common < 0.02) & (n >= 20), common > 0.08), judged(stops, (stops < 0.005) & (n >= 50), stops > 0.02),
        judged(stutter, stutter > 0.15, stutter < 0.03)])
    out[1:, none] = 1
    return out


def signs(texts: pa.Array, function_words: tuple[str, ...]) -> list[str]:
    """Votes on each text, a sign for each labeller, from a bounded amount of text at once."""
    out = []
    for a, b in slices(texts, SCORED_BYTES):
        found = np.frombuffer(b"-.+", np.uint8)[votes(texts.slice(a, b - a), function_words)].T
        out += [bytes(r).decode() for r in np.ascontiguousarray(found)]
    return out


def posteriors(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The probability that a text with each pattern (rows of 0, 1, 2) is good, by expectation-maximisation.

    It starts from the share of good among the votes given, and keeps a small count of every answer from both classes, so
    that no labeller becomes certain.
    """
    if not len(patterns):
        return np.empty(0)
    good, bad = (patterns == 2).sum(axis=1), (patterns == 0).sum(axis=1)
    p, given = (good + 0.5) / (good + bad + 1), patterns != 1
    for _ in range(rounds):
        yes, no = counts * p, counts * (1 - p)
        prior = np.log((yes.sum() + 1) / (no.sum() + 1))
        logit = np.full(len(p), prior)
        said_yes, said_no = (yes @ given + 2, no @ given + 2)
        for answer in (0, 2):
            there = patterns == answer
            logit += there @ np.log((yes @ there + 1) / said_yes / ((no @ there + 1) / said_no))
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return p


LOWER, UPPER, DIGIT = (np.frombuffer(x, np.uint8)[0] for x in (b"a", b"A", b"9"))
SHAPE = byte_table(BLANKS, lower=False)
SHAPE[97:123], SHAPE[65:91], SHAPE[48:58], SHAPE[128:] = LOWER, UPPER, DIGIT, LOWER


def word_places(values: pa.Array) -> np.ndarray:
    """Each word, and its shape: runs of capitals, small letters and digits as one sign each, other signs as they are."""
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    signs = SHAPE[np.frombuffer(values.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]]
    offsets -= offsets[0]
    first = np.ones(len(signs), bool)
    first[1:] = signs[1:] != signs[:-1]
    first[offsets[:-1]] = True
    kept = np.concatenate(([0], np.cumsum(first)))[offsets].astype(np.int32)
    shapes = pa.StringArray.from_buffers(len(values), pa.py_buffer(kept), pa.py_buffer(signs[first]))
    return np.stack([hashed(values, 1), hashed(shapes, 2)])


def text_places(words: Words) -> np.ndarray:
    """Of each text, hashed steps of its length and of the share of different words."""
    n, rows = words.counts, words.rows()
    width = max(len(words.values), 1)
    pairs = np.unique(rows * width + words.codes) if len(rows) else np.empty(0, np.int64)
    variety = np.bincount(pairs // width, minlength=len(n)) / np.maximum(n, 1)
    steps = [np.log2(n + 1).astype(int), (variety * 10).astype(int)]
    return np.stack([hashed(pa.array(s.astype(str), pa.string()), 3 + i) for i, s in enumerate(steps)])


FEATURES = Features(SPACED_AS_IS, word_places, text_places)


def score(docs: DataFrame, rows: int = TRAIN_ROWS, function_words: tuple[str, ...] = FUNCTION_WORDS) -> DataFrame:
    """doc_id, votes, posterior, score and kept of each row of documents.

    votes has a sign for each labeller: + good, - bad, . nothing. posterior comes from the votes alone, score from the
    scorer that learned from the posteriors of at most so many rows; kept means a score of one half or more. Null texts
    are empty texts. Equal texts get equal results, under any id. An empty table gives no rows. Other columns are left out.
    """

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            said = pa.array(signs(batch.column(1).cast(pa.string()), function_words), pa.string())
            yield pa.record_batch([batch.column(0), said, batch.column(2)],
                                  ["doc_id", "votes", "text_hash"])

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    hash_of = F.xxhash64("text").alias("text_hash")
    voted = stored(texts.select("doc_id", "text", hash_of).mapInArrow(vote, "doc_id long, votes string, text_hash long"))
    found = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).orderBy("votes").toArrow()  # bounded by the labellers
    names, counts = found.column("votes").to_pylist(), found.column("n").to_numpy()
    patterns = np.array([["-.+".index(c) for c in name] for name in names], int).reshape(-1, len(LABELLERS))
    table = dict(zip(names, posteriors(patterns, counts).tolist(), strict=True))
    known = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in table.items()], "votes string, posterior double")

    chosen = voted.groupBy("text_hash").agg(F.first("votes").alias("votes")).orderBy("text_hash").limit(rows)
    labelled = chosen.join(F.broadcast(known), "votes").select("text_hash", F.col("posterior").alias("label"))
    sample = stored(texts.select("text", hash_of).join(F.broadcast(labelled), "text_hash").dropDuplicates(["text_hash"]).select("text", "label"))
    model = fit(sample, FEATURES)

    @F.arrow_udf("struct<votes:string,posterior:double>")
    def judged_votes(column: pa.Array) -> pa.Array:
        said = signs(column.cast(pa.string()), function_words)
        return pa.StructArray.from_arrays([pa.array(said, pa.string()), pa.array([table[s] for s in said], pa.float64())], ["votes", "posterior"])

    out = texts.select("doc_id", judged_votes("text").alias("v"), score_column(F.col("text"), FEATURES, model).alias("score"))
    return out.select("doc_id", "v.votes", "v.posterior", "score", (F.col("score") >= KEPT).alias("kept"))
