"""Benchmark decontamination: a prefix-filtered join of benchmark windows with document words.

A window occurs in a document only if all its words do, so the prefix that must be shared is one word: the window's
rarest, by the number of documents that hold it. Places of that word give the possible starts of the window; length
and position bounds drop those that would stick out of the document; the rest are compared word by word.

The benchmark side is cut into blocks of a bounded size. One block, the usual case, is a pass over the documents; with
more, each block is a pass and the results of equal texts are merged by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from reportloom.llm.words import ALPHANUMERIC, Words, list_array, split_words, text_slices

WINDOW = 13
BLOCK_BYTES = 8 << 20  # of benchmark text held in each task at once
RESULT = "n_words long, starts array<int>, ends array<int>, items array<string>"


class Index(NamedTuple):
    """Distinct windows of a block, in order of the word they are looked up by."""

    vocabulary: pa.Array
    words: np.ndarray  # windows x WINDOW: places in the vocabulary, -1 beyond a shorter window
    lengths: np.ndarray
    offsets: np.ndarray  # of the looked-up word in its window
    first: np.ndarray  # windows looked up by vocabulary word v are first[v] to first[v + 1]
    item_bounds: np.ndarray  # the items of window i are item_ids[item_bounds[i]:item_bounds[i + 1]]
    item_ids: np.ndarray


def windows(item_ids: list[str], texts: pa.Array, window: int) -> tuple[pa.Array, dict[tuple[int, ...], set[str]]]:
    words = split_words(texts, ALPHANUMERIC)
    found: dict[tuple[int, ...], set[str]] = {}
    for item, a, b in zip(item_ids, words.bounds[:-1], words.bounds[1:], strict=True):
        codes = words.codes[a:b].tolist()
        for i in range(max(len(codes) - window + 1, min(len(codes), 1))):
            found.setdefault(tuple(codes[i : i + window]), set()).add(item)
    return words.values, found


def build_index(vocabulary: pa.Array, found: dict[tuple[int, ...], set[str]], frequency: np.ndarray, window: int) -> Index:
    keys = list(found)
    words = np.full((len(keys), window), -1, np.int64)
    for i, key in enumerate(keys):
        words[i, : len(key)] = key
    lengths = np.array([len(k) for k in keys], np.int64)
    # rarest first; ties by place in the vocabulary, so that equal windows always use the same word
    order = np.empty(len(vocabulary), np.int64)
    order[np.lexsort((np.arange(len(vocabulary)), frequency))] = np.arange(len(vocabulary))
    ranks = np.where(words >= 0, order[words] if len(order) else words, np.iinfo(np.int64).max)
    offsets = ranks.argmin(axis=1) if len(keys) else np.empty(0, np.int64)
    looked_up = words[np.arange(len(keys)), offsets]
    by_word = np.argsort(looked_up, kind="stable")
    items = [sorted(found[keys[i]]) for i in by_word]
    return Index(vocabulary, words[by_word], lengths[by_word], offsets[by_word],
                 np.searchsorted(looked_up[by_word], np.arange(len(vocabulary) + 1)),
                 np.concatenate(([0], np.cumsum([len(x) for x in items]))).astype(np.int64),
                 np.array([x for some in items for x in some], object))


def in_vocabulary(words: Words, vocabulary: pa.Array) -> np.ndarray:
    """Each word's place in the vocabulary, -1 if it has none."""
    known = pc.fill_null(pc.index_in(words.values, value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
    return known[words.codes].astype(np.int64) if len(known) else np.empty(0, np.int64)


def spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... counts[i] times for each i."""
    ends = np.cumsum(counts)
    return np.repeat(first - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def occurrences(words: Words, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word (counted over all rows) and window of each occurrence."""
    ids = in_vocabulary(words, index.vocabulary)
    at = np.flatnonzero(ids >= 0)
    counts = index.first[ids[at] + 1] - index.first[ids[at]]
    at, counts = at[counts > 0], counts[counts > 0]
    window = spread(index.first[ids[at]], counts)
    row = np.repeat(np.searchsorted(words.bounds, at, "right") - 1, counts)
    start = np.repeat(at, counts) - index.offsets[window]
    inside = (start >= words.bounds[row]) & (start + index.lengths[window] <= words.bounds[row + 1])
    row, start, window = row[inside], start[inside], window[inside]
    for k in range(index.words.shape[1]):
        expected = index.words[window, k]
        same = (expected < 0) | (ids[np.minimum(start + k, len(ids) - 1)] == expected)
        row, start, window = row[same], start[same], window[same]
    return row, start, window


def merged_spans(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of spans that touch or overlap, by row. Spans of different rows never touch."""
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    if not len(row):
        return row, start, end
    reach = np.maximum.accumulate(end)  # rows ascend, and with them all places
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (start[1:] > reach[:-1])))
    heads = np.flatnonzero(new)
    return row[heads], start[heads], np.maximum.reduceat(end, heads)


def scanned(batch: pa.RecordBatch, index: Index) -> list[pa.Array]:
    words = split_words(batch.column(batch.schema.get_field_index("text")), ALPHANUMERIC)
    n = len(words.bounds) - 1
    row, start, window = occurrences(words, index)
    span_row, a, b = merged_spans(row, start, start + index.lengths[window])
    base = words.bounds[span_row]
    spans = np.bincount(span_row, minlength=n)
    counts = index.item_bounds[window + 1] - index.item_bounds[window]
    items: list[list[str]] = [[] for _ in range(n)]
    pairs = {(r, index.item_ids[i]) for r, i in zip(np.repeat(row, counts).tolist(), spread(index.item_bounds[window], counts).tolist(), strict=True)}
    for r, item in sorted(pairs):
        items[r].append(item)
    return [pa.array(words.counts, pa.int64()), list_array(a - base, spans, pa.int32()), list_array(b - base, spans, pa.int32()),
            pa.array(items, pa.list_(pa.string()))]


def document_frequency(docs: DataFrame, vocabulary: pa.Array) -> np.ndarray:
    """In how many rows each word of the vocabulary stands."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in text_slices(batches):
            words = split_words(batch.column(0), ALPHANUMERIC)
            known = pc.fill_null(pc.index_in(words.values, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            pairs = np.unique(words.rows() * len(words.values) + words.codes)
            ids = known[pairs % max(len(words.values), 1)] if len(pairs) else pairs
            total += np.bincount(ids[ids >= 0], minlength=len(vocabulary))
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], ["word", "n"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "word long, n long")
    out = np.zeros(len(vocabulary), np.int64)
    for r in found.groupBy("word").agg(F.sum("n").alias("n")).collect():  # no longer than the block's vocabulary
        out[r["word"]] = r["n"]
    return out


def text_key() -> Column:
    """Of a row of documents, the digest that rows of one text share; null and empty texts are one."""
    return F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each row of documents, the word spans that repeat a benchmark window and the items they come from.

    Returns doc_id, n_words, n_hit, spans (from, to; to excluded), items and contaminated: at least one word in twenty
    is inside a window. Items without an id are left out; null texts have no words; an item of fewer words than the
    window is one window; equal items all count; rows of equal ids or texts are each judged; without rows on either side
    nothing is contaminated. Other columns are left out.
    """
    return judged(docs, benchmark, window, block_bytes).drop("digest")


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """digest: the text_key of each contaminated text, once."""
    return judged(docs, benchmark, window, block_bytes).filter("contaminated").select("digest").distinct()


def judged(docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int) -> DataFrame:
    """The columns of contamination, and digest, the text_key."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).dropna()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))

    def passed(block: int, source: DataFrame, *keys: str) -> DataFrame:
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toArrow()  # a block is bounded
        vocabulary, found = windows(part.column("item_id").to_pylist(), part.column("text").combine_chunks(), window)
        index = spark.sparkContext.broadcast(build_index(vocabulary, found, document_frequency(texts, vocabulary), window))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches):
                yield pa.record_batch([*batch.columns[: len(keys)], *scanned(batch, index.value)], [*keys, "n_words", "starts", "ends", "items"])

        return source.select(*keys, "text").mapInArrow(scan, ", ".join([*(f"{k} {dict(source.dtypes)[k]}" for k in keys), RESULT]))

    if blocks == 1:
        result = passed(0, texts.withColumn("digest", text_key()), "doc_id", "digest").withColumn("spans", F.arrays_zip(F.col("starts").alias("from"), F.col("ends").alias("to")))
    else:
        distinct = texts.select(text_key().alias("digest"), "text").dropDuplicates(["digest"])
        parts = passed(0, distinct, "digest")
        for block in range(1, blocks):
            parts = parts.unionByName(passed(block, distinct, "digest"))
        spans = F.array_sort(F.flatten(F.collect_list(F.arrays_zip(F.col("starts").alias("from"), F.col("ends").alias("to")))))
        joined = F.aggregate(spans, F.array().cast("array<struct<from:int,to:int>>"), lambda a, s: F.when(
            (F.size(a) > 0) & (F.element_at(a, -1)["to"] >= s["from"]),
            F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(F.element_at(a, -1)["from"].alias("from"), F.greatest(F.element_at(a, -1)["to"], s["to"]).alias("to"))))
        ).otherwise(F.concat(a, F.array(s))))
        by_text = parts.groupBy("digest").agg(F.first("n_words").alias("n_words"), joined.alias("spans"),
                                              F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        result = texts.select("doc_id", text_key().alias("digest")).join(by_text, "digest")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    return result.select("doc_id", "digest", "n_words", hit.alias("n_hit"), "spans", "items").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
