"""Linear scorers over hashed features of whole texts, fitted on a bounded sample."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

from reportloom.llm.words import Words, mixed, slices, split_words, text_slices, word_hashes

BITS = 20
FEATURES = 20_000  # kept of the hashed ones, those that tell the labels apart best
LEAST_Z = 4.0
SCORED_BYTES = 2 << 20  # text scored at once, so that a worker needs little memory whatever the batch; a longer text is a slice of its own
STEPS, RATE, DECAY = 300, 0.3, 5e-4


def hashed(values: pa.Array, kind: int) -> np.ndarray:
    """A place among 2**BITS for each word of a kind; -1 for empty ones."""
    salt = np.uint64(kind * 0x9E3779B97F4A7C15 % 2**64)
    places = (mixed(word_hashes(values) ^ salt) >> np.uint64(64 - BITS)).astype(np.int64)
    places[np.asarray(values.to_numpy(zero_copy_only=False) == "", bool)] = -1
    return places


class Features(NamedTuple):
    """How texts become features: the byte table that cuts words, places of each distinct word (kinds x words), and
    places that go by the whole text (kinds x texts). A feature counts once for each text."""

    table: np.ndarray
    of_words: Callable[[pa.Array], np.ndarray]
    of_texts: Callable[[Words], np.ndarray] | None = None


class Model(NamedTuple):
    places: np.ndarray  # ascending
    weights: np.ndarray
    bias: float


def present(texts: pa.Array, features: Features, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Texts and places, each pair once. With wanted (ascending), only those, as their number in it."""

    def chosen(places: np.ndarray) -> np.ndarray:
        if wanted is None:
            return places
        at = np.minimum(np.searchsorted(wanted, places), max(len(wanted) - 1, 0))
        return np.where(wanted[at] == places, at, -1) if len(wanted) else np.full(places.shape, -1)

    words = split_words(texts, features.table)
    rows = words.rows()
    pairs, width = [], 1 << BITS
    for places in chosen(features.of_words(words.values)) if len(words.values) else ():
        there = places[words.codes] >= 0
        pairs.append(rows[there] * width + places[words.codes[there]])
    if features.of_texts:
        for places in chosen(features.of_texts(words)):
            there = np.flatnonzero(places >= 0)
            pairs.append(there * width + places[there])
    both = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)
    return both // width, both % width


def scored(texts: pa.Array, features: Features, model: Model) -> np.ndarray:
    """Probabilities of label 1."""
    out = []
    for a, b in slices(texts, SCORED_BYTES):
        row, at = present(texts.slice(a, b - a), features, model.places)
        out.append(np.bincount(row, model.weights[at], b - a))
    z = np.concatenate(out) + model.bias if out else np.empty(0)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score_column(text: Column, features: Features, model: Model) -> Column:
    """A column of scores; other columns of the frame stay as they are. A null text is scored as an empty one."""
    sent = text_session().sparkContext.broadcast(model)

    @F.arrow_udf(DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(scored(texts.cast(pa.string()).fill_null(""), features, sent.value))

    return score(text)


def text_session():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()


def select_features(sample: DataFrame, features: Features) -> tuple[np.ndarray, np.ndarray]:
    """Places, and their smoothed log odds, out of a sample (text, label from 0 to 1): the most telling ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 << BITS))
        for batch in text_slices(batches):
            row, at = present(batch.column(0), features)
            label = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), float)[row]
            sums[1] += np.bincount(at, label, 1 << BITS)
            sums[0] += np.bincount(at, 1 - label, 1 << BITS)
        some = np.flatnonzero(sums.sum(axis=0))
        yield pa.record_batch([pa.array(some), pa.array(sums[1, some]), pa.array(sums[0, some])], ["place", "yes", "no"])

    found = sample.select("text", "label").mapInArrow(count, "place long, yes double, no double").groupBy("place").agg(
        F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    all_yes, rows = sample.agg(F.coalesce(F.sum("label"), F.lit(0.0)), F.count(F.lit(1))).first()
    share = min(max(all_yes / max(rows, 1), 1e-6), 1 - 1e-6)
    n = F.col("yes") + F.col("no")
    z = F.abs(F.col("yes") - n * share) / F.sqrt(n * share * (1 - share))
    top = found.filter(n >= 5).withColumn("z", z).filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "place").limit(FEATURES).toArrow()
    place, yes, no = (top.column(c).to_numpy() for c in ("place", "yes", "no"))
    order = np.argsort(place)
    odds = np.log((yes + 1) / (all_yes + 2)) - np.log((no + 1) / (rows - all_yes + 2))
    return place[order], odds[order]


def fit(sample: DataFrame, features: Features, always: np.ndarray | None = None, swaps: Callable[[np.ndarray], list] | None = None,
        penalty: float = 0.0) -> Model:
    """Logistic regression on a sample (text, label from 0 to 1), whose size the caller bounds.

    Features are scaled by their log odds. swaps gives, for the places kept, pairs of feature numbers that a text loses
    and gains with a change that should not matter; the squared change of the score is punished. always are places to
    keep whatever the labels say.
    """
    places, odds = select_features(sample, features)
    if always is not None and len(always):
        more = np.setdiff1d(always, places)
        order = np.argsort(np.concatenate((places, more)))
        places, odds = np.concatenate((places, more))[order], np.concatenate((odds, np.full(len(more), 1e-3)))[order]

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            row, at = present(batch.column(0), features, places)
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(at, pa.int32()))
            yield pa.record_batch([batch.column(1), lists], ["label", "at"])

    rows = sample.select("text", F.col("label").cast("double").alias("label")).mapInArrow(reduce, "label double, at array<int>").toArrow()
    label = rows.column("label").to_numpy()
    if not len(label):
        return Model(places, np.zeros(len(places)), 0.0)
    lists = rows.column("at").combine_chunks()
    at, row = lists.flatten().to_numpy(), np.repeat(np.arange(len(label)), np.diff(lists.offsets.to_numpy()))
    value = odds[at]
    pairs = swaps(places) if swaps else []
    pair_row = np.array([i for i, (a, b) in enumerate(pairs) for _ in (*a, *b)], np.int64)
    pair_at = np.array([j for a, b in pairs for j in (*a, *b)], np.int64)
    pair_sign = np.array([s for a, b in pairs for s in (*[1.0] * len(a), *[-1.0] * len(b))])
    w, share = np.ones(len(places)) * 0.1, min(max(label.mean(), 1e-6), 1 - 1e-6)
    bias, first, second = np.log(share / (1 - share)), np.zeros(len(places) + 1), np.zeros(len(places) + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(row, w[at] * value, len(label)) + bias
        off = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) / len(label)
        slope = np.append(np.bincount(at, off[row] * value, len(places)) + DECAY * w, off.sum())
        if len(pairs):
            change = np.bincount(pair_row, pair_sign * (w * odds)[pair_at], len(pairs))
            slope[:-1] += 2 * penalty / len(pairs) * np.bincount(pair_at, change[pair_row] * pair_sign * odds[pair_at], len(places))
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        move = RATE * (1 - step / (STEPS + 1)) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return Model(places, w * odds, float(bias))
