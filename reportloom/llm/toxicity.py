"""Toxicity: a linear classifier whose score should not change when an identity term is swapped for another.

Labelled sentences that mention a group are written again with the other terms of the same kind, and the squared change
of the score is part of the loss. Features are the presence of words and of their beginnings, so that inflected forms
of a stem count together.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from reportloom.llm.linear import Features, Model, fit, hashed, present, score_column
from reportloom.llm.store import stored
from reportloom.llm.words import ALPHANUMERIC, text_slices

TRAIN_ROWS = 20_000  # labelled rows that are fitted on, chosen by a hash of their id
PENALTY = 10.0
THRESHOLD = 0.7
BEGINNINGS = (4, 5, 6)
#: Terms that name groups of people, by kind. A caller may give others.
IDENTITY = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "african", "european", "american", "latino", "arab"),
    ("woman", "man", "transgender", "nonbinary"), ("women", "men"), ("gay", "lesbian", "bisexual", "straight"),
    ("immigrant", "refugee", "foreigner"), ("immigrants", "refugees", "foreigners"), ("blind", "deaf", "disabled"),
    ("musulman", "chrétien", "juif", "hindou", "bouddhiste"), ("femme", "homme"), ("femmes", "hommes"), ("noir", "blanc", "arabe", "asiatique"),
    ("moslem", "christ", "jude", "buddhist"), ("frau", "mann"), ("frauen", "männer"), ("ausländer", "flüchtling", "einwanderer"),
    ("musulmán", "cristiano", "judío", "budista"), ("mujer", "hombre"), ("mujeres", "hombres"), ("negro", "blanco", "árabe", "asiático"),
)
SENTENCE = re.compile(r"[.!?\n]+")


def beginnings(values: pa.Array) -> np.ndarray:
    longer = [pc.if_else(pc.greater(pc.utf8_length(values), n), pc.utf8_slice_codeunits(values, 0, n), "") for n in BEGINNINGS]
    return np.stack([hashed(values, 0), *(hashed(x, n) for n, x in zip(BEGINNINGS, longer, strict=True))])


FEATURES = Features(ALPHANUMERIC, beginnings)


def swapped_sentences(text: str, kinds: dict[str, tuple[str, ...]]) -> Iterator[tuple[str, str]]:
    """Each sentence with a group's term, and it with each other term of the kind."""
    for sentence in SENTENCE.split(text.lower()):
        for term in kinds.keys() & set(re.findall(r"\w+", sentence)):
            for other in kinds[term]:
                if other != term:
                    yield sentence, re.sub(rf"\b{re.escape(term)}\b", other, sentence)


def swap_pairs(sample: DataFrame, identity: tuple[tuple[str, ...], ...], places: np.ndarray) -> list[tuple[list[int], list[int]]]:
    """Kept features that sentences of the sample lose and gain by a swap, a pair for each time it happens."""
    kinds = {term: kind for kind in identity for term in kind}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in text_slices(batches):
            both = [x for text in batch.column(0).to_pylist() for pair in swapped_sentences(text or "", kinds) for x in pair]
            row, at = present(pa.array(both, pa.string()), FEATURES, places)
            bounds = np.searchsorted(row, np.arange(len(both) + 1))
            for i in range(0, len(both), 2):
                old, new = (set(at[bounds[j] : bounds[j + 1]].tolist()) for j in (i, i + 1))
                found[tuple(sorted(old - new)), tuple(sorted(new - old))] += 1
        yield pa.record_batch([pa.array([list(k[i]) for k in found], pa.list_(pa.int32())) for i in (0, 1)] + [pa.array(list(found.values()), pa.int64())],
                              ["lost", "gained", "n"])

    rows = sample.select("text").mapInArrow(find, "lost array<int>, gained array<int>, n long")
    return [(r["lost"], r["gained"]) for r in rows.groupBy("lost", "gained").agg(F.sum("n").alias("n")).collect()]


def train(docs: DataFrame, labels: DataFrame, identity: tuple[tuple[str, ...], ...] = IDENTITY, rows: int = TRAIN_ROWS,
          penalty: float = PENALTY) -> Model:
    """Fits on at most so many labelled rows of ids that are not held out. Ids labelled twice count as toxic if one label says so."""
    held_in = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("double").alias("label")).dropna().filter(held_in)
              .groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sample = stored(texts.join(F.broadcast(chosen), "doc_id").select("text", "label"))  # two numbers for each of at most so many rows
    terms = [t for kind in identity for t in kind]
    always = np.unique(beginnings(pa.array(terms))) if terms else np.empty(0, np.int64)
    return fit(sample, FEATURES, always[always >= 0], lambda places: swap_pairs(sample, identity, places), penalty)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from the threshold on) of each row of documents.

    Null and empty texts get the score of no feature. Rows of one id are each scored. A missing id is not held out. The
    score depends on the text alone. An empty table gives no rows; without labelled rows every score is one half.
    """
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score_column(F.col("text").cast("string"), FEATURES, model).alias("score"))
    out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    return scored.select("doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of documents, as they are, that score below the threshold."""
    name = "score_" + "_".join(docs.columns)[:64]
    return docs.withColumn(name, score_column(F.col("text").cast("string"), FEATURES, model)).filter(F.col(name) < THRESHOLD).drop(name)
