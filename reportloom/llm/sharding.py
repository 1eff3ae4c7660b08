"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Rows of equal text are a group. Large groups are placed one by one, largest first, and stay whole as long as some shard
has room for them; only those that fit no shard are cut into pieces by a hash of their rows. Small groups are gathered into
batches by a hash of their text, which fill the rest. Large groups, pieces and batches are units; there are at most a
fixed number of them, whatever the input. The driver places units on the shard whose residual capacity has the largest dot
product with the unit's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from reportloom.llm.ranks import ranked
from reportloom.llm.words import SPACED, slices, split_words
from reportloom.llm.store import stored

BATCHES = 4096  # of small groups
PIECE_SHARE = 4096  # a larger part of the table makes a group large; pieces have this part at most, so there are at most twice as many
SLACK = 0.02  # of a shard's capacity that large groups leave free, so that batches can even out the measures
MEASURES = ("size", "tokens", "rows")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text, size (UTF-8 bytes and 1), tokens (words between white space), text_crc32."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.string())
            counts = [split_words(texts.slice(a, b - a), SPACED).counts for a, b in slices(texts)]
            yield pa.record_batch([*batch.columns[:1], *batch.columns[2:], pa.array(np.concatenate([np.empty(0, np.int64), *counts]))],
                                  ["doc_id", "digest", "size", "text_crc32", "tokens"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.md5(text).alias("digest"),
                       (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")).mapInArrow(
        count, "doc_id long, digest string, size long, text_crc32 long, tokens long")


def place_whole(groups: np.ndarray, sums: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """A shard for each large group, -1 if none has room for all of it in every measure, and what the shards have left."""
    share = groups / np.maximum(sums, 1)
    residual = np.full((shards, len(sums)), 1 / shards)
    out = np.full(len(groups), -1, np.int32)
    for i in np.lexsort((np.arange(len(groups)), -share.sum(axis=1))):
        room = np.flatnonzero((residual - SLACK / shards >= share[i]).all(axis=1))
        if len(room):
            out[i] = shard = int(room[np.argmax(residual[room] @ share[i])])
            residual[shard] -= share[i]
    return out, residual


def place(units: np.ndarray, shards: int, sums: np.ndarray | None = None, residual: np.ndarray | None = None) -> np.ndarray:
    """A shard for each unit, a row of measures. Ties go to the first shard.

    Capacities are equal parts of the sums, less what is placed already. Measures are taken as shares of them, so none
    counts by its unit of measure.
    """
    share = units / np.maximum(units.sum(axis=0) if sums is None else sums, 1)
    residual = np.full((shards, units.shape[1]), 1 / shards) if residual is None else residual.copy()
    out = np.zeros(len(units), np.int32)
    for i in np.lexsort((np.arange(len(units)), -share.sum(axis=1))):
        out[i] = shard = int(np.argmax(residual @ share[i]))
        residual[shard] -= share[i]
    return out


def assign(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Gives every row of documents a shard and a slot, gapless from 0 within the shard.

    Returns doc_id, size, tokens, text_crc32, group (digest of the text), unit, shard and slot. Null and empty texts are
    one group of size 1 a row. A group is on one shard unless none has room for it. Rows of equal ids or texts each get a slot. An empty table gives no rows. Shards may stay
    empty if there are fewer rows than shards. Other columns are left out.
    """
    rows = stored(measured(docs).withColumn("key", F.monotonically_increasing_id()))
    sums = rows.agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")).first()
    share = F.greatest(*(F.ceil(F.col(m) * PIECE_SHARE / max(sums[m] or 1, 1)) for m in MEASURES))
    measures = [F.sum(m).alias(m) if m != "rows" else F.count(F.lit(1)).alias(m) for m in MEASURES]
    total = np.array([float(sums[m] or 0) for m in MEASURES])
    matrix = lambda found: np.column_stack([found.column(m).to_numpy().astype(float) for m in MEASURES])
    groups = rows.groupBy("digest").agg(*measures).withColumn("pieces", F.least(share, F.col("rows")))
    # more than one part of the table in some measure, so there are at most three times PIECE_SHARE; a lone row is a batch's
    large = groups.filter("pieces > 1").orderBy("digest").toArrow()
    whole, residual = place_whole(matrix(large), total, shards)
    pieces = np.where(whole < 0, large.column("pieces").to_numpy(), 1)
    cut = docs.sparkSession.createDataFrame(pa.table({"digest": large.column("digest"), "pieces": pa.array(pieces, pa.int64())}))
    name = F.when(F.col("pieces") == 1, F.col("digest")).otherwise(F.concat_ws("-", "digest", F.pmod(F.xxhash64("key"), "pieces")))
    piece = F.when(F.col("pieces").isNotNull(), name)
    batch = F.pmod(F.xxhash64("digest"), F.lit(BATCHES)).cast("string")
    dealt = rows.join(F.broadcast(cut), "digest", "left").withColumn("unit", F.coalesce(piece, batch)).drop("pieces")
    kept = pc.filter(large.column("digest"), pa.array(whole >= 0)).combine_chunks()
    found = dealt.groupBy("unit").agg(*measures).orderBy("unit").toArrow()  # pieces, batches and large groups, so of bounded length
    at = pc.fill_null(pc.index_in(found.column("unit"), value_set=kept), -1).to_numpy()
    shard = np.zeros(len(found), np.int32)
    shard[at >= 0] = whole[whole >= 0][at[at >= 0]]
    shard[at < 0] = place(matrix(found)[at < 0], shards, total, residual)
    names = found.column("unit").combine_chunks()

    @F.arrow_udf("int")
    def shard_of(unit: pa.Array) -> pa.Array:
        return pa.array(shard).take(pc.index_in(unit, value_set=names))

    placed = dealt.withColumn("shard", shard_of("unit"))
    return ranked(placed, "shard", "key", sums["rows"], "slot").select(
        "doc_id", "size", "tokens", "text_crc32", F.col("digest").alias("group"), "unit", "shard", F.col("slot").cast("long").alias("slot"))
