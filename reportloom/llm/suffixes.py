"""Passages that repeat across documents, byte by byte: a later copy goes, the first stays.

A string of LENGTH bytes counts as repeated if its longest previous factor is as long as itself: if, in suffix order, a
suffix with a smaller position shares that many bytes with it. Suffixes can only share them if they share the least gram
among those that the string holds, so runs of strings with one least gram are dealt by it. Runs of equal bytes are settled
by their positions. Those that differ are put into suffix order together, and the previous and next smaller positions of
each suffix tell whether it was there before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from reportloom.llm.store import stored
from reportloom.llm.words import mixed, slices

LENGTH = 100  # bytes that have to be there before
GRAM = 40  # bytes of a gram; a string holds LENGTH - GRAM + 1 of them
PLACE_BITS = np.uint64(24)  # of a gram's key: its place, so that of equal grams the first is the least
PLACES = np.uint64((1 << 24) - 1)
WINDOWS = 1 << 21  # strings looked at together
SLICE = 2 << 20  # bytes of text looked at together
TOGETHER = 8_000  # runs put into suffix order together, as far as their groups allow
BLOCK = 4_096  # runs of a larger group are put into suffix order in several blocks
BASE = 0x9E3779B97F4A7C15
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """64 bits of the gram that starts at each byte, those of two halves put together."""
    power = lambda n: np.uint64(pow(BASE, n, 1 << 64))
    part, size, whole, covered = BYTE_VALUES[data], 1, None, 0
    while True:
        if gram & size:
            if whole is None:
                whole, covered = part, size
            else:
                n = max(len(part) - covered, 0)
                whole, covered = whole[:n] * power(size) + part[covered:], covered + size
        if size * 2 > gram:
            return mixed(whole)
        part = part[:-size] * power(size) + part[size:]
        size *= 2


def least_places(hashes: np.ndarray, count: int) -> np.ndarray:
    """Of every count hashes in a row, the place of the least one."""
    key = (hashes & ~PLACES) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while width * 2 <= count:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < count:
        key = np.minimum(key[: len(key) - (count - width)], key[count - width :])
    return (key & PLACES).astype(np.int64)


def runs_of(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """``row, start, size, gram, content`` of runs of strings with one least gram; ends are the bounds of the texts in data."""
    for base in range(0, max(len(data) - length + 1, 0), WINDOWS):
        block = data[base : base + WINDOWS + length - 1]
        hashes = gram_hashes(block, gram)
        place = least_places(hashes, length - gram + 1)
        row = np.searchsorted(ends, np.arange(base, base + len(place)), "right") - 1
        start = np.flatnonzero(ends[row + 1] - base - np.arange(len(place)) >= length)
        place, row = place[start], row[start]
        if not len(start):
            continue
        first = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (row[1:] != row[:-1]))))
        size = np.diff(np.append(first, len(start)))
        at = start[first]
        view = memoryview(np.ascontiguousarray(block))
        content = np.array([xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(at.tolist(), (at + size + length - 1).tolist(), strict=True)], np.uint64)
        yield row[first], at + base - ends[row[first]], size, hashes[place[first]], content


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The batches by slices of text, with the bytes of the texts and their bounds."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index("text")).cast(pa.string()).fill_null("")
        for a, b in slices(texts, SLICE):
            yield batch.slice(a, b - a), *_flat(texts.slice(a, b - a))


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, key, text``: the key tells rows of one id apart by their texts."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", text).alias("key"), text.alias("text"))


RUN = "doc_id long, key long, start int, size int, gram long, content long"


def shared_runs(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The runs whose least gram is that of another run as well.

    A gram that comes several times in one slice of text is known to be shared. Only one of its runs is then dealt by the
    gram, as a witness for other slices; the rest is dealt evenly, so that a gram of a third of all documents makes no task
    larger than others.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, ends in _parts(batches):
            for row, start, size, least, content in runs_of(data, ends, length, gram):
                _, one, inverse, times = np.unique(least, return_index=True, return_inverse=True, return_counts=True)
                known = times[inverse] > 1
                spread = known.copy()
                spread[one] = False
                key = batch.column(1).take(pa.array(row))
                deal = np.where(spread, mixed(key.to_numpy().view(np.uint64) + mixed(least + start.astype(np.uint64))), least)
                yield pa.record_batch(
                    [batch.column(0).take(pa.array(row)), key, pa.array(start, pa.int32()), pa.array(size, pa.int32()), pa.array(least.view(np.int64)),
                     pa.array(content.view(np.int64)), pa.array(deal.view(np.int64)), pa.array(known)],
                    ["doc_id", "key", "start", "size", "gram", "content", "deal", "known"])

    cut_up = texts.mapInArrow(cut, RUN + ", deal long, known boolean")
    together = F.count(F.lit(1)).over(Window.partitionBy("deal"))
    return stored(cut_up.withColumn("n", together).filter("known OR n > 1").drop("deal", "known", "n"))


def place_of(start: str | Column) -> Column:
    """Positions in their order: by document, rows without an id last, then within the text."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(start).alias("start") if isinstance(start, str) else start)


def judged_runs(runs: DataFrame) -> DataFrame:
    """The runs, with later: whether one of equal bytes lies at an earlier position."""
    first = stored(runs.groupBy("gram", "content").agg(F.min(place_of("start")).alias("first")))  # a join of tables, so that hot keys can be split
    return stored(runs.join(first, ["gram", "content"]).select(*runs.columns, (place_of("start") > F.col("first")).alias("later")))


def suffix_ranks(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the strings of the given length at the given places; equal strings rank equal, others in suffix order.

    Ranks of twice the bytes come from pairs of ranks. data must reach length bytes beyond every place.
    """
    padded = np.concatenate((data, np.zeros(2 * length, np.uint8)))
    ranks, size = padded[: len(data) + length].astype(np.int64), 1
    while size < 8 and size * 2 <= length:
        ranks = np.append(ranks[:-size] << (8 * size) | ranks[size:], np.zeros(size, np.int64)) if size < 4 else _dense(ranks, size)
        size *= 2
    while size * 2 <= length:
        ranks = _dense(ranks, size)
        size *= 2
    pair = np.unique(ranks, return_inverse=True)[1].astype(np.int64)
    return np.unique(pair[at] * (len(pair) + 1) + pair[at + length - size], return_inverse=True)[1]


def _dense(ranks: np.ndarray, size: int) -> np.ndarray:
    values = np.unique(ranks, return_inverse=True)[1].astype(np.int64)
    return values * (len(values) + 1) + np.append(values[size:], np.zeros(size, np.int64))


def smaller_before(place: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For suffixes in suffix order: the nearest one before each that has a smaller place and is in its group, or -1."""
    near = np.arange(len(place)) - 1
    open_ = np.flatnonzero((near >= 0) & (group[near] == group))
    near[np.setdiff1d(np.arange(len(place)), open_, assume_unique=True)] = -1
    while len(open_):
        open_ = open_[place[near[open_]] >= place[open_]]
        near[open_] = near[near[open_]]  # what lies between is no smaller, so it can be passed over at once
        open_ = open_[near[open_] >= 0]
    return near


def earlier_factors(group: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Of suffixes with their groups (equal as far as the wanted length) and places: whether the longest previous factor reaches it."""
    order = np.argsort(group, kind="stable")
    place, group = place[order], group[order]
    before = smaller_before(place, group) >= 0
    behind = smaller_before(place[::-1], group[::-1])[::-1] >= 0
    found = np.empty(len(order), bool)
    found[order] = before | behind
    return found


def _groups(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Batches of at least so many rows that part no group (columns gram and block, sorted)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(x.num_rows for x in held) < least:
            continue
        rows = pa.concat_batches(held)
        gram, block = (rows.column(rows.schema.get_field_index(c)).to_numpy() for c in ("gram", "block"))
        cuts = np.flatnonzero((gram[1:] != gram[:-1]) | (block[1:] != block[:-1]))
        if len(cuts):
            yield rows.slice(0, cuts[-1] + 1)
            rows = rows.slice(cuts[-1] + 1)
        held = [rows]
    if held:
        yield pa.concat_batches(held)


STRING = "doc_id long, key long, start int, size int, gram long, high long, low long"


def compared_runs(runs: DataFrame, texts: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """Strings of runs that share their least gram and not their bytes: those that were there before (high is null), and of
    groups in several blocks those that were not there before in their own block, with 128 bits of each."""
    kept = runs.filter(~F.col("later"))
    groups = kept.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / block)
    chosen = kept.join(groups, "gram").withColumn("block", F.pmod(F.xxhash64("key", "start"), blocks)).withColumn("many", blocks > 1)
    wanted = chosen.groupBy("key", "doc_id").agg(F.collect_list(F.struct("start", "size", "gram", "block", "many")).alias("runs"))
    sides = texts.alias("t").join(wanted.alias("w"), (F.col("t.key") == F.col("w.key")) & F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")))
    found = sides.select("t.doc_id", "t.key", "t.text", "w.runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, ends in _parts(batches):
            lists = batch.column(3)
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            runs = lists.flatten()
            start, size = (runs.field(i).to_numpy().astype(np.int64) for i in (0, 1))
            at = ends[row] + start
            pieces = [data[a:b] for a, b in zip(at.tolist(), (at + size + length - 1).tolist(), strict=True)]
            offsets = np.concatenate(([0], np.cumsum(size + length - 1))).astype(np.int32)
            bytes_ = pa.BinaryArray.from_buffers(pa.binary(), len(pieces), [None, pa.py_buffer(offsets), pa.py_buffer(np.concatenate(pieces))])
            yield pa.record_batch([batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), *runs.flatten(), bytes_],
                                  ["doc_id", "key", "start", "size", "gram", "block", "many", "bytes"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches, TOGETHER):
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            number = lambda name: column[name].to_numpy(zero_copy_only=False).astype(np.int64)
            data, ends = _flat(column["bytes"])
            size, start = number("size"), number("start")
            run = np.repeat(np.arange(len(size)), size)
            within = np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)
            group = np.cumsum(np.concatenate(([0], np.diff(number("gram")) != 0)) | np.concatenate(([0], np.diff(number("block")) != 0)))
            ranks = suffix_ranks(data, ends[run] + within, length)
            alike = group[run] * (len(ranks) + 1) + ranks
            ids = column["doc_id"].fill_null(0).to_numpy().astype(np.int64)
            none = column["doc_id"].is_null().to_numpy(zero_copy_only=False)
            document = np.unique(ids, return_inverse=True)[1].astype(np.int64)
            document[none] = len(document)
            earlier = earlier_factors(alike, (document[run] << 32) + start[run] + within)
            first = np.flatnonzero(earlier & np.concatenate(([True], ~earlier[:-1] | (run[1:] != run[:-1]))))
            last = np.flatnonzero(earlier & np.concatenate((~earlier[1:] | (run[1:] != run[:-1]), [True])))
            open_ = np.flatnonzero(~earlier & number("many").astype(bool)[run])
            view = memoryview(data)
            digests = [xxhash.xxh3_128_digest(view[a : a + length]) for a in (ends[run[open_]] + within[open_]).tolist()]
            halves = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
            at = np.concatenate((first, open_))
            absent = pa.array(np.arange(len(at)) < len(first))
            high, low = (pa.array(np.concatenate((np.zeros(len(first), np.int64), halves[:, i])), mask=absent.to_numpy(zero_copy_only=False)) for i in (0, 1))
            rows = pa.array(run[at])
            yield pa.record_batch(
                [column["doc_id"].take(rows), column["key"].take(rows), pa.array(start[run[at]] + within[at], pa.int32()),
                 pa.array(np.concatenate((last - first + 1, np.ones(len(open_), np.int64))), pa.int32()), column["gram"].take(rows), high, low],
                ["doc_id", "key", "start", "size", "gram", "high", "low"])

    cuts = found.mapInArrow(cut, "doc_id long, key long, start int, size int, gram long, block long, many boolean, bytes binary")
    return stored(cuts.repartition("gram", "block").sortWithinPartitions("gram", "block").mapInArrow(compare, STRING))


def repeated_strings(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """``doc_id, key, start, size``: size strings in a row, from start on, that also start earlier."""
    runs = judged_runs(shared_runs(texts, length, gram))
    compared = compared_runs(runs, texts, length, block)
    apart = compared.filter("high IS NOT NULL")
    first = stored(apart.groupBy("gram", "high", "low").agg(F.min(place_of("start")).alias("first")))
    across = apart.join(first, ["gram", "high", "low"]).filter(place_of("start") > F.col("first"))
    columns = ["doc_id", "key", "start", "size"]
    return runs.filter("later").select(columns).unionByName(compared.filter("high IS NULL").select(columns)).unionByName(across.select(columns))


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """Each document without the bytes that any string of ``length`` bytes covers which also starts earlier.

    Returns a row per row of docs: doc_id, n_bytes, n_removed, spans (start and end of each removed run of bytes, in order) and
    kept (the bytes that are left). Earlier means a smaller doc_id, or an earlier place under the same id; rows without an id
    come last. Rows that share an id stand at the same place, so equal rows under one id all keep what they have. A null text
    is empty; a text below ``length`` bytes keeps everything; an empty table gives an empty result; other columns are left out.
    """
    if not 1 < gram < length:
        raise ValueError("a gram must be shorter than the strings")
    texts = keyed(docs)
    spans = repeated_strings(texts, length, gram, block).groupBy("key", "doc_id").agg(F.collect_list(F.struct("start", "size")).alias("strings"))
    both = texts.alias("t").join(spans.alias("s"), (F.col("t.key") == F.col("s.key")) & F.col("t.doc_id").eqNullSafe(F.col("s.doc_id")), "left")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, ends in _parts(batches):
            lists = batch.column(2)
            count = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(len(lists)), count)
            strings = lists.flatten()
            start, size = (strings.field(i).to_numpy().astype(np.int64) for i in (0, 1))
            change = np.zeros(len(data) + 1, np.int32)
            np.add.at(change, ends[row] + start, 1)
            np.add.at(change, ends[row] + start + size - 1 + length, -1)
            gone = np.cumsum(change[:-1]) > 0
            edge = np.zeros(len(data) + 1, bool)
            edge[ends[:-1]] = True
            opens = np.flatnonzero(gone & (np.concatenate(([True], ~gone[:-1])) | edge[:-1]))
            closes = np.flatnonzero(gone & (np.concatenate((~gone[1:], [True])) | edge[1:])) + 1
            of = np.searchsorted(ends, opens, "right") - 1
            left = np.concatenate(([0], np.cumsum(~gone)))[ends].astype(np.int32)
            spans = pa.StructArray.from_arrays([pa.array(opens - ends[of], pa.int32()), pa.array(closes - ends[of], pa.int32())], ["start", "end"])
            bounds = pa.array(np.searchsorted(of, np.arange(len(ends))), pa.int32())
            kept = pa.BinaryArray.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(left), pa.py_buffer(data[~gone])])
            n_bytes = np.diff(ends)
            yield pa.record_batch([batch.column(0), pa.array(n_bytes), pa.array(n_bytes - np.diff(left)), pa.ListArray.from_arrays(bounds, spans), kept],
                                  ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    empty = F.array().cast("array<struct<start:int,size:int>>")
    return (both.select("t.doc_id", "t.text", F.coalesce("s.strings", empty).alias("strings"))
            .mapInArrow(keep, "doc_id long, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, kept binary"))
