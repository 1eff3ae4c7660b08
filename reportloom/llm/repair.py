"""Repair of the order of turns: the cheapest edits that make a conversation one of a system turn, if any, and pairs of a
user's and an assistant's turn.

Each conversation is searched depth first with branch and bound. Its rows come to the search as one code each; texts only
pass by in order, so a long conversation needs no more memory than its codes.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from reportloom.llm.store import stored

# Prices of the edits, whose initials are the letters of an audit.
DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
PRICE = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
UNFINISHED = 3  # for each truncated row that stays

# How a repaired conversation has ended so far; it may end for good at the start and after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # whom an inserted row or one with another role has to be
ROLE = {USER: "user", ASSISTANT: "assistant"}
FORBIDDEN = 1 << 40

# A row's code: its role's initial times 4, and how sound it is.
INITIALS = "sua"
SOUND, TRUNCATED, DROPPED = range(3)
BLANK, DUPLICATE, CUT = 1, 2, 3
SPACES = r"\x20\x09-\x0D"
CACHED = 100_000


def edits(code: int, state: int) -> Iterator[tuple[str, int, int]]:
    """What can be done with a row: the edit, its price and the state after it."""
    initial, sound = divmod(code, 4)
    yield DELETE, PRICE[DELETE], state
    if sound == DROPPED:
        return
    extra = UNFINISHED if sound == TRUNCATED else 0
    if initial < len(INITIALS) and (initial == NEXT[state] - USER + 1 or initial == 0 and state == START):
        yield KEEP, PRICE[KEEP] + extra, (SYSTEM, USER, ASSISTANT)[initial]
    yield REROLE, PRICE[REROLE] + extra, NEXT[state]


def suffix_bounds(codes: bytes) -> list[array]:
    """For each row and state the price that the rest has at least: its cheapest edits, whatever their order says."""
    low = [array("q", (0, 2 * PRICE[INSERT], PRICE[INSERT], 0))]
    for code in reversed(codes):
        after = low[-1]
        base = [min(price + after[to] for _, price, to in edits(code, state)) for state in range(4)]
        user, assistant = min(base[USER], base[ASSISTANT] + PRICE[INSERT]), min(base[ASSISTANT], base[USER] + PRICE[INSERT])
        low.append(array("q", (min(base[START], user + PRICE[INSERT]), min(base[SYSTEM], user + PRICE[INSERT]), user, assistant)))
    low.reverse()
    return low


def no_bounds(codes: bytes) -> list[array]:
    """Only what no repair can avoid: rows that have to go, and truncated ones that go or stay."""
    forced = [(0, UNFINISHED, PRICE[DELETE])[code % 4] for code in codes]
    return [array("q", [sum(forced[i:])] * 4) for i in range(len(codes) + 1)]


def _letters(path) -> str:
    out = []
    while path is not None:
        path, letter = path
        out.append(letter)
    return "".join(reversed(out))


def search(codes: bytes, bounds: Callable[[bytes], list[array]] = suffix_bounds) -> tuple[int, str]:
    """The cheapest repair and of equally cheap ones the one whose audit comes first.

    An explicit stack goes down the most promising edit first. A prefix is given up if its price and the bound of the rest
    exceed the incumbent's price, if they equal it and its letters are behind the incumbent's, or if a prefix that reached
    the same row and state was cheaper, or as cheap with earlier letters. What is left when the stack is empty is optimal.
    """
    low = bounds(codes)
    best, audit, agreed = FORBIDDEN, "", 0  # the first agreed letters of trail are those of audit
    reached: dict[tuple[int, int], tuple[int, object]] = {}
    trail: list[str] = []
    stack = [(0, START, 0, 0, None)]
    while stack:
        row, state, price, depth, path = stack.pop()
        if depth:
            del trail[depth - 1 :]
            trail.append(path[1])
            agreed = min(agreed, depth - 1)
            agreed += agreed == depth - 1 and agreed < len(audit) and audit[agreed] == trail[agreed]
        bound = price + low[row][state]
        if bound > best or bound == best and agreed < depth and agreed < len(audit) and trail[agreed] > audit[agreed]:
            continue
        before = reached.get((row, state))
        if before is not None and (before[0] < price or before[0] == price and _letters(before[1]) <= "".join(trail)):
            continue
        reached[row, state] = price, path
        if row == len(codes) and state in (START, ASSISTANT):
            if price < best or "".join(trail) < audit:
                best, audit, agreed = price, "".join(trail), depth
            continue
        ways = [(INSERT, PRICE[INSERT], row, NEXT[state])]
        if row < len(codes):
            ways += [(letter, cost, row + 1, to) for letter, cost, to in edits(codes[row], state)]
        ways = sorted(((price + cost + low[at][to], letter, at, to, price + cost) for letter, cost, at, to in ways), reverse=True)
        stack += [(at, to, cost, depth + 1, (path, letter)) for _, letter, at, to, cost in ways]
    return best, audit


def faulty_rows(rows: DataFrame) -> DataFrame:
    """Adds fault (0 none, 1 blank, 2 seen before, 3 truncated), digest and initial to ``conv_id, turn, role, text``.

    Rows of a conversation are in order of turn, those without one first, then of role and digest.
    """
    marked = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                         F.coalesce("text", F.lit(" ")).alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy(F.asc_nulls_first("turn"))) > 1
    narrow = marked.select("conv_id", "turn", "role", "digest", F.left("role", F.lit(1)).alias("initial"),
                           F.when(F.col("text").rlike(f"[^{SPACES}]"), F.when(F.col("text").rlike(rf"[.!?][{SPACES}]*\z"), 0).otherwise(CUT))
                           .otherwise(BLANK).cast("int").alias("own"))
    fault = F.when(F.col("own") == BLANK, BLANK).when(F.col("seen"), DUPLICATE).otherwise(F.col("own"))
    return narrow.withColumn("seen", seen).withColumn("fault", fault.cast("int"))


def _in_order(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions(*[F.asc_nulls_first(c) for c in ("conv_id", *order)])


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[object, int, int]]:
    """Conversations of a batch and the bounds of their rows."""
    ids = batch.column(0)
    values, none = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero((values[1:] != values[:-1]) | (none[1:] != none[:-1])) + 1).tolist(), len(values)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield ids[a].as_py(), a, b


PLAN = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
LEGAL = {"su", "ua", "au"}


class _Facts:
    """What is known of a conversation after some of its rows."""

    def __init__(self, conv_id):
        self.conv_id, self.codes, self.counts, self.illegal = conv_id, bytearray(), [0, 0, 0, 0], 0
        self.last, self.low, self.high, self.turns = None, None, None, 0

    def add(self, turns: list, initials: list, faults: list) -> None:
        for turn, initial, fault in zip(turns, initials, faults, strict=True):
            self.counts[fault] += 1
            self.illegal += self.last is not None and self.last + initial not in LEGAL
            self.last = initial
            if turn is not None and turn != self.high:
                self.turns, self.high = self.turns + 1, turn
                self.low = turn if self.low is None else self.low
            place = INITIALS.find(initial) if initial else -1
            self.codes.append(4 * (place if place >= 0 else len(INITIALS)) + (SOUND, DROPPED, DROPPED, TRUNCATED)[fault])


def plans(rows: DataFrame) -> DataFrame:
    """A row per conversation of ``conv_id, turn, role, text``: its gaps and faults, and the price and audit of its repair.

    A missing role or text is one blank. A role is known by its first character; one that is none of s, u and a cannot be
    kept. Rows without a conv_id are one conversation.
    """
    narrow = _in_order(faulty_rows(rows).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "digest", "initial", "fault"),
                       "turn", "role", "digest").select("conv_id", "turn", "initial", "fault")

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(CACHED)(search)
        facts: _Facts | None = None

        def told(some: list[_Facts]) -> pa.RecordBatch:
            out = [[] for _ in range(8)]
            for f in some:
                gaps = f.high - f.low + 1 - f.turns if f.turns else 0
                codes = bytes(f.codes)
                found = known(codes) if len(codes) < 100 else search(codes)
                for column, value in zip(out, (f.conv_id, gaps, *f.counts[1:], f.illegal, *found), strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 7 + [pa.string()]
            return pa.record_batch([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], [c.split()[0] for c in PLAN.split(", ")])

        for batch in batches:
            done, columns = [], [batch.column(i).to_pylist() for i in (1, 2, 3)]
            for conv_id, a, b in _runs(batch):
                if facts is not None and facts.conv_id != conv_id:
                    done.append(facts)
                    facts = None
                facts = facts or _Facts(conv_id)
                facts.add(*[c[a:b] for c in columns])
            if done:
                yield told(done)
        if facts is not None:
            yield told([facts])

    return narrow.mapInArrow(plan, PLAN)


class _Walk:
    """Follows an audit along the rows of its conversation."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == INSERT:
            self.state, self.at = NEXT[self.state], self.at + 1
            yield ROLE[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter == KEEP:
            self.state = (SYSTEM, USER, ASSISTANT)[INITIALS.index(role[0])]
            yield role, text
        elif letter == REROLE:
            self.state = NEXT[self.state]
            yield ROLE[self.state], text


def _walked(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Audits and rows of each conversation, the audit first, the rows in order: conv_id, audit, role, text."""
    text = F.coalesce("text", F.lit(" "))
    body = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.lit(1).alias("head"), F.lit(None).cast("string").alias("audit"),
                       F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                       F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    none = {"turn": "long", "role": "string", "digest": "binary", "text": "string"}
    heads = planned.select("conv_id", F.lit(0).alias("head"), "audit", *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    return _in_order(heads.unionByName(body), "head", "turn", "role", "digest").select("conv_id", "audit", "role", "text")


def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str | None, str | None]]:
    """Repaired rows of conversation after conversation. One without role ends a conversation."""
    walk, current = None, None
    for batch in batches:
        audits, roles, texts = (batch.column(i) for i in (1, 2, 3))
        for conv_id, a, b in _runs(batch):
            for i in range(a, b):
                if (audit := audits[i].as_py()) is not None:
                    if walk is not None:
                        yield from ((current, *x) for x in walk.inserted())
                        yield current, None, None
                    walk, current = _Walk(audit), conv_id
                else:
                    yield from ((conv_id, *x) for x in walk.row(roles[i].as_py(), texts[i].as_py()))
    if walk is not None:
        yield from ((current, *x) for x in walk.inserted())
        yield current, None, None


def repaired(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``conv_id, place, role, text`` of the repaired conversations, places from 0."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, place = [], 0
        for conv_id, role, text in _repairs(batches):
            if role is None:
                place = 0
            else:
                out.append((conv_id, place, role, text))
                place += 1
            if len(out) >= 1000:
                yield _batch(out)
                out = []
        yield _batch(out)

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv_id", "place", "role", "text"])

    return _walked(rows, planned).mapInArrow(walk, "conv_id long, place long, role string, text string")


def digests(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: of ``role:text`` of each conversation's repaired rows, joined by line feeds.

    The digest is carried along the rows as they come in order, so no conversation is held as a whole.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, found, sha, some = [], [], hashlib.sha256(), False
        for conv_id, role, text in _repairs(batches):
            if role is not None:
                sha.update((b"\n" if some else b"") + role.encode() + b":" + text.encode())
                some = True
                continue
            ids.append(conv_id)
            found.append(sha.hexdigest())
            sha, some = hashlib.sha256(), False
            if len(ids) >= 10_000:
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(found, pa.string())], ["conv_id", "repaired_sha256"])
                ids, found = [], []
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(found, pa.string())], ["conv_id", "repaired_sha256"])

    return _walked(rows, planned).mapInArrow(walk, "conv_id long, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """A repeatable damage for trials: by the checksum of ``conv_id:turn``, rows go, lose their text or their ends of
    sentences, come twice or get the user's role. Missing values count as one blank."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    x = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    text = F.when(F.col("x") == 1, "").when(F.col("x") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("x") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (rows.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), x.alias("x")).filter("x != 0")
            .select("conv_id", "turn", F.when(F.col("x") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy"))
            .drop("copy"))


def repair_report(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """For each distinct conv_id of ids, the plan and the digest of the conversation in rows; without rows, zeros, an empty
    audit and the digest of nothing. Other columns are left out; no ids give no rows."""
    planned = stored(plans(rows))
    found = planned.withColumnRenamed("conv_id", "of").join(digests(rows, planned).withColumnRenamed("conv_id", "at"), F.col("of").eqNullSafe(F.col("at")))
    known = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    # a plan is never without a digest, which is how a conversation without an id is told from one without rows
    return known.join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id", *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
