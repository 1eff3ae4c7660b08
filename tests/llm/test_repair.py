"""Conversation repair against every possible repair, and the whole query against plain Python."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from reportloom.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"


def every_repair(codes):
    """The best of all audits with at most two insertions in a row."""
    best = None

    def go(i, state, cost, audit, inserted):
        nonlocal best
        if best and cost > best[0]:
            return
        if i == len(codes) and state in (repair.START, repair.ASSISTANT) and (best is None or (cost, audit) < best):
            best = (cost, audit)
        if inserted < 3:
            go(i, repair.NEXT[state], cost + 3, audit + "I", inserted + 1)
        if i < len(codes):
            initial, sound = divmod(codes[i], 4)
            go(i + 1, state, cost + 4, audit + "D", 0)
            if sound != repair.DROPPED:
                extra = 3 if sound == repair.TRUNCATED else 0
                if (state, initial) in {(0, 0), (0, 1), (1, 1), (2, 2), (3, 1)}:
                    go(i + 1, initial + 1, cost + extra, audit + "K", 0)
                go(i + 1, repair.NEXT[state], cost + 3 + extra, audit + "R", 0)

    go(0, repair.START, 0, "", 0)
    return best


@pytest.mark.parametrize("bounds", [repair.suffix_bounds, repair.no_bounds])
def test_the_search_finds_the_best_repair(bounds):
    rng = random.Random(1)
    for _ in range(1500):
        codes = bytes(rng.choice([0, 1, 2, 4, 5, 6, 8, 9, 10, 12, 13, 14, 4, 8, 4, 8]) for _ in range(rng.randrange(7)))
        assert repair.search(codes, bounds) == every_repair(codes)


def test_a_long_conversation_is_settled_soon():
    codes = bytes(random.Random(2).choice([4, 8, 4, 8, 5, 9, 6, 10, 0]) for _ in range(20_000))
    cost, audit = repair.search(codes)
    assert cost == repair.suffix_bounds(codes)[0][repair.START] and len(audit) - audit.count("I") == len(codes)


def plain(rows):
    """The query's result by dynamic programming over (cost, audit), in plain Python."""
    text_of = lambda x: " " if x is None else str(x)
    chats, out = {}, []
    for conv, turn, role, text in rows:
        chats.setdefault(conv, [])
        x = zlib.crc32(f"{text_of(conv)}:{text_of(turn)}".encode()) % 20
        role, text = text_of(role), text_of(text)
        text = "" if x == 1 else re.sub("[.!?]", "", text) if x == 2 else text
        chats[conv] += [(turn, "user" if x == 4 else role, text)] * (0 if x == 0 else 2 if x == 3 else 1)
    for conv, chat in chats.items():
        chat.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, codes, faults = set(), [], [0, 0, 0, 0]
        for _, role, text in chat:
            body = text.rstrip(" \t\n\v\f\r")
            fault = 1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0
            seen.add((role, text))
            faults[fault] += 1
            codes.append((role[:1], fault))

        @lru_cache(None)
        def best(i, state, inserts):
            ways = [(0, "")] if i == len(codes) and state in (0, 3) else []
            then = lambda cost, letter, rest: (cost + rest[0], letter + rest[1])
            if inserts:
                ways.append(then(3, "I", best(i, repair.NEXT[state], inserts - 1)))
            if i < len(codes):
                initial, fault = codes[i]
                ways.append(then(4, "D", best(i + 1, state, 2)))
                if fault not in (1, 2):
                    extra = 3 if fault == 3 else 0
                    if (state, initial) in {(0, "s"), (0, "u"), (1, "u"), (2, "a"), (3, "u")}:
                        ways.append(then(extra, "K", best(i + 1, "sua".index(initial) + 1, 2)))
                    ways.append(then(3 + extra, "R", best(i + 1, repair.NEXT[state], 2)))
            return min(ways, default=(10**9, ""))

        cost, audit = best(0, 0, 2)
        state, rest, lines = 0, list(chat), []
        for letter in audit:
            row = None if letter == "I" else rest.pop(0)
            if letter == "D":
                continue
            if letter == "K":
                state = "sua".index(row[1][0]) + 1
                lines.append(f"{row[1]}:{row[2]}")
            else:
                state = repair.NEXT[state]
                lines.append(f"{repair.ROLE[state]}:{row[2] if row else ''}")
        turns = {t for t, _, _ in chat if t is not None}
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(codes, codes[1:]))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *faults[1:], illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def report(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("'x' AS fault", "*", "1 AS audit").repartition(3)
    return sorted((tuple(r) for r in repair.repair_report(repair.damaged(df), df).collect()), key=str)


def test_the_report_is_that_of_plain_python(spark):
    rng, rows = random.Random(3), []
    for conv in [*range(150), None]:
        for turn in range(rng.randrange(9)):
            text = rng.choice(["Yes.", "No", "Why?", " \t", "", "Go on! \n", None, "é…", "x" * 3000 + "."])
            rows.append((conv, rng.choice([turn, turn, turn, None, 3]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), text))
    assert report(spark, rows) == plain(rows)


def test_whole_roundtrip(spark):
    rows = [(1, 5, "user", "a."), (1, 7, "user", "b."), (2, 0, "assistant", "c")]
    df = spark.createDataFrame(rows, SCHEMA)
    planned = repair.plans(df)
    assert {(r.conv_id, r.cost, r.audit, r.gaps) for r in planned.collect()} == {(1, 3, "KR", 1), (2, 4, "D", 0)}
    assert [tuple(r) for r in repair.repaired(df, planned).orderBy("conv_id", "place").collect()] == [(1, 0, "user", "a."), (1, 1, "assistant", "b.")]


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert report(spark, []) == [] and repair.repaired(empty, repair.plans(empty)).count() == 0
    nothing = hashlib.sha256(b"").hexdigest()
    known = spark.createDataFrame([(4, 0, "user", "a.")], SCHEMA)
    assert [tuple(r) for r in repair.repair_report(empty, known).collect()] == [(4, 0, 0, 0, 0, 0, 0, "", nothing)]
