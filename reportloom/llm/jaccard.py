"""Exact similarity join of documents by word n-grams, over a matrix of groups and tokens.

Sets that are equal are one set. Which sets may be similar is found by prefixes: ordered by rarity, two similar sets share
some of their first tokens. Rarity is only an order. It is taken from the tokens that repeat within a task's share of
documents, and any order gives the same links. Prefixes a little longer must share several tokens, which keeps out sets
that meet in one common phrase.

First each token of the prefixes names one pivot, the set with the most common tokens, and sets are compared with their
pivots only. So a family of near copies, whose sets are mostly close to one of them, becomes one cluster with as many
comparisons as it has sets. Then similar sets that no cluster has joined are looked for: clusters and single sets are
gathered into groups, a group is cut when it has too many sets or tokens, and sets ask only groups that hold sets of
other clusters. The union of a group's tokens bounds what a set can share with any set of the group: with the wanted
similarity it shares that part of its own size with the union. So only groups that reach the bound are opened.

Links are counted, where asked for, within each component: its sets are cut into blocks, and each set asks each block.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reportloom.llm.components import smallest_reachable
from reportloom.llm.store import stored
from reportloom.llm.words import SPACED, mixed, split_words, text_slices, word_hashes

SHINGLE = 4
PERCENT = 85
FREQUENT = 1_000_000  # tokens whose counts order the others; 16 MB in each task
MEETINGS = 3  # tokens that the prefixes of similar sets share, each prefix being longer by all but one of them
COUNTED = 1_000_000  # tokens counted at once in a task
SLICE = 2 << 20  # bytes of text cut at once
GROUP_SETS, GROUP_TOKENS = 64, 1 << 16
BLOCK_SETS, BLOCK_TOKENS = 512, 1 << 17  # of a component, when links are counted
SALTS = 32  # shares that a large family is dealt to while it is cut
QUERIES_A_CALL = 1024  # of one group
CALL_TOKENS = 1 << 21
STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Of each text, the ascending hashes of its distinct shingles."""
    words = split_words(texts, SPACED)
    hashes = word_hashes(words.values)[words.codes] if len(words.codes) else np.empty(0, np.uint64)
    whole = np.zeros(max(len(hashes) - size + 1, 0), np.uint64)
    for k in range(size):
        whole = whole * STEP + mixed(hashes[k : k + len(whole)])
    whole = mixed(whole)
    out = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(whole[a : b - size + 1]))
        elif b > a:
            one = np.array([b - a], np.uint64)
            for h in mixed(hashes[a:b]):
                one = one * STEP + h
            out.append(mixed(one))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def row_key() -> Column:
    """Of a row of documents, 16 bytes that rows of one id and one text share, and no others."""
    named = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("-")), F.coalesce(F.md5(F.col("text").cast("string")), F.lit("-")))
    return F.unhex(F.md5(named))


def digest(tokens: np.ndarray) -> bytes | None:
    return blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None


def frequent_tokens(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that repeat within a task's share of documents, the most frequent ones, ascending; and their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> pa.RecordBatch:
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch([pa.array(tokens[n > 1].view(np.int64)), pa.array(n[n > 1])], ["token", "n"])

        held, total = [], 0
        for batch in text_slices(batches, limit=SLICE):
            held += shingle_sets(batch.column(0), size)
            total += sum(map(len, held[-batch.num_rows:]))
            if total > COUNTED:
                yield found()
                held, total = [], 0
        if held:
            yield found()

    counts = stored(texts.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")))
    # the least count that leaves no more tokens than wanted, to an eighth of a power of two; no task ranks them
    step = F.floor(8 * F.log2("n")).cast("int")
    steps = sorted(counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("tokens")).collect(), reverse=True)
    room, least = FREQUENT, 1 << 30
    for r in steps:
        room -= r["tokens"]
        if room < 0:
            break
        least = r["step"]
    top = counts.filter(step >= least).toArrow()
    tokens = top.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top.column("n").to_numpy()[order]


def prefixes(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, row (its row_key), n, digest, gather (the group key), core (how common its prefix is) and prefix: the rarest
    tokens, as many as a similar set must meet."""
    known = texts.sparkSession.sparkContext.broadcast(frequent_tokens(texts, size))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts = known.value
        for batch in text_slices(batches, limit=SLICE):
            rows = []
            for s in shingle_sets(batch.column(1), size):
                n = len(s)
                if not n:
                    rows.append((0, None, None, None, None))
                    continue
                seen = np.zeros(n, np.int64)
                if len(tokens):
                    at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
                    seen = np.where(tokens[at] == s, counts[at], 0)
                at = np.argsort(seen, kind="stable")[: n - -(-percent * n // 100) + MEETINGS]
                rows.append((n, digest(s), int(mixed(s ^ STEP).min().view(np.int64)), int(seen[at].mean()), s[at].view(np.int64)))
            columns = list(zip(*rows, strict=True))
            yield pa.record_batch([batch.column(0), batch.column(2), *map(pa.array, columns, (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64())))],
                                  ["doc_id", "row", "n", "digest", "gather", "core", "prefix"])

    return texts.select("doc_id", "text", "row").mapInArrow(cut, "doc_id long, row binary, n long, digest binary, gather long, core long, prefix array<long>")


def enough(percent: int) -> Column:
    """Tokens that the prefixes of a set and a similar one share."""
    return F.least(F.lit(MEETINGS), F.ceil(F.lit(percent) * F.col("n") / 100))


def shared_tokens(sets: DataFrame, percent: int) -> DataFrame:
    """rep, n, token, indexed (a smaller similar set is found by it) and pivot: tokens of prefixes that several sets have."""
    indexed = F.col("n") - F.ceil(F.lit(2 * percent) * F.col("n") / F.lit(100 + percent)) + MEETINGS
    tokens = sets.select("rep", "n", "core", indexed.alias("first"), F.posexplode("prefix").alias("at", "token"))
    pivot = F.min(F.struct((-F.col("core")).alias("core"), "rep", "n")).alias("pivot")
    pivots = stored(tokens.groupBy("token").agg(pivot, F.count(F.lit(1)).alias("sets")).filter("sets > 1").select("token", F.struct("pivot.rep", "pivot.n").alias("pivot")))
    return tokens.join(pivots, "token").select("rep", "n", "token", (F.col("at") < F.col("first")).alias("indexed"), "pivot")


def candidate_families(held: DataFrame, percent: int) -> DataFrame:
    """rep, n and family: sets and the families in which another cluster may hold one of at most their size that is similar."""
    clusters = stored(held.groupBy("token").agg(F.min("cluster").alias("a"), F.max("cluster").alias("b")).filter("a < b").select("token"))
    crossing = stored(held.join(clusters, "token", "left_semi"))
    by_token = stored(crossing.filter("indexed").groupBy("token", "family").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("cluster").alias("low"), F.max("cluster").alias("high")))
    other = (F.col("low") != F.col("cluster")) | (F.col("high") != F.col("cluster"))
    fits = (F.col("least") <= F.col("n")) & (100 * F.col("most") >= percent * F.col("n"))
    met = (crossing.select("rep", "n", "cluster", "token").join(by_token, "token").filter(other & fits)
           .groupBy("rep", "n", "family").agg(F.count(F.lit(1)).alias("met")))
    return met.filter(F.col("met") >= enough(percent)).drop("met")


def cut(sets: DataFrame, most_sets: int, most_tokens: int) -> tuple[DataFrame, DataFrame]:
    """The sets (rep, n, family, …) with gid, their part of the family; and the parts of families that have several."""
    salt = F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int")
    sizes = sets.groupBy("family").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("tokens"))
    parts = F.greatest(F.ceil(F.col("sets") / most_sets), F.ceil(F.col("tokens") / most_tokens))
    large = stored(sizes.withColumn("parts", parts).filter("parts > 1").select("family", "parts"))
    salted = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    part = F.pmod(F.xxhash64(F.col("rep") + 1), F.coalesce("parts", F.lit(1)))
    placed = sets.withColumn("salt", salt).join(salted, ["family", "salt"], "left").withColumn("gid", F.xxhash64("family", part))
    return placed.drop("salt", "parts"), large


def all_parts(found: DataFrame, large: DataFrame) -> DataFrame:
    """rep, n and gid: each part of the families that sets (rep, n, family) ask."""
    salt = F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int")
    salted = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
    each = found.withColumn("salt", salt).join(salted, ["family", "salt"], "left").select("rep", "n", "family", part)
    return each.select("rep", "n", F.xxhash64("family", "part").alias("gid"))


def opened(call: pa.Table, percent: int, downward: bool) -> pa.Table:
    """Bounds each query by its group's union and opens the groups that reach the bound. A call has whole groups.

    Where sets ask each other, links go downward: from a set to smaller ones, or of lower number among those of one size.
    Returns a row for each linked set: the weight of its partners and the least set that its links here lead to.
    """
    links: dict[int, int] = defaultdict(int)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    inside: dict[bool, dict[int, dict[int, tuple[int, int, np.ndarray]]]] = {s: defaultdict(dict) for s in (False, True)}
    for gid, rep, weight, member, blob in zip(*(call.column(c).to_pylist() for c in ("gid", "rep", "weight", "member", "tokens")), strict=True):
        inside[member][gid][rep] = (rep, weight, np.frombuffer(blob, np.uint64))
    for gid, asking in inside[False].items():
        group = list(inside[True][gid].values())
        if not group:
            continue
        reps, weights = (np.array([m[i] for m in group], np.int64) for i in (0, 1))
        sizes = np.array([len(m[2]) for m in group])
        union = np.unique(np.concatenate([m[2] for m in group]))
        matrix = np.zeros((len(union), len(group)), np.uint8)  # tokens x sets
        for j, (_, _, tokens) in enumerate(group):
            matrix[np.searchsorted(union, tokens), j] = 1
        for rep, weight, tokens in asking.values():
            at = np.minimum(np.searchsorted(union, tokens), len(union) - 1)
            at = at[union[at] == tokens]
            n = len(tokens)
            if 100 * len(at) < percent * n:
                continue
            shared = matrix[at].sum(axis=0, dtype=np.int64)
            linked = (100 * shared >= percent * (n + sizes - shared)) & (reps != rep)
            if downward:
                linked &= (sizes < n) | ((sizes == n) & (reps < rep))
            for j in np.flatnonzero(linked).tolist():
                other = int(reps[j])
                links[rep] += int(weights[j])
                links[other] += weight
                a, b = find(rep), find(other)
                root[max(a, b)] = min(a, b)
    return pa.table({"rep": pa.array(list(links), pa.int64()), "links": pa.array(list(links.values()), pa.int64()),
                     "root": pa.array([find(x) for x in links], pa.int64())})


def token_sets(texts: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """rep, weight and tokens (64-bit hashes, ascending) of wanted sets, each out of the text of its first row only."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, limit=SLICE):
            yield pa.record_batch([batch.column(1), batch.column(2), pa.array([s.tobytes() for s in shingle_sets(batch.column(0), size)], pa.binary())],
                                  ["rep", "weight", "tokens"])

    # repeated rows share a key; they are dropped where the join has put them, before they are cut
    found = texts.select("row", "text").join(wanted.hint("merge"), "row").dropDuplicates(["row"]).select("text", "rep", "weight")
    return found.mapInArrow(build, "rep long, weight long, tokens binary")


def verified(asking: DataFrame, members: DataFrame, tokens: DataFrame, percent: int, downward: bool = True) -> DataFrame:
    """rep, links and root of the sets that are linked with a member of a group (rep, n, gid) that they ask (rep, n, gid)."""
    # who asks which group, in blocks, and the group's sets beside each block
    blocks = F.greatest(F.ceil(F.col("asking") / QUERIES_A_CALL), F.ceil(F.col("tokens") / CALL_TOKENS))
    asked = asking.groupBy("gid").agg(F.count(F.lit(1)).alias("asking"), F.sum("n").alias("tokens")).select("gid", blocks.alias("blocks"))
    dealt = asking.join(asked, "gid").select("rep", "n", "gid", F.pmod(F.xxhash64("rep"), "blocks").alias("block"), F.lit(False).alias("member"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    beside = members.join(asked, "gid").select("rep", "n", "gid", each, F.lit(True).alias("member"))
    plan = stored(dealt.union(beside).select("rep", "n", F.xxhash64("gid", "block").alias("gid"), "member"))
    calls = max(1, (plan.agg(F.sum("n")).first()[0] or 0) // CALL_TOKENS)
    given = plan.drop("n").hint("merge").join(tokens, "rep").withColumn("call", F.pmod(F.xxhash64("gid"), F.lit(calls)))
    return stored(given.groupBy("call").applyInArrow(lambda call: opened(call, percent, downward), "rep long, links long, root long"))


def labels(edges: DataFrame) -> DataFrame:
    """rep and root of every set that has a link, the smallest of a component included."""
    found = smallest_reachable(edges)
    return stored(found.select(F.col("u").alias("rep"), "root").union(found.select("root", "root").distinct()))


def components_of_sets(docs: DataFrame, size: int, percent: int, counted: bool) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, row, n, digest), and of each set digest, weight, links (if counted), root (its component) and first: the
    row of the smallest id, then key, that has the set; a missing id comes last."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row_key().alias("row"))
    rows = stored(prefixes(texts, size, percent).withColumn("key", F.monotonically_increasing_id()))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row")).alias("first")
    same = stored(rows.filter("n > 0").groupBy("digest").agg(F.min("key").alias("rep"), first, F.count(F.lit(1)).alias("weight"), F.min("n").alias("n"),
                                                            F.min("gather").alias("gather"), F.max("core").alias("core")))
    prefix = rows.select(F.col("key").alias("rep"), "prefix")
    shared = stored(shared_tokens(same.select("rep", "n", "core").join(prefix, "rep"), percent))
    enough_met = lambda met: met.filter(F.col("met") >= enough(percent)).drop("met")
    wanted = enough_met(shared.groupBy("rep", "n").agg(F.count(F.lit(1)).alias("met"))).select("rep")
    tokens = stored(token_sets(texts, wanted.join(same.select("rep", "weight", "first.row"), "rep"), size))

    near = (F.col("rep") != F.col("pivot.rep")) & (100 * F.least("n", "pivot.n") >= percent * F.greatest("n", "pivot.n"))
    to_pivots = stored(enough_met(shared.filter(near).groupBy("rep", "n", "pivot").agg(F.count(F.lit(1)).alias("met"))))
    asking = to_pivots.select("rep", "n", F.col("pivot.rep").alias("gid"))
    pivots = to_pivots.select("pivot").distinct().select("pivot.rep", "pivot.n", F.col("pivot.rep").alias("gid"))
    edges = lambda linked: linked.select(F.col("rep").alias("u"), F.col("root").alias("v"))
    clusters = labels(edges(verified(asking, pivots, tokens, percent, downward=False)))

    family = F.when(F.col("root").isNull(), F.xxhash64("gather")).otherwise(F.xxhash64("root", F.lit(1)))  # a hash of null is not null
    grouped = stored(same.select("rep", "n", "gather").join(clusters, "rep", "left").select("rep", "n", F.coalesce("root", "rep").alias("cluster"), family.alias("family")))
    placed, large = cut(grouped, GROUP_SETS, GROUP_TOKENS)
    found = stored(candidate_families(shared.select("rep", "token", "indexed").join(grouped, "rep"), percent))
    more = verified(all_parts(found, large), placed.select("rep", "n", "gid"), tokens, percent)
    roots = labels(edges(clusters).union(edges(more)))

    labelled = same.select("digest", "rep", "weight", "first", "n").join(roots, "rep", "left").withColumn("family", F.col("root")).withColumn("root", F.coalesce("root", "rep"))
    if counted:
        linked = stored(labelled.filter("family is not null").select("rep", "n", "family"))
        placed, large = cut(linked, BLOCK_SETS, BLOCK_TOKENS)
        links = verified(all_parts(linked, large), placed.select("rep", "n", "gid"), tokens, percent).groupBy("rep").agg(F.sum("links").alias("links"))
        labelled = labelled.join(links, "rep", "left").withColumn("links", F.coalesce("links", F.lit(0)))
    return rows.select("doc_id", "row", "n", "digest"), labelled.drop("rep", "n", "family")


def similar_groups(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """For each row of documents, its shingles, its links and the smallest document that links lead to.

    Returns doc_id, n_shingles, n_links (rows linked with this one, copies included) and component_id. Words are cut at
    ASCII white space, A-Z lower-cased. A text of fewer words than a shingle is one shingle; null texts and those without
    words have none, no links, and are their own component. Rows of equal text are linked, also under one id. A missing
    id is never the smallest unless its whole component lacks ids. An empty table gives no rows. Other columns are left out.
    """
    rows, labelled = components_of_sets(docs, size, percent, counted=True)
    smallest = labelled.groupBy("root").agg(F.min("first.doc_id").alias("component_id"))
    classes = labelled.join(smallest, "root").select("digest", "component_id", (F.col("links") + F.col("weight") - 1).alias("n_links"))
    return rows.select("doc_id", "n", "digest").join(classes, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def wordless() -> Column:
    """Whether a row has no words and so no component with others."""
    return ~F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


def first_rows(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """row: the row_key of one row of each component of rows with words, the smallest by id, a missing one last, then key."""
    _, labelled = components_of_sets(docs, size, percent, counted=False)
    return labelled.groupBy("root").agg(F.min("first").alias("first")).select("first.row")
