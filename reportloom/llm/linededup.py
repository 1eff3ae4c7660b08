"""Line dedup by a log-template tree, in SQL expressions only.

A line is parsed to a fixed depth: its number of tokens, then its leading tokens, lead to a leaf. Runs of digits are
variable fields from the start. Lines of a leaf are merged by their share of equal tokens: the rest of a line is cut
into quarters, and lines that have two quarters in common meet at the first of them in order of documents. Both are
compared position by position. Where enough positions are equal they have one template, and the positions that differ
are its fields. Lines of a template that more documents share than allowed stay only in the first of them.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reportloom.llm.store import stored
from reportloom.sources.scratch import scratch_scope

DEPTH = 3  # leading tokens on the way to a leaf
PARTS = 4
PERCENT = 85  # of the positions are equal in lines of one template
LONG, LONG_CHARS = 8, 50  # tokens or characters from which two documents are enough; so many tokens may have open positions
DOCS, DOCS_SHORT = 2, 10  # documents that make a template recurring
LAST = 2**63 - 1  # stands for a missing id
KEYS = [f"key{i}" for i in range(PARTS * (PARTS - 1) // 2)]


def fields(text: Column) -> Column:
    """Tokens between blanks, tabs and line ends."""
    for separator in "\t\r\n":
        text = F.replace(text, F.lit(separator), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def parsed(line: Column) -> Column:
    """Columns n (tokens), long, whole (a hash of all tokens, null for a line of nothing but digits) and codes (a hash of each
    token, for lines of LONG tokens only) of a line. They come from a generator: what filters them is not pushed below it,
    where a line would be cut a second time."""

    def read(tokens: Column) -> Column:
        n = F.size(tokens)
        fixed = F.contains(line, F.lit("<*>")) | F.exists(tokens, lambda t: t != "<*>")  # not digits only
        return F.struct(
            n.alias("n"), ((n >= LONG) | (F.length(line) >= LONG_CHARS)).alias("long"), F.when((n > 0) & fixed, F.xxhash64(n, tokens)).alias("whole"),
            F.when(n >= LONG, F.transform(tokens, lambda t: F.hash(t))).alias("codes"))

    return F.inline(F.transform(F.array(fields(F.regexp_replace(line, "[0-9]+", "<*>"))), read))


def with_keys(lines: DataFrame) -> DataFrame:
    """Lines with KEYS, hashes of a line's leaf with each two of its parts, null for lines without codes."""
    codes, rest = F.col("codes"), F.size("codes") - DEPTH
    cut = lambda j: F.floor(rest * j / PARTS).cast("int")
    parts = [F.xxhash64(F.slice(codes, cut(j) + (DEPTH + 1), cut(j + 1) - cut(j))).alias(f"part{j}") for j in range(PARTS)]
    hashed = lines.select("*", F.xxhash64(F.size(codes), F.slice(codes, 1, DEPTH)).alias("leaf"), *parts)
    pairs = zip(KEYS, combinations(range(PARTS), 2), strict=True)
    return hashed.select(*lines.columns, *(F.when(codes.isNotNull(), F.xxhash64("leaf", F.lit(i), F.lit(j), f"part{i}", f"part{j}")).alias(k) for k, (i, j) in pairs))


def merged(lines: DataFrame, firsts: DataFrame) -> DataFrame:
    """whole: distinct lines that have the template of a line of an earlier document.

    A key names one line, the first that has it, and all others are compared with that one only. So a leaf costs as many
    comparisons as it has lines, whatever its size.
    """
    each = firsts.filter(F.col(KEYS[0]).isNotNull()).select("whole", "at.doc", "at.pos", F.explode(F.array(*KEYS)).alias("key")).repartition("key")
    # most keys are of one line; the one exchange serves the count and the lines themselves, and only keys of several documents are sorted
    several = each.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first < last").select("key")
    place = F.struct("doc", "pos", "whole")
    pivot = F.first(place).over(Window.partitionBy("key").orderBy("doc", "pos", "whole")).alias("pivot")
    pairs = stored(each.join(several.hint("shuffle_hash"), "key", "left_semi").select(place.alias("own"), pivot).filter("pivot.doc < own.doc").distinct())
    wanted = pairs.select("own.*").union(pairs.select("pivot.*")).distinct()
    codes = stored(lines.join(wanted, ["whole", "doc", "pos"]).select("whole", "codes").dropDuplicates(["whole"]))
    theirs = codes.select(F.col("whole").alias("first"), F.col("codes").alias("theirs"))
    beside = pairs.select("own.whole", F.col("pivot.whole").alias("first")).join(codes, "whole").join(theirs, "first")
    equal = F.size(F.filter(F.zip_with("codes", "theirs", lambda a, b: a == b), lambda same: same))
    return beside.filter(100 * equal >= PERCENT * F.size("codes")).select("whole").distinct()


def lines_gone(texts: DataFrame) -> DataFrame:
    """gone_doc, gone_body, all_tokens, gone (places of lines to take out, ascending) and gone_tokens of texts (doc, body, text);
    the last two are null for a text that loses no line."""
    read = texts.select("doc", "body", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    read = stored(with_keys(read.select("doc", "body", "pos", parsed(F.col("line"))).filter("n > 0 or pos = 0")))
    rows = F.count_if(F.col("pos") == 0)  # equal rows of one id
    counted = read.groupBy("doc", "body").agg((F.sum("n") / rows).cast("long").alias("all_tokens"))
    lines = read.filter("whole is not null")

    at = F.min(F.struct("doc", "pos")).alias("at")
    long = lines.filter("codes is not null").select("whole", "doc", "pos", *KEYS)
    often_long = F.when(F.max("doc") > F.min("doc"), DOCS).otherwise(1).cast("long").alias("docs")  # one or more is all that matters
    many = long.groupBy("whole").agg(at, often_long, F.lit(True).alias("long"), *(F.min(k).alias(k) for k in KEYS))
    by_doc = lines.filter("codes is null").groupBy("whole", "doc").agg(F.min("pos").alias("pos"), F.max("long").alias("long"))
    few = by_doc.groupBy("whole").agg(at, F.count(F.lit(1)).alias("docs"), F.max("long").alias("long"), *(F.lit(None).cast("long").alias(k) for k in KEYS))
    firsts = stored(many.union(few))
    later = merged(lines, firsts).select("whole", F.lit(-1).cast("long").alias("first"))
    often = firsts.filter(F.col("docs") >= F.when(F.col("long"), DOCS).otherwise(DOCS_SHORT)).select("whole", F.col("at.doc").alias("first"))
    recurring = often.union(later).groupBy("whole").agg(F.min("first").alias("first"))
    dropped = lines.select("doc", "body", "pos", "n", "whole").join(recurring, "whole").filter("first < doc").select("doc", "body", "pos", "n").distinct()
    gone = dropped.groupBy("doc", "body").agg(F.array_sort(F.collect_list("pos")).alias("gone"), F.sum("n").alias("gone_tokens"))
    return stored(counted.join(gone, ["doc", "body"], "left").withColumnsRenamed({"doc": "gone_doc", "body": "gone_body"}), outlives=True)


def without_recurring_lines(docs: DataFrame, whole: str | None = None) -> DataFrame:
    """Documents with all their columns, lines of recurring templates taken out of text, and n_lines, n_dropped, n_tokens,
    n_dropped_tokens.

    A line stays in the document of the smallest id among those that share a template, however often it stands there. Lines
    of LONG tokens or LONG_CHARS characters go from two documents on, shorter ones from ten. Of these, only equal ones (up to
    digits) share a template, and so do long ones of few tokens; others share one with the first line that has their leaf
    and two of their quarters, if PERCENT of the positions are equal. That line may in turn have the template of an earlier
    one. Rows of one id count as one document; a missing id comes after all others. Null texts stay null and have no lines;
    blank lines and those of digits only stay. Lines are cut at \\n and nothing but whole lines is changed. Columns of
    documents that have one of the four names are replaced. An empty table gives no rows. whole names a column for the
    text as it was.
    """
    own = ["n_lines", "n_dropped", "n_tokens", "n_dropped_tokens"]
    docs = docs.drop(*own)
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    text = F.col("text").cast("string")
    body = F.xxhash64(text)
    with scratch_scope(docs.sparkSession):
        gone = lines_gone(docs.select(doc.alias("doc"), body.alias("body"), text.alias("text")))

    mark = {c: f"{c}_of_{'_'.join(docs.columns)}"[:120] for c in ("gone", "gone_tokens", "all_tokens", "gone_doc", "gone_body")}  # names that no column has
    gone = gone.withColumnsRenamed(mark)
    joined = docs.join(gone, (doc == F.col(mark["gone_doc"])) & (body == F.col(mark["gone_body"])), "left")
    split = F.split(text, "\n")
    at = F.coalesce(F.col(mark["gone"]), F.array().cast("array<int>"))
    before, after = F.concat(F.array(F.lit(-1)), at), F.concat(at, F.array(F.size(split)))
    runs = F.transform(F.array(split), lambda all_lines: F.flatten(F.transform(
        F.arrays_zip(before.alias("a"), after.alias("b")), lambda r: F.slice(all_lines, r["a"] + 2, r["b"] - r["a"] - 1))))
    left = F.when(F.size(at) > 0, F.array_join(runs[0], "\n")).otherwise(text)
    counts = [F.when(text.isNull(), 0).otherwise(F.size(split)), F.size(at), F.coalesce(mark["all_tokens"], F.lit(0)), F.coalesce(mark["gone_tokens"], F.lit(0))]
    kept = [left.alias(c) if c == "text" else F.col(c) for c in docs.columns]
    if whole is not None:
        kept.append(text.alias(whole))
    return joined.select(*kept, *(c.cast("long").alias(name) for c, name in zip(counts, own, strict=True)))
