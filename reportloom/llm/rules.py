"""Quality rules with cutoffs that limit false rejections, in SQL expressions only.

Each rule rejects texts above a cutoff of one measure. Good texts among labelled ones are the holdout: a cutoff is
certified for a stratum if so few of them lie above it that a false rejection rate over the limit is refuted by the exact
binomial test, at a level divided by the number of all tests. The lowest certified cutoff of a rule is used; where none
is certified, the rule rejects nothing.
"""

from __future__ import annotations

import math
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from reportloom.llm.store import stored

LIMIT = 0.04  # false rejections of good texts by all rules together, in each stratum
RISK = 0.05  # that any limit is broken
CUTOFFS = {
    "symbols": [round(0.05 * i, 2) for i in range(1, 21)],  # symbols for each word
    "repeats": [round(0.025 * i, 3) for i in range(1, 21)],  # share of words in repeated windows
    "dup_lines": [round(0.025 * i, 3) for i in range(1, 21)],  # share of lines that repeat an earlier one
    "word_length": [float(i) for i in range(5, 25)],  # mean code points of a word
}
SEPARATORS = r"[\x20\x09-\x0D]+"


def let(value: Column, use) -> Column:
    """use(value), with the value computed once a row."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that stand twice or more in the text.

    Windows are sorted by hash; those equal to a neighbour are repeated. Their places, sorted, each add the words not yet
    covered by the one before.
    """
    def places(sorted_windows: Column) -> Column:
        n = F.size(sorted_windows)
        near = lambda i: F.get(sorted_windows, i)["h"]
        same = F.filter(sorted_windows, lambda w, i: F.coalesce(w["h"] == near(i - 1), F.lit(False)) | F.coalesce(w["h"] == near(i + 1), F.lit(False)))
        return F.when(n > 1, F.sort_array(F.transform(same, lambda w: w["i"]))).otherwise(F.array().cast("array<int>"))

    def covered(at: Column) -> Column:
        added = F.transform(at, lambda p, i: F.when(i == 0, 3).otherwise(F.least(F.lit(3), p - F.get(at, i - 1))))
        return F.aggregate(added, F.lit(0).cast("long"), lambda a, b: a + b)

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(
        F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    return F.when(F.size(words) >= 4, let(F.sort_array(windows), lambda s: let(places(s), covered))).otherwise(F.lit(0).cast("long"))


def measured(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum and the counts of each row's whole text; null texts count as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    group = F.coalesce(F.col(stratum).cast("string"), F.lit("")) if stratum in docs.columns else F.lit("")
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), group.alias("stratum"), text.alias("text"),
                      F.filter(F.split(text, SEPARATORS), lambda w: w != "").alias("words"),
                      F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    return cut.select(
        "doc_id", "stratum", F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"))


def rule_values() -> dict[str, Column]:
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return {"symbols": share("n_symbols", "n_words"), "repeats": share("n_repeat_words", "n_words"),
            "dup_lines": share("n_dup_lines", "n_lines"), "word_length": share("word_chars", "n_words")}


def binomial_log_tail(n: Column, k: Column, rate: float) -> Column:
    """Natural logarithm of the chance of k or fewer among n at the rate: terms by their ratio, added as logarithms."""
    start = F.struct((n * F.log(F.lit(1 - rate))).alias("term"), (n * F.log(F.lit(1 - rate))).alias("total"))

    def add(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i + 1) / i * (rate / (1 - rate)))
        high, low = F.greatest(a["total"], term), F.least(a["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    return F.aggregate(F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")), start, add, lambda a: a["total"])


def exceeded(value: Column, cutoffs: list[float]) -> Column:
    """How many of the ascending cutoffs the value is above."""
    return F.size(F.filter(F.lit(cutoffs), lambda c: value > c))


def certified(measures: DataFrame, labels: DataFrame, limit: float = LIMIT, risk: float = RISK) -> DataFrame:
    """stratum, rule and cutoff: the lowest certified one. Rules share the limit; all cutoffs of all strata share the risk.

    An id labelled twice is good only if all its labels say so. Labels without a value are left out.
    """
    good = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna()
            .groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1").select("doc_id"))
    values = rule_values()
    above = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), exceeded(v, CUTOFFS[r]).alias("passed")) for r, v in values.items())))
    seen = measures.join(good, "doc_id", "left_semi").select("stratum", above.alias("r")).groupBy("stratum", "r.rule", "r.passed").agg(F.count(F.lit(1)).alias("n"))
    by_rule = seen.groupBy("stratum", "rule").agg(F.sum("n").alias("n"), F.collect_list(F.struct("passed", "n")).alias("seen"))  # one entry a cutoff at most
    lists = F.create_map(*chain.from_iterable((F.lit(r), F.lit(c)) for r, c in CUTOFFS.items()))
    each = by_rule.select("stratum", "rule", "n", "seen", F.posexplode(lists[F.col("rule")]).alias("i", "cutoff"))
    wrong = F.aggregate("seen", F.lit(0).cast("long"), lambda a, s: a + F.when(s["passed"] > F.col("i"), s["n"]).otherwise(0))
    tests = sum(map(len, CUTOFFS.values()))
    counted = each.withColumn("k", wrong)
    strata = measures.select("stratum").distinct().count()
    rate = limit / len(CUTOFFS)
    level = math.log(risk / max(strata * tests, 1))
    hopeful = F.col("k") <= F.col("n") * rate  # above it the test can't refute anything
    passing = counted.filter(hopeful).filter(binomial_log_tail(F.col("n"), F.col("k"), rate) <= level)
    return passing.groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", limit: float = LIMIT, risk: float = RISK) -> DataFrame:
    """Each row of documents with its counts, base_failed and kept, and the rules that reject it.

    Base failures are texts of under 50 words, or with more than half their words in repeated windows. A missing or null
    stratum is the stratum "". Rows of one id are each judged. An empty table gives no rows.
    """
    measures = stored(measured(docs, stratum))
    cuts = certified(measures, labels, limit, risk).groupBy("stratum").pivot("rule", list(CUTOFFS)).agg(F.first("cutoff"))
    cuts = cuts.withColumnsRenamed({r: f"{r}_cutoff" for r in CUTOFFS})
    over = [F.when(v > F.col(f"{r}_cutoff"), F.lit(r)) for r, v in rule_values().items()]
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = measures.join(cuts, "stratum", "left").withColumns({"base_failed": base, "rejected_by": F.array_compact(F.array(*over))})
    return judged.select("doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "rejected_by",
                         (~F.col("base_failed") & (F.size("rejected_by") == 0)).alias("kept"))
