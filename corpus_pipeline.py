"""A training-data pipeline out of the operators in reportloom.llm.

Each stage gets what its predecessor kept, as a table that was written and is read again, and all but the last return the
columns of documents. Rows without an id, repeated rows, null and empty texts pass through the stages as their operators
define; an empty table gives an empty result. Documents lose no row that no stage has a reason to take out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reportloom.llm import decontaminate, jaccard, linededup, queries, toxicity
from reportloom.llm.store import stored

ORACLE_SQL = None  # a trained model and a tokenizer are no SQL; tests hold run() against a brute-force version



def free(docs: DataFrame, name: str) -> str:
    """A name that no column of documents has."""
    while name in docs.columns:
        name += "_"
    return name


def without_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on labelled ones of the same table, does not reject."""
    model = toxicity.train(docs, queries.table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def without_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines stay in their first document. A document that has a token of its own left keeps that.

    One with none left is no copy for that, since its lines may come from many documents and may differ in fields. It goes if
    a smaller document had its whole text, which may have lost lines here; else it stays whole, for the next stage to judge.
    """
    was, key, at = (free(docs, name) for name in ("text_as_it_was", "text_key", "first_place"))
    cleaned = linededup.without_recurring_lines(docs, was)
    none_left = (F.col("n_tokens") > 0) & (F.col("n_dropped_tokens") >= F.col("n_tokens"))
    kept = cleaned.filter(~none_left)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("id"))
    first = docs.groupBy(F.md5("text").alias(key)).agg(F.min(place).alias(at))
    whole = cleaned.filter(none_left).withColumn("text", F.col(was))
    same = F.md5(whole["text"]) == first[key]
    return kept.select(docs.columns).unionByName(whole.join(first, same & (place == F.col(at)), "left_semi").select(docs.columns))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar ones, the smallest by id, then by its text's digest; a missing id comes last. Rows
    without words are similar to none and all stay."""
    first, row = jaccard.first_rows(docs), free(docs, "row_key")
    keyed = docs.filter(~jaccard.wordless()).withColumn(row, jaccard.row_key())
    kept = keyed.join(first.withColumnRenamed("row", row), row, "left_semi").dropDuplicates([row])  # of equal rows, one
    return kept.select(docs.columns).unionByName(docs.filter(jaccard.wordless()))


def without_contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose own text holds no more of the benchmark than the rule allows."""
    row = free(docs, "row_key")
    dirty = decontaminate.contaminated_texts(docs, queries.table(spark, sf_dir, "benchmark")).withColumnRenamed("digest", row)
    return docs.withColumn(row, decontaminate.text_key()).join(dirty, row, "left_anti").select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.packed(docs)


STAGES = [("toxicity", without_toxicity), ("line dedup", without_lines), ("n-gram Jaccard join", without_near_duplicates),
          ("benchmark decontamination", without_contamination), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
