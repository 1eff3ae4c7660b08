"""Which files have been loaded: a file is read once, and again only when it has changed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from reportloom.sources.reports import html_files, literal_path, one_spelling
from reportloom.sources.scratch import materialise, scratch_scope
from reportloom.sources.tables import drop_load, ensure_table, replace_load, replace_loads

LEDGER_DDL = "path string, length bigint, modified timestamp, n_rows bigint, state string, at timestamp, load_id string"
STARTED, DONE = "started", "done"


@dataclass(frozen=True)
class Loaded:
    """What a load did: files that it read, files that it found unchanged, and the rows it wrote."""
    files: int
    unchanged: int
    rows: int


def listing(spark: SparkSession, path: str | list[str], glob: str = "*.html") -> DataFrame:
    """``path, length, modified`` of the files under a path. No file is opened."""
    files = html_files(spark.read, glob).load(path)
    return files.select(one_spelling(F.col("path")).alias("path"), "length", F.col("modificationTime").alias("modified"))


def loaded_files(ledger: DataFrame) -> DataFrame:
    """The latest complete entry of each file."""
    last = F.max_by(F.struct("length", "modified", "n_rows", "load_id"), "at")
    return ledger.where(F.col("state") == DONE).groupBy("path").agg(last.alias("last")).select("path", "last.*")


def unfinished_loads(ledger: DataFrame) -> DataFrame:
    """``load_id, n_files`` of loads that began and did not end."""
    return ledger.where(F.col("state") == STARTED).groupBy("load_id").agg(F.count(F.lit(1)).alias("n_files"))


def load_changed(spark: SparkSession, path: str | list[str], table: str, ledger: str, load_id: str,
                 read: Callable[[list[str]], DataFrame], glob: str = "*.html", location: str | None = None) -> Loaded:
    """Loads the files under a path that the ledger does not have as they are now.

    ``read`` makes table rows, with their ``source_path``, out of a list of files. Rows that other loads hold of a changed
    file go in the same write that adds the new ones, and a load that is run again keeps its rows of unchanged files. The
    ledger says ``started`` before and ``done`` after the rows are written: what a failed run has begun is read again and its
    rows, if there are any, are replaced, while a run that finds nothing to do writes nothing.
    """
    ensure_table(spark, ledger, LEDGER_DDL, location=location)
    with scratch_scope(spark):
        known = loaded_files(spark.table(ledger)).select("path", F.struct("length", "modified").alias("was"))
        found = listing(spark, path, glob).join(known, "path", "left")
        fresh = F.col("was").isNull() | (F.col("was") != F.struct("length", "modified"))
        files = materialise(found.withColumn("fresh", fresh).drop("was"))
        counts = files.agg(F.count_if("fresh"), F.count_if(~F.col("fresh"))).first()
        if not counts[0]:
            return Loaded(0, counts[1], 0)
        wanted = files.where("fresh").drop("fresh")
        entries = wanted.withColumns({"n_rows": F.lit(None).cast("bigint"), "state": F.lit(STARTED), "at": F.current_timestamp()})
        # loads that may hold rows of these files, or that are about to be written again
        touched = spark.table(ledger).join(wanted.select("path"), "path", "left_semi").select("load_id").distinct()
        before = materialise(touched.union(spark.createDataFrame([(load_id,)], "load_id string")).distinct())
        earlier = materialise(spark.table(ledger).where(F.col("load_id") == load_id).join(wanted.select("path"), "path", "left_anti"))
        replace_load(entries.unionByName(earlier.drop("load_id")), ledger, load_id)
        # only paths, which Spark's own listing holds on the driver as well
        rows = read([literal_path(r.path) for r in wanted.select("path").collect()])
        paths = wanted.select(F.col("path").alias("source_path"))
        kept = materialise(spark.table(table).join(before, "load_id", "left_semi").join(paths, "source_path", "left_anti"))
        written = materialise(rows.withColumn("load_id", F.lit(load_id)))
        emptied = before.join(kept.unionByName(written, allowMissingColumns=True).select("load_id").distinct(), "load_id", "left_anti").collect()
        replace_loads(written.unionByName(kept, allowMissingColumns=True), table)
        for row in emptied:  # a load whose every file has changed has no rows that could replace its partition
            drop_load(spark, table, row.load_id)
        per_file = written.groupBy(F.col("source_path").alias("path")).agg(F.count(F.lit(1)).alias("n"))
        done = wanted.join(per_file, "path", "left").select("path", "length", "modified", F.coalesce("n", F.lit(0)).alias("n_rows"),
                                                            F.lit(DONE).alias("state"), F.current_timestamp().alias("at"))
        replace_load(done.unionByName(earlier.drop("load_id")), ledger, load_id)
        return Loaded(counts[0], counts[1], written.count())
