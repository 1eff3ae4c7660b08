"""Findings documents as text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from reportloom.sources.scratch import materialise, scratch_scope

INDEX = "_reports"  # readers of the documents pass over names that start so


def folder_of(report_id: Column) -> Column:
    """A short folder name for an id of any length, which may be a whole path. Never NULL."""
    return F.md5(F.coalesce(report_id.cast("string"), F.lit("")))


def write_markdown(report: DataFrame, path: str, order) -> None:
    """One folder per report, named by a digest of its id; its files, read in name order, are the document.

    ``read_index`` tells which folder is which report's. One range sort over all reports: a large report spans several
    ranges and so several files, and the sort already puts the reports of a task one after the other, which is what
    writing by partition needs. The folder comes first in the sort, or the writer would sort again and lose the order.
    """
    with scratch_scope(report.sparkSession):
        lines = materialise(report)  # read twice by the sort, which samples it, and once for the ids
        (lines.withColumn("folder", folder_of(F.col("report_id"))).orderBy("folder", *order)
         .select("folder", "markdown_info").write.partitionBy("folder").text(path))
        ids = lines.select("report_id").distinct()
        ids.select(folder_of(F.col("report_id")).alias("folder"), "report_id").write.parquet(f"{path.rstrip('/')}/{INDEX}")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``folder, report_id`` of the documents under a path."""
    return spark.read.parquet(f"{path.rstrip('/')}/{INDEX}")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``report_id, file, block, line, markdown_info``: the documents' lines, in order by file, block and line."""
    lines = spark.read.text(path).select(
        "folder", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), F.col("value").alias("markdown_info"))
    return lines.join(read_index(spark, path), "folder").drop("folder")


def write_packed(report: DataFrame, path: str, order: Sequence[Column], partitions: int | None = None) -> None:
    """Documents one after the other in text files that follow the data's size, with an index of where each one is.

    ``order`` sorts by report first. The report is evaluated once and kept, since ranging it reads it twice; what is ranged
    and sorted is kept again, and both the files and the index are made from that. The number of ranges, each of which is a file, is left to Spark, which joins small
    ones, unless it is given. A document larger than a range goes on in the next file; a file holds many small ones. The
    index has one row for each document and file, ``report_id, part, first_line, n_lines``, lines counted from 0.
    """
    keys = [*order]
    with scratch_scope(report.sparkSession):
        whole = materialise(report)
        ranged = whole.repartitionByRange(partitions, *keys) if partitions else whole.repartitionByRange(*keys)
        lines = materialise(ranged.sortWithinPartitions(*keys).select("report_id", "markdown_info").withColumn("_at", F.monotonically_increasing_id()))
        part, line = F.shiftright("_at", 33).alias("part"), F.col("_at").bitwiseAND((1 << 33) - 1)
        placed = lines.select("report_id", "markdown_info", part, line.alias("_line"))
        # every part whole in one task, whatever the tasks that read it back are given
        (placed.repartition("part").sortWithinPartitions("part", "_line").select("part", "markdown_info")
         .write.partitionBy("part").text(path))
        index = placed.groupBy("report_id", "part").agg(F.min("_line").alias("first_line"), F.count(F.lit(1)).alias("n_lines"))
        index.repartitionByRange("report_id").sortWithinPartitions("report_id").write.parquet(f"{path.rstrip('/')}/{INDEX}")


def read_packed(spark: SparkSession, path: str, report_ids: Sequence[str] | None = None) -> DataFrame:
    """``report_id, line_no, markdown_info`` of all documents, or of some, for which only the files that hold them are read.

    The index is sorted by report, so that looking some up reads little of it.
    """
    index = spark.read.parquet(f"{path.rstrip('/')}/{INDEX}")
    base = path.rstrip("/")
    if report_ids is None:
        files = spark.read.option("basePath", base).text(base)
    else:
        index = index.where(F.col("report_id").isin(list(report_ids)))
        parts = [row.part for row in index.select("part").distinct().collect()]  # as many as the wanted documents have files
        if not parts:
            return spark.createDataFrame([], "report_id string, line_no bigint, markdown_info string")
        files = spark.read.option("basePath", base).text([f"{base}/part={part}" for part in parts])
    lines = files.select(F.col("part").cast("long").alias("part"), F.col("_metadata.file_block_start").alias("block"),
                         F.monotonically_increasing_id().alias("at"), F.col("value").alias("markdown_info"))
    numbered = lines.withColumn("line", F.row_number().over(Window.partitionBy("part").orderBy("block", "at")) - 1)  # within one file
    before = F.coalesce(F.sum("n_lines").over(Window.partitionBy("report_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = index.withColumn("before", before)
    inside = (F.col("line") >= F.col("first_line")) & (F.col("line") < F.col("first_line") + F.col("n_lines"))
    if report_ids is not None:
        found = numbered.join(spans, "part").where(inside)
    else:  # each line belongs to the last document that starts at or before it
        marks = spans.select("part", F.col("first_line").alias("line"), F.struct("report_id", "first_line", "before").alias("at_line"))
        last = F.last("at_line", ignorenulls=True).over(Window.partitionBy("part").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        found = numbered.join(marks, ["part", "line"], "left").withColumn("_doc", last).select("part", "line", "markdown_info", "_doc.*")
    return found.select("report_id", (F.col("before") + F.col("line") - F.col("first_line") + 1).alias("line_no"), "markdown_info")
