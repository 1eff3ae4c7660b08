"""Loading reports as their files arrive, with the same reading and the same transformations as a batch load."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from reportloom.plans.diagnosis import diagnosis_rows, prepared
from reportloom.plans.usage import read_split
from reportloom.schema import DIAGNOSIS_FIELDS, DIAGNOSIS_TABLE_DDL, Field
from reportloom.sources.reports import html_files, literal_path
from reportloom.sources.scratch import materialise, scratch_scope
from reportloom.sources.tables import ensure_table, replace_load

IDS_DDL = "report_id string, last_id bigint, batch bigint, load_id string"


def arriving_files(spark: SparkSession, path: str, glob: str = "*.html", files_per_batch: int = 10_000) -> DataFrame:
    """``path, length`` of files as they appear under a folder. Their content is not read here, so their size does not matter."""
    source = spark.readStream.schema("path string, modificationTime timestamp, length long, content binary")
    return html_files(source, glob).option("maxFilesPerTrigger", files_per_batch).load(path).select("path", "length")


def load_arrivals(files: DataFrame, fields: tuple[Field, ...], transform: Callable[[DataFrame, str, int], DataFrame], table: str, ddl: str,
                  checkpoint: str, name: str = "stream", location: str | None = None, reading: dict | None = None, **trigger) -> StreamingQuery:
    """Starts a stream that reads the files of each micro-batch as a batch load does and writes them as a load of its own.

    ``transform`` makes table rows out of rows with cells, the load's id and the batch's number; ``reading`` has options of
    ``read_split``. A load is named after the stream, the query that its checkpoint belongs to and the batch. A batch that is
    run again after a failure so replaces its own partition only, and neither another stream nor one with a new checkpoint
    can replace it.
    """
    ensure_table(files.sparkSession, table, ddl, location=location)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query:
            raise RuntimeError("the stream does not say which query it is")
        paths = [literal_path(row.path) for row in batch.select("path").collect()]  # no more than files_per_batch
        if paths:
            load_id = f"{name}-{query}-{number}"
            with scratch_scope(spark):
                replace_load(transform(read_split(spark, paths, fields, **{"glob": "*", **(reading or {})}), load_id, number), table, load_id)

    stream = files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (stream.trigger(**trigger) if trigger else stream).start()


def load_prepared_arrivals(files: DataFrame, table: str, ids: str, checkpoint: str, name: str = "stream", location: str | None = None,
                           ids_location: str | None = None, databases: str | None = None, reading: dict | None = None, **trigger) -> StreamingQuery:
    """The diagnosis load, with derived fields and row numbers, for files as they arrive.

    Numbers of a report run on over the batches, without gaps: the ``ids`` table has, for each batch, the last number of each
    report in it. A batch starts behind what earlier batches of its stream left, so running it again gives the same numbers.
    """
    spark = files.sparkSession
    ensure_table(spark, ids, IDS_DDL, location=ids_location)

    def transform(split: DataFrame, load_id: str, number: int) -> DataFrame:
        rows = materialise(prepared(materialise(diagnosis_rows(split, databases))))
        stream = load_id.rsplit("-", 1)[0]
        before = (rows.sparkSession.table(ids).where(F.col("load_id").startswith(f"{stream}-") & (F.col("batch") < number))
                  .groupBy("report_id").agg(F.max("last_id").alias("_before")))
        numbered = materialise(rows.join(before, "report_id", "left").withColumn("id", F.col("id") + F.coalesce("_before", F.lit(0))).drop("_before"))
        last = numbered.groupBy("report_id").agg(F.max("id").alias("last_id")).where("last_id IS NOT NULL").withColumn("batch", F.lit(number).cast("bigint"))
        replace_load(last, ids, load_id)
        return numbered

    return load_arrivals(files, DIAGNOSIS_FIELDS, transform, table, DIAGNOSIS_TABLE_DDL, checkpoint, name, location, reading, **trigger)
