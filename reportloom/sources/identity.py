"""Numbers that no two loads share, handed out by files that only one of them can create."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reportloom.operators.numbering import number_rows
from reportloom.sources.scratch import fresh_path, materialise, remove

ROWS_BITS = 40  # a load may have a million million rows, and there may be eight million loads
ROW_KEY = "row_key"


def _created(spark: SparkSession, path: str) -> bool:
    """Creates an empty file; False if it is there already. Two callers never both get True.

    A local folder is asked through the file system's own exclusive creation. Hadoop's is exclusive on HDFS; an object store
    without conditional writes cannot promise it and is no place for reservations.
    """
    jvm = spark._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    fs = file.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() == "file":
        return jvm.java.io.File(file.toUri().getPath()).createNewFile()
    try:
        fs.create(file, False).close()
    except Exception as error:  # the gateway wraps whatever Hadoop throws
        if "FileAlreadyExists" in str(error):
            return False
        raise
    return True


def reserve(spark: SparkSession, folder: str) -> int:
    """The next number of a folder of reservations. Once given it is never given again, whether its load succeeds or not."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(folder)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(place)
    taken = [int(name) for status in fs.listStatus(place) if (name := status.getPath().getName()).isdigit()]
    number = max(taken, default=0) + 1
    while not _created(spark, f"{folder.rstrip('/')}/{number}"):
        number += 1
    return number


def with_row_key(rows: DataFrame, folder: str, order: list[str], name: str = ROW_KEY) -> DataFrame:
    """Adds a number that is unique over all loads with one folder of reservations, growing with the loads and, within
    one, by ``order``, which should tell rows apart. Rows of a load are numbered without gaps, in ranges, not in one task.

    They are stored first, since ranging looks at them once to find its bounds and once to deal them out."""
    spark = rows.sparkSession
    number = reserve(spark, folder)
    stored = materialise(rows, path := fresh_path(spark, "unnumbered"))
    numbered = number_rows(stored, [F.asc(c) for c in order], name=name)
    remove(spark, path)
    return numbered.withColumn(name, F.lit(number << ROWS_BITS) + F.col(name))
