"""From usage report files to the inventory table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reportloom.operators.markup import cells, shred_rows, typed
from reportloom.schema import USAGE_FIELDS, USAGE_TABLE_DDL, Field
from reportloom.sources.identity import ROW_KEY, with_row_key
from reportloom.sources.reports import WHOLE_FILE_LIMIT, read_report_rows, read_reports
from reportloom.sources.scratch import scratch_scope
from reportloom.sources.tables import ensure_table, replace_load

ORIGIN = ["report_id", "source_path", "row_pos", "problem", "raw_row"]
FAILED = "failed_cells"


def checked(rows: DataFrame, loose: bool = False) -> DataFrame:
    """Cells, with a heading mismatch counted as a problem and the raw row kept for rows that have one."""
    split = cells(rows, loose=loose)
    if "header_ok" in split.columns:
        split = split.withColumn("problem", F.when(~F.col("header_ok"), "unexpected headings")
                                 .otherwise(F.col("problem")))
    return split.withColumn("raw_row", F.when(F.col("problem").isNotNull(), F.col("tr")))


def shredded(docs: DataFrame, fields: tuple[Field, ...], check_headings: bool = True, loose: bool = False, **tables) -> DataFrame:
    """``loose`` is that of ``cells``; ``tables`` are the options of ``shred_rows`` that say which tables count."""
    return checked(shred_rows(docs, fields=fields if check_headings else None, **tables), loose)


def usage_rows(split: DataFrame) -> DataFrame:
    """Typed inventory rows; a row with a problem keeps its origin and raw text and NULL columns otherwise."""
    sound = split.withColumn("cells", F.when(F.col("problem").isNull(), F.col("cells")))
    return typed(sound, USAGE_FIELDS, [c for c in ORIGIN if c in split.columns], failed=FAILED)


def read_split(spark: SparkSession, path: str | list[str], fields: tuple[Field, ...], check_headings: bool = True,
               size_limit: int = WHOLE_FILE_LIMIT, glob: str = "*.html", id_pattern: str | None = None, loose: bool = False,
               **tables) -> DataFrame:
    """Rows with cells of all files under a path; files above the limit are read row by row and give the same rows."""
    docs = read_reports(spark, path, glob, id_pattern, size_limit)
    whole = shredded(docs, fields, check_headings, loose, **tables)
    rows = read_report_rows(spark, path, id_pattern, fields if check_headings else None, glob=glob, size_above=size_limit, **tables)
    return whole.unionByName(checked(rows, loose), allowMissingColumns=True)


def load_usage(spark: SparkSession, path: str, table: str, load_id: str, location: str | None = None,
               row_keys: str | None = None, **reading) -> None:
    """Loads the reports under a path as one load. Rows of files up to the size limit are not shuffled.

    ``row_keys`` names a folder of reservations and adds a number to each row that is unique over all loads.
    """
    ensure_table(spark, table, with_key(USAGE_TABLE_DDL, row_keys), location=location)
    with scratch_scope(spark):
        rows = usage_rows(read_split(spark, path, USAGE_FIELDS, **reading))
        if row_keys:
            rows = with_row_key(rows, row_keys, ["report_id", "source_path", "row_pos"])
        replace_load(rows, table, load_id)


def with_key(ddl: str, row_keys: str | None) -> str:
    return f"{ROW_KEY} bigint, {ddl}" if row_keys else ddl


def sound_rows(table: DataFrame) -> DataFrame:
    return table.where("problem IS NULL")


def quarantined(table: DataFrame) -> DataFrame:
    """Rows that were set aside, with the reason and their raw markup."""
    return table.where("problem IS NOT NULL").select(*ORIGIN, "load_id")
