"""From diagnosis report files to the prepared diagnosis table and its findings documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reportloom.functions.text import starts_with
from reportloom.operators.derive import derive, read_sentences
from reportloom.operators.markup import typed
from reportloom.operators.numbering import with_row_id
from reportloom.operators.report import findings_report, report_order
from reportloom.plans.usage import FAILED, ORIGIN, read_split, with_key
from reportloom.schema import DIAGNOSIS_FIELDS, DIAGNOSIS_TABLE_DDL
from reportloom.sources.catalog import load_catalog
from reportloom.sources.identity import with_row_key
from reportloom.sources.markdown import write_markdown, write_packed
from reportloom.sources.scratch import materialise, scratch_scope
from reportloom.sources.tables import ensure_table, replace_load


def diagnosis_rows(split: DataFrame, databases: str | None = None) -> DataFrame:
    """Typed rows with empty text kept. ``databases`` keeps databases whose name starts so, and all problem rows."""
    sound = split.withColumn("cells", F.when(F.col("problem").isNull(), F.col("cells")))
    rows = typed(sound, DIAGNOSIS_FIELDS, [c for c in ORIGIN if c in split.columns], empty_as_null=False, failed=FAILED)
    if databases is None:
        return rows
    return rows.where(f"{starts_with('database_name', databases)} OR problem IS NOT NULL")


def prepared(rows: DataFrame, unread: str | None = None) -> DataFrame:
    """Derived fields, by whole sentences if ``unread`` names a column for those that were not held, and a number per report in priority and finding order, ties in document order.

    The number follows the findings as the report spells them, before ``Active Heap`` is evened out. Rows with a
    problem sort behind the sound ones and get none.
    """
    numbered = with_row_id(rows, within=["report_id"], order=["problem", "priority", "finding"],
                           position=["source_path", "row_pos"])
    numbered = numbered.withColumn("id", F.when(F.col("problem").isNull(), F.col("id")))
    return read_sentences(numbered, unread) if unread else derive(numbered)


def load_diagnosis(spark: SparkSession, path: str, table: str, load_id: str, databases: str | None = None,
                   location: str | None = None, row_keys: str | None = None, unread: str | None = None, **reading) -> None:
    """Loads the reports under a path as one load; ``row_keys`` as in ``load_usage``, ``unread`` as in ``prepared``.

    The typed rows are written once: numbering needs them twice, and markup should be read and parsed once only.
    """
    ddl = f"{unread} array<string>, {DIAGNOSIS_TABLE_DDL}" if unread else DIAGNOSIS_TABLE_DDL
    ensure_table(spark, table, with_key(ddl, row_keys), location=location)
    with scratch_scope(spark):
        rows = prepared(materialise(diagnosis_rows(read_split(spark, path, DIAGNOSIS_FIELDS, **reading), databases)), unread)
        if row_keys:
            rows = with_row_key(rows, row_keys, ["report_id", "id", "source_path", "row_pos"])
        replace_load(rows, table, load_id)


def per_load(diagnosis: DataFrame) -> DataFrame:
    """A loaded table whose reports are named ``load/report``, since row numbers are only unique within a load."""
    return diagnosis.withColumn("report_id", F.concat_ws("/", "load_id", "report_id"))


def write_findings(diagnosis: DataFrame, path: str, catalog: DataFrame | None = None, packed: bool = False) -> None:
    """Writes the findings documents of a loaded table: one for each report and load, or each report if it has no loads.

    A folder for each, or, if ``packed``, many in a file with an index, which suits many reports.
    """
    if "load_id" in diagnosis.columns:
        diagnosis = per_load(diagnosis)
    report = findings_report(diagnosis, load_catalog(diagnosis.sparkSession) if catalog is None else catalog)
    (write_packed if packed else write_markdown)(report, path, report_order())
