"""The findings document: a heading block per report and section, then one line per finding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reportloom.functions.text import drop, literal, swap, through
from reportloom.operators.classify import classify, in_section
from reportloom.plans.sections import COLLATION, OVERFLOW_ROWS, SECTIONS, Section, overflow_text, printable

TITLE, TEXT, ANCHOR, HEADER, ALIGN = -6, -5, -4, -3, -2
NUMBER = "decimal(23,4)"  # holds any bigint and every derived decimal
NUMBERS, TEXTS = ("n1", "n2", "n3"), ("s1", "s2")
REPORT_COLUMNS = ["report_id", "section_no", "section", "priority", *NUMBERS, *TEXTS, "id", "markdown_info"]
BASE_COLUMNS = ["finding", "database_name", "details", "definition", "secret_columns", "usage", "size",
                "create_tsql"]


def report_order() -> list[Column]:
    """A total order over the lines of all reports: numbers downwards, text upwards whatever its case, then the row's id."""
    return [F.asc("report_id"), F.asc("section_no"), F.asc("priority"), *[F.desc(n) for n in NUMBERS],
            *[F.lower(s).asc() for s in TEXTS], *[F.asc(s) for s in TEXTS], F.asc("id")]


def section_counts(diagnosis: DataFrame, sections: Sequence[Section] = SECTIONS) -> DataFrame:
    """``report_id, section_no, section, n`` for the sections a report has; combined before its one shuffle."""
    return (classify(diagnosis.select("report_id", "priority", "finding"), sections)
            .groupBy("report_id", "section_no", "section").agg(F.count(F.lit(1)).alias("n")))


def section_titles(catalog: DataFrame, sections: Sequence[Section] = SECTIONS) -> DataFrame:
    """``section, titles``: the distinct title and description pairs of the catalog rows a section stands for.

    One row per section; how it is joined is left to Spark, which knows the catalog's size.
    """
    pair = F.struct("short_title", "description")
    return classify(catalog, sections).groupBy("section").agg(F.sort_array(F.collect_set(pair)).alias("titles"))


def _by_section(sections: Sequence[Section], value) -> str:
    return "CASE section " + " ".join(f"WHEN {literal(s.name)} THEN {value(s)}" for s in sections) + " END"


def preamble(counts: DataFrame, catalog: DataFrame, sections: Sequence[Section] = SECTIONS) -> DataFrame:
    """Title, description, overflow anchor, heading and alignment of every section a report has.

    A section without catalog rows keeps its last three lines.
    """
    def line(priority: int, text: str) -> str:
        return f"named_struct('priority', {priority}, 'markdown_info', {text})"

    anchor = f"if(n > {OVERFLOW_ROWS}, {_by_section(sections, lambda s: literal(overflow_text(s)))}, '')"
    fixed = [line(ANCHOR, anchor), line(HEADER, _by_section(sections, lambda s: literal(s.heading))),
             line(ALIGN, _by_section(sections, lambda s: literal(s.alignment)))]
    titles = "coalesce(titles, array())"
    lines = F.expr(f"concat(transform({titles}, t -> {line(TITLE, "concat(' ', t.short_title)")}), "
                   f"transform({titles}, t -> {line(TEXT, 't.description')}), array({', '.join(fixed)}))")
    joined = counts.join(section_titles(catalog, sections), "section", "left")
    return joined.select("report_id", "section_no", "section", F.inline(lines))


def data_lines(diagnosis: DataFrame, sections: Sequence[Section] = SECTIONS) -> DataFrame:
    """One Markdown line per finding with the section's sort keys, in one projection over one scan."""
    def key(names: str, index: int, type_: str) -> str:
        used = [s for s in sections if len(getattr(s, names)) > index]
        if not used:
            return f"CAST(NULL AS {type_})"
        return f"CAST({_by_section(used, lambda s: _column(s, getattr(s, names)[index]))} AS {type_})"

    keys = [f"{key('numbers', i, NUMBER)} AS {name}" for i, name in enumerate(NUMBERS)]
    keys += [f"{key('texts', i, 'string')} AS {name}" for i, name in enumerate(TEXTS)]
    return printable(classify(diagnosis, sections)).selectExpr(
        "report_id", "section_no", "section", "priority", *keys, "CAST(id AS bigint) AS id",
        f"{_by_section(sections, lambda s: s.line())} AS markdown_info")


def _column(section: Section, name: str) -> str:
    """A sort column, numbers at the one scale that all sections share."""
    column = section.derived().get(name, name)
    return f"CAST({column} AS {NUMBER})" if name in section.numbers else column


def findings_report(diagnosis: DataFrame, catalog: DataFrame, sections: Sequence[Section] = SECTIONS) -> DataFrame:
    """All lines of all reports, unordered; sort by ``report_order()`` to read them.

    ``diagnosis`` is a prepared table with an ``id`` that is unique within a report.
    """
    head = preamble(section_counts(diagnosis, sections), catalog, sections)
    blanks = {**{n: F.lit(None).cast(NUMBER) for n in NUMBERS}, **{s: F.lit(None).cast("string") for s in TEXTS},
              "id": F.lit(None).cast("bigint")}
    return (head.withColumns(blanks).select(*REPORT_COLUMNS)
            .unionByName(data_lines(diagnosis, sections).select(*REPORT_COLUMNS)))


def section_report(diagnosis: DataFrame, catalog: DataFrame, section: Section) -> DataFrame:
    """One section with its data columns: heading lines carry empty text and NULL numbers.

    The section's own predicate filters the scan, so no classification join is needed.
    """
    rows = diagnosis.where(in_section(section))
    derived = section.derived()
    base = [c for c in BASE_COLUMNS if not (c == "create_tsql" and "rebuild_tsql" in derived)]
    base += ["data_prep"] if section.data_prep else []
    data = printable(rows.withColumn("_cells", F.struct(*base))).selectExpr(
        "report_id", "priority", "_cells.*", *[f"{rule} AS {name}" for name, rule in derived.items()],
        "CAST(id AS bigint) AS id", f"{section.line()} AS markdown_info")
    counts = (rows.groupBy("report_id").agg(F.count(F.lit(1)).alias("n"))
              .select("report_id", F.lit(section.number).alias("section_no"), F.lit(section.name).alias("section"),
                      "n"))
    texts = {name: F.lit("") for name in base} | ({"rebuild_tsql": F.lit("")} if "rebuild_tsql" in derived else {})
    head = preamble(counts, catalog, [section]).withColumns(texts)
    return head.drop("section_no", "section").unionByName(data, allowMissingColumns=True).select(*data.columns)


def section_order(section: Section) -> list[Column]:
    """Text whatever its case first, as in ``report_order``."""
    return [F.asc("report_id"), F.asc("priority"), *[F.desc(n) for n in section.numbers],
            *[F.lower(s).asc() for s in section.texts], *[F.asc(s) for s in section.texts], F.asc("id")]


def collation_rows(diagnosis: DataFrame) -> DataFrame:
    """Columns whose collation differs from their database's: a plain list without heading lines."""
    return diagnosis.where(in_section(COLLATION)).selectExpr(
        "report_id", f"{swap('finding', 'Abnormal Psychology: ')} AS finding", "database_name", "details",
        "secret_columns", "usage", f"{drop(through('size', ' '), "','")} AS num_rows", "replace(size, ',', '') AS size",
        "definition")
