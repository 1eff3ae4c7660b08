"""Which report section a diagnosis row or a catalog row belongs to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reportloom.functions.text import ends_with, literal
from reportloom.plans.sections import COLLATION, SECTIONS, Section

ALL_SECTIONS = (*SECTIONS, COLLATION)


def section_table(spark, sections: Sequence[Section] = ALL_SECTIONS) -> DataFrame:
    """``section, section_no, section_priority, suffix``: one row per section, written in the query itself."""
    rows = ", ".join(f"({literal(s.name)}, {s.number}, {s.priority}, {literal(s.suffix.lower())})" for s in sections)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS s(section, section_no, section_priority, suffix)")


def in_section(section: Section) -> Column:
    """The section's own predicate; its priority half reaches the scan."""
    return F.expr(f"priority = {section.priority} AND {ends_with('finding', section.suffix)}")


def classify(df: DataFrame, sections: Sequence[Section] = ALL_SECTIONS) -> DataFrame:
    """Adds ``section`` and ``section_no`` and drops rows that no section reports.

    The section side has one row per section, sixteen at most, so it is always broadcast: priority is the hash key
    and the suffix is checked on the few sections that share it.
    """
    table = section_table(df.sparkSession, sections)
    matched = F.expr("priority = section_priority AND endswith(lower(finding), suffix)")
    return df.join(F.broadcast(table), matched).drop("section_priority", "suffix")
