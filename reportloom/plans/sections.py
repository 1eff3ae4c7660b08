"""The fifteen report sections and the collation list, as data.

A section names its rows by priority and finding suffix, says how its document part is headed, which cells its
lines print, which typed columns it derives, and which of those it sorts by. Numbers sort downwards, text upwards.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from reportloom.functions.text import after_last, before, cast_to, digits, literal, number, shown, swap, tail, through
from reportloom.operators import derive


@dataclass(frozen=True)
class Section:
    number: int
    name: str
    priority: int
    suffix: str
    anchor: str = ""
    label: str = ""
    header: str = ""
    align: str = ""
    lead: str = "|"
    cells: Callable[[], list[str]] = list
    derived: Callable[[], dict[str, str]] = dict
    numbers: tuple[str, ...] = ()
    texts: tuple[str, ...] = ()
    data_prep: bool = False

    @property
    def heading(self) -> str:
        return f"| {self.header} |"

    @property
    def alignment(self) -> str:
        return "| " + " | ".join({"l": ":----", "r": "----:"}[a] for a in self.align) + " |"

    def line(self) -> str:
        """A Markdown table row over ``printable`` columns. A NULL cell makes the whole line NULL."""
        parts = ", ' | ', ".join(self.cells())
        return f"concat({literal(self.lead)}, {parts}, ' | ')"


PRINTED = ("database_name", "details", "definition", "usage", "size", "table_name", "object_name", "sample_plan_file")


def printable(diagnosis: DataFrame) -> DataFrame:
    """Cells as a document prints them. The two plans below read them many times, so they are settled first."""
    return diagnosis.withColumns({name: F.expr(shown(name)) for name in PRINTED})


def _many_nc():
    return ["database_name", through("definition", " "), digits(through("details", " ")), "usage", "size"]


def _keys():
    return ["database_name", through("details", " "), "definition", "secret_columns", "usage", "size"]


def _impact():
    """The percentage with its sign, between the last semicolon and the first sign after it."""
    return through(after_last("data_prep", ";"), "%")


def _missing():
    script = swap("create_tsql", " WITH (FILLFACTOR=100, ONLINE=?, SORT_IN_TEMPDB=?, DATA_COMPRESSION=?)")
    return ["database_name", "table_name", after_last("data_prep", "%"), _impact(),
            digits(before("data_prep", ";")), "size", "sample_plan_file", shown(script)]


def _heap(unit: str):
    """A heap and its count; the count keeps its blank and so closes its cell by itself."""
    heap = swap(tail("details", ":"), ".Unknown (0)")
    return ["database_name", heap, "usage", f"concat({through('details', unit)}, '|', size)"]


def _heap_count(name: str, unit: str):
    return {name: number(through("details", unit), "bigint"), "rebuild_tsql": "create_tsql"}


def _active_heaps():
    heap = swap(swap("details", "Should this table be a heap? "), ".Unknown (0)")
    return ["database_name", heap, swap("finding", "Self Loathing Indexes: "), "usage", "size"]


def _heap_nc_pk():
    return ["database_name", through("details", " "), "definition", "usage", "size"]


def _index():
    return ["database_name", "table_name", "object_name", "usage", "size", "definition"]


def _wide_indexes():
    return ["database_name", "table_name", "object_name", "usage", "size", "data_prep", "definition"]


def _wide_clustered():
    return ["database_name", "table_name", "object_name", before("data_prep", " "),
            after_last("data_prep", " "), "size", "definition"]


def _lob_columns():
    return f"if(contains(data_prep, '.'), {after_last('data_prep', '.')}, '')"


def _record_bytes():
    return before(after_last("data_prep", " "), ".")


def _wide_tables():
    return ["database_name", "table_name", before("data_prep", " "), _lob_columns(),
            f"concat(' ', {_record_bytes()})", "usage", "size"]


def _nulls():
    return ["database_name", "table_name", after_last("data_prep", " "), before("data_prep", " "), "usage", "size"]


# Priorities, suffixes, anchors, labels, headings and alignments of the findings document.
SECTIONS = (
    Section(1, "many_nc", 10, "Many NC Indexes on a Single Table", "manyncix", "Many NC Indexes on a Single Table",
            "DatabaseName | TableName | NCIndexCount | Usage | Size", "llllr", cells=_many_nc,
            derived=lambda: {"nc_indexes_count": number(through("details", " "), "int")},
            numbers=("nc_indexes_count",)),
    Section(2, "duplicate_keys", 20, "duplicate keys", "dupekeys", "Duplicate keys",
            "DatabaseName | IndexName | Definition | SecretColumns | Usage | Size", "lllllr", cells=_keys,
            texts=("database_name", "details")),
    Section(3, "borderline_keys", 30, "Borderline duplicate keys", "approxdupekeys", "Approximate duplicate keys",
            "DatabaseName | IndexName | Definition | SecretColumns | Usage | Size", "lllllr", cells=_keys,
            texts=("database_name", "details")),
    Section(4, "missing_index", 50, derive.MISSING_INDEX, "missingix", "High Value Missing Index",
            "Database | Table | Avg Query Cost | Potential Improvement | UsageCount | Size | Sample Plan | CreateTSQL",
            "llrrrrll", " | ", _missing,
            lambda: {"usage_count": number(before("data_prep", ";"), "bigint"),
                     "impact_pct": cast_to(before(after_last("data_prep", ";"), "%"), "decimal(4,1)"),
                     "avg_query_cost": cast_to(after_last("data_prep", "%"), "decimal(20,4)")},
            numbers=("avg_query_cost", "impact_pct", "usage_count"), data_prep=True),
    Section(5, "forwarded_fetches", 100, "Heaps with Forwarded Fetches", "fwdfetch", "Heaps with Forwarded Fetches",
            "DatabaseName | HeapName | Usage | ForwardedFetches/Day | Size", "lllrr", cells=lambda: _heap(" f"),
            derived=lambda: _heap_count("forwarded_fetches_count", " f"), numbers=("forwarded_fetches_count",)),
    Section(6, "heap_deletes", 200, "Heaps with Deletes", "heapsdel", "Heaps with Deletes",
            "Database | Table | Usage | Deletes | Size", "lllrr", cells=lambda: _heap(" d"),
            derived=lambda: _heap_count("deletes_count", " d"), numbers=("deletes_count",)),
    Section(7, "active_heaps", 100, "active heap", "activeheaps", "Active Heaps",
            "DatabaseName | HeapName | Finding | Usage | Size", "llllr", cells=_active_heaps,
            texts=("finding", "database_name")),
    Section(8, "heap_nc_pk", 100, "Heap with a Nonclustered Primary Key", "heapswithncpk",
            "Heap with a Nonclustered Primary Key", "Database | Table & PKName | Definition | Usage | Size", "llllr",
            cells=_heap_nc_pk),
    Section(9, "nc_high_writes", 100, "NC index with High Writes:Reads", "nchighwr",
            "NC index with High Writes:Reads", "Database | Table | Index | Usage | Size | Definition", "llllrl",
            " | ", _index),
    Section(10, "wide_indexes", 150, derive.WIDE_INDEXES, "wideix", "Wide Indexes (7 or More Columns)",
            "Database | Table | Index | Usage | Size | Columns | Definition", "llllrll", cells=_wide_indexes,
            derived=lambda: {"cols": cast_to("data_prep", "int")}, numbers=("cols",)),
    Section(11, "wide_clustered", 150, derive.WIDE_CLUSTERED, "widecx",
            "Wide Clustered Index (> 3 columns OR > 16 bytes)",
            "Database | Table | CXName | KeyColumns | KeyColPotentialSize(Bytes) | Size | Definition", "lllrrrl",
            cells=_wide_clustered,
            derived=lambda: {"cx_max_bytes": cast_to(after_last("data_prep", " "), "int")},
            numbers=("cx_max_bytes",)),
    Section(12, "unindexed_fk", 150, derive.UNINDEXED_KEYS, "noixfk", "Unindexed Foreign Keys",
            "Database Name | FKMissingIndex", "ll", cells=lambda: ["database_name", "details"],
            texts=("database_name",)),
    Section(13, "wide_tables", 150, derive.WIDE_TABLES, "widetab", "Wide Tables: 35+ cols or > 2000 non-LOB bytes",
            "Database | Table | Total Columns | LOB Columns | Max Possible Bytes/Record | Usage | Size", "llllrlr",
            cells=_wide_tables,
            derived=lambda: {"total_columns": cast_to(before("data_prep", " "), "int"),
                             "lob_columns": _lob_columns(),
                             "max_possible_bytes_per_record": cast_to(_record_bytes(), "bigint")},
            numbers=("max_possible_bytes_per_record",), texts=("database_name",), data_prep=True),
    Section(14, "addicted_to_nulls", 200, derive.ADDICTED_TO_NULLS, "manynulls",
            "Tables with a high NULLable column ratio",
            "Database | Table | Total Columns | NULLable Columns | Usage | Size", "llrrlr", cells=_nulls,
            derived=lambda: {"total_columns": cast_to(after_last("data_prep", " "), "int"),
                             "nullable_columns": cast_to(before("data_prep", " "), "int")},
            numbers=("nullable_columns",), texts=("database_name",), data_prep=True),
    Section(15, "non_unique_cx", 150, "Non-Unique Clustered Index", "nonuqcix", "Non-Unique Clustered Index",
            "Database | Table | Index | Usage | Size | Definition", "llllrl", " | ", _index),
)
COLLATION = Section(16, "collation", 150, "Column Collation Does Not Match Database Collation")
BY_NAME = {section.name: section for section in (*SECTIONS, COLLATION)}

OVERFLOW_ROWS = 10


def overflow_text(section: Section) -> str:
    """The jump target and link of a section that is too long to be read in place, on one line."""
    return (" - Results with more than 10 records can be found in the second half of this document, click "
            f"[here](#{section.anchor}) to jump to the list. <a name=\"{section.anchor}\"></a> {section.label}")
