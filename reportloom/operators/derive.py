"""Fields hidden in the free text of diagnosis rows: table and object names, counts and sizes."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from reportloom.functions.text import before, drop, ends_with, extract, literal, rewrite, starts_with, swap

# The phrases of the report's sentences, and the finding titles that tell which sentence a row holds.
WIDE_TABLES = "Wide Tables: 35+ cols or > 2000 non-LOB bytes"
ADDICTED_TO_NULLS = "Addicted to Nulls"
WIDE_CLUSTERED = "Wide Clustered Index (> 3 columns OR > 16 bytes)"
MISSING_INDEX = "High Value Missing Index"
WIDE_INDEXES = "Wide Indexes (7 or More Columns)"
UNINDEXED_KEYS = "Unindexed Foreign Keys"
CREATED_INDEX = r"^CREATE [A-Z ]*INDEX \[([^\]]*)\]"
ADDED_CONSTRAINT = r"^ALTER .*? ADD CONSTRAINT \[([^\]]*)\]"
FOREIGN_KEY = r"^Foreign key \[([^\]]*)\]"
FOREIGN_KEY_TABLE = r"^Foreign key \[[^\]]*\] on \[(.*?)\](?:\s|$)"

# Words that a sentence drops, one pass each; a bracketed group is what stays of its match.
WIDE_TABLE_WORDS = r" total columns with a max possible width of| bytes(?:(\.) )?| columns are LOB types\.$"
NULLS_WORDS = r" columns\.| of( )"
WIDE_CLUSTERED_WORDS = r" bytes in clustered index| columns with potential size of( )"
MISSING_INDEX_WORDS = r" uses?(;)| Impact: |(%);| Avg query cost: "


def table_name(more_info: str = "more_info", database: str = "database_name") -> str:
    """``schema.table`` out of the call that shows more about a table, whichever procedure it calls.

    The call names the row's own database, so the text to cut at is built per row. Where the database differs the
    call's start stays in place.
    """
    marker = f"concat({literal("@DatabaseName='")}, {database}, {literal("', @SchemaName='")})"
    at = f"locate(lower({marker}), lower({more_info}))"
    called = f"{starts_with(more_info, 'EXEC dbo.')} AND {at} > 0"
    rest = f"if({called}, substring({more_info}, {at} + length({marker})), {more_info})"
    named = drop(swap(rest, "', @TableName='", "."), literal("';"))
    return f"if({database} IS NULL, NULL, {named})"


def data_prep(finding: str) -> str:
    """The numbers of a sentence without the words around them; empty where a finding has no such sentence.

    ``finding`` is in lower case here and in the functions below.
    """
    sized = rewrite(drop("details", "concat(table_name, ' has ')"), WIDE_TABLE_WORDS, "$1")
    nulls = drop("details", "concat(table_name, ' allows null in ')")
    return f"""CASE
        WHEN {ends_with(finding, WIDE_TABLES, True)}
            THEN if({ends_with("details", "LOB types.")}, {sized}, {drop(sized, "'.'")})
        WHEN {ends_with(finding, ADDICTED_TO_NULLS, True)} THEN {rewrite(nulls, NULLS_WORDS, "$1")}
        WHEN {ends_with(finding, WIDE_CLUSTERED, True)}
            THEN {rewrite(before("details", ":"), WIDE_CLUSTERED_WORDS, "$1")}
        WHEN priority = 50 AND {ends_with(finding, MISSING_INDEX, True)}
            THEN {rewrite("usage", MISSING_INDEX_WORDS, "$1$2")}
        WHEN priority = 150 AND {ends_with(finding, WIDE_INDEXES, True)} THEN {before("details", " ")}
        ELSE '' END"""


def object_name(finding: str) -> str:
    """Index, constraint or foreign key name, read up to its closing bracket so that blanks stay in it."""
    return f"""CASE
        WHEN {starts_with("create_tsql", "CREATE")} THEN {extract("create_tsql", CREATED_INDEX)}
        WHEN create_tsql ILIKE 'ALTER%CONSTRAINT%' THEN {extract("create_tsql", ADDED_CONSTRAINT)}
        WHEN {ends_with(finding, UNINDEXED_KEYS, True)} THEN {extract("details", FOREIGN_KEY)}
        ELSE '' END"""


def foreign_key_table(finding: str) -> str:
    """Foreign key findings carry no call to read the table from; their sentence names it."""
    of_key = ends_with(finding, UNINDEXED_KEYS, True)
    return f"""CASE
        WHEN {of_key} AND table_name = '' THEN {drop(extract("details", FOREIGN_KEY_TABLE), "']'")}
        WHEN {of_key} AND contains(table_name, ']') THEN {drop(before("table_name", " "), "']'")}
        ELSE table_name END"""


def heap_title(finding: str) -> str:
    """Spells ``Active Heap`` one way."""
    heap = f"priority = 100 AND {ends_with(finding, 'active heap', True)}"
    return f"if({heap}, {swap('finding', 'Active heap', 'Active Heap')}, finding)"


class Sentence(NamedTuple):
    """A whole sentence: the rows that should hold it, the column it is in, its pattern, and what is taken out of it."""
    name: str
    where: str
    column: str
    pattern: str
    value: str = ""


def sentences(finding: str) -> tuple[tuple[Sentence, ...], ...]:
    """What each derived field is read from: ``data_prep``, ``object_name`` and ``table_name``."""
    ends = lambda title: ends_with(finding, title, True)
    count = "([0-9][0-9,]*)"
    created, altered = starts_with("create_tsql", "CREATE"), "create_tsql ILIKE 'ALTER%CONSTRAINT%'"
    return (
        (Sentence("wide_tables", ends(WIDE_TABLES), "details",
                  rf"^.+ has {count} total columns with a max possible width of {count} bytes(?:(\.[0-9][0-9,]*) columns are LOB types)?\.$", "$1 $2$3"),
         Sentence("addicted_to_nulls", ends(ADDICTED_TO_NULLS), "details", rf"^.+ allows null in {count} of {count} columns\.$", "$1 $2"),
         Sentence("wide_clustered", ends(WIDE_CLUSTERED), "details", rf"^{count} columns with potential size of {count} bytes in clustered index:.+$", "$1 $2"),
         Sentence("missing_index", f"priority = 50 AND {ends(MISSING_INDEX)}", "usage",
                  rf"^{count} uses?; Impact: ([0-9.]+%); Avg query cost: ([0-9.,]+)$", "$1;$2$3"),
         Sentence("wide_indexes", f"priority = 150 AND {ends(WIDE_INDEXES)}", "details", rf"^{count} columns? on .+$", "$1")),
        (Sentence("created_index", created, "create_tsql", CREATED_INDEX + ".*$", "$1"),
         Sentence("added_constraint", f"NOT {created} AND {altered}", "create_tsql", ADDED_CONSTRAINT + ".*$", "$1"),
         Sentence("foreign_key", f"NOT {created} AND NOT {altered} AND {ends(UNINDEXED_KEYS)}", "details",
                  r"^Foreign key \[([^\]]+)\] on \[.+?\](?:\s.*)?$", "$1")),
        (Sentence("table_call", starts_with("more_info", "EXEC dbo."), "more_info",
                  r"^EXEC dbo\.\S+ @DatabaseName='.*', @SchemaName='(.*?)', @TableName='(.*)';$", "$1.$2"),
         Sentence("foreign_key_table", f"more_info = '' AND {ends(UNINDEXED_KEYS)}", "details", r"^Foreign key \[[^\]]+\] on \[(.+?)\](?:\s.*)?$", "$1")))


def _matches(sentence: Sentence) -> str:
    return f"coalesce({sentence.column} RLIKE {literal('(?is)' + sentence.pattern)}, false)"


def read_sentences(diagnosis: DataFrame, unread: str) -> DataFrame:
    """Like ``derive``, but every field comes out of a whole sentence or stays empty.

    ``unread`` names a column for the sentences that a row should hold and does not: words that a rule would leave over are
    no value, and such rows can be found. A NULL sentence counts as not held. A table's name is the one its call gives.
    """
    fields = ("data_prep", "object_name", "table_name")
    found = diagnosis.withColumn("_finding", F.lower("finding"))
    groups = sentences("_finding")
    value = lambda s: f"WHEN {s.where} THEN if({_matches(s)}, regexp_replace({s.column}, {literal('(?is)' + s.pattern)}, {literal(s.value)}), '')"
    columns = {name: F.expr(f"CASE {' '.join(map(value, group))} ELSE '' END") for name, group in zip(fields, groups, strict=True)}
    marks = ", ".join(f"if(coalesce({s.where}, false) AND NOT {_matches(s)}, {literal(s.name)}, NULL)" for group in groups for s in group)
    return (found.withColumns({**columns, unread: F.expr(f"array_compact(array({marks}))")})
            .withColumn("finding", F.expr(heap_title("_finding"))).drop("_finding"))


def derive(diagnosis: DataFrame) -> DataFrame:
    """Adds ``table_name``, ``data_prep`` and ``object_name`` and evens out ``finding``. Narrow: projections only.

    The lower-case finding is computed once, in a projection of its own, for the many suffixes it is tested for.
    """
    return (
        diagnosis
        .withColumns({"table_name": F.expr(table_name()), "_finding": F.lower("finding")})
        .withColumns({name: F.expr(rule("_finding")) for name, rule in (
            ("data_prep", data_prep), ("object_name", object_name), ("table_name", foreign_key_table),
            ("finding", heap_title))})
        .drop("_finding"))
