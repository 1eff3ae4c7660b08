"""The same results as SQL on the driver's tables.

Derived values come from the whole numbers ``k, kind, n1, n2``, never from parsing the sentences again.
"""

from __future__ import annotations

from checks.fixtures import CELL_VALUE, DIAGNOSIS_SQL, PAGE_KEYS, USAGE_KEYS, usage_cell
from checks.queries import NUMERIC, USAGE_COLUMNS
from reportloom.plans.sections import SECTIONS, overflow_text
from reportloom.schema import DIAGNOSIS_FIELDS, USAGE_FIELDS
from reportloom.sources.catalog import CATALOG


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


DIAGNOSIS = DIAGNOSIS_SQL.format(orders="orders")
D = f"with d as ({DIAGNOSIS})"
CELLS = ", ".join(f.name for f in DIAGNOSIS_FIELDS)
TABLE_SHOWN = "'dbo.T' || k"
PREP = """case kind when 3 then '1,' || (100 + n1) || ';' || n1 || '.' || (n2 % 10) || '%' || n2 || '.1234'
  when 9 then '' || n1 when 10 then n1 || ' ' || n2
  when 12 then n1 || ' ' || (n2 * 100) || case when n1 % 2 = 0 then '.' || (n1 % 7) else '' end
  when 13 then n1 || ' ' || (n1 + n2) else '' end"""
OBJECT = "case kind when 10 then 'pk' || k when 11 then 'fk' || k else 'ix' || k end"
HEAP = "case n1 % 3 when 0 then 'Large' when 1 then 'Medium' else 'Small' end || ' Active Heap'"
FINDING = f"case when kind = 6 then 'Self Loathing Indexes: ' || {HEAP} else finding end"

# Which kind of row each section reports: the sections and the kinds are numbered alike, from one and from zero.
KINDS = {section.name: section.number - 1 for section in SECTIONS}
NAMED = "case kind " + " ".join(f"when {kind} then '{name}'" for name, kind in KINDS.items()) + " end"
NUMBERED = "case kind " + " ".join(f"when {KINDS[s.name]} then {s.number}" for s in SECTIONS) + " end"

DB = "case when database_name = '' then 'x' else database_name end"
_U, _S = "usage", "size"
_FULL_INDEX = f"' | ' || {DB} || ' | dbo.T' || k || ' | ix' || k || ' | ' || {_U} || ' | ' || {_S} || ' | ' || definition || ' | '"
_KEYS = f"'|' || {DB} || ' | dbo.T' || k || '.ix' || k || '  | ' || definition || ' | ' || secret_columns || ' | ' || {_U} || ' | ' || {_S} || ' | '"
LINES = {
    "many_nc": f"'|' || {DB} || ' | dbo.T' || k || '  | 1' || (100 + n1) || ' | ' || usage || ' | ' || size || ' | '",
    "duplicate_keys": _KEYS,
    "borderline_keys": _KEYS,
    "missing_index": f"' | ' || {DB} || ' | dbo.T' || k || ' | ' || n2 || '.1234 | ' || n1 || '.' || (n2 % 10) || '% | 1' || (100 + n1) || ' | ' || size || ' | plan_' || k || '.sqlplan | CREATE ' || case when n1 % 2 = 0 then 'UNIQUE ' else '' end || 'INDEX [ix' || k || '] ON [' || database_name || '].[dbo].[T' || k || '] ([a]); | '",
    "forwarded_fetches": f"'|' || {DB} || ' | dbo.T' || k || ' | ' || usage || ' | 2,' || (100 + n1) || ' |' || size || ' | '",
    "heap_deletes": f"'|' || {DB} || ' | dbo.T' || k || ' | ' || usage || ' | 3,' || (100 + n1) || ' |' || size || ' | '",
    "active_heaps": f"'|' || {DB} || ' | dbo.T' || k || ' | ' || {HEAP} || ' | ' || usage || ' | ' || size || ' | '",
    "heap_nc_pk": f"'|' || {DB} || ' | dbo.T' || k || '.ix' || k || '  | ' || definition || ' | ' || usage || ' | ' || size || ' | '",
    "nc_high_writes": _FULL_INDEX,
    "wide_indexes": f"'|' || {DB} || ' | dbo.T' || k || ' | ix' || k || ' | ' || usage || ' | ' || size || ' | ' || n1 || ' | ' || definition || ' | '",
    "wide_clustered": f"'|' || {DB} || ' | dbo.T' || k || ' | pk' || k || ' | ' || n1 || ' | ' || n2 || ' | ' || size || ' | ' || definition || ' | '",
    "unindexed_fk": f"'|' || {DB} || ' | Foreign key [fk' || k || '] on [dbo.T' || k || '] has no supporting index. | '",
    "wide_tables": f"'|' || {DB} || ' | dbo.T' || k || ' | ' || n1 || ' | ' || case when n1 % 2 = 0 then '' || (n1 % 7) else '' end || ' |  ' || (n2 * 100) || ' | ' || usage || ' | ' || size || ' | '",
    "addicted_to_nulls": f"'|' || {DB} || ' | dbo.T' || k || ' | ' || (n1 + n2) || ' | ' || n1 || ' | ' || usage || ' | ' || size || ' | '",
    "non_unique_cx": _FULL_INDEX,
}
DERIVED = {
    "many_nc": {"nc_indexes_count": "cast(1100 + n1 as integer)"},
    "missing_index": {"usage_count": "1100 + n1",
                      "impact_pct": "cast(cast(n1 * 10 + n2 % 10 as decimal(18,0)) * 0.1 as decimal(4,1))",
                      "avg_query_cost": "cast(cast(n2 * 10000 + 1234 as decimal(18,0)) * 0.0001 as decimal(20,4))"},
    "forwarded_fetches": {"forwarded_fetches_count": "2100 + n1", "rebuild_tsql": "create_tsql"},
    "heap_deletes": {"deletes_count": "3100 + n1", "rebuild_tsql": "create_tsql"},
    "wide_indexes": {"cols": "cast(n1 as integer)"},
    "wide_clustered": {"cx_max_bytes": "cast(n2 as integer)"},
    "wide_tables": {"total_columns": "cast(n1 as integer)",
                    "lob_columns": "case when n1 % 2 = 0 then '' || (n1 % 7) else '' end",
                    "max_possible_bytes_per_record": "n2 * 100"},
    "addicted_to_nulls": {"total_columns": "cast(n1 + n2 as integer)", "nullable_columns": "cast(n1 as integer)"},
}
PREPARED = ("missing_index", "wide_tables", "addicted_to_nulls")
NUMBER_KEYS = {"many_nc": ["1100 + n1"], "missing_index": ["n2 * 10000 + 1234", "n1 * 10 + n2 % 10", "1100 + n1"],
               "forwarded_fetches": ["2100 + n1"], "heap_deletes": ["3100 + n1"], "wide_indexes": ["n1"],
               "wide_clustered": ["n2"], "wide_tables": ["n2 * 100"], "addicted_to_nulls": ["n1"]}
NUMBER_SCALES = {"missing_index": ["0.0001", "0.1", "1"]}
TEXT_KEYS = {"duplicate_keys": [DB, "details"], "borderline_keys": [DB, "details"],
             "active_heaps": [FINDING, DB], "unindexed_fk": [DB],
             "wide_tables": [DB], "addicted_to_nulls": [DB]}


def _titles(name: str) -> list[tuple[str, str]]:
    section = next(s for s in SECTIONS if s.name == name)
    return sorted({(title, text) for priority, finding, _, title, text in CATALOG
                   if priority == section.priority and finding.lower().endswith(section.suffix.lower())})


def _preamble(counts: str) -> str:
    """Heading lines of the sections in ``counts(report_id, section, n)``."""
    values = []
    for s in SECTIONS:
        for title, text in _titles(s.name):
            values += [(s.name, s.number, -6, " " + title, False), (s.name, s.number, -5, text, False)]
        values += [(s.name, s.number, -4, overflow_text(s), True), (s.name, s.number, -3, s.heading, False),
                   (s.name, s.number, -2, s.alignment, False)]
    rows = ", ".join(f"('{a}', {b}, {p}, {quoted(t)}, {'true' if o else 'false'})" for a, b, p, t, o in values)
    return (f"select c.report_id, cast(l.section_no as integer) as section_no, l.section, l.priority, "
            f"case when l.overflow and c.n <= 10 then '' else l.line end as markdown_info "
            f"from {counts} c join (values {rows}) l(section, section_no, priority, line, overflow) "
            f"on c.section = l.section")


def _case(by_name: dict[str, str], otherwise: str = "null") -> str:
    whens = " ".join(f"when {KINDS[name]} then {value}" for name, value in by_name.items())
    return f"case kind {whens} else {otherwise} end"


def _key(keys: dict[str, list[str]], index: int, scaled: bool = False) -> str:
    found = {}
    for name, values in keys.items():
        if len(values) > index:
            scale = NUMBER_SCALES.get(name, ["1"] * 3)[index]
            found[name] = (f"cast(cast({values[index]} as decimal(18,0)) * {scale} as decimal(23,4))" if scaled
                           else values[index])
    if not found:
        return f"cast(null as {'decimal(23,4)' if scaled else 'varchar'})"
    return _case(found)


COUNTS = f"(select report_id, {NAMED} as section, count(*) as n from d where kind < 15 group by all)"
REPORT = (
    f"select report_id, section_no, section, priority, cast(null as decimal(23,4)) as n1, "
    f"cast(null as decimal(23,4)) as n2, cast(null as decimal(23,4)) as n3, cast(null as varchar) as s1, "
    f"cast(null as varchar) as s2, cast(null as bigint) as id, markdown_info from ({_preamble(COUNTS)}) "
    f"union all select report_id, {NUMBERED}, {NAMED}, priority, {_key(NUMBER_KEYS, 0, True)}, "
    f"{_key(NUMBER_KEYS, 1, True)}, {_key(NUMBER_KEYS, 2, True)}, {_key(TEXT_KEYS, 0)}, {_key(TEXT_KEYS, 1)}, k, "
    f"{_case(LINES)} from d where kind < 15")
LINE_ORDER = ("section_no, priority, n1 desc nulls last, n2 desc nulls last, n3 desc nulls last, lower(s1) nulls first, "
              "lower(s2) nulls first, s1 nulls first, s2 nulls first, id nulls first")


def section_sql(name: str) -> str:
    derived, kind = DERIVED.get(name, {}), KINDS[name]
    base = {"finding": FINDING if name == "active_heaps" else "finding"}
    base |= {c: c for c in ("database_name", "details", "definition", "secret_columns", "usage", "size")}
    if "rebuild_tsql" not in derived:
        base["create_tsql"] = "create_tsql"
    if name in PREPARED:
        base["data_prep"] = PREP
    data = ", ".join(f"{v} as {c}" for c, v in (base | derived).items())
    blank = ", ".join(f"'' as {c}" if c in base or c == "rebuild_tsql" else f"null as {c}" for c in base | derived)
    return (f"{D} select report_id, priority, {data}, k as id, {LINES[name]} as markdown_info from d "
            f"where kind = {kind} union all select report_id, priority, {blank}, null, markdown_info "
            f"from ({_preamble(COUNTS)}) where section = '{name}'")


def _usage_sql(columns: str, tail: str = "") -> str:
    values = ", ".join(f"{usage_cell(f, CELL_VALUE)} as {f.name}" for f in USAGE_FIELDS if f.kept)
    return (f"with o as (select o_orderkey as k, cast(o_orderdate as timestamp) as d from orders), "
            f"u as (select k // {USAGE_KEYS} as report_id, {values} from o) select {columns} from u {tail}")


# Fixed values, held here too so that a typing error in the library shows.
REPLACED = (('<a href="#top">Jump to top</a>', ""), ("<br>", ""), ("<td></td>", "<td>x</td>"), ('<link rel="stylesheet" href="styles.css">', ""),
            ('<input type="text" id="SearchBox" class="SearchBox" onkeyup="SearchIndexUsage()" placeholder=" Filter by object name...">', ""),
            ("<table id='IndexUsgTable' class='IndexUsageTable sortable'>", "<table>"))


def _cleaned(column: str) -> str:
    for old, new in REPLACED:
        column = f"replace({column}, {quoted(old)}, {quoted(new)})"
    return column


def _derive_sql(columns: str) -> str:
    return f"{D} select k, {columns} from d"


# Which tables of nested_documents each way takes: 0 the outer one, 1 and 2 inside a cell, 3 to 5 behind it.
NESTED = """with o as (select o_orderkey as k, o_orderkey // 1000 as r from orders), x as (
  select 0 as t, '' || k as c0, 'az' as c1, '' || (k % 11) as c2 from o
  union all select 1, 'i' || k, '' || (k % 7), null from o where k % 3 = 0 union all select 1, '' || k, null, null from o where k % 3 = 0
  union all select 2, 'j' || k, '' || (k % 7), null from o where k % 6 = 0 union all select 2, '' || k, null, null from o where k % 6 = 0
  union all select distinct m.t, m.mark || r, null, null from o, (values (3, 's'), (4, 'd'), (5, 'e')) m(t, mark))
select mode, c0, c1, c2 from x join (values ('first', 0), ('each', 0), ('each', 1), ('each', 4), ('all', 0), ('all', 1), ('all', 2), ('all', 3),
  ('all', 4), ('all', 5)) w(mode, t) using (t)"""
LINE_ROWS = "select l_orderkey, l_linenumber, l_partkey, nullif(l_returnflag, 'N') as l_returnflag"

PRIORITY_ORDER = "order by priority, finding, k"
ORACLES: dict[str, str] = {
    "clean_pages": f"select page_id, length(c) as n_chars, sha256(c) as digest "
                   f"from (select page_id, {_cleaned('html')} as c from pages)",
    "read_documents": f"{D} select report_id, count(*) as n_rows from d group by 1",
    "read_split_rows": "select l_orderkey, l_linenumber, l_partkey, nullif(l_returnflag, 'N') as l_returnflag "
                       "from lineitem",
    "nested_rows": NESTED,
    "nested_rows_in_pieces": NESTED,
    "encodings": f"{LINE_ROWS}, e || ' ' || p as form from lineitem, (values ('utf-8'), ('utf-16le'), ('utf-16be')) a(e), (values ('true'), ('false')) b(p)",
    "loose_rows": "select case when l_linenumber <> 4 then '' || l_orderkey end as c0, case when l_linenumber <> 4 then l_linenumber || chr(160) || 'é' end as c1, "
                  "case when l_linenumber <> 4 then '' || l_partkey end as c2, case when l_linenumber <> 4 then l_returnflag || ' & ö' || chr(128512) || ' x' end as c3, "
                  "case when l_linenumber = 4 then 'malformed row' end as problem from lineitem",
    "shred_counts": f"{D} select report_id, 'page' || lpad(cast(k // {PAGE_KEYS} as varchar), 12, '0') as source_path, "
                    "count(*) as n_rows, count(*) as last_row, cast(11 as bigint) as n_cells from d group by 1, 2",
    "shred_diagnosis": f"{D} select report_id, {CELLS} from d",
    "shred_lineitem": "select l_orderkey, l_linenumber, l_partkey, nullif(l_returnflag, 'N') as l_returnflag "
                      "from lineitem",
    "quarantine": "select l_orderkey, count(*) filter (l_linenumber <> 3) as n_sound, "
                  "count(*) filter (l_linenumber = 3) as n_broken from lineitem group by 1",
    "usage_typed": _usage_sql("report_id, " + ", ".join(USAGE_COLUMNS)),
    "usage_projection": _usage_sql("index_id, index_name, rows, reserved_mb, last_user_seek"),
    "usage_null_counts": _usage_sql("report_id, " + ", ".join(f"count(*) - count({c}) as {c}" for c in USAGE_COLUMNS),
                                    "group by 1"),
    "usage_sums": _usage_sql("report_id, " + ", ".join(
        f"cast(sum(cast({c} as decimal(38,2))) as decimal(38,2)) as {c}" for c in NUMERIC), "group by 1"),
    "unconverted": "select o_orderkey * 1000003 as big, case when o_orderkey % 3 <> 0 then cast(cast(o_orderdate as date) as timestamp) end "
                   "as day, case when o_orderkey % 4 <> 0 then cast(o_orderkey % 100 as integer) end as small, concat_ws(',', "
                   "case when o_orderkey % 3 = 0 then '2' end, case when o_orderkey % 4 = 0 then '3' end) as failed from orders",
    "load_append": f"select o_orderkey // {USAGE_KEYS} as report_id, 2 * count(*) as n_rows, "
                   "cast(2 * sum(o_orderkey) as bigint) as sum_index_id from orders group by 1",
    "load_replace": "select load_id, count(*) as n_rows from orders, (values ('monday'), ('tuesday')) l(load_id) "
                    "group by 1",
    "load_stream": f"{D} select report_id, count(*) as n_rows, cast(sum(priority) as bigint) as sum_priority from d "
                   "group by 1",
    "stream_prepared": f"{D} select report_id, count(*) as n_rows, cast(1 as bigint) as first_id, count(*) as last_id, count(*) as n_ids, count(*) as n_named from d group by 1",
    "load_schema": _usage_sql("load_id, index_id, case when load_id = 'after' then rows end as rows, case when load_id = 'after' then cast(0 as integer) end as n_failed",
                              ", (values ('before'), ('after')) l(load_id)"),
    "load_ledger": f"select case when o_orderkey // {USAGE_KEYS} % 3 = 0 then 'one' else 'two' end as load_id, count(*) as n_rows, cast(sum(o_orderkey) as bigint) as sum_index_id, "
                   f"count(distinct o_orderkey // {USAGE_KEYS}) as n_files, count(*) as n_noted from orders group by 1",
    "load_row_keys": "select cast(o_orderkey as integer) as index_id, n as load_no, row_number() over (partition by n order by o_orderkey) as row_no "
                     "from orders, (values (cast(1 as bigint)), (cast(2 as bigint))) l(n)",
    "row_id": f"{D} select report_id, row_number() over (partition by report_id {PRIORITY_ORDER}) as id, priority, "
              "finding, details from d",
    "row_id_global": f"{D} select k, priority, finding, row_number() over ({PRIORITY_ORDER}) as id from d",
    "derive_T1": _derive_sql(f"{TABLE_SHOWN} as table_name"),
    "derive_T2": _derive_sql(f"n1, {PREP} as data_prep"),
    "derive_T3": _derive_sql(f"kind, {PREP} as data_prep"),
    "derive_T4": _derive_sql(f"{PREP} as data_prep"),
    "derive_T5": _derive_sql(f"n2, {PREP} as data_prep"),
    "derive_T6": _derive_sql(f"priority, {PREP} as data_prep"),
    "derive_T7": _derive_sql(f"report_id, {PREP} as data_prep"),
    "derive_T8": _derive_sql(f"kind, {OBJECT} as object_name"),
    "derive_T9": _derive_sql(f"{OBJECT} as object_name"),
    "derive_T10": _derive_sql(f"{TABLE_SHOWN} as table_name, {OBJECT} as object_name"),
    "derive_T11": _derive_sql(f"kind, {FINDING} as finding"),
    "derive_unread": f"{D} select k, case when k % 10 = 7 then '' else {PREP} end as data_prep, case when k % 10 = 7 then '' else {OBJECT} end as object_name, "
                     f"case when k % 10 = 7 then '' else {TABLE_SHOWN} end as table_name, case when k % 10 = 7 then concat_ws(',', case kind when 3 then 'missing_index' "
                     "when 9 then 'wide_indexes' when 10 then 'wide_clustered' when 12 then 'wide_tables' when 13 then 'addicted_to_nulls' end, case kind when 10 then "
                     "'added_constraint' when 11 then 'foreign_key' else 'created_index' end, case kind when 11 then 'foreign_key_table' else 'table_call' end) else '' end as unread from d",
    "scalar_text": f"{D} select k, '1,' || (100 + n2) || ' rows' as text_before, '1,' || (100 + n2) || ' ' as "
                   "text_through, '' as text_through_none, n1 || 'MB' as text_after_last, '' || n1 as text_between, "
                   "case when kind = 11 then '' else database_name || ''', @SchemaName=''dbo'', @TableName=''T' || k "
                   "|| ''';' end as text_tail, '1,' || (100 + n2) || ' lines; ' || n1 || 'MB' as swapped, cast(11 as bigint) as place, "
                   "1100 + n2 as n, cast(null as integer) as not_a_number, case when n1 % 4 = 0 then 'x' else "
                   "secret_columns end as shown, lower(finding) as lowered, case when n1 % 4 = 0 then null else "
                   "database_name || '.[1 KEY] max' || n2 end as joined from d",
    "section_counts": f"{D} select report_id, section, n from {COUNTS}",
    "classify_rows": f"{D} select k, case kind when 15 then 'collation' else {NAMED} end as section from d where kind < 16",
    "catalog_titles": f"{D} select section, n, short_title from (select {NAMED} as section, count(*) as n from d where "
                      "kind < 15 group by 1) join (values " + ", ".join(
                          f"('{s.name}', {quoted(title)})" for s in SECTIONS for title, _ in _titles(s.name))
                      + ") t(named, short_title) on section = named",
    "preamble_lines": f"{D} select report_id, section, priority, markdown_info from ({_preamble(COUNTS)})",
    "database_filter": f"{D} select report_id, database_name, count(*) as n_rows from d where k % 5 = 3 group by 1, 2",
    **{f"section_{s.name}": section_sql(s.name) for s in SECTIONS},
    "section_collation": f"{D} select report_id, 'Column Collation Does Not Match Database Collation' as finding, "
                         "database_name, details, secret_columns, usage, '1' || (100 + n2) || ' ' as num_rows, "
                         "'1' || (100 + n2) || ' rows; ' || n1 || 'MB' as size, definition from d where kind = 15",
    "report_full": f"{D} {REPORT}",
    "report_lines": f"{D}, r as ({REPORT}) select report_id, row_number() over (partition by report_id order by "
                    f"{LINE_ORDER}) as line_no, section, markdown_info from r",
    "report_from_documents": f"{D}, r as ({REPORT}) select report_id, section, priority, markdown_info from r",
    "packed_files": f"{D}, r as ({REPORT}), l as (select report_id, row_number() over (partition by report_id order by {LINE_ORDER}) as line_no, markdown_info from r) "
                    "select l.*, how from l, (values ('all'), ('by index')) h(how) where how = 'all' or report_id in (3, 21)",
    "markdown_files": f"{D}, r as ({REPORT}) select report_id, row_number() over (partition by report_id order by "
                      f"{LINE_ORDER}) as line_no, markdown_info from r",
}
