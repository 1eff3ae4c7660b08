"""Column layouts of the two HTML reports and of the findings catalog.

A report binds its cells to columns by position. ``title`` is the heading as the report shows it and is what
the header check compares; ``name`` is the column of our tables.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Field:
    position: int
    name: str
    title: str
    type: str
    kept: bool = True


def _fields(text: str) -> tuple[Field, ...]:
    out = []
    for line in text.strip().splitlines():
        position, name, title, type_ = (part.strip() for part in line.split("|"))
        out.append(Field(int(position), name, title, type_.removesuffix(" dropped"), not type_.endswith("dropped")))
    return tuple(out)


# Positions, headings and types of the usage report.
USAGE_FIELDS = _fields("""
1 | database | Database | string
2 | schema | Schema | string
3 | object | Object | string
4 | index_name | Index | string
5 | index_id | IndexID | int
6 | object_type | ObjectType | string
7 | definition | Definition: Property ColumnName {datatype maxbytes} | string
8 | key_column_names_with_sort | Key Column Names With Sort | string
9 | count_key_columns | Count Key Columns | int
10 | include_column_names | Include Column Names | string
11 | count_included_columns | Count Included Columns | int
12 | secret_column_names | Secret Column Names | string
13 | count_secret_columns | Count Secret Columns | int
14 | partition_key_column_name | Partition key column name | string
15 | filter_definition | Filter Definition | string
16 | is_indexed_view | Is Indexed View | string
17 | is_pk | Is PK | string
18 | is_unique_constraint | Is Unique Constraint | string
19 | is_xml | Is XML | string
20 | is_spatial | Is Spatial | string
21 | is_nc_columnstore | Is NC Columnstore | string
22 | is_cx_columnstore | Is CX Columnstore | string
23 | is_in_memory_oltp | Is In-Memory OLTP | string dropped
24 | is_disabled | Is Disabled | string
25 | is_hypothetical | Is Hypothetical | string
26 | is_padded | Is Padded | string
27 | fill_factor | Fill Factor | int
28 | is_reference_by_foreign_key | Is Reference by Foreign Key | string
29 | last_user_seek | Last User Seek | timestamp_ntz
30 | last_user_scan | Last User Scan | timestamp_ntz
31 | last_user_lookup | Last User Lookup | timestamp_ntz
32 | last_user_update | Last User Update | timestamp_ntz
33 | total_reads | Total Reads | int
34 | user_updates | User Updates | int
35 | reads_per_write | Reads Per Write | string
36 | index_usage | Index Usage | string
37 | partition_count | Partition Count | int
38 | rows | Rows | bigint
39 | reserved_mb | Reserved MB | decimal(18,2)
40 | reserved_lob_mb | Reserved LOB MB | decimal(18,2)
41 | reserved_row_overflow_mb | Reserved Row Overflow MB | decimal(18,2)
42 | index_size | Index Size | string
43 | row_lock_count | Row Lock Count | bigint
44 | row_lock_wait_count | Row Lock Wait Count | bigint
45 | row_lock_wait_ms | Row Lock Wait ms | bigint
46 | avg_row_lock_wait_ms | Avg Row Lock Wait ms | bigint
47 | page_lock_count | Page Lock Count | bigint
48 | page_lock_wait_count | Page Lock Wait Count | bigint
49 | page_lock_wait_ms | Page Lock Wait ms | bigint
50 | avg_page_lock_wait_ms | Avg Page Lock Wait ms | bigint
51 | lock_escalation_attempts | Lock Escalation Attempts | bigint
52 | lock_escalations | Lock Escalations | bigint
53 | page_latch_wait_count | Page Latch Wait Count | bigint
54 | page_latch_wait_ms | Page Latch Wait ms | bigint
55 | page_io_latch_wait_count | Page IO Latch Wait Count | bigint
56 | page_io_latch_wait_ms | Page IO Latch Wait ms | bigint
57 | forwarded_fetches | Forwarded Fetches | bigint
58 | data_compression | Data Compression | string
59 | create_date | Create Date | timestamp_ntz
60 | modify_date | Modify Date | timestamp_ntz
""")

# Positions, headings and types of the diagnosis report.
DIAGNOSIS_FIELDS = _fields("""
1 | priority | Priority | int
2 | finding | Finding | string
3 | database_name | DatabaseName | string
4 | details | Details | string
5 | definition | Definition | string
6 | secret_columns | SecretColumns | string
7 | usage | Usage | string
8 | size | Size | string
9 | more_info | MoreInfo | string
10 | create_tsql | CreateTSQL | string
11 | sample_plan_file | SamplePlanFile | string
""")

# Columns that the diagnosis load derives from the eleven cells.
DIAGNOSIS_DERIVED = (("table_name", "string"), ("data_prep", "string"), ("object_name", "string"))

CATALOG_DDL = "priority smallint, finding string, url string, short_title string, description string"

# Where a loaded row came from, its number within the report, what was wrong with it, if anything, and the positions of
# cells that did not convert.
ORIGIN_DDL = "report_id string, source_path string, row_pos bigint, problem string, raw_row string, failed_cells array<int>"


def _ddl(fields) -> str:
    return ", ".join(f"{f.name} {f.type}" for f in fields if f.kept)


USAGE_TABLE_DDL = f"{ORIGIN_DDL}, {_ddl(USAGE_FIELDS)}, load_id string"
DIAGNOSIS_TABLE_DDL = ", ".join(
    [ORIGIN_DDL, "id bigint", _ddl(DIAGNOSIS_FIELDS), *(f"{name} {type_}" for name, type_ in DIAGNOSIS_DERIVED),
     "load_id string"])
