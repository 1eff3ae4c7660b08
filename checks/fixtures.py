"""Report data made from the driver's tables: diagnosis rows as a table, and HTML documents to shred.

Whole numbers of the source row are turned into the sentences and cells that reports hold, so a check can compare
what the library reads back with the numbers themselves. Documents are bounded by rule: a page holds at most a
thousand rows however large the tables or however often one key repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reportloom.schema import DIAGNOSIS_FIELDS, USAGE_FIELDS

PAGE_KEYS = 20_000  # diagnosis: every twentieth key belongs to a report, so a page holds 1,000 rows or fewer
USAGE_KEYS = 1_000
LINES = 1_000

# One text for both engines. ``k, kind, n1, n2`` are the numbers the rest is made from; k is unique.
DIAGNOSIS_SQL = """
with b as (
  select o_orderkey as k, o_orderkey % 17 as kind, o_orderkey % 97 + 1 as n1, o_orderkey % 89 + 1 as n2,
         case when o_orderkey % 1000 < 12 then 20 + o_orderkey % 1000 else o_orderkey % 20 end as report_id,
         case when o_orderkey % 35 = 4 then '' when o_orderkey % 5 = 2 then 'DB2' else 'db' || cast(o_orderkey % 5 as string) end as db,
         'T' || cast(o_orderkey as string) as t
  from {orders})
select k, kind, n1, n2, report_id, db as database_name,
  case when kind = 0 then 10 when kind = 1 then 20 when kind = 2 then 30 when kind = 3 then 50
       when kind in (4, 6, 7, 8) then 100 when kind in (5, 13) then 200 when kind = 16 then 70 else 150 end as priority,
  case kind when 0 then 'Index Hoarder: Many NC Indexes on a Single Table'
    when 1 then 'Multiple Index Personalities: Duplicate keys'
    when 2 then 'Multiple Index Personalities: Borderline duplicate keys'
    when 3 then 'Indexaphobia: High Value Missing Index'
    when 4 then 'Self Loathing Indexes: Heaps with Forwarded Fetches'
    when 5 then 'Self Loathing Indexes: Heaps with Deletes'
    when 6 then 'Self Loathing Indexes: ' || case n1 % 3 when 0 then 'Large' when 1 then 'Medium' else 'Small' end || ' Active heap'
    when 7 then 'Self Loathing Indexes: Heap with a Nonclustered Primary Key'
    when 8 then 'Index Hoarder: NC index with High Writes:Reads'
    when 9 then 'Index Hoarder: Borderline: Wide Indexes (7 or More Columns)'
    when 10 then 'Index Hoarder: Wide Clustered Index (> 3 columns OR > 16 bytes)'
    when 11 then 'Abnormal Psychology: Unindexed Foreign Keys'
    when 12 then 'Index Hoarder: Wide Tables: 35+ cols or > 2000 non-LOB bytes'
    when 13 then 'Index Hoarder: Addicted to Nulls'
    when 14 then 'Index Hoarder: Non-Unique Clustered Index'
    when 15 then 'Abnormal Psychology: Column Collation Does Not Match Database Collation'
    else 'Aggressive Indexes: Total lock wait time > 5 minutes (row + page)' end as finding,
  case when kind = 0 then '1,' || cast(100 + n1 as string) || ' NC indexes on dbo.' || t
    when kind = 4 then '2,' || cast(100 + n1 as string) || ' forwarded fetches per day against heap: dbo.' || t || '.Unknown (0)'
    when kind = 5 then '3,' || cast(100 + n1 as string) || ' deletes against heap: dbo.' || t || '.Unknown (0)'
    when kind = 6 then 'Should this table be a heap? dbo.' || t || '.Unknown (0)'
    when kind = 9 then cast(n1 as string) || ' columns on dbo.' || t
    when kind = 10 then cast(n1 as string) || ' columns with potential size of ' || cast(n2 as string) || ' bytes in clustered index:dbo.' || t
    when kind = 11 then 'Foreign key [fk' || cast(k as string) || '] on [dbo.' || t || '] has no supporting index.'
    when kind = 12 then 'dbo.' || t || ' has ' || cast(n1 as string) || ' total columns with a max possible width of ' || cast(n2 * 100 as string) || ' bytes.' || case when n1 % 2 = 0 then cast(n1 % 7 as string) || ' columns are LOB types.' else '' end
    when kind = 13 then 'dbo.' || t || ' allows null in ' || cast(n1 as string) || ' of ' || cast(n1 + n2 as string) || ' columns.'
    else 'dbo.' || t || '.ix' || cast(k as string) || ' (2)' end as details,
  case when kind = 0 then 'dbo.' || t || ' [CX] [PK]' else '[1 KEY] c' || cast(n1 as string) end as definition,
  case when n1 % 4 = 0 then '' else '[1 KEY] max' || cast(n2 as string) end as secret_columns,
  case when kind = 3 then '1,' || cast(100 + n1 as string) || ' uses; Impact: ' || cast(n1 as string) || '.' || cast(n2 % 10 as string) || '%; Avg query cost: ' || cast(n2 as string) || '.1234'
    else 'Reads: ' || cast(n1 as string) || ' Writes: ' || cast(n2 as string) end as usage,
  '1,' || cast(100 + n2 as string) || ' rows; ' || cast(n1 as string) || 'MB' as size,
  case when kind = 11 then '' else 'EXEC dbo.sp_ShowTable @DatabaseName=''' || db || ''', @SchemaName=''dbo'', @TableName=''' || t || ''';' end as more_info,
  case when kind = 10 then 'ALTER TABLE [' || db || '].[dbo].[' || t || '] ADD CONSTRAINT [pk' || cast(k as string) || '] PRIMARY KEY CLUSTERED ([a]);'
    when kind = 11 then ''
    else 'CREATE ' || case when n1 % 2 = 0 then 'UNIQUE ' else '' end || case when kind = 14 then 'CLUSTERED ' when kind = 7 then 'NONCLUSTERED ' else '' end || 'INDEX [ix' || cast(k as string) || '] ON [' || db || '].[dbo].[' || t || '] ([a]) WITH (FILLFACTOR=100, ONLINE=?, SORT_IN_TEMPDB=?, DATA_COMPRESSION=?);' end as create_tsql,
  case when kind = 3 then 'plan_' || cast(k as string) || '.sqlplan' else '' end as sample_plan_file
from b
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagnosis rows as a report holds them, with the numbers they were made from."""
    return spark.sql(DIAGNOSIS_SQL, orders=table(spark, sf_dir, "orders"))


def _cell(text, empty_as: str):
    escaped = text
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(entity))
    return F.when(text.isNull() | (text == ""), empty_as).otherwise(F.concat(F.lit("<td>"), escaped, F.lit("</td>")))


def row_markup(cells, empty_as: str = "<td></td>"):
    """``<tr>`` with one ``<td>`` per cell; a NULL or empty cell becomes ``empty_as``."""
    marked = F.transform(F.array(*cells), lambda text: _cell(text, empty_as))
    return F.concat(F.lit("<tr>"), F.array_join(marked, ""), F.lit("</tr>"))


def documents(rows: DataFrame, by: list[str], order: str, tr, titles: list[str]) -> DataFrame:
    """One HTML document per ``by`` group, its ``tr`` rows in ``order``. Groups must be bounded by their rule.

    The narrow source rows are shuffled, before they become markup; the grouping then needs no shuffle of its own.
    """
    head = "".join(f"<th>{title}</th>" for title in titles)
    ordered = F.sort_array(F.collect_list(F.struct(order, "tr")))
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartition(count, *by).select(*by, order, tr.alias("tr"))
    return (placed.groupBy(*by).agg(F.array_join(F.transform(ordered, lambda row: row["tr"]), "").alias("_rows"))
            .select(*by, F.concat(F.lit(f"<html><body><a href=\"#top\">Jump to top</a><br><table><tr>{head}</tr>"),
                                  "_rows", F.lit("</table></body></html>")).alias("html")))


def diagnosis_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``report_id, source_path, html``: a report is one document per page of keys."""
    page = F.concat(F.lit("page"), F.format_string("%012d", F.floor(F.col("k") / PAGE_KEYS)))
    rows = diagnosis(spark, sf_dir).withColumn("source_path", page)
    tr = row_markup([F.col(f.name).cast("string") for f in DIAGNOSIS_FIELDS])
    return documents(rows, ["report_id", "source_path"], "k", tr, [f.title for f in DIAGNOSIS_FIELDS])


def line_documents(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """Order lines as documents of up to a thousand rows in scan order, whatever their keys.

    ``broken`` leaves the second cell of every line with line number 3 unclosed.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    text = [F.col(name).cast("string") for name in ("l_orderkey", "l_linenumber", "l_partkey")]
    tr = row_markup([*text, F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))])
    if broken:
        tr = F.when(F.col("l_linenumber") == 3, F.regexp_replace(tr, r"^(<tr><td>\d+</td><td>3)</td>", "$1")).otherwise(tr)
    numbered = lines.withColumn("at", F.monotonically_increasing_id())
    rows = numbered.withColumn("report_id", F.floor(F.col("at") / LINES))
    return documents(rows, ["report_id"], "at", tr, ["Order", "Line", "Part", "Flag"])


# How a usage cell of each type is made from the key, as Spark text and as a value in the check's SQL.
# ``{p}`` is the cell's position, ``k`` the key, ``d`` the order's date.
CELL_TEXT = {
    "int": "cast((k * {p}) % 100000 as string)",
    "bigint": "cast(k * {p} * 1000003 as string)",
    "decimal(18,2)": "cast(k % 1000 as string) || '.' || cast(10 + {p} as string)",
    "timestamp_ntz": "case when k % 5 = 0 then date_format(d + make_dt_interval(0, {p}), 'M/d/yyyy h:mm:ss a') "
                     "else date_format(d + make_dt_interval(0, {p}), 'yyyy-MM-dd HH:mm:ss') end",
    "string": "case when k % 10 = 0 then 'a & b < ' || cast(k % {p} as string) else 'v' || cast(k % {p} as string) end",
}
CELL_VALUE = {
    "int": "cast((k * {p}) % 100000 as integer)",
    "bigint": "k * {p} * 1000003",
    "decimal(18,2)": "cast(cast((k % 1000) * 100 + 10 + {p} as decimal(18,0)) * 0.01 as decimal(18,2))",
    "timestamp_ntz": "d + interval {p} hour",
    "string": "case when k % 10 = 0 then 'a & b < ' || cast(k % {p} as varchar) else 'v' || cast(k % {p} as varchar) end",
}


def usage_cell(field, forms) -> str:
    """A cell is empty when key and position add up to a multiple of seven; IndexID is the key and never empty."""
    if field.name == "index_id":
        return "cast(k as string)" if forms is CELL_TEXT else "cast(k as integer)"
    form = forms[field.type].format(p=field.position)
    return f"case when (k + {field.position}) % 7 = 0 then null else {form} end"


def usage_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey as k", "cast(o_orderdate as timestamp_ntz) as d")
    tr = row_markup([F.expr(usage_cell(f, CELL_TEXT)) for f in USAGE_FIELDS])
    rows = orders.withColumn("report_id", F.floor(F.col("k") / USAGE_KEYS))
    return documents(rows, ["report_id"], "k", tr, [f.title for f in USAGE_FIELDS])


def nested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as table rows, with a table inside every third and two inside every sixth, and two more tables behind."""
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey as k", f"floor(o_orderkey / {USAGE_KEYS}) as report_id")
    inner = lambda mark: (f"concat('<table><tr><th>x</th></tr><tr><td>{mark}', k, '</td><td>', k % 7, '</td></tr>"  # noqa: E731
                          "<tr><td>', k, '</td></tr></table>')")
    tr = F.expr(f"concat('<tr><td>', k, '</td><td>a', if(k % 3 = 0, {inner('i')}, ''), if(k % 6 = 0, {inner('j')}, ''), 'z</td><td>', k % 11, '</td></tr>')")
    docs = documents(orders, ["report_id"], "k", tr, ["Order", "Text", "Rest"])
    small = lambda mark: F.concat(F.lit(f"<table><tr><th>x</th></tr><tr><td>{mark}"), "report_id", F.lit("</td></tr></table>"))
    behind = F.concat(F.lit("</table>"), small("s"), F.lit("<div>"), small("d"), small("e"), F.lit("</div></body>"))
    return docs.withColumn("html", F.replace("html", F.lit("</table></body>"), behind))


def loose_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines whose rows are no XML: names of references, attributes without values, lone signs, missing end tags."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    tr = F.expr("concat('<tr><td nowrap>', l_orderkey, '</td><td width=3>', l_linenumber, '&nbsp;&eacute;</td><td>', l_partkey, "
                "'<td title=\"a > b\">', l_returnflag, ' & &#246;&#x1F600; <b>x</b></td></tr>')")
    tr = F.when(F.col("l_linenumber") == 4, F.expr("concat('<tr>', l_orderkey, '<td>&nbsp;</td></tr>')")).otherwise(tr)
    rows = lines.withColumn("at", F.monotonically_increasing_id()).withColumn("report_id", F.floor(F.col("at") / LINES))
    return documents(rows, ["report_id"], "at", tr, ["Order", "Line", "Part", "Flag"])
