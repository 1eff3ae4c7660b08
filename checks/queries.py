"""One query per operator, on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import fixtures as fx
from reportloom.functions import text as tx
from reportloom.operators import derive as dv
from reportloom.operators import report as rp
from reportloom.operators.classify import classify
from reportloom.operators.markup import USAGE_REPLACEMENTS, clean_markup, typed
from reportloom.operators.numbering import number_rows, with_row_id
from reportloom.plans import diagnosis as dg
from reportloom.plans.sections import BY_NAME, SECTIONS
from reportloom.plans.usage import checked, read_split, shredded, sound_rows, usage_rows
from reportloom.schema import DIAGNOSIS_FIELDS, USAGE_FIELDS, USAGE_TABLE_DDL, Field
from reportloom.sources import tables
from reportloom.sources.catalog import load_catalog
from reportloom.sources.identity import ROWS_BITS, with_row_key
from reportloom.sources.ledger import load_changed, loaded_files
from reportloom.sources.markdown import read_lines, read_packed, write_markdown, write_packed
from reportloom.sources.reports import read_report_rows, read_reports
from reportloom.sources.scratch import fresh_path, materialise
from reportloom.streaming.arrivals import arriving_files, load_arrivals, load_prepared_arrivals

Query = Callable[[SparkSession, str], DataFrame]
DIAGNOSIS_CELLS = [f.name for f in DIAGNOSIS_FIELDS]


# ---- reading and shredding

def clean_pages(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages").select("page_id", "html")
    return clean_markup(pages, "html", USAGE_REPLACEMENTS).select(
        "page_id", F.length("html").cast("bigint").alias("n_chars"), F.sha2("html", 256).alias("digest"))


def _written_documents(spark, sf_dir) -> str:
    """Diagnosis documents as files, one per report and page."""
    path = fresh_path(spark, "files")
    (fx.diagnosis_documents(spark, sf_dir).withColumnRenamed("source_path", "page")
     .write.partitionBy("report_id", "page").text(path))
    return path


FILES = {"glob": "*.txt", "id_pattern": r"report_id=(\d+)"}


def read_documents(spark, sf_dir):
    docs = read_reports(spark, _written_documents(spark, sf_dir), **FILES)
    return (shredded(docs, DIAGNOSIS_FIELDS).groupBy(F.col("report_id").cast("bigint").alias("report_id"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def read_split_rows(spark, sf_dir):
    path = fresh_path(spark, "large")
    fx.line_documents(spark, sf_dir).select("html").write.text(path)
    # Every file holds many documents; take each as one report whose tables follow one another.
    rows = checked(read_report_rows(spark, path, id_pattern=r"(part-\d+)", all_tables=True))
    return _line(rows)


MODES = {"first": {}, "each": {"each_parent": True}, "all": {"all_tables": True}}


def _nested(rows: DataFrame, mode: str) -> DataFrame:
    return rows.select(F.lit(mode).alias("mode"), *[F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(3)])


def nested_rows(spark, sf_dir):
    """Rows of nested and sibling tables, by each of the ways to choose tables."""
    docs = fx.nested_documents(spark, sf_dir)
    return reduce(DataFrame.unionByName, [_nested(shredded(docs, (), False, **mode), name) for name, mode in MODES.items()])


def nested_rows_in_pieces(spark, sf_dir):
    """The same of files that are read in pieces."""
    path = fresh_path(spark, "nested")
    fx.nested_documents(spark, sf_dir).withColumnRenamed("report_id", "page").write.partitionBy("page").text(path)
    rows = lambda mode: checked(read_report_rows(spark, path, glob="*.txt", **mode))
    return reduce(DataFrame.unionByName, [_nested(rows(mode), name) for name, mode in MODES.items()])


def encodings(spark, sf_dir):
    """Files in three encodings, whole and in pieces: the same rows of all."""
    docs, found = fx.line_documents(spark, sf_dir), []
    for encoding in ("UTF-8", "UTF-16LE", "UTF-16BE"):
        path = fresh_path(spark, "encoded")
        docs.select(F.encode("html", encoding).cast("string").alias("html")).write.option("encoding", encoding).option("lineSep", "\n").text(path)
        for limit in (-1, 1 << 40):
            rows = read_split(spark, path, (), False, size_limit=limit, glob="*.txt", all_tables=True)
            found.append(_line(rows.where("problem IS NULL")).withColumn("form", F.lit(f"{encoding} {limit < 0}".lower())))
    return reduce(DataFrame.unionByName, found)


def loose_rows(spark, sf_dir):
    """Rows that are no XML, read as browsers read them; text outside the cells still sets a row aside."""
    rows = shredded(fx.loose_documents(spark, sf_dir), (), False, loose=True)
    return rows.select(*[F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(4)], "problem")


def shred_counts(spark, sf_dir):
    rows = shredded(fx.diagnosis_documents(spark, sf_dir), DIAGNOSIS_FIELDS)
    return rows.groupBy("report_id", "source_path").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("row_pos").alias("last_row"),
        F.max(F.size("cells")).cast("bigint").alias("n_cells"))


def shred_diagnosis(spark, sf_dir):
    rows = dg.diagnosis_rows(shredded(fx.diagnosis_documents(spark, sf_dir), DIAGNOSIS_FIELDS))
    return rows.select("report_id", *DIAGNOSIS_CELLS)


def _line(rows: DataFrame) -> DataFrame:
    cell = lambda i: F.get("cells", F.lit(i))
    return rows.select(cell(0).try_cast("bigint").alias("l_orderkey"), cell(1).try_cast("int").alias("l_linenumber"),
                       cell(2).try_cast("bigint").alias("l_partkey"), F.nullif(cell(3), F.lit("")).alias("l_returnflag"))


def shred_lineitem(spark, sf_dir):
    docs = fx.line_documents(spark, sf_dir)
    return _line(shredded(docs, (), check_headings=False).where("problem IS NULL"))


def quarantine(spark, sf_dir):
    rows = shredded(fx.line_documents(spark, sf_dir, broken=True), (), check_headings=False)
    first = F.regexp_extract("tr", r"<td>(\d+)<", 1).try_cast("bigint")
    return rows.groupBy(first.alias("l_orderkey")).agg(
        F.count_if(F.col("problem").isNull()).alias("n_sound"), F.count_if(F.col("problem") == "malformed row").alias("n_broken"))


# ---- usage reports

def _usage(spark, sf_dir) -> DataFrame:
    return usage_rows(shredded(fx.usage_documents(spark, sf_dir), USAGE_FIELDS)).where("problem IS NULL")


USAGE_COLUMNS = [f.name for f in USAGE_FIELDS if f.kept]


def usage_typed(spark, sf_dir):
    return _usage(spark, sf_dir).select("report_id", *USAGE_COLUMNS)


def usage_projection(spark, sf_dir):
    return _usage(spark, sf_dir).select("index_id", "index_name", "rows", "reserved_mb", "last_user_seek")


def usage_null_counts(spark, sf_dir):
    counts = [F.count_if(F.col(name).isNull()).alias(name) for name in USAGE_COLUMNS]
    return _usage(spark, sf_dir).groupBy("report_id").agg(*counts)


NUMERIC = [f.name for f in USAGE_FIELDS if f.type in ("int", "bigint") or f.type.startswith("decimal")]


def usage_sums(spark, sf_dir):
    sums = [F.sum(F.col(name).cast("decimal(38,2)")).cast("decimal(38,2)").alias(name) for name in NUMERIC]
    return _usage(spark, sf_dir).groupBy("report_id").agg(*sums)


def _load_table(spark, label) -> str:
    path = fresh_path(spark, label)
    name = f"{label}_{path.rsplit('-', 1)[1]}"
    tables.ensure_table(spark, name, USAGE_TABLE_DDL, location=path)
    return name


def _usage_load(spark, sf_dir) -> DataFrame:
    docs = fx.usage_documents(spark, sf_dir).withColumn("source_path", F.lit("orders"))
    return usage_rows(shredded(docs, USAGE_FIELDS))


ODD_FIELDS = (Field(1, "big", "Big", "bigint"), Field(2, "day", "Day", "timestamp_ntz"), Field(3, "small", "Small", "int"))


def unconverted(spark, sf_dir):
    """Numbers with separators are read; days that are none and numbers that are too large are marked."""
    orders = fx.table(spark, sf_dir, "orders").selectExpr("o_orderkey as k", "cast(o_orderdate as timestamp_ntz) as d")
    cells = ["format_number(k * 1000003, 0)", "if(k % 3 = 0, 'no day', date_format(d, 'yyyy-MM-dd'))",
             "if(k % 4 = 0, '99999999999', string(k % 100))"]
    rows = orders.withColumn("report_id", F.floor(F.col("k") / fx.USAGE_KEYS))
    docs = fx.documents(rows, ["report_id"], "k", fx.row_markup([F.expr(c) for c in cells]), [f.title for f in ODD_FIELDS])
    found = typed(shredded(docs, ODD_FIELDS), ODD_FIELDS, [], failed="failed")
    return found.select("big", "day", "small", F.array_join("failed", ",").alias("failed"))


def load_append(spark, sf_dir):
    """Two appends double the rows, and creating the table again leaves it alone."""
    name, rows = _load_table(spark, "append"), materialise(_usage_load(spark, sf_dir)).withColumn("load_id", F.lit("a"))
    tables.append(rows, name)
    tables.ensure_table(spark, name, USAGE_TABLE_DDL)
    tables.append(rows, name)
    return spark.table(name).groupBy(F.col("report_id").cast("bigint").alias("report_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("index_id").alias("sum_index_id"))


def load_replace(spark, sf_dir):
    """The same load twice counts once; another load stays."""
    name, rows = _load_table(spark, "replace"), materialise(_usage_load(spark, sf_dir))
    for load_id in ("monday", "monday", "tuesday"):
        tables.replace_load(rows, name, load_id)
    return sound_rows(spark.table(name)).groupBy("load_id").agg(F.count(F.lit(1)).alias("n_rows"))


def load_stream(spark, sf_dir):
    """Files that arrive are loaded by a stream; a second start finds nothing new."""
    files, name = _written_documents(spark, sf_dir), "stream_" + fresh_path(spark, "s").rsplit("-", 1)[1]
    ddl = "report_id string, source_path string, row_pos bigint, problem string, raw_row string, failed_cells array<int>, " + ", ".join(
        f"{f.name} {f.type}" for f in DIAGNOSIS_FIELDS) + ", load_id string"
    state, place = fresh_path(spark, "state"), fresh_path(spark, "stream")
    transform = lambda split, load_id, number: dg.diagnosis_rows(split)
    for _ in range(2):
        load_arrivals(arriving_files(spark, files, glob=FILES["glob"]), DIAGNOSIS_FIELDS, transform, name, ddl, state, location=place,
                      reading=FILES, availableNow=True).awaitTermination()
    return spark.table(name).groupBy(F.col("report_id").cast("bigint").alias("report_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("priority").alias("sum_priority"))


def stream_prepared(spark, sf_dir):
    """Prepared rows of files that come in several batches: numbers run on without gaps in each report."""
    files, name = _written_documents(spark, sf_dir), "prepared_" + fresh_path(spark, "s").rsplit("-", 1)[1]
    arriving = arriving_files(spark, files, glob=FILES["glob"], files_per_batch=400)
    load_prepared_arrivals(arriving, name, f"{name}_ids", fresh_path(spark, "state"), location=fresh_path(spark, "stream"),
                           ids_location=fresh_path(spark, "ids"), reading=FILES, availableNow=True).awaitTermination()
    return sound_rows(spark.table(name)).groupBy(F.col("report_id").cast("bigint").alias("report_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count_distinct("id").alias("n_ids"),
        F.count_if(F.col("object_name") != "").alias("n_named"))


def load_schema(spark, sf_dir):
    """A table made before two of its columns takes new loads and keeps old rows."""
    path = fresh_path(spark, "older")
    name = f"older_{path.rsplit('-', 1)[1]}"
    tables.ensure_table(spark, name, "report_id string, index_id int, load_id string", location=path)
    rows = _usage_load(spark, sf_dir)
    tables.replace_load(rows.select("report_id", "index_id"), name, "before")
    tables.ensure_table(spark, name, "report_id string, index_id int, failed_cells array<int>, rows bigint, load_id string")
    tables.replace_load(rows.select("report_id", "index_id", "failed_cells", "rows"), name, "after")
    return spark.table(name).select("load_id", "index_id", "rows", F.size("failed_cells").alias("n_failed"))


def load_ledger(spark, sf_dir):
    """Files are loaded once, whichever load finds them."""
    path, name = fresh_path(spark, "files"), _load_table(spark, "ledger")
    docs = fx.usage_documents(spark, sf_dir).withColumnRenamed("report_id", "page")
    read = lambda paths: usage_rows(read_split(spark, paths, USAGE_FIELDS, glob="*", id_pattern=r"page=(\d+)"))
    place = fresh_path(spark, "read")
    for load_id, some in (("one", "page % 3 = 0"), ("two", "page % 3 = 1"), ("two", "page < 0"), ("two", "page % 3 = 2"), ("three", "page < 0")):
        docs.where(some).write.mode("append").partitionBy("page").text(path)
        load_changed(spark, path, name, f"{name}_files", load_id, read, glob="*.txt", location=place)
    rows = sound_rows(spark.table(name)).groupBy("load_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("index_id").alias("sum_index_id"))
    files = loaded_files(spark.table(f"{name}_files")).groupBy("load_id").agg(F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").alias("n_noted"))
    return rows.join(files, "load_id")


def load_row_keys(spark, sf_dir):
    """Numbers of two loads: each has its own range, and counts its rows in their order."""
    rows, place = materialise(_usage_load(spark, sf_dir).select("index_id", "rows")), fresh_path(spark, "keys")
    loads = [with_row_key(rows, place, ["index_id"]) for _ in range(2)]
    return loads[0].unionByName(loads[1]).select("index_id", F.shiftright("row_key", ROWS_BITS).alias("load_no"), F.col("row_key").bitwiseAND((1 << ROWS_BITS) - 1).alias("row_no"))


# ---- row numbers

def row_id(spark, sf_dir):
    rows = dg.diagnosis_rows(shredded(fx.diagnosis_documents(spark, sf_dir), DIAGNOSIS_FIELDS))
    numbered = with_row_id(rows, ["report_id"], ["priority", "finding"], ["source_path", "row_pos"], chunk=100)
    return numbered.select("report_id", "id", "priority", "finding", "details")


def row_id_global(spark, sf_dir):
    rows = fx.diagnosis(spark, sf_dir).select("k", "priority", "finding")
    return number_rows(rows, [F.asc("priority"), F.asc("finding"), F.asc("k")], name="id")


# ---- derivations

def _derived(spark, sf_dir) -> DataFrame:
    return dv.derive(fx.diagnosis(spark, sf_dir))


def _derivation(*columns: str) -> Query:
    """All rows, so that those which a rule must leave alone are compared too."""
    def query(spark, sf_dir):
        return _derived(spark, sf_dir).select("k", *columns)
    return query


def derive_unread(spark, sf_dir):
    """Every tenth row holds other sentences than its finding says, and says which."""
    other = {"details": "concat('Some other sentence ', k)", "usage": "'another wording'", "create_tsql": "if(create_tsql = '', '', concat(left(create_tsql, 6), ' CONSTRAINT'))",
             "more_info": "if(more_info = '', '', 'EXEC dbo.other ')"}
    rows = fx.diagnosis(spark, sf_dir).withColumns({c: F.expr(f"if(k % 10 = 7, {e}, {c})") for c, e in other.items()})
    return dv.read_sentences(rows, "unread").select("k", "data_prep", "object_name", "table_name", F.array_join("unread", ",").alias("unread"))


def scalar_text(spark, sf_dir):
    """The text building blocks, one column each."""
    columns = {
        "text_before": tx.before("size", ";"), "text_through": tx.through("size", " "),
        "text_through_none": tx.through("size", "#"), "text_after_last": tx.after_last("size", " "),
        "text_between": tx.before(tx.after_last("size", "; "), "MB"), "text_tail": tx.tail("more_info", "="),
        "swapped": tx.swap("size", "ROWS", "lines"), "place": "CAST(locate(';', size) AS bigint)",
        "n": tx.number(tx.through("size", " "), "bigint"), "not_a_number": tx.number("secret_columns", "int"),
        "shown": tx.shown("secret_columns"), "lowered": "lower(finding)",
        "joined": "concat(database_name, '.', nullif(secret_columns, ''))"}
    return fx.diagnosis(spark, sf_dir).selectExpr("k", *[f"{rule} AS {name}" for name, rule in columns.items()])


# ---- classification and counts

def section_counts(spark, sf_dir):
    return rp.section_counts(fx.diagnosis(spark, sf_dir)).select("report_id", "section", "n")


def classify_rows(spark, sf_dir):
    return classify(fx.diagnosis(spark, sf_dir).select("k", "priority", "finding")).select("k", "section")


def catalog_titles(spark, sf_dir):
    titles = rp.section_titles(load_catalog(spark))
    counts = classify(fx.diagnosis(spark, sf_dir).select("priority", "finding"), SECTIONS).groupBy("section").count()
    return counts.join(titles, "section", "left").select(
        "section", F.col("count").alias("n"), F.inline("titles")).drop("description")


def preamble_lines(spark, sf_dir):
    rows = rp.preamble(rp.section_counts(fx.diagnosis(spark, sf_dir)), load_catalog(spark))
    return rows.select("report_id", "section", "priority", "markdown_info")


def database_filter(spark, sf_dir):
    split = shredded(fx.diagnosis_documents(spark, sf_dir), DIAGNOSIS_FIELDS)
    return dg.diagnosis_rows(split, databases="DB3").groupBy("report_id", "database_name").agg(
        F.count(F.lit(1)).alias("n_rows"))


# ---- reports

def _prepared(spark, sf_dir) -> DataFrame:
    return _derived(spark, sf_dir).withColumn("id", F.col("k"))


def section(name: str, spark, sf_dir):
    return rp.section_report(_prepared(spark, sf_dir), load_catalog(spark), BY_NAME[name])


def section_collation(spark, sf_dir):
    return rp.collation_rows(_prepared(spark, sf_dir))


def report_full(spark, sf_dir):
    return rp.findings_report(_prepared(spark, sf_dir), load_catalog(spark))


def report_lines(spark, sf_dir):
    """Every document line with its number in the document."""
    order = rp.report_order()
    numbered = number_rows(report_full(spark, sf_dir), order[1:], within=["report_id"], name="line_no")
    return numbered.select("report_id", "line_no", "section", "markdown_info")


def report_from_documents(spark, sf_dir):
    """The whole way: documents to cells, numbered and prepared rows, and the document lines."""
    docs = fx.diagnosis_documents(spark, sf_dir)
    loaded = materialise(dg.prepared(dg.diagnosis_rows(shredded(docs, DIAGNOSIS_FIELDS))))
    return rp.findings_report(loaded, load_catalog(spark)).select("report_id", "section", "priority", "markdown_info")


def markdown_files(spark, sf_dir):
    """The documents as files, read back: every line at its place."""
    path = fresh_path(spark, "documents")
    write_markdown(report_full(spark, sf_dir), path, rp.report_order())
    lines = read_lines(spark, path).withColumn("report_id", F.col("report_id").cast("bigint"))
    numbered = number_rows(lines, [F.asc("file"), F.asc("block"), F.asc("line")], within=["report_id"], name="line_no")
    return numbered.select("report_id", "line_no", "markdown_info")


def packed_files(spark, sf_dir):
    """The documents packed into few files, read back whole and, for some reports, by the index."""
    path = fresh_path(spark, "packed")
    report = report_full(spark, sf_dir).withColumn("report_id", F.col("report_id").cast("string"))
    write_packed(report, path, rp.report_order(), partitions=6)
    some = read_packed(spark, path, ["3", "21"]).withColumn("how", F.lit("by index"))
    lines = read_packed(spark, path).withColumn("how", F.lit("all")).unionByName(some)
    return lines.withColumn("report_id", F.col("report_id").cast("bigint"))


QUERIES: dict[str, Query] = {
    "clean_pages": clean_pages,
    "read_documents": read_documents,
    "read_split_rows": read_split_rows,
    "nested_rows": nested_rows,
    "nested_rows_in_pieces": nested_rows_in_pieces,
    "encodings": encodings,
    "loose_rows": loose_rows,
    "shred_counts": shred_counts,
    "shred_diagnosis": shred_diagnosis,
    "shred_lineitem": shred_lineitem,
    "quarantine": quarantine,
    "usage_typed": usage_typed,
    "usage_projection": usage_projection,
    "usage_null_counts": usage_null_counts,
    "usage_sums": usage_sums,
    "unconverted": unconverted,
    "load_append": load_append,
    "load_replace": load_replace,
    "load_stream": load_stream,
    "stream_prepared": stream_prepared,
    "load_schema": load_schema,
    "load_ledger": load_ledger,
    "load_row_keys": load_row_keys,
    "row_id": row_id,
    "row_id_global": row_id_global,
    "derive_T1": _derivation("table_name"),
    "derive_T2": _derivation("n1", "data_prep"),
    "derive_T3": _derivation("kind", "data_prep"),
    "derive_T4": _derivation("data_prep"),
    "derive_T5": _derivation("n2", "data_prep"),
    "derive_T6": _derivation("priority", "data_prep"),
    "derive_T7": _derivation("report_id", "data_prep"),
    "derive_T8": _derivation("kind", "object_name"),
    "derive_T9": _derivation("object_name"),
    "derive_T10": _derivation("table_name", "object_name"),
    "derive_T11": _derivation("kind", "finding"),
    "derive_unread": derive_unread,
    "scalar_text": scalar_text,
    "section_counts": section_counts,
    "classify_rows": classify_rows,
    "catalog_titles": catalog_titles,
    "preamble_lines": preamble_lines,
    "database_filter": database_filter,
    **{f"section_{s.name}": partial(section, s.name) for s in SECTIONS},
    "section_collation": section_collation,
    "report_full": report_full,
    "report_lines": report_lines,
    "report_from_documents": report_from_documents,
    "markdown_files": markdown_files,
    "packed_files": packed_files,
}
