"""Times the headline queries and prints one JSON line.

Inputs that a user would have on disk, HTML documents and a loaded diagnosis table, are written once beforehand and
not timed. Every query is run whole into the noop sink, once to warm up and once for the time.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession, functions as F

from checks import fixtures as fx
from reportloom.operators import report as rp
from reportloom.operators.derive import derive
from reportloom.operators.markup import USAGE_REPLACEMENTS, clean_markup
from reportloom.operators.numbering import number_rows
from reportloom.plans import diagnosis as dg
from reportloom.plans.sections import BY_NAME
from reportloom.plans.usage import read_split, shredded, usage_rows
from reportloom.schema import DIAGNOSIS_FIELDS, USAGE_FIELDS
from reportloom.sources.catalog import load_catalog
from reportloom.sources.markdown import write_markdown
from reportloom.sources.scratch import materialise

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
             .config("spark.driver.memory", "12g").config("spark.sql.shuffle.partitions", CPUS)
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.sql.files.maxPartitionBytes", "4m").config("spark.sql.files.openCostInBytes", "1m")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def stored(df, path: str):
    df.repartition(4 * int(CPUS)).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def main() -> None:
    spark = session()
    place = tempfile.mkdtemp(prefix="bench-")
    pages = fx.table(spark, SF_DIR, "pages")
    usage = stored(fx.usage_documents(spark, SF_DIR), f"{place}/usage")
    lines = stored(fx.line_documents(spark, SF_DIR), f"{place}/lines")
    docs = stored(fx.diagnosis_documents(spark, SF_DIR), f"{place}/docs")
    raw = stored(fx.diagnosis(spark, SF_DIR), f"{place}/raw")
    table = stored(derive(raw).withColumn("id", F.col("k")), f"{place}/table")
    catalog = load_catalog(spark)
    fx.usage_documents(spark, SF_DIR).select("html").repartition(4 * int(CPUS)).write.text(f"{place}/files")
    files = lambda limit: usage_rows(read_split(spark, f"{place}/files", USAGE_FIELDS, glob="*.txt", size_limit=limit))
    split = lambda: dg.diagnosis_rows(shredded(docs, DIAGNOSIS_FIELDS))
    queries = {
        "clean_pages": lambda: clean_markup(pages, "html", USAGE_REPLACEMENTS),
        "shred_usage_60_cells": lambda: usage_rows(shredded(usage, USAGE_FIELDS)),
        "shred_lines_4_cells": lambda: shredded(lines, (), check_headings=False).select("cells"),
        "shred_diagnosis": split,
        "read_files_whole": lambda: files(1 << 40),
        "read_files_in_pieces": lambda: files(-1),
        "load_diagnosis_with_ids": lambda: dg.prepared(materialise(split())),
        "derive": lambda: derive(raw),
        "section_counts": lambda: rp.section_counts(table),
        "section_missing_index": lambda: rp.section_report(table, catalog, BY_NAME["missing_index"]),
        "report_full": lambda: rp.findings_report(table, catalog),
        "report_sorted": lambda: rp.findings_report(table, catalog).orderBy(*rp.report_order()),
        "row_numbers_global": lambda: number_rows(raw.select("k", "priority", "finding"), [
            F.asc("priority"), F.asc("finding"), F.asc("k")]),
    }
    times = {}
    for name, query in queries.items():
        for _ in range(2):
            start = time.perf_counter()
            query().write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    for run in range(2):
        start = time.perf_counter()
        write_markdown(rp.findings_report(table, catalog), f"{place}/documents{run}", rp.report_order())
        times["markdown_files"] = round(time.perf_counter() - start, 3)
    rows = {"usage": usage_rows(shredded(usage, USAGE_FIELDS)).count(), "diagnosis": raw.count()}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": SF_DIR.rsplit("sf", 1)[-1], "rows": rows}))
    spark.stop()


if __name__ == "__main__":
    main()
