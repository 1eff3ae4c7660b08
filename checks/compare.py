"""Runs the check queries beside their SQL in DuckDB: ``python -m checks.compare SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


def session(cpus: int = 8) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("reportloom")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _rows(rows, names) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(spark: SparkSession, con, sf_dir: str, name: str, queries=QUERIES, oracles=ORACLES) -> tuple[int, str]:
    """The row count and what differs, empty text if nothing does."""
    df = queries[name](spark, sf_dir)
    mine = _rows((tuple(r) for r in df.collect()), df.columns)
    if name not in oracles:
        return sum(mine.values()), ""
    result = con.execute(oracles[name])
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return sum(mine.values()), f"columns {sorted(df.columns)} against {sorted(names)}"
    theirs = _rows(result.fetchall(), names)
    missing, extra = theirs - mine, mine - theirs
    if not missing and not extra:
        return sum(mine.values()), ""
    show = lambda c: "\n    ".join(str(row) for row in list(c)[:2])
    return sum(mine.values()), (f"{sum(missing.values())} missing, {sum(extra.values())} extra\n  missing\n    "
                                f"{show(missing)}\n  extra\n    {show(extra)}")


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, con, failed = session(), database(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            count, difference = differences(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            count, difference = 0, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(difference)
        print(f"{'FAIL' if difference else 'ok  '} {name:28} {count:8} rows {time.time() - start:6.1f} s {difference}",
              flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")


if __name__ == "__main__":
    main()
