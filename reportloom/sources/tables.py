"""Report tables: created once, kept to their fields, appended to or replaced per load."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from reportloom.sources.scratch import remove


def ensure_table(spark: SparkSession, name: str, ddl: str, partition_by: str = "load_id",
                 location: str | None = None, renamed: Mapping[str, str] | None = None) -> None:
    """Creates the table if it is missing; one that is there is compared with the wanted fields.

    Fields that it lacks are added, NULL in the rows it has. A field of another type is refused, and so are new fields in a
    table that has others the wanted ones do not name, since they may be the same under another name: ``renamed`` maps the
    new names of such to the old ones (``read_renamed`` reads both as one) or to an empty text for one that is really new.
    """
    if not spark.catalog.tableExists(name):
        place = f"LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet PARTITIONED BY ({partition_by}) {place}")
    renamed = dict(renamed or {})
    wanted, found = {f.name: f for f in StructType.fromDDL(ddl)}, {f.name: f for f in spark.table(name).schema}
    other = [f"{n} is {found[n].dataType.simpleString()}, wanted {f.dataType.simpleString()}"
             for n, f in wanted.items() if n in found and found[n].dataType != f.dataType]
    for new, old in renamed.items():
        if old and old not in found:
            other.append(f"{new} was {old}, which is not there")
        elif old and new in wanted and found[old].dataType != wanted[new].dataType:
            other.append(f"{old} is {found[old].dataType.simpleString()}, {new} is wanted {wanted[new].dataType.simpleString()}")
    added = [f for n, f in wanted.items() if n not in found]
    unknown = [n for n in found if n not in wanted and n not in renamed.values()]
    doubtful = [f.name for f in added if f.name not in renamed]
    if unknown and doubtful:
        other.append(f"new {', '.join(doubtful)} beside {', '.join(unknown)}, which may be their old names")
    if other:
        raise ValueError(f"table {name} does not fit: {'; '.join(other)}")
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in added)})")


def read_renamed(spark: SparkSession, name: str, renamed: Mapping[str, str]) -> DataFrame:
    """The table with renamed columns as one: what older rows hold under the old name, newer ones under the new one."""
    table = spark.table(name)
    pairs = {new: old for new, old in renamed.items() if old}
    return table.withColumns({new: F.coalesce(new, old) for new, old in pairs.items()}).drop(*pairs.values())


def _fitted(df: DataFrame, name: str, besides: tuple[str, ...] = ()) -> list[str]:
    """The table's columns, after a check that the frame has no others. Columns it lacks are NULL."""
    columns = df.sparkSession.table(name).columns
    unknown = [c for c in df.columns if c not in columns and c not in besides]
    if unknown:
        raise ValueError(f"table {name} has no column {', '.join(unknown)}")
    return columns


def _values(df: DataFrame, columns: list[str]) -> list:
    return [F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns]


def append(df: DataFrame, name: str) -> None:
    """Adds rows on every call, so loading a report twice doubles it."""
    df.select(*_values(df, _fitted(df, name))).write.mode("append").insertInto(name)


@contextmanager
def _partitions_only(spark: SparkSession) -> Iterator[None]:
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(mode, before)


def replace_loads(df: DataFrame, name: str) -> None:
    """Writes the partitions that the rows name in ``load_id``, in one job; those loads are replaced, others stay."""
    rows = df.select(*_values(df, _fitted(df, name)))
    with _partitions_only(df.sparkSession):
        rows.write.mode("overwrite").insertInto(name)


def replace_load(df: DataFrame, name: str, load_id: str) -> None:
    """Writes one load as one partition; running the same load again replaces it and leaves the others.

    A load is a batch of reports, such as a day's, so the number of partitions follows the loads rather than the
    reports. The old partition goes only when the new files are complete, so a run that fails leaves it as it was. A run
    without rows replaces nothing.
    """
    replace_loads(df.withColumn("load_id", F.lit(load_id)), name)


def drop_load(spark: SparkSession, name: str, load_id: str) -> None:
    """Removes one load's partition, files included."""
    place = next(row.data_type for row in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if row.col_name == "Location")
    folder = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(load_id)
    if spark.conf.get("spark.sql.catalogImplementation") == "hive":  # the only one that keeps a list of partitions
        escaped = load_id.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (load_id = '{escaped}')")
    remove(spark, f"{place.rstrip('/')}/load_id={folder}")
    spark.catalog.refreshTable(name)
