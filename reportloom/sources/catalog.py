"""The findings catalog: what each diagnosis means, in sixty rows.

Priorities, findings, addresses and short titles are fixed values that reports are matched by; the descriptions are
our own. A catalog is always replaced as a whole, because a finding listed twice would be printed twice.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from reportloom.schema import CATALOG_DDL

_GO = "https://www.brentozar.com/go/"
DUPLICATES = _GO + "duplicateindex"
AGGRESSIVE = _GO + "AggressiveIndexes"
HOARDER = _GO + "IndexHoarder"
FEATURES = _GO + "IndexFeatures"
LOATHING = _GO + "SelfLoathing"
INDEXAPHOBIA = _GO + "Indexaphobia"
ABNORMAL = _GO + "AbnormalPsychology"
STATISTICS = _GO + "stats"
SCALAR = _GO + "computedscalar"
WORKAHOLICS = _GO + "Workaholics"
TRACE_FLAG = "https://support.microsoft.com/en-us/kb/3210239"

_DUPLICATE_KEYS = (
    "These indexes repeat the key columns of another index on the same table. Each copy takes space and memory and is "
    "maintained on every write, mostly for nothing. Before dropping one, check whether it is the clustered index, "
    "whether it enforces a constraint, which included columns it adds, and which copy queries really use.")
_NEAR_DUPLICATES = (
    "These indexes begin with the same key column as another index on their table and differ after it. Many such "
    "pairs can be merged into one index. Compare their types, included columns and usage first.")
_LOCK_WAITS = (
    "Sessions have waited more than five minutes in total for row or page locks here. The details say how often, "
    "for how long and on which kind of lock. Look at the whole table: a missing index can turn short reads into "
    "scans that block, and surplus indexes make every write hold more locks.")
_MANY_INDEXES = (
    "Tables with ten or more nonclustered indexes. Every insert and delete, and many updates, must maintain all of "
    "them. The number is a rule of thumb; review usage, overlap and width together before removing any.")
_UNUSED_WRITES = (
    "Nonclustered indexes that are written to often and have not been read since usage counters were last reset. "
    "Check that the counters cover a full business cycle before disabling one.")
_FILL_FACTOR = (
    "The fill factor is 80% or lower, so each page is left partly empty whenever the index is rebuilt. That costs "
    "disk, memory and reads. Keep a low value only where page splits were measured, and restore the default "
    "elsewhere.")
_REBUILD = (
    " Rebuilding the heap helps for a while; it is a fully logged operation, so plan it with log backups and outside "
    "busy hours. The lasting cure is a clustered index, unless the heap was measured to be faster.")
_FORWARDED = (
    "An updated row that no longer fits its page moves elsewhere and leaves a pointer behind. Each later read follows "
    "the pointer, which adds random reads." + _REBUILD)
_ACTIVE_HEAPS = (
    "Heaps that are read or written, but show no forwarded fetches or deletes since the last restart. They are the "
    "ones most likely to collect both." + _REBUILD)
_HEAP_DELETES = (
    "Deleting from a heap without a table lock leaves the emptied pages allocated to it, and scans go on reading "
    "them." + _REBUILD)
_HEAP_PK = (
    "The table has a primary key but no clustered index. A primary key is usually a good clustering key, so making "
    "it clustered often removes the heap at little cost.")
_WRITES_READS = (
    "Nonclustered indexes with at least ten times as many writes as reads. Their upkeep may cost more than they "
    "give. Weigh this together with the duplicate, unused and wide index findings.")
_MISSING = (
    "The server's own suggestions for indexes that would have helped recent queries most. They ignore each other and "
    "the indexes that already exist, so merge overlapping ones, prefer extending an existing index, rename them to "
    "your convention, and confirm with a test that the plan uses them and gets faster.")
_WIDE_INDEXES = (
    "Indexes with seven or more key and included columns. Wide indexes are large, change often and slow down writes. "
    "Some are justified; a habit of them is not.")
_WIDE_CLUSTERED = (
    "The clustering key has more than three columns or sixteen bytes. It is copied into every nonclustered index of "
    "the table, so its width is paid many times. Prefer keys that are static, unique, narrow and ever increasing; "
    "avoid character and nullable columns.")
_NULLABLE = (
    "Nearly all columns of these tables allow NULL. That can point at columns nobody fills or at data that belongs in "
    "a lookup table.")
_WIDE_TABLES = (
    "Tables with 35 columns or more, or with rows that may exceed 2000 bytes without large objects. Few rows fit a "
    "page, and rows of 8000 bytes or more rule out page compression. Check which columns are used and whether the "
    "table should be split.")
_NON_UNIQUE = (
    "The clustered index does not enforce uniqueness, so the server adds a hidden number to repeated keys and checks "
    "for repeats on every insert. The hidden number also ends up in nonclustered indexes. Declare the key unique "
    "where the data allows it.")
_COLLATION = (
    "The column's collation is not the database's. Comparisons and joins with other columns may fail, convert or sort "
    "in an unexpected way. Keep it only if it is intended.")
_FOREIGN_KEYS = (
    "No index supports the foreign key. Joins along it and deletes from the parent table have to scan. Index the "
    "referencing columns if either happens.")

# Priority, finding, address, short title; then the description.
CATALOG = (
    (20, "Multiple Index Personalities: Duplicate keys", DUPLICATES, "Duplicate keys", _DUPLICATE_KEYS),
    (30, "Multiple Index Personalities: Borderline duplicate keys", DUPLICATES, "Approximate duplicate keys",
     _NEAR_DUPLICATES),
    (70, "Aggressive Under-Indexing: Total lock wait time > 5 minutes (row + page)", AGGRESSIVE,
     "Potential Under-Indexing: Total lock wait time > 5 minutes (row + page)", _LOCK_WAITS),
    (70, "Aggressive Indexes: Total lock wait time > 5 minutes (row + page)", AGGRESSIVE,
     "Total lock wait time > 5 minutes (row + page)", _LOCK_WAITS),
    (70, "Aggressive Over-Indexing: Total lock wait time > 5 minutes (row + page)", AGGRESSIVE,
     "Potential Over-Indexing: Total lock wait time > 5 minutes (row + page)", _LOCK_WAITS),
    (10, "Index Hoarder: Many NC Indexes on a Single Table", HOARDER, "Many NC Indexes on a Single Table",
     _MANY_INDEXES),
    (10, "Index Hoarder: Unused NC Index with High Writes", HOARDER, "Unused NC Index with High Writes",
     _UNUSED_WRITES),
    (80, "Abnormal Psychology: Filter Columns Not In Index Definition", FEATURES,
     "Filter Columns Not In Index Definition",
     "A filtered index should also contain the columns its filter tests, or the optimizer may pass it over."),
    (100, "Self Loathing Indexes: Low Fill Factor on Nonclustered Index", LOATHING,
     "Low Fill Factor on Nonclustered Index", _FILL_FACTOR),
    (100, "Self Loathing Indexes: Low Fill Factor on Clustered Index", LOATHING,
     "Low Fill Factor on Clustered Index", _FILL_FACTOR),
    (100, "Self Loathing Indexes: Heaps with Forwarded Fetches", LOATHING, "Heaps with Forwarded Fetches", _FORWARDED),
    (100, "Self Loathing Indexes: Large Active Heap", LOATHING, "Active Heap(s)", _ACTIVE_HEAPS),
    (100, "Self Loathing Indexes: Medium Active Heap", LOATHING, "Active Heap(s)", _ACTIVE_HEAPS),
    (100, "Self Loathing Indexes: Small Active Heap", LOATHING, "Active Heap(s)", _ACTIVE_HEAPS),
    (100, "Self Loathing Indexes: Heap with a Nonclustered Primary Key", LOATHING,
     "Heap with a Nonclustered Primary Key", _HEAP_PK),
    (100, "Index Hoarder: NC index with High Writes:Reads", HOARDER, "NC Index with High Writes:Reads", _WRITES_READS),
    (50, "Indexaphobia: High Value Missing Index", INDEXAPHOBIA, "High Value Missing Index", _MISSING),
    (80, "Abnormal Psychology: Identity Column Within xx Percent End of Range", ABNORMAL, "", ""),
    (80, "Abnormal Psychology: Columnstore Indexes with Trace Flag 834", TRACE_FLAG,
     "Columnstore Indexes with Trace Flag 834",
     "Columnstore indexes and trace flag 834 are known to disturb each other. Read the vendor's note and drop one."),
    (90, "Functioning Statistaholics: Statistics Not Updated Recently", STATISTICS,
     "Statistics Not Updated Recently",
     "Statistics of active tables should be refreshed about weekly, and after large loads or purges."),
    (90, "Functioning Statistaholics: Low Sampling Rates", STATISTICS, "Low Sampling Rates",
     "These statistics were built from a small sample, which can mislead row estimates and so query plans."),
    (90, "Functioning Statistaholics: Statistics With NO RECOMPUTE", STATISTICS, "", ""),
    (100, "Serial Forcer: Check Constraint with Scalar UDF", SCALAR, "Check Constraint with Scalar UDF",
     "A check constraint calls a scalar function, so work on its table cannot run in parallel."),
    (100, "Serial Forcer: Computed Column with Scalar UDFs", SCALAR, "Computed Column with Scalar UDF",
     "A computed column calls a scalar function, so work on its table cannot run in parallel."),
    (150, "Index Hoarder: More Than 5 Percent NC Indexes Are Unused", HOARDER,
     "More Than 5 Percent NC Indexes Are Unused",
     "More than one in twenty nonclustered indexes has no reads. Review those listed as unused."),
    (150, "Index Hoarder: Borderline: Wide Indexes (7 or More Columns)", HOARDER, "Wide Indexes (7 or More Columns)",
     _WIDE_INDEXES),
    (150, "Index Hoarder: Wide Clustered Index (> 3 columns OR > 16 bytes)", HOARDER,
     "Wide Clustered Index (> 3 columns OR > 16 bytes)", _WIDE_CLUSTERED),
    (200, "Index Hoarder: Addicted to Nulls", HOARDER, "Tables with a high NULLable column ratio", _NULLABLE),
    (150, "Index Hoarder: Wide Tables: 35+ cols or > 2000 non-LOB bytes", HOARDER,
     "Wide Tables: 35+ cols or > 2000 non-LOB bytes", _WIDE_TABLES),
    (200, "Index Hoarder: Addicted to strings", HOARDER, "", ""),
    (150, "Index Hoarder: Non-Unique Clustered Index", HOARDER, "Non-Unique Clustered Index", _NON_UNIQUE),
    (150, "Index Hoarder: Unused NC index with Low Writes", HOARDER, "Unused NC index with Low Writes",
     "Nonclustered indexes without reads since the last restart and with few writes. They may serve rare jobs or "
     "enforce a key, so check both before removing one."),
    (250, "Feature-Phobic Indexes: No Indexes Use Includes", FEATURES, "",
     "No index has included columns, which can cover queries without widening keys."),
    (250, "Feature-Phobic Indexes: Few Indexes Use Includes", FEATURES, "Few Indexes Use Includes",
     "Hardly any index has included columns. There is no right share, but check that the option is known and used."),
    (250, "Feature-Phobic Indexes: No Filtered Indexes or Indexed Views", FEATURES,
     "No Filtered Indexes or Indexed Views",
     "Neither feature is used. Both can help special cases, but writes from sessions with other SET options can fail "
     "once they exist, so try them in development first."),
    (250, "Feature-Phobic Indexes: Potential Filtered Index (Based on Column Name)", FEATURES,
     "Potential Filtered Index (Based on Column Name)",
     "A key column is named like a flag, so a filtered index might serve its queries better."),
    (150, "Self Loathing Indexes: Hypothetical Index", LOATHING, "", ""),
    (150, "Self Loathing Indexes: Disabled Index", LOATHING, "Disabled Index",
     "Disabled indexes are either leftovers to drop or were meant to be enabled again."),
    (200, "Self Loathing Indexes: Heaps with Deletes", LOATHING, "Heaps with Deletes", _HEAP_DELETES),
    (150, "Abnormal Psychology: XML Index", ABNORMAL, "", ""),
    (150, "Abnormal Psychology: NC Columnstore Index", ABNORMAL, "", ""),
    (150, "Abnormal Psychology: Clustered Columnstore Index", ABNORMAL, "", ""),
    (150, "Abnormal Psychology: Spatial Index", ABNORMAL, "", ""),
    (150, "Abnormal Psychology: Compressed Index", ABNORMAL, "", ""),
    (150, "Abnormal Psychology: Partitioned Index", ABNORMAL, "", ""),
    (150, "Abnormal Psychology: Non-Aligned Index on a Partitioned Table", ABNORMAL, "", ""),
    (200, "Abnormal Psychology: Recently Created Tables/Indexes (1 week)", ABNORMAL, "", ""),
    (200, "Abnormal Psychology: Recently Modified Tables/Indexes (2 days)", ABNORMAL, "", ""),
    (150, "Abnormal Psychology: Column Collation Does Not Match Database Collation", ABNORMAL,
     "Column Collation Does Not Match Database Collation", _COLLATION),
    (200, "Abnormal Psychology: Replicated Columns", ABNORMAL, "", ""),
    (150, "Abnormal Psychology: Cascading Updates or Deletes", ABNORMAL, "", ""),
    (150, "Abnormal Psychology: Unindexed Foreign Keys", ABNORMAL, "Unindexed Foreign Keys", _FOREIGN_KEYS),
    (150, "Abnormal Psychology: In-Memory OLTP", ABNORMAL, "", ""),
    (200, "Abnormal Psychology: Identity Column Using a Negative Seed or Increment Other Than 1", ABNORMAL, "", ""),
    (200, "Workaholics: Scan-a-lots (index-usage-stats)", WORKAHOLICS, "", ""),
    (200, "Workaholics: Top Recent Accesses (index-op-stats)", WORKAHOLICS, "", ""),
    (200, "Functioning Statistaholics: Filter Fixation", STATISTICS, "", ""),
    (200, "Cold Calculators: Definition Defeatists", "", "", ""),
    (200, "Abnormal Psychology: Temporal Tables", "", "", ""),
    (200, "Medicated Indexes: Optimized For Sequential Keys", "", "", ""),
)


def load_catalog(spark: SparkSession) -> DataFrame:
    """The sixty rows as a local relation."""
    names = [field.split()[0] for field in CATALOG_DDL.split(", ")]
    rows = pa.table([pa.array(column) for column in zip(*CATALOG)], names=names)
    return spark.createDataFrame(rows).withColumn("priority", F.col("priority").cast("smallint"))


def seed_catalog(spark: SparkSession, name: str) -> None:
    """Writes the catalog table, replacing what it held."""
    load_catalog(spark).write.mode("overwrite").format("parquet").saveAsTable(name)
