"""Row numbers without sorting a whole group in one task.

A plain ``row_number`` over a group puts that group into one task, and one report may hold a third of all rows.
Both ways here split a group, number the pieces, and add up what lies before each piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from reportloom.sources.scratch import materialise

# A piece table up to this many rows is broadcast (some tens of bytes a row); a larger one is joined by shuffle.
BROADCAST_ROWS = 200_000


def _sum_before(within: Sequence[str | Column], order: Sequence[str | Column]) -> Column:
    window = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(window), F.lit(0))


def with_row_id(df: DataFrame, within: Sequence[str], order: Sequence[str], position: Sequence[str],
                name: str = "id", chunk: int = 2_000_000) -> DataFrame:
    """Numbers the rows of each ``within`` group by ``order``, then by ``position``.

    The last ``position`` column must be a running whole number, such as the place of a row in its file: its row
    number, or its byte offset where a large file is read in pieces. Cutting that range into chunks bounds every piece
    by ``chunk`` rows however many rows share a group and an order key.
    Rows are shuffled once, on the piece; the counts are combined before their own, small shuffle. Pieces are equal
    when all their columns are, NULL included, since a struct compares whole.
    """
    *outer, last = position
    piece = df.withColumn("_piece", F.struct(*within, *order, *outer, F.floor(F.col(last) / chunk).alias("_chunk")))
    parts = [f"_piece.{c}" for c in [*order, *outer, "_chunk"]]
    starts = (piece.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n"))
              .select("_piece", _sum_before([f"_piece.{c}" for c in within], parts).alias("_before")))
    inner = F.row_number().over(Window.partitionBy("_piece").orderBy(last))
    return (piece.withColumn("_inner", inner)
            .join(starts, "_piece")
            .withColumn(name, F.col("_before") + F.col("_inner"))
            .drop("_piece", "_inner", "_before"))


def number_rows(df: DataFrame, order: Sequence[Column], within: Sequence[str] = (), name: str = "row_no",
                partitions: int | None = None) -> DataFrame:
    """Numbers the rows of each ``within`` group, or of the whole frame, by any ``order``.

    Rows are ranged by group and order, sorted within partitions and written once to the shared folder with their
    place in the partition, so both passes below read the same places even if executors are lost. The first pass
    reads the group and place columns only. ``order`` should end in a unique column: ties cannot be ranged apart.
    """
    spark = df.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(c).asc() for c in within], *order]
    ranged = (df.repartitionByRange(count, *keys).sortWithinPartitions(*keys)
              .withColumn("_at", F.monotonically_increasing_id()))
    kept = materialise(ranged).withColumn("_run", F.struct(*within, F.shiftright("_at", 33).alias("_part")))
    runs = kept.groupBy("_run").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    # Without a group this window sees one row per partition, never more.
    offset = _sum_before([f"_run.{c}" for c in within], ["_run._part"]) - F.col("_first") + 1
    bases = materialise(runs.select("_run", offset.alias("_base")))
    if bases.count() <= BROADCAST_ROWS:
        bases = F.broadcast(bases)
    return (kept.join(bases, "_run")
            .withColumn(name, F.col("_at") + F.col("_base"))
            .drop("_run", "_at", "_base"))


def running(df: DataFrame, within: Sequence[str], block: str, order: str, values: dict[str, Column]) -> DataFrame:
    """Adds the sums of whole numbers over all rows of a ``within`` group up to each row, the row included.

    Rows are summed up block by block, a block being a bounded part of the group such as a split of a file, and what the
    blocks before hold is added. The frame is read twice, so it should be a stored one.
    """
    local = Window.partitionBy(*within, block).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*within).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*within, block).agg(*[F.sum(v).alias(n) for n, v in values.items()])
    offsets = totals.select(*within, block, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_{n}") for n in values])
    summed = df.withColumns({n: F.sum(v).over(local) for n, v in values.items()})
    return summed.join(offsets, [*within, block]).withColumns({n: F.col(n) + F.col(f"_{n}") for n in values}).drop(*[f"_{n}" for n in values])


def latest(df: DataFrame, within: Sequence[str], block: str, order: str, value: Column, name: str) -> DataFrame:
    """Adds the last value that is not NULL in a ``within`` group up to each row, the row included; blocks as in ``running``."""
    local = Window.partitionBy(*within, block).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*within).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    lasts = df.groupBy(*within, block).agg(F.max_by(value, F.when(value.isNotNull(), F.col(order))).alias("_last"))
    carried = lasts.select(*within, block, F.last("_last", ignorenulls=True).over(before).alias("_last"))
    own = df.withColumn("_own", F.last(value, ignorenulls=True).over(local))
    return own.join(carried, [*within, block]).withColumn(name, F.coalesce("_own", "_last")).drop("_own", "_last")
