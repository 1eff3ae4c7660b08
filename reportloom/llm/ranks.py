"""Gapless numbers within a few large groups, without one task for each group."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

ROWS_A_PART = 10_000


def ranked(df: DataFrame, group: str, key: str, rows: int, name: str) -> DataFrame:
    """Adds numbers from 0 within each group. key tells rows apart; df must give the same rows each time it is read.

    A group is dealt into parts by a hash of the key, each part is numbered on its own, and the counts of the parts
    before it are added. The shuffle that numbers a part also joins its count.
    """
    part, local, before = f"{name}_part", f"{name}_local", f"{name}_before"
    parts = max(1, math.ceil(rows / ROWS_A_PART))
    dealt = df.withColumn(part, F.pmod(F.xxhash64(key), F.lit(parts)))
    counted = dealt.groupBy(group, part).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(group, part, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))
    numbered = dealt.withColumn(local, F.row_number().over(Window.partitionBy(group, part).orderBy(key)) - 1)
    return (numbered.join(offsets, [group, part]).withColumn(name, F.col(local) + F.col(before))
            .drop(part, local, before))
