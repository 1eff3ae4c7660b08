"""Intermediate tables whose shuffle files go as soon as the table is written."""

from __future__ import annotations

from pyspark.sql import DataFrame

from reportloom.sources.scratch import materialise

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, outlives: bool = False) -> DataFrame:
    """Writes the frame to the shared folder and reads it back. Until the session's own setting is restored, Spark drops
    the shuffle files of the write when it ends; otherwise they stay until the driver collects its garbage. A table that
    outlives the ``scratch_scope`` it is written in stays when that ends."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return materialise(df, outlives=outlives)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
