"""Deal out work that multiplies rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(scan: DataFrame, tasks: int) -> DataFrame:
    """The rows dealt out to `tasks` tasks, whatever the scan gives.

    For work that costs much per row or multiplies rows over files that cannot
    be split (one row group, quoted newlines, gzip). The caller knows its files;
    nothing is decided by their size.
    """
    return scan.repartition(tasks)


def shuffle_partitions(df: DataFrame) -> int:
    """The session's shuffle width, for an explicit repartition (which AQE does not coalesce)."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
