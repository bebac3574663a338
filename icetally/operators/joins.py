"""Joins of per-game dimensions onto row-level tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dimension(rows: DataFrame, dim: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Joins a dimension of a few rows per key onto rows whose keys may be very uneven.

    A plain join: large partitions of the rows are split at run time (skew join), which copies the dimension
    only where a key is found to be heavy.
    """
    return rows.join(dim, on, how)


def jersey_maps(spots: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with maps ``ids`` (jersey -> player id) and ``names`` (jersey -> full name).

    Of several players with one jersey the highest id counts; a map is bounded by the jersey numbers.
    """
    one = spots.where(F.col("sweaterNumber").isNotNull()).groupBy(*keys, "sweaterNumber").agg(
        F.max_by(F.struct(F.col("playerId").cast("bigint").alias("playerId"), "fullName"), "playerId").alias("p")
    )
    return one.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("sweaterNumber", "p.playerId"))).alias("ids"),
        F.map_from_entries(F.collect_list(F.struct("sweaterNumber", "p.fullName"))).alias("names"),
    )
