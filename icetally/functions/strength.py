"""Strength labels and on-ice counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def side_label(skaters: Column, goalies: Column, star: str = "*") -> Column:
    """Skater count of one side, starred when its net is empty."""
    return F.concat(skaters.cast("string"), F.when(goalies > 0, F.lit("")).otherwise(F.lit(star)))


def list_size(c: Column) -> Column:
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(c))


def on_ice_counts(df: DataFrame) -> DataFrame:
    """Sizes of the four on-ice lists, skater counts and empty-net flags."""
    for base in ("home_on", "away_on", "homeGoalie_on", "awayGoalie_on"):
        df = df.withColumn(f"{base}_count", list_size(F.col(f"{base}_id")))
    for side in ("home", "away"):
        goalies = F.col(f"{side}Goalie_on_count")
        df = df.withColumn(
            f"n_{side}_skaters", F.col(f"{side}_on_count") - F.least(goalies, F.lit(1))
        ).withColumn(f"pulled_{side}", (goalies == 0).cast("int"))
    return df


def strength_strings(df: DataFrame) -> DataFrame:
    """home_strength, away_strength, gameStrength and detailedGameStrength of play rows.

    The event team's count stands first; a row without side is read home first. Rows with an empty
    side get nulls.
    """
    home_first = F.coalesce(F.col("isHome").cast("int"), F.lit(1)) != 0
    known = (F.col("home_on_count") > 0) & (F.col("away_on_count") > 0)

    def oriented(home: Column, away: Column) -> tuple[Column, Column]:
        return F.when(home_first, home).otherwise(away), F.when(home_first, away).otherwise(home)

    def starred(side: str) -> Column:
        count = F.col(f"{side}_on_count").cast("string")
        return F.when(F.col(f"pulled_{side}") == 1, F.concat(count, F.lit("*"))).otherwise(count)

    plain = oriented(F.col("home_on_count").cast("string"), F.col("away_on_count").cast("string"))
    star = oriented(starred("home"), starred("away"))
    return df.withColumns(
        {
            "home_strength": F.when(known, star[0]),
            "away_strength": F.when(known, star[1]),
            "gameStrength": F.when(known, F.concat(plain[0], F.lit("v"), plain[1])),
            "detailedGameStrength": F.when(known, F.concat(star[0], F.lit("v"), star[1])),
        }
    )
