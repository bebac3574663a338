"""Time shared by pairs of players."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icetally.functions.arrays import combos
from icetally.functions.rates import toi_value
from icetally.operators import timeline as tl


def _everyone(side: int) -> Column:
    return F.array_union(F.col(f"s{side}_ids"), F.col(f"g{side}_ids"))


def pairs_of(ids: Column) -> Column:
    return combos(F.array_sort(ids), 2)


def shared_toi_teammates(pbp: DataFrame, in_seconds: bool = False) -> DataFrame:
    """(gameId, eventTeam, player1Id, tm_player1Id, Strength, TOI): ordered pairs of one side, goalies
    included, label from that side's view."""
    views = F.array(
        F.struct(F.col("t1").alias("eventTeam"), _everyone(1).alias("ids"), tl.label("12").alias("Strength")),
        F.struct(F.col("t2").alias("eventTeam"), _everyone(2).alias("ids"), tl.label("21").alias("Strength")),
    )
    # Each unordered pair is counted once and read from both ends afterwards.
    return (
        tl.lineups(pbp, "home")
        .select("gameId", "seconds", F.explode(views).alias("v"))
        .select("gameId", "seconds", "v.eventTeam", "v.Strength", F.explode(pairs_of(F.col("v.ids"))).alias("ab"))
        .select("gameId", "seconds", "eventTeam", "Strength", F.col("ab")[0].alias("a"), F.col("ab")[1].alias("b"))
        .groupBy("gameId", "eventTeam", "a", "b", "Strength")
        .agg(F.sum("seconds").alias("sec"))
        .withColumn("p", F.explode(F.array(
            F.struct(F.col("a").alias("x"), F.col("b").alias("y")),
            F.struct(F.col("b").alias("x"), F.col("a").alias("y")),
        )))
        .select("gameId", "eventTeam", F.col("p.x").alias("player1Id"), F.col("p.y").alias("tm_player1Id"),
                "Strength", toi_value("sec", in_seconds).alias("TOI"))
    )


def shared_toi_opponents(pbp: DataFrame, in_seconds: bool = False) -> DataFrame:
    """(gameId, eventTeam, player1Id, opp_player1Id, playerStrength, oppStrength, TOI), from both sides."""
    return (
        tl.lineups(pbp, "home")
        .select("gameId", "t1", "t2", "seconds", tl.label("12").alias("home_label"),
                tl.label("21").alias("away_label"), _everyone(2).alias("away"),
                F.explode(_everyone(1)).alias("h"))
        .withColumn("a", F.explode("away"))
        .groupBy("gameId", "h", "a", "home_label", "away_label")
        .agg(F.sum("seconds").alias("sec"), F.first("t1").alias("t1"), F.first("t2").alias("t2"))
        .withColumn("p", F.explode(F.array(
            F.struct(F.col("t1").alias("team"), F.col("h").alias("x"), F.col("a").alias("y"),
                     F.col("home_label").alias("own"), F.col("away_label").alias("opp")),
            F.struct(F.col("t2").alias("team"), F.col("a").alias("x"), F.col("h").alias("y"),
                     F.col("away_label").alias("own"), F.col("home_label").alias("opp")),
        )))
        .select("gameId", F.col("p.team").alias("eventTeam"), F.col("p.x").alias("player1Id"),
                F.col("p.y").alias("opp_player1Id"), F.col("p.own").alias("playerStrength"),
                F.col("p.opp").alias("oppStrength"), toi_value("sec", in_seconds).alias("TOI"))
    )
