"""Time on ice by strength, player and second."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icetally.functions.rates import toi_value
from icetally.operators import timeline as tl


def toi_by_strength(pbp: DataFrame) -> DataFrame:
    """(gameId, strength, seconds, minutes) with the alphabetically first team on the left."""
    return (
        tl.cells(tl.ledger(pbp, changes_only=True)).where("t_end > t_start")
        .groupBy("gameId", tl.label("12").alias("strength"))
        .agg(F.sum(F.col("t_end") - F.col("t_start")).alias("seconds"))
        .withColumn("minutes", F.col("seconds") / 60.0)
    )


def players_on(side1_label: str, side2_label: str, goalies: bool = True) -> Column:
    """Array of (pid, side1, goalie, label) of everybody in a lineup; labels are SQL expressions."""
    def part(ids: str, side1: bool, goalie: bool) -> str:
        text = side1_label if side1 else side2_label
        return f"transform({ids}, p -> named_struct('pid', p, 'side1', {side1}, 'goalie', {goalie}, 'label', {text}))"

    parts = [part("s1_ids", True, False), part("s2_ids", False, False)]
    if goalies:
        parts += [part("g1_ids", True, True), part("g2_ids", False, True)]
    return F.expr(f"concat({', '.join(parts)})")


def toi_by_player_and_strength(pbp: DataFrame) -> DataFrame:
    """(gameId, player1Id, player1Name, eventTeam, strength, seconds, minutes), goalies included."""
    toi = (
        tl.lineups(pbp, changes_only=True)
        .withColumn("strength", tl.label("12"))
        .select("gameId", "seconds", F.explode(players_on("strength", "strength")).alias("p"))
        .groupBy("gameId", F.col("p.pid").alias("player1Id"), F.col("p.label").alias("strength"))
        .agg(F.sum("seconds").alias("seconds"))
    )
    return toi.join(tl.player_names(pbp), ["gameId", "player1Id"]).select(
        "gameId", "player1Id", F.col("name").alias("player1Name"), F.col("team").alias("eventTeam"),
        "strength", "seconds", (F.col("seconds") / 60.0).alias("minutes"),
    )


def strength_by_second_full(pbp: DataFrame, sep: str = "v", star: str = "*") -> DataFrame:
    """Counts, side strings and both team labels for every second up to the last one anybody is on."""
    home, away = tl.side_strings(star)
    anybody = F.when(F.col("s1") + F.col("s2") + F.col("g1") + F.col("g2") > 0, F.col("t_end"))
    return (
        tl.cells(tl.ledger(pbp, "home"))
        .withColumn("ice_end", F.max(anybody).over(Window.partitionBy("gameId")))
        .withColumn("t_end", F.least("t_end", "ice_end"))
        .where(F.col("t_end") > F.col("t_start"))
        .withColumn("second", F.explode(F.sequence("t_start", F.col("t_end") - 1)))
        .select(
            "gameId", "second",
            F.col("s1").alias("home_sktrs_count"), F.col("s2").alias("away_sktrs_count"),
            F.col("g1").alias("home_goalies_count"), F.col("g2").alias("away_goalies_count"),
            home.alias("home_strength"), away.alias("away_strength"),
            F.concat(home, F.lit(sep), away).alias("team_str_home"),
            F.concat(away, F.lit(sep), home).alias("team_str_away"),
        )
    )


def toi_player_strength_dense(pbp: DataFrame, in_seconds: bool = False) -> DataFrame:
    """Every player of a game against every label any of its players saw, zeros included."""
    toi = (
        tl.lineups(pbp, "home")
        .withColumns({"l12": tl.label("12"), "l21": tl.label("21")})
        .select("gameId", "t1", "t2", "seconds", F.explode(players_on("l12", "l21")).alias("p"))
        .groupBy("gameId", F.when(F.col("p.side1"), F.col("t1")).otherwise(F.col("t2")).alias("eventTeam"),
                 F.col("p.goalie").cast("int").alias("isGoalie"), F.col("p.pid").alias("player1Id"),
                 F.col("p.label").alias("Strength"))
        .agg(F.sum("seconds").alias("sec"))
    )
    # A game has as many of these rows as players times labels; its label list is a window over them
    # and each player row fills in the labels it lacks, so nothing is crossed.
    player = ("gameId", "eventTeam", "isGoalie", "player1Id")
    seen = toi.withColumn(
        "labels", F.collect_set("Strength").over(Window.partitionBy("gameId"))
    ).groupBy(*player).agg(
        F.map_from_entries(F.collect_list(F.struct("Strength", "sec"))).alias("seen"),
        F.first("labels").alias("labels"),
    )
    return (
        seen.withColumn("Strength", F.explode("labels"))
        .withColumn("sec", F.coalesce(F.try_element_at("seen", F.col("Strength")), F.lit(0).cast("bigint")))
        .select("gameId", "player1Id", "eventTeam", "isGoalie", "Strength",
                toi_value("sec", in_seconds).alias("time_on_ice"))
    )
