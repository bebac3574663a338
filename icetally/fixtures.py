"""Play-by-play, shift and roster views over the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer has a seat: 24 players in each game."""
    key = F.col("c_custkey")
    k = key % 24
    return table(spark, sf_dir, "customer").select(
        F.floor(key / 24).alias("gameId"), k.alias("playerId"), F.col("c_name").alias("fullName"),
        F.when(k < 12, 1).otherwise(0).alias("isHome"),
        F.when(k % 12 == 0, "G").when(k % 12 < 5, "D").when(k % 3 == 0, "L").otherwise("C").alias("positionCode"),
        (k + 10).cast("int").alias("sweaterNumber"),
    )


def pbp(spark: SparkSession, sf_dir: str, names: bool = False) -> DataFrame:
    """Thirty games of plays and ON/OFF rows."""
    k, uid, eid = F.col("k"), F.col("user_id"), F.col("event_id")
    t = F.floor((F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")) / 24.0).cast("int")
    kind = F.col("event_type")
    other = (
        F.when(k < 15, "GOAL").when(k < 35, "PENL").when(k < 50, "GIVE").when(k < 65, "TAKE")
        .when(k < 80, "FAC").when(k < 90, "HIT").otherwise("STOP")
    )
    event = (
        F.when(kind == "view", "ON").when(kind == "signup", "OFF").when(kind == "click", "SHOT")
        .when(kind == "error", F.when(k < 50, "MISS").otherwise("BLOCK")).otherwise(other)
    )
    base = table(spark, sf_dir, "events").withColumn(
        "k", F.translate("props", "{}\"k: ", "").cast("int")
    ).select(
        eid.alias("event_id"), eid.alias("seq"), "user_id", "k",
        F.dayofyear("ts").alias("gameId"), t.alias("elapsedTime"), (uid % 12).alias("pid"),
        F.when(uid % 2 == 0, "AAA").otherwise("BBB").alias("eventTeam"), event.alias("Event"),
    )
    change = F.col("Event").isin("ON", "OFF")
    located = ~change & (eid % 17 != 0)
    goal = F.col("Event") == "GOAL"
    out = base.select(
        "event_id", "seq", "user_id", "k", "gameId", "elapsedTime",
        (F.floor(F.col("elapsedTime") / 1200.0).cast("int") + 1).alias("period"), "Event", "eventTeam",
        F.lit("AAA").alias("homeTeam"), F.lit("BBB").alias("awayTeam"),
        F.when(F.col("eventTeam") == "AAA", 1).otherwise(0).alias("isHome"),
        F.when(change, F.col("pid")).alias("player1Id"),
        F.when(change, F.when(F.col("pid") < 2, 1).otherwise(0)).alias("isGoalie"),
        F.when(F.col("Event").isin("SHOT", "GOAL", "MISS"), k.cast("double") / 250).alias("xG"),
        F.when(located, (k * 2 - 99).cast("double")).alias("xCoord"),
        F.when(located, ((uid * 7 + k) % 85 - 42).cast("double")).alias("yCoord"),
        F.when(goal, (k % 7).cast("int")).alias("homeScore"),
        F.when(goal, (k % 5).cast("int")).alias("awayScore"),
        (3 + eid % 4).cast("int").alias("home_on_count"),
        (3 + eid % 5).cast("int").alias("away_on_count"),
        F.when(k % 20 == 0, 1).otherwise(0).alias("pulled_home"),
        F.when(k % 20 == 1, 1).otherwise(0).alias("pulled_away"),
    )
    if names:
        who = roster(spark, sf_dir).select(
            "gameId", F.col("playerId").alias("player1Id"), F.col("fullName").alias("player1Name")
        )
        out = out.join(who, ["gameId", "player1Id"], "left")
    return out


def shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One game per supplier, 24 players, overlapping shifts; shift_id repeats."""
    start = ((F.col("l_orderkey") * 37 + F.col("l_linenumber") * 11) % 3600).cast("int")
    p = F.col("l_partkey")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("shift_id"),
        F.col("l_suppkey").alias("gameId"), (p % 24).alias("playerId"),
        F.when(p % 24 < 12, 1).otherwise(0).alias("isHome"),
        F.when(p % 12 == 0, "G").when(p % 12 < 5, "D").otherwise("C").alias("positionCode"),
        start.alias("elapsed_time_start"),
        (start + F.floor("l_quantity").cast("int")).alias("elapsed_time_end"),
    )


def forest() -> dict:
    """A small stored shot model: numbers, a flag, categories and a missing value."""
    def split(name: str, limit: object, yes: object, no: object) -> dict:
        test = {"among": limit} if isinstance(limit, list) else {"at_most": limit}
        return {"input": name, **test, **{k: v if isinstance(v, dict) else {"value": v} for k, v in (("yes", yes), ("no", no))}}

    return {
        "scale": 2.0, "base": -0.25, "missing": {"distanceFromGoal": 60.0, "timeDiff": 9.0},
        "trees": [
            {"weight": 1.0, "root": split(
                "distanceFromGoal", 30.5, split("angle_signed", -10.0, 0.4, split("isRebound", 0.5, 0.2, 0.9)),
                split("shotType", ["wrist", "<NA>"], -0.6, -0.9))},
            {"weight": 0.5, "root": split(
                "previousEvent", ["FAC", "STOP"], split("timeDiff", 4.0, 0.3, -0.1),
                split("strengthDiff", 0.0, -0.2, split("shootEmptyNet", 0.5, 0.1, 0.7)))},
            {"weight": 0.25, "root": split("scoreDiff", -1.0, 0.15, split("previousEventXNorm", 25.0, -0.35, 0.05))},
        ],
    }
