"""Shot, penalty and possession counts per player and per team.

GOAL, SHOT and MISS belong to the event team; a BLOCK row names the blocking team, so the attempt is
the other team's. PF counts penalties drawn, PA penalties taken. Plays count for the players on the ice
before the changes of their second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icetally.functions.rates import RATE_FIELDS, per60_filled
from icetally.operators import timeline as tl
from icetally.operators.toi import players_on

COUNTS = ("CF", "CA", "FF", "FA", "SF", "SA", "GF", "GA")
PENALTY_COUNTS = ("PF", "PA")
PUCK_COUNTS = ("GIVE_for", "GIVE_against", "TAKE_for", "TAKE_against")


def credit(mine: str, theirs: str) -> dict[str, str]:
    """SQL of the counts of one side; ``mine`` and ``theirs`` are suffixes of the tally columns."""
    def shots(by: str) -> str:
        return f"shot{by} + goal{by}"

    def unblocked(by: str) -> str:
        return f"{shots(by)} + miss{by}"

    return {
        "CF": f"{unblocked(mine)} + block{theirs}", "CA": f"{unblocked(theirs)} + block{mine}",
        "FF": unblocked(mine), "FA": unblocked(theirs), "SF": shots(mine), "SA": shots(theirs),
        "GF": f"goal{mine}", "GA": f"goal{theirs}", "xG": f"xg{mine}", "xGA": f"xg{theirs}",
        "PF": f"pen{theirs}", "PA": f"pen{mine}", "GIVE_for": f"give{mine}", "GIVE_against": f"give{theirs}",
        "TAKE_for": f"take{mine}", "TAKE_against": f"take{theirs}",
    }


def tally_sums(own1: str) -> list[Column]:
    """Sums of seconds and of the tallies of both ends per group, for views whose side ``own1`` tells."""
    ours = f"coalesce(play1 = {own1}, false)"
    sums = [F.expr("sum(seconds) AS seconds")]
    for k in (*tl.TALLIES, "xg"):
        sums.append(F.expr(f"sum(CASE WHEN {ours} THEN {k} ELSE 0 END) AS {k}_own"))
        sums.append(F.expr(f"sum(CASE WHEN {ours} THEN 0 ELSE {k} END) AS {k}_opp"))
    return sums


def counts_from_sums(names: tuple[str, ...], aliases: tuple[str, ...] | None = None) -> list[Column]:
    table = credit("_own", "_opp")
    return [F.expr(f"{table[n]} AS {alias}") for n, alias in zip(names, aliases or names)]


def on_ice_stats_by_player_strength(
    pbp: DataFrame, include_goalies: bool = False, rates: bool = False, rate_fields=RATE_FIELDS
) -> DataFrame:
    """Per player and strength: time on ice and counts; rows exist only where there is time."""
    label = tl.label("12")
    moments = tl.lineups(pbp, plays="before").withColumn("strength", label)
    per_player = (
        moments.select("gameId", "seconds", "play1", *tl.TALLIES, "xg",
                       F.explode(players_on("strength", "strength", include_goalies)).alias("p"))
        .withColumn("own1", F.col("p.side1"))
        .groupBy("gameId", F.col("p.pid").alias("player1Id"), F.col("p.label").alias("strength"))
        .agg(*tally_sums("own1"))
        .where(F.col("seconds") > 0)
    )
    out = per_player.join(tl.player_names(pbp), ["gameId", "player1Id"], "left").select(
        "gameId", "player1Id",
        F.coalesce("name", F.col("player1Id").cast("string")).alias("player1Name"),
        F.col("team").alias("eventTeam"), "strength", "seconds",
        (F.col("seconds") / 60.0).alias("minutes"),
        *counts_from_sums((*COUNTS, "xG", "xGA", *PENALTY_COUNTS, *PUCK_COUNTS)),
    )
    return per60_filled(out, rate_fields) if rates else out


def team_strength_aggregates(pbp: DataFrame, rates: bool = False, min_toi: int = 0) -> DataFrame:
    """Per team and strength, both teams under the same label: time and counts."""
    pieces = tl.cells(tl.ledger(pbp, with_plays=True)).withColumn("strength", tl.label("12"))
    sums = [F.expr("sum(t_end - t_start) AS seconds")]
    sums += [F.sum(f"{k}{i}").alias(f"{k}{i}") for k in (*tl.TALLIES, "xg") for i in (1, 2)]
    names = (*COUNTS, "xG", "xGA", *PENALTY_COUNTS)

    def view(own: int, opp: int) -> str:
        table = credit(str(own), str(opp))
        fields = ", ".join(f"'{n}', {table[n]}" for n in names)
        return f"named_struct('team', t{own}, 'opp', t{opp}, {fields})"

    out = (
        pieces.groupBy("gameId", "t1", "t2", "strength").agg(*sums)
        .where((F.col("seconds") > 0) & (F.col("seconds") >= min_toi))
        .select("gameId", "strength", "seconds", F.expr(f"explode(array({view(1, 2)}, {view(2, 1)})) AS v"))
        .select("gameId", "v.team", "v.opp", "strength", F.col("seconds").cast("double").alias("seconds"),
                (F.col("seconds") / 60.0).alias("minutes"), *[F.col(f"v.{n}").alias(n) for n in names])
    )
    return per60_filled(out) if rates else out
