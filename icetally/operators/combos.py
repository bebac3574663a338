"""Time and shot metrics of N-player combinations, with or without opposing combinations.

Combinations come from lineups, whose size is the number of players on the ice, so a row yields at most
C(n, N) * C(m, M) combinations and these are summed map-side before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icetally.functions import arrays
from icetally.functions.columns import first_present
from icetally.functions.rates import differentials_and_shares, per60, per60_filled, toi_value
from icetally.operators import timeline as tl
from icetally.operators.metrics import (
    COUNTS, PENALTY_COUNTS, counts_from_sums, tally_sums,
)

SIDES = ("home", "away", "both")


def _views(
    moments: DataFrame, side: str, goalies_team: bool, goalies_opp: bool, own_labels: bool
) -> DataFrame:
    """A lineup seen from its sides: team, opp, own ids, other ids, label."""
    if side not in SIDES:
        raise ValueError(f"side must be one of {SIDES}")

    def view(own: int, opp: int) -> Column:
        return F.struct(
            F.lit(own == 1).alias("own1"), F.col(f"t{own}").alias("team"), F.col(f"t{opp}").alias("opp"),
            tl.members(own, goalies_team).alias("own"), tl.members(opp, goalies_opp).alias("other"),
            tl.label(f"{own}{opp}" if own_labels else "12").alias("label"),
        )

    chosen = [view(1, 2)] * (side != "away") + [view(2, 1)] * (side != "home")
    kept = [c for c in ("gameId", "seconds", "play1", *tl.TALLIES, "xg") if c in moments.columns]
    return moments.select(*kept, F.explode(F.array(*chosen)).alias("v")).select(*kept, "v.*")


def _with_combos(views: DataFrame, n_team: int, m_opp: int) -> DataFrame:
    """One row per own combination and opposing combination of each view (empty array when m_opp is 0)."""
    out = views.where((F.size("own") >= n_team) & (F.size("other") >= m_opp)).withColumn(
        "team_ids", F.explode(arrays.combos(F.col("own"), n_team))
    )
    if m_opp == 0:
        return out.withColumn("opp_ids", F.array().cast("array<bigint>"))
    return out.withColumn("opp_ids", F.explode(arrays.combos(F.col("other"), m_opp)))


def _slots(ids: str, prefix: str, n: int) -> list[Column]:
    return [F.element_at(ids, i).alias(f"{prefix}{i}_player1Id") for i in range(1, n + 1)]


def combo_toi(
    pbp: DataFrame, n_team: int = 2, m_opp: int = 0, include_goalies_team: bool = False,
    include_goalies_opp: bool = False, side: str = "both", in_seconds: bool = False, min_seconds: int = 1,
) -> DataFrame:
    """(gameId, team, p1_player1Id.., opp1_player1Id.., Strength, TOI), own-side labels."""
    views = _views(tl.lineups(pbp, "home"), side, include_goalies_team, include_goalies_opp, True)
    return (
        _with_combos(views, n_team, m_opp)
        .groupBy("gameId", "team", "team_ids", "opp_ids", F.col("label").alias("Strength"))
        .agg(F.sum("seconds").alias("sec"))
        .where(F.col("sec") >= min_seconds)
        .select("gameId", "team", *_slots("team_ids", "p", n_team), *_slots("opp_ids", "opp", m_opp),
                "Strength", toi_value("sec", in_seconds).alias("TOI"))
    )


def teammate_combo_toi(
    pbp: DataFrame, n: int = 3, include_goalies: bool = False, in_seconds: bool = False,
    min_seconds: int = 1,
) -> DataFrame:
    """Time of every n-player combination of one side."""
    return combo_toi(
        pbp, n, 0, include_goalies_team=include_goalies, in_seconds=in_seconds, min_seconds=min_seconds
    )


def player_vs_opponent_combo_toi(
    pbp: DataFrame, n: int = 2, include_goalies: bool = False, in_seconds: bool = False,
    min_seconds: int = 1,
) -> DataFrame:
    """Time of every player (goalies too) against n opponents at once."""
    toi = combo_toi(
        pbp, 1, n, include_goalies_team=True, include_goalies_opp=include_goalies,
        in_seconds=in_seconds, min_seconds=min_seconds,
    )
    return toi.withColumnRenamed("p1_player1Id", "player_player1Id")


def combo_shot_metrics(
    pbp: DataFrame, n_team: int = 2, m_opp: int = 0, include_goalies_team: bool = False,
    include_goalies_opp: bool = False, side: str = "both", include_toi: bool = True,
    toi_in_seconds: bool = False, precomputed_toi: DataFrame | None = None,
) -> DataFrame:
    """Shots, Fenwick and Corsi for and against per combination and own-side label.

    Attempts see the lineup from their second on. Combinations without any attempt have no row. TOI
    comes from the same pass over the lineups unless ``precomputed_toi`` (output of ``combo_toi`` with
    the same arguments) is given.
    """
    moments = tl.lineups(pbp, "home", plays="after")
    if not include_toi or precomputed_toi is not None:
        moments = moments.where(F.col("play1").isNotNull())
    views = _views(moments, side, include_goalies_team, include_goalies_opp, True)
    ids = [*_slots("team_ids", "p", n_team), *_slots("opp_ids", "opp", m_opp)]
    out = (
        _with_combos(views, n_team, m_opp)
        .groupBy("gameId", "team", "team_ids", "opp_ids", F.col("label").alias("Strength"))
        .agg(*tally_sums("own1"))
        .select("gameId", "team", *ids, "Strength", "seconds",
                *counts_from_sums(
                    ("SF", "SA", "FF", "FA", "CF", "CA"),
                    ("ShotsFor", "ShotsAgainst", "FenwickFor", "FenwickAgainst", "CorsiFor", "CorsiAgainst"),
                ))
        .where(F.col("CorsiFor") + F.col("CorsiAgainst") > 0)
    )
    if include_toi:
        if precomputed_toi is None:
            value = toi_value("seconds", toi_in_seconds)
            out = out.withColumn("TOI", F.when(F.col("seconds") > 0, value))
        else:
            keys = [c for c in out.columns if c.endswith("player1Id")] + ["gameId", "team", "Strength"]
            out = out.join(precomputed_toi.select(*keys, "TOI"), keys, "left")
    out = differentials_and_shares(out.drop("seconds"))
    if include_toi:
        minutes = F.col("TOI") / 60.0 if toi_in_seconds else F.col("TOI")
        out = per60(out, minutes)
    return out


def _player_maps(players: DataFrame) -> DataFrame:
    """(gameId, players map): one map per game from a table with gameId, player1Id, name, pos, number,
    headshot; a player appears once per game."""
    entry = F.struct("name", "pos", "number", "headshot")
    one = players.groupBy("gameId", "player1Id").agg(F.max(entry).alias("e"))
    return one.groupBy("gameId").agg(
        F.map_from_entries(F.collect_list(F.struct("player1Id", "e"))).alias("players")
    )


def _dimension(pbp: DataFrame, player_df: DataFrame | None) -> DataFrame:
    """Players of every game: from ``player_df`` where listed, else the first change row."""
    seen = tl.player_names(pbp, last=False).select("gameId", "player1Id", F.col("name").alias("seen_name"))
    if player_df is None:
        null = F.lit(None)
        return seen.select(
            "gameId", "player1Id", F.col("seen_name").alias("name"), null.cast("string").alias("pos"),
            null.cast("int").alias("number"), null.cast("string").alias("headshot"),
        )
    from icetally.functions.clock import position_letter

    def pick(names: tuple[str, ...], kind: str) -> Column:
        c = first_present(player_df, names)
        return F.lit(None).cast(kind) if c is None else F.col(c).cast(kind)

    keyed = ["gameId"] if "gameId" in player_df.columns else []
    fields = ("name", "pos", "number", "headshot")
    row = F.col("seq") if "seq" in player_df.columns else F.lit(0)
    listed = player_df.select(
        *keyed, row.alias("row"), pick(("player1Id", "playerId", "id"), "bigint").alias("player1Id"),
        pick(("fullName", "player1Name", "Player", "name"), "string").alias("name"),
        position_letter(pick(("position", "positionCode", "pos", "Position"), "string")).alias("pos"),
        pick(("sweaterNumber", "number", "jerseyNumber"), "int").alias("number"),
        pick(("headshot", "Headshot"), "string").alias("headshot"),
    ).where(F.col("player1Id").isNotNull())
    # of a player listed twice the last row counts, or the largest values where rows have no order
    listed = listed.groupBy(*keyed, "player1Id").agg(F.max(F.struct("row", *fields)).alias("e")).select(
        *keyed, "player1Id", *[f"e.{c}" for c in fields], F.lit(True).alias("listed")
    )
    return seen.join(listed, [*keyed, "player1Id"], "left").select(
        "gameId", "player1Id",
        F.when(F.col("listed"), F.col("name")).otherwise(F.col("seen_name")).alias("name"),
        "pos", "number", "headshot",
    )


def combo_on_ice_stats_both_teams(
    pbp: DataFrame, n_team: int = 2, m_opp: int = 0, min_toi: int = 15, include_goalies: bool = False,
    rates: bool = False, player_df: DataFrame | None = None, focus_team: str | None = None,
) -> DataFrame:
    """Time and counts per combination, opposing combination ("ANY" when m_opp is 0) and strength, for
    both teams, with names, position signatures and one block of columns per player."""
    views = _views(tl.lineups(pbp, plays="before"), "both", include_goalies, include_goalies, False)
    if focus_team is not None:
        views = views.where(F.col("team") == focus_team)
    base = (
        _with_combos(views, n_team, m_opp)
        .groupBy("gameId", "team", "opp", "team_ids", "opp_ids", F.col("label").alias("strength"))
        .agg(*tally_sums("own1"))
        .where((F.col("seconds") > 0) & (F.col("seconds") >= min_toi))
    )
    named = base.join(_player_maps(_dimension(pbp, player_df)), "gameId", "left")
    table = F.coalesce(
        F.col("players"),
        F.create_map().cast("map<bigint,struct<name:string,pos:string,number:int,headshot:string>>"),
    )
    named = named.withColumn("players", table)
    players = F.col("players")

    def block(ids: str, prefix: str, n: int) -> list[Column]:
        out = []
        for i in range(1, n + 1):
            pid = F.element_at(ids, i)
            who = F.try_element_at(players, pid)
            out += [
                pid.alias(f"{prefix}{i}Id"), who["name"].alias(f"{prefix}{i}Name"),
                who["pos"].alias(f"{prefix}{i}Position"), who["number"].alias(f"{prefix}{i}Number"),
                who["headshot"].alias(f"{prefix}{i}Headshot"),
            ]
        return out

    opp_label = F.lit("ANY") if m_opp == 0 else arrays.combo_label(F.col("opp_ids"), players)
    out = named.select(
        "gameId", "team", "opp", arrays.combo_label(F.col("team_ids"), players).alias("team_combo"),
        opp_label.alias("opp_combo"),
        arrays.combo_positions(F.col("team_ids"), players).alias("team_combo_pos"),
        arrays.combo_positions(F.col("opp_ids"), players).alias("opp_combo_pos"),
        "strength", F.col("seconds").cast("double").alias("seconds"),
        (F.col("seconds") / 60.0).alias("minutes"),
        *counts_from_sums((*COUNTS, "xG", "xGA", *PENALTY_COUNTS)),
        *block("team_ids", "player", n_team), *block("opp_ids", "oppPlayer", m_opp),
        F.col("team_ids").alias("team_combo_ids"),
        (F.lit(None).cast("array<bigint>") if m_opp == 0 else F.col("opp_ids")).alias("opp_combo_ids"),
    )
    return per60_filled(out) if rates else out


def combo_on_ice_stats(
    pbp: DataFrame, focus_team: str, n_team: int = 2, m_opp: int = 0, min_toi: int = 15,
    include_goalies: bool = False, rates: bool = False,
) -> DataFrame:
    """One team's combinations; games without that team have no rows. Names are the last seen."""
    names = tl.player_names(pbp).withColumnRenamed("name", "fullName").select(
        "gameId", "player1Id", "fullName"
    )
    out = combo_on_ice_stats_both_teams(
        pbp, n_team, m_opp, min_toi, include_goalies, rates, names, focus_team
    )
    dropped = [c for c in out.columns if c.startswith(("player", "oppPlayer")) or c.endswith(("_pos", "_ids"))]
    return out.drop(*dropped)
