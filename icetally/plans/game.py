"""Whole-game tables from landed reports and payloads: shifts, play-by-play, players."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icetally.functions.clock import elapsed_time, player_team, position_group, to_int
from icetally.functions.columns import dedupe_columns
from icetally.functions.events import event_code, event_players
from icetally.functions.strength import on_ice_counts, strength_strings
from icetally.operators import onice, ordered, shifts as shift_ops
from icetally.operators.joins import jersey_maps, join_dimension
from icetally.operators.xg import engineer_xg_features, predict_xg
from icetally.session import delete_path, shared_path
from icetally.sources import feeds, reports

_PLAY_COLUMNS = (
    "eventId", "event_api", "sortOrder", "situationCode", "isHome", "eventOwnerTeamId", "xCoord", "yCoord",
    "zoneCode", "shotType", "reason", *ordered.SCOREBOARD,
    *[c for c in feeds.DETAIL_IDS if c != "eventOwnerTeamId"],
)


#: Rows of a game (report rows, plays, ON and OFF rows) up to which it is put together in one task; real ones have a few thousand.
GAME_ROWS = 50_000


def hold(df: DataFrame, held: list[str] | None) -> DataFrame:
    """df, written to the shared folder if the caller gives a list to take its path; ``release`` deletes what it lists.

    Parsed documents are used by several branches of a whole-game plan; without holding them every branch parses
    its own. Nothing stays in executors' memory, and what follows survives lost executors without parsing again.
    """
    if held is None:
        return df
    path = shared_path(df.sparkSession, "held")
    df.write.parquet(path)
    held.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, held: list[str]) -> None:
    """Deletes the held tables; to be called when the results have been written."""
    while held:
        delete_path(spark, held.pop())


def build_shifts(shift_reports: DataFrame, games: DataFrame) -> DataFrame:
    """Shift rows with roster spot, side, team codes and game seconds.

    ``shift_reports``: gameId, team_type (Home / Away), html. ``games``: output of ``parse_game``.
    """
    rows = reports.shift_rows(shift_reports).withColumn("isHome", (F.col("team_type") == "Home").cast("int"))
    meta = feeds.game_meta(games).select("gameId", "gameType", "homeTeam", "awayTeam")
    rows = join_dimension(rows, meta, ["gameId"])
    rows = shift_ops.attach_roster(rows, feeds.roster_spots(games))
    return rows.withColumns({
        "sweaterNumber": F.when(F.col("playerId").isNotNull(), F.col("jersey_number")),
        **{
            f"elapsed_time_{end}": elapsed_time(
                F.col(f"{end}_time_in_period_seconds"), F.col("period_number"), F.col("gameType")
            )
            for end in ("start", "end")
        },
    })


def _game_dimension(games: DataFrame) -> DataFrame:
    """One row per game: facts, jersey maps of both sides and a player name map."""
    spots = feeds.roster_spots(games)
    maps = None
    for side, flag in (("home", 1), ("away", 0)):
        m = jersey_maps(spots.where(F.col("isHome") == flag), ["gameId"]).select(
            "gameId", F.col("ids").alias(f"{side}_ids"), F.col("names").alias(f"{side}_names")
        )
        maps = m if maps is None else maps.join(m, "gameId", "full")
    names = spots.where(F.col("playerId").isNotNull()).groupBy("gameId", "playerId").agg(
        F.max("fullName").alias("fullName")
    ).groupBy("gameId").agg(
        F.map_from_entries(F.collect_list(F.struct("playerId", "fullName"))).alias("player_names")
    )
    return feeds.game_meta(games).join(maps, "gameId", "left").join(names, "gameId", "left")


def _api_plays(games: DataFrame, whole: bool) -> DataFrame:
    """Feed plays with report codes, sides and a filled scoreboard; only mapped events."""
    plays = feeds.plays(games).withColumns({
        "Event": event_code(F.col("event_api")),
        "isHome": F.coalesce((F.col("eventOwnerTeamId") == F.col("homeId")).cast("int"), F.lit(0)),
        "block": F.floor(F.col("seq") / 100).cast("int"),
    })
    filled = ordered.in_order(plays, [F.col("seq")], fill=ordered.SCOREBOARD, second="block", whole=whole)
    return filled.where(F.col("Event").isNotNull()).select(
        "gameId", "seq", "Event", F.col("period").cast("string").alias("Per"),
        F.col("timeInPeriod").alias("Time"), *[c for c in _PLAY_COLUMNS if c in filled.columns],
    )


def _by_size(
    html: DataFrame, games: DataFrame, shifts: DataFrame, held: list[str] | None,
) -> list[tuple[DataFrame, DataFrame, DataFrame, bool]]:
    """The three tables for games of up to GAME_ROWS rows (True) and, if there are any, for the others (False).

    The rows are counted only where the tables are held; else every game counts as one of the others.
    """
    if held is None:
        return [(html, games, shifts, False)]
    sizes = html.select("gameId", F.lit(1).alias("n")).unionByName(shifts.select("gameId", F.lit(2).alias("n"))).unionByName(
        games.select(F.col("id").alias("gameId"), F.size("plays").alias("n")))
    # no more than one game for every GAME_ROWS rows
    big = hold(sizes.groupBy("gameId").agg(F.sum("n").alias("n")).where(F.col("n") > GAME_ROWS).select(
        F.col("gameId").alias("big")), held)
    if big.isEmpty():
        return [(html, games, shifts, True)]

    def those(df: DataFrame, key: str, how: str) -> DataFrame:
        return df.join(F.broadcast(big), F.col(key).eqNullSafe(F.col("big")), how)

    return [(those(html, "gameId", how), those(games, "id", how), those(shifts, "gameId", how), whole)
            for how, whole in (("left_anti", True), ("left_semi", False))]


def pbp_parts(
    event_reports: DataFrame, games: DataFrame, shifts: DataFrame, strict_compat: bool = False,
    held: list[str] | None = None,
) -> list[tuple[DataFrame, bool]]:
    """``build_pbp`` in parts, each with whether the rows of any of its games fit into one task."""
    html = hold(reports.event_table(event_reports), held).withColumn("Time", F.col("timeInPeriod"))
    dim = hold(_game_dimension(games), held)
    return [(_pbp(*tables, dim, strict_compat, whole, held), whole) for *tables, whole in _by_size(html, games, shifts, held)]


def build_pbp(
    event_reports: DataFrame, games: DataFrame, shifts: DataFrame, strict_compat: bool = False,
    held: list[str] | None = None,
) -> DataFrame:
    """Report rows joined to feed plays, with on-ice lists and strengths, merged with ON/OFF rows into
    one ordered table per game.

    ``strict_compat`` leaves period 5 without game seconds even in playoff games. ``held`` takes the tables that are
    kept because several branches read them (see ``hold``); then games of up to GAME_ROWS rows are put together by plain
    windows, their rows dealt by game once.
    """
    parts = pbp_parts(event_reports, games, shifts, strict_compat, held)
    return reduce(DataFrame.unionByName, [table for table, _ in parts])


def _pbp(
    html: DataFrame, games: DataFrame, shifts: DataFrame, dim: DataFrame, strict_compat: bool, whole: bool,
    held: list[str] | None,
) -> DataFrame:
    rows = ordered.occurrence_join(html, _api_plays(games, whole), whole=whole).drop("seq_api")
    rows = join_dimension(
        rows, dim.select("gameId", "gameType", "home_ids", "home_names", "away_ids", "away_names", "player_names"),
        ["gameId"],
    )
    for side in ("home", "away"):
        skaters, goalies = f"{side}_on_ice", f"{side}_goalie"
        rows = onice.map_on_ice(rows, {skaters: f"{side}_on_id", goalies: f"{side}Goalie_on_id"}, f"{side}_ids")
        rows = onice.map_on_ice(
            rows, {skaters: f"{side}_on_full_name", goalies: f"{side}Goalie_on_full_name"}, f"{side}_names",
            keep_text=True,
        )
    rows = strength_strings(on_ice_counts(rows)).withColumns({
        "Per": to_int(F.col("Per")), "unmapped_count": onice.unmapped_count("home_on_id") + onice.unmapped_count("away_on_id"),
    })
    rows = rows.withColumn(
        "elapsedTime",
        elapsed_time(F.col("timeInPeriodSec"), F.col("Per"), None if strict_compat else F.col("gameType")),
    )
    rows = event_players(rows)
    rows = rows.withColumns({
        f"player{i}Name": F.try_element_at("player_names", F.col(f"player{i}Id")) for i in (1, 2, 3)
    }).drop("gameType", "home_ids", "home_names", "away_ids", "away_names", "player_names", "playerId",
            "home_on_ice", "away_on_ice", "home_goalie", "away_goalie")

    changes = shift_ops.shift_events_with_strength(shifts, whole).drop("eventTeam", "homeTeam", "awayTeam")
    merged = rows.withColumn("src", F.lit(0)).unionByName(
        changes.withColumn("src", F.when(F.col("Event") == "ON", 1).otherwise(2)), allowMissingColumns=True
    )
    if not whole:
        merged = hold(merged, held)
    out = ordered.in_order(
        merged, ordered.canonical_keys(merged), fill=ordered.SCOREBOARD, number="#", whole=whole
    ).drop("merge_idx")
    facts = dim.select("gameId", "venue", "venueLocation", *feeds.META, "homeTeam", "awayTeam")
    out = join_dimension(out, facts, ["gameId"])
    return dedupe_columns(
        feeds.stamp(
            out.withColumns({
                "eventTeam": F.when(F.col("isHome").isNotNull(), player_team(
                    F.col("isHome"), F.col("homeTeam"), F.col("awayTeam"))),
                "teamId": F.coalesce("teamId", "eventOwnerTeamId"),
            }).withColumnsRenamed({"eventOwnerTeamId": "teamId_", "Str": "strength"}),
            "NHL Play-by-Play API",
        )
    )


def build_players(shifts: DataFrame) -> DataFrame:
    """Distinct players of the shifts with team and position group."""
    columns = (
        "player_name", "jersey_number", "team_type", "team_name", "isHome", "teamId", "playerId",
        "sweaterNumber", "positionCode", "headshot", "fullName", "firstName", "lastName", "gameId", "homeTeam", "awayTeam",
    )
    return shifts.select(*[c for c in columns if c in shifts.columns]).distinct().withColumns({
        "team": player_team(F.col("isHome"), F.col("homeTeam"), F.col("awayTeam")),
        "position": position_group(F.col("positionCode")),
    })


def pipeline(
    event_reports: DataFrame, shift_reports: DataFrame, payloads: DataFrame, model: PipelineModel | dict | None = None,
    max_skaters: int = 6, held: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(play-by-play with features, xG when a model is given and wide on-ice columns, players)."""
    games = hold(feeds.parse_game(payloads), held)
    shifts = hold(build_shifts(shift_reports, games), held)
    parts = []
    for pbp, whole in pbp_parts(event_reports, games, shifts, held=held):
        # by whole games the features follow in the task that put the game together; else two branches read the table
        features = engineer_xg_features(pbp if whole else hold(pbp, held), order="#", whole=whole)
        scored = predict_xg(features, model) if model is not None else features.withColumn("xG", F.lit(None).cast("double"))
        parts.append(onice.on_ice_wide(scored, max_skaters=max_skaters))
    return reduce(DataFrame.unionByName, parts), build_players(shifts)
