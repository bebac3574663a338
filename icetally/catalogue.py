"""Every operator as a named query over the sample tables: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from icetally import fixtures, rendered
from icetally.functions import arrays, clock, geometry
from icetally.functions.columns import flatten
from icetally.functions.events import FEED_CODES, event_code, event_players, event_rank, is_play
from icetally.functions.strength import on_ice_counts, strength_strings
from icetally.operators import combos, joins, metrics, onice, ordered, pairs, timeline, toi, xg
from icetally.operators import shifts as shift_ops
from icetally.operators.joins import jersey_maps
from icetally.plans import game as plans
from icetally.sources import feeds, reports

Query = Callable[[SparkSession, str], DataFrame]


def tidy(df: DataFrame) -> DataFrame:
    """Doubles rounded to six digits, arrays as text."""
    out = []
    for f in df.schema.fields:
        name = f"`{f.name}`"
        if isinstance(f.dataType, T.DoubleType):
            out.append(f"round({name}, 6) AS {name}")
        elif isinstance(f.dataType, T.ArrayType):
            out.append(f"array_join(transform({name}, x -> CAST(x AS STRING)), ',') AS {name}")
        else:
            out.append(name)
    return df.selectExpr(*out)


def _on_pbp(fn: Callable[[DataFrame], DataFrame], names: bool = False) -> Query:
    return lambda spark, sf_dir: tidy(fn(fixtures.pbp(spark, sf_dir, names)))


def _seconds(df: DataFrame) -> DataFrame:
    """Pieces listed second by second."""
    return df.withColumn("second", F.explode(F.sequence("t_start", F.col("t_end") - 1))).drop("t_start", "t_end")


def _combo_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = combos.combo_on_ice_stats_both_teams(
        fixtures.pbp(spark, sf_dir, True), 2, 1, rates=True, player_df=fixtures.roster(spark, sf_dir)
    )
    return tidy(out)


ICE: dict[str, Query] = {
    "player_intervals": _on_pbp(timeline.player_intervals),
    "strength_segments_set": _on_pbp(lambda p: _seconds(timeline.strength_segments(p))),
    "on_ice_at": _on_pbp(lambda p: _seconds(timeline.on_ice_at(p)).drop("t1", "t2")),
    "toi_by_strength": _on_pbp(toi.toi_by_strength),
    "toi_by_player_strength": _on_pbp(toi.toi_by_player_and_strength, True),
    "toi_dense": _on_pbp(toi.toi_player_strength_dense),
    "strength_by_second_full": _on_pbp(toi.strength_by_second_full),
    "shared_toi_teammates": _on_pbp(pairs.shared_toi_teammates),
    "shared_toi_opponents": _on_pbp(pairs.shared_toi_opponents),
    "combos_teammates": _on_pbp(combos.teammate_combo_toi),
    "combos_opponents": _on_pbp(combos.player_vs_opponent_combo_toi),
    "combo_toi": _on_pbp(lambda p: combos.combo_toi(p, 2, 1)),
    "combo_toi_long": _on_pbp(lambda p: combos.combo_toi(p, 2, 1, min_seconds=10)),
    "combo_on_ice_stats": _on_pbp(lambda p: combos.combo_on_ice_stats(p, "AAA", rates=True), True),
    "combo_on_ice_stats_both": _combo_both,
    "combo_shot_metrics": _on_pbp(combos.combo_shot_metrics),
    "on_ice_stats_by_player_strength": _on_pbp(
        lambda p: metrics.on_ice_stats_by_player_strength(p, rates=True), True
    ),
    "team_strength_aggregates": _on_pbp(lambda p: metrics.team_strength_aggregates(p, rates=True)),
}

# --- shifts ---------------------------------------------------------------------------------------


def _shift_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shift_ops.strength_segments_multiset(fixtures.shifts(spark, sf_dir))


_EVENT_COLUMNS = ("shift_id", "gameId", "player1Id", "isHome", "isGoalie", "Event", "elapsedTime", "gameStrength",
                  "detailedGameStrength")


def _shift_event_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = shift_ops.shift_events(fixtures.shifts(spark, sf_dir))
    return shift_ops.shift_event_strength(events, _shift_segments(spark, sf_dir)).select(*_EVENT_COLUMNS)


def _spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roster spots of every game: its players with the roster's names and numbers."""
    players = fixtures.shifts(spark, sf_dir).select("gameId", "playerId").distinct()
    return players.join(fixtures.roster(spark, sf_dir), ["gameId", "playerId"]).drop("positionCode")


def _attach_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.shifts(spark, sf_dir).withColumn("jersey_number", (F.col("playerId") + 9).cast("int"))
    return shift_ops.attach_roster(rows.drop("playerId"), _spots(spark, sf_dir)).select(
        "shift_id", "gameId", "isHome", "jersey_number", "elapsed_time_start", "playerId", "fullName"
    )


def _attach_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifts = fixtures.shifts(spark, sf_dir)
    rows = shift_ops.shift_events(shifts).select("shift_id", "gameId", "player1Id", "Event", "elapsedTime")
    return shift_ops.attach_position(rows, shifts)


SHIFTS: dict[str, Query] = {
    "shift_events": lambda s, d: shift_ops.shift_events(fixtures.shifts(s, d)).select(
        "shift_id", "gameId", "player1Id", "isHome", "isGoalie", "Event", "elapsedTime"
    ),
    "strength_segments_multiset": _shift_segments,
    "strength_by_second": lambda s, d: shift_ops.strength_by_second(_shift_segments(s, d)),
    "shift_event_strength": _shift_event_strength,
    "shift_events_with_strength": lambda s, d: shift_ops.shift_events_with_strength(fixtures.shifts(s, d)).select(
        *_EVENT_COLUMNS),
    "attach_roster": _attach_roster,
    "attach_position": _attach_position,
}


# --- rows of one game in order --------------------------------------------------------------------


def _plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.pbp(spark, sf_dir).where(is_play(F.col("Event")))


def _occurrence_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The k-th play of a key in row order meets the k-th in reverse row order."""
    rows = _plays(spark, sf_dir).select("gameId", "Event", F.col("period").alias("Per"),
                                        F.col("elapsedTime").alias("Time"), "seq")
    return ordered.occurrence_join(rows, rows, right_descending=True).select(
        "gameId", "Event", "Per", "Time", "merge_idx", "seq", "seq_api"
    )


def _ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.pbp(spark, sf_dir)
    return ordered.scoreboard_ffill(rows, ordered.canonical_keys(rows)).select(
        "event_id", "gameId", "Event", "elapsedTime", *ordered.SCOREBOARD
    )


def _canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.pbp(spark, sf_dir).withColumns({
        "Str": F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("S"), (F.col("k") % 4).cast("string"))),
        "elapsedTime": F.when(F.col("event_id") % 19 != 0, F.col("elapsedTime")),
    })
    return ordered.canonical_order(rows).select("event_id", "gameId", "Event", "elapsedTime", "Str", "#")


def _on_ice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays with on-ice lists: ids, names of another length, sometimes goalies, sometimes nothing."""
    e = F.col("event_id")

    def names(ids: Column) -> Column:
        return F.transform(ids, lambda x: F.concat(F.lit("P"), x.cast("string")))

    home = F.array(e % 12, (e + 5) % 12, (e + 7) % 12, e % 5 + 20, F.lit(31).cast("bigint"))
    away = F.when(e % 11 != 0, F.array((e + 1) % 12 + 40, (e + 3) % 12 + 40, F.lit(61).cast("bigint")))
    return _plays(spark, sf_dir).select(
        "event_id", "gameId", "elapsedTime", F.col("period").alias("Per"), "Event", "isHome",
        home.alias("home_on_id"), names(F.slice(home, 1, 4)).alias("home_on_full_name"),
        away.alias("away_on_id"), F.concat(names(away), F.array(F.lit("extra"))).alias("away_on_full_name"),
        F.when(e % 3 == 0, F.array(F.lit(31).cast("bigint"))).alias("homeGoalie_on_id"),
        F.when(e % 3 == 0, F.array(F.lit("P31"))).alias("homeGoalie_on_full_name"),
        F.when(e % 4 == 0, F.array(F.lit(61).cast("bigint"))).alias("awayGoalie_on_id"),
        F.when(e % 4 == 0, F.array(F.lit("P61"))).alias("awayGoalie_on_full_name"),
    )


def _on_ice_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return onice.on_ice_long(_on_ice_rows(spark, sf_dir).withColumnRenamed("event_id", "seq"))


def _on_ice_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return onice.on_ice_wide(_on_ice_rows(spark, sf_dir), max_skaters=4, drop_list_cols=True)


def _on_ice_strengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = strength_strings(on_ice_counts(_on_ice_rows(spark, sf_dir)))
    return rows.select(
        "event_id", "home_on_count", "away_on_count", "homeGoalie_on_count", "awayGoalie_on_count",
        "n_home_skaters", "n_away_skaters", "pulled_home", "pulled_away", "home_strength",
        "away_strength", "gameStrength", "detailedGameStrength",
    )


def _on_ice_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jersey lists to ids and names through one map per game."""
    spots = _spots(spark, sf_dir)
    out = _plays(spark, sf_dir).select(
        "event_id", (F.col("event_id") % 97).alias("gameId"),
        *[F.array(*[(F.col("event_id") * i % 14 + low).cast("string") for i in (1, 2, 3)]).alias(f"{side}_on_ice")
          for side, low in (("home", 8), ("away", 20))],
    )
    for side, flag in (("home", 1), ("away", 0)):
        maps = jersey_maps(spots.where(F.col("isHome") == flag), ["gameId"])
        out = joins.join_dimension(out, maps, ["gameId"])
        out = onice.map_on_ice(out, {f"{side}_on_ice": f"{side}_on_id"}, "ids")
        out = onice.map_on_ice(out, {f"{side}_on_ice": f"{side}_on_full_name"}, "names", keep_text=True).drop("ids", "names")
    unmapped = onice.unmapped_count("home_on_id") + onice.unmapped_count("away_on_id")
    return out.select(
        "event_id", "gameId",
        *[F.transform(f"{side}_on_id", lambda x: F.coalesce(x, F.lit(-1))).alias(f"{side}_on_id") for side in ("home", "away")],
        "home_on_full_name", "away_on_full_name", unmapped.alias("unmapped_count"),
    )


def _event_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays under their feed names with detail fields, read back as players 1 to 3."""
    feed_name = {code: name for name, code in FEED_CODES.items()}
    name = None
    for code in ("SHOT", "GOAL", "MISS", "BLOCK", "PENL", "GIVE", "TAKE", "FAC", "HIT", "STOP"):
        hit = F.col("Event") == code
        name = F.when(hit, feed_name[code]) if name is None else name.when(hit, feed_name[code])
    fields = ("winningPlayerId", "losingPlayerId", "hittingPlayerId", "hitteePlayerId", "shootingPlayerId",
              "blockingPlayerId", "scoringPlayerId", "assist1PlayerId", "playerId", "committedByPlayerId",
              "drawnByPlayerId", "servedByPlayerId")
    rows = _plays(spark, sf_dir).select(
        "event_id", name.alias("event_api"),
        *[(F.col("user_id") * 100 + i).alias(c) for i, c in enumerate(fields)],
    )
    out = event_players(rows)
    return out.select("event_id", "event_api", event_code(F.col("event_api")).alias("Event"),
                      event_rank(event_code(F.col("event_api"))).alias("rank"),
                      "player1Id", "player2Id", "player3Id")


def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small games, some with one team or three."""
    rows = fixtures.pbp(spark, sf_dir).withColumns({
        "gameId": (F.col("event_id") % 997).cast("int"),
        "eventTeam": F.when(F.col("k") % 25 == 0, "CCC").when(F.col("k") % 2 == 0, F.col("eventTeam")),
    })
    return timeline.rejected_games(rows)


ROWS: dict[str, Query] = {
    "occurrence_join": _occurrence_join,
    "scoreboard_ffill": _ffill,
    "canonical_order": _canonical,
    "on_ice_long": _on_ice_long,
    "on_ice_wide": _on_ice_wide,
    "on_ice_strengths": _on_ice_strengths,
    "on_ice_mapping": lambda s, d: tidy(_on_ice_mapping(s, d)),
    "event_players": _event_players,
    "rejected_games": _rejected,
}


# --- scalar functions -----------------------------------------------------------------------------


def _clock_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clock texts made from the order lines and read back."""
    n = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    sec = (n % 1300).cast("int")
    period = (n % 6 + 1).cast("int")
    text = F.concat((sec / 60).cast("int").cast("string"), F.lit(":"), F.lpad((sec % 60).cast("string"), 2, "0"))
    rows = fixtures.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(n % 13 != 0, F.when(n % 17 != 0, text).otherwise("bad")).alias("clock"),
        F.concat(text, F.lit("20:00")).alias("both"),
        F.when(period == 4, "OT").when(period == 6, "SO").otherwise(period.cast("string")).alias("per"),
        (F.col("l_suppkey") % 4).cast("int").alias("game_type"),
    )
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        clock.mmss_to_seconds(F.col("clock")).alias("seconds"),
        clock.split_clock(F.col("both"))["elapsed"].alias("elapsed"),
        clock.split_clock(F.col("both"))["remaining"].alias("remaining"),
        clock.period_number(F.col("per")).alias("period"),
        clock.elapsed_time(clock.mmss_to_seconds(F.col("clock")), clock.period_number(F.col("per"))).alias("elapsed_any"),
        clock.elapsed_time(
            clock.mmss_to_seconds(F.col("clock")), clock.period_number(F.col("per")), F.col("game_type")
        ).alias("elapsed_typed"),
    )


def _name_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    code = F.when(k % 7 == 0, "G").when(k % 7 == 1, "D").when(k % 7 == 2, "l").when(k % 7 == 3, "forward").when(k % 7 < 6, "C")
    rows = fixtures.table(spark, sf_dir, "customer").select("c_custkey", "c_name", code.alias("code"))
    return rows.select(
        "c_custkey",
        clock.report_key(F.lit(2024020000) + k, "PL").alias("report_key"),
        clock.jersey_number(F.concat((k % 99).cast("string"), F.lit(" "), F.col("c_name"))).alias("jersey"),
        clock.jersey_number(F.col("c_name")).alias("no_jersey"),
        clock.full_name(F.col("c_name"), F.col("code")).alias("full_name"),
        clock.position_group(F.coalesce("code", F.lit("R"))).alias("position_group"),
        clock.position_letter(F.col("code")).alias("position_letter"),
        clock.player_team(k % 2, F.lit("AAA"), F.lit("BBB")).alias("team"),
    )


def _as_array_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of event ids written as bracketed, parenthesised or comma text and read back."""
    a, b = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    text = (
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("["), a, F.lit(", "), b, F.lit("]")))
        .when(F.col("event_id") % 5 == 1, F.concat(F.lit("("), a, F.lit(", "), b, F.lit(")")))
        .when(F.col("event_id") % 5 == 2, F.concat(a, F.lit(" , "), b, F.lit(",")))
        .when(F.col("event_id") % 5 == 3, a)
    )
    rows = fixtures.table(spark, sf_dir, "events").select("event_id", text.alias("t"))
    return rows.select("event_id", arrays.as_array(F.col("t"), False).alias("items"))


def _geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = geometry.rink_geometry(geometry.origin_distance(_plays(spark, sf_dir)))
    return rows.select("event_id", "x_normalized", "y_normalized", "distance_from_goal", "x_norm", "y_norm",
                       "distanceFromGoal", "angle_signed")


SCALARS: dict[str, Query] = {
    "clock_functions": _clock_functions,
    "name_functions": _name_functions,
    "as_array_text": lambda s, d: tidy(_as_array_text(s, d)),
    "geometry": lambda s, d: tidy(_geometry(s, d)),
}


# --- shot features and scoring --------------------------------------------------------------------

_FEATURES = (
    "event_id", "gameId", "Event", "x_norm", "y_norm", "distanceFromGoal", "angle_signed", "isHome",
    "strengthDiff", "scoreDiff", "shooterSkaters", "defendingSkaters", "shootEmptyNet", "previousEvent",
    "previousTeam", "previousEventSameTeam", "previousElapsedTime", "previousEventDistanceFromGoal",
    "previousEventAngleSigned", "previousEventXNorm", "previousEventYNorm", "timeDiff", "isRebound", "isGoal",
)


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.pbp(spark, sf_dir).withColumns({
        "Per": F.col("period"), "timeInPeriodSec": F.col("elapsedTime") % 1200,
        "timeRemainingSec": 1200 - F.col("elapsedTime") % 1200,
        "shotType": F.when(F.col("k") % 3 == 0, " wrist").when(F.col("k") % 3 == 1, "slap"),
        "strength": F.when(F.col("event_id") % 2 == 0, "EV").otherwise("PP"),
    })
    return xg.engineer_xg_features(rows)


_LEVELS = {"shotType": ["wrist", "slap", "<NA>"], "strength": ["EV", "PP"], "previousEvent": ["SHOT", "FAC", "STOP"]}


def _design(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = xg.one_hot(xg.shots_design_matrix(_features(spark, sf_dir)), _LEVELS)
    dummies = [f"{c}_{v}" for c, vs in _LEVELS.items() for v in vs]
    return xg.align_columns(
        matrix, [*xg.NUMERIC, *xg.FLAGS, *dummies, "previousEvent_ANTHEM", "timeDiff"], ("event_id",)
    )


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xg.predict_xg(_features(spark, sf_dir), fixtures.forest()).select("event_id", "gameId", "Event", "xG")


def _fitted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = _features(spark, sf_dir)
    model = xg.fit_xg(feats, max_iter=5, max_depth=3)
    return xg.predict_xg(feats, model).select("event_id", "gameId", "Event", "xG")


def _xg_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for the scores of any model: a score exactly on the shot rows, inside [0, 1], no row lost."""
    score = F.col("xG")
    return _fitted_scores(spark, sf_dir).groupBy("Event").agg(
        F.count("*").alias("n"), F.count(score).alias("scored"),
        F.count(F.when(~score.between(0, 1), 1)).alias("outside"), F.countDistinct("event_id").alias("events"),
    )


SHOTS: dict[str, Query] = {
    "xg_features": lambda s, d: tidy(_features(s, d).select(*_FEATURES)),
    "shots_design_matrix": lambda s, d: tidy(_design(s, d)),
    "xg_scores": lambda s, d: tidy(_scores(s, d)),
    "xg_fitted_scores": lambda s, d: tidy(_fitted_scores(s, d)),
    "xg_frame": _xg_frame,
}

# --- reports --------------------------------------------------------------------------------------


def _report_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.event_table(rendered.event_reports(spark, sf_dir)).drop("part")


REPORTS: dict[str, Query] = {
    "report_events": lambda s, d: tidy(_report_events(s, d)),
    "report_shifts": lambda s, d: reports.shift_rows(rendered.shift_reports(s, d)).drop("part"),
    "report_summary": lambda s, d: reports.shift_summary(rendered.shift_reports(s, d)),
    "report_counts": lambda s, d: reports.parse_report_counts(
        rendered.shift_reports(s, d), ("gameId", "team_type", "part")
    ),
    "report_rosters": lambda s, d: reports.report_rosters(rendered.roster_reports(s, d)),
    "report_coaches": lambda s, d: reports.report_coaches(rendered.roster_reports(s, d)),
    "report_officials": lambda s, d: reports.report_officials(rendered.roster_reports(s, d)),
    "report_game_info": lambda s, d: tidy(reports.report_game_info(rendered.roster_reports(s, d))),
}


# --- feeds ----------------------------------------------------------------------------------------


def _default(c: Column) -> Column:
    return F.struct(c.alias("default"))


def _feed(table: str, key: str, name: str, envelope: str, record: Callable[[], Column], **extra: object) -> Query:
    """Rows of a table rendered as payloads of a feed, read back and flattened."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = rendered.payloads(fixtures.table(spark, sf_dir, table), key, record(), envelope)
        return tidy(flatten(feeds.parse_feed(made, name, **extra)).drop("scrapedOn", "raw"))

    return run


def _team_record() -> Column:
    return F.struct(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("fullName"),
        F.struct((F.col("s_suppkey") % 90 + 1917).alias("id")).alias("firstSeason"),
    )


def _game_record() -> Column:
    k = F.col("o_orderkey")
    return F.struct(
        k.alias("id"), F.lit(20242025).alias("season"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("gameDate"),
        _default(F.concat(F.lit("Rink "), (k % 32).cast("string"))).alias("venue"),
        F.struct((k % 32).alias("id"), F.lit("HOM").alias("abbrev")).alias("homeTeam"),
        F.struct((k % 31).alias("id"), F.lit("AWY").alias("abbrev"), (k % 7).alias("score")).alias("awayTeam"),
    )


def _standing_record() -> Column:
    k = F.col("s_suppkey")
    return F.struct(_default(F.col("s_name")).alias("teamName"), (k % 82).alias("gamesPlayed"),
                    (k % 41).alias("wins"), ((k % 41) * 2).alias("points"))


def _player_record(*more: Column) -> Column:
    k = F.col("c_custkey")
    return F.struct(k.alias("playerId"), _default(F.lit("A")).alias("firstName"), _default(F.col("c_name")).alias("lastName"),
                    (k % 82).alias("gamesPlayed"), *more)


def _roster_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    record = F.struct(k.alias("id"), _default(F.col("c_name")).alias("lastName"), (k % 98 + 1).alias("sweaterNumber"))
    position = F.when(k % 4 == 0, "D").when(k % 9 == 0, "G").otherwise("C")
    made = rendered.roster_payloads(fixtures.table(spark, sf_dir, "customer"), "c_custkey", record, position)
    return flatten(feeds.parse_feed(made, "roster")).drop("scrapedOn", "raw")


def _pick_record() -> Column:
    k = F.col("p_partkey")
    return F.struct((k % 7 + 1).alias("round"), k.alias("overallPick"), _default(F.col("p_name")).alias("lastName"),
                    F.col("p_size").alias("height"))


def _draft_record() -> Column:
    k = F.col("p_partkey")
    return F.struct(k.alias("id"), (k % 60 + 1963).alias("draftYear"), F.col("p_name").alias("playerName"),
                    F.struct((k % 32).alias("id"), F.col("p_brand").alias("fullName")).alias("team"))


def _feed_game(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        games = feeds.parse_game(rendered.game_payloads(spark, sf_dir))
        if table == "plays":
            return tidy(feeds.plays(games).select(
                "gameId", "seq", "eventId", "period", "timeInPeriod", "event_api", "pptReplayUrl",
                "scoringPlayerId", "shootingPlayerId", "xCoord", "homeScore", "eventOwnerTeamId"))
        if table == "roster_spots":
            return feeds.roster_spots(games).drop("firstName", "lastName")
        return feeds.game_meta(games)

    return run


def _replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.parse_goal_replay(rendered.replay_payloads(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = feeds.parse_game(rendered.game_payloads(spark, sf_dir))
    out = feeds.enrich_plays(feeds.plays(games), feeds.game_meta(games), rendered.replay_payloads(spark, sf_dir))
    return out.select("gameId", "eventId", "venue", "venueLocation", "gameDate", "gameType", "startTimeUTC",
                      "easternUTCOffset", "venueUTCOffset", "source", F.length("pptReplayData").alias("replay_length"))


FEEDS: dict[str, Query] = {
    "feed_teams": _feed("supplier", "s_suppkey", "teams", "teams", _team_record, source="records"),
    "feed_schedule": _feed("orders", "o_orderkey", "schedule", "games", _game_record),
    "feed_standings": _feed("supplier", "s_suppkey", "standings", "standings", _standing_record),
    "feed_roster": _roster_feed,
    "feed_team_stats": _feed("customer", "c_custkey", "team_stats", "skaters", lambda: _player_record(
        (F.col("c_custkey") % 50).alias("goals"), F.col("c_acctbal").alias("avgTimeOnIcePerGame"))),
    "feed_team_stats_goalies": _feed("customer", "c_custkey", "team_stats_goalies", "goalies", lambda: _player_record(
        (F.col("c_custkey") % 9).alias("shutouts"))),
    "feed_draft_picks": _feed("part", "p_partkey", "draft_picks", "picks", _pick_record, year=2024),
    "feed_draft_records": _feed("part", "p_partkey", "draft_records", "data", _draft_record, year=2025),
    "feed_team_draft_history": _feed("part", "p_partkey", "team_draft_history", "data", _draft_record),
    "feed_plays": _feed_game("plays"),
    "feed_roster_spots": _feed_game("roster_spots"),
    "feed_game_meta": _feed_game("game_meta"),
    "goal_replay": _replay,
    "enriched_plays": _enriched,
}

# --- whole games ----------------------------------------------------------------------------------


def _game_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (rendered.whole_event_reports(spark, sf_dir), rendered.whole_shift_reports(spark, sf_dir),
            rendered.whole_payloads(spark, sf_dir))


def _game_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, shift_docs, payloads = _game_inputs(spark, sf_dir)
    return plans.build_shifts(shift_docs, feeds.parse_game(payloads))


def _ids(c: str) -> Column:
    return F.transform(c, lambda x: F.coalesce(x, F.lit(-1)))


def _game_pbp(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, shift_docs, payloads = _game_inputs(spark, sf_dir)
    held: list[str] = []
    games = plans.hold(feeds.parse_game(payloads), held)
    shifts = plans.hold(plans.build_shifts(shift_docs, games), held)
    pbp = plans.build_pbp(events, games, shifts, held=held)
    return tidy(pbp.select(
        "gameId", "eventId", "Event", "Per", "elapsedTime", F.col("#").alias("position"),
        "eventTeam", "player1Id", "player1Name", "homeScore", "strength", "gameStrength", "detailedGameStrength",
        _ids("home_on_id").alias("home_on_id"), _ids("away_on_id").alias("away_on_id"),
        _ids("homeGoalie_on_id").alias("homeGoalie_on_id"), "home_on_full_name", "unmapped_count",
    ))


def _game_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays and changes of whole games with previous play, xG of the stored model and all on-ice slots."""
    wide, _ = plans.pipeline(*_game_inputs(spark, sf_dir), model=fixtures.forest(), held=[])
    slots = [f"{side}_{kind}" for side in ("home", "away")
             for kind in (*(f"skater_{what}_{i}" for i in range(1, 7) for what in ("id", "name")), "goalie_id", "goalie_name")]
    return tidy(wide.select(
        "gameId", "eventId", "Event", F.col("#").alias("position"), "elapsedTime", "x_norm", "previousEvent", "timeDiff",
        "strengthDiff", "scoreDiff", "shootEmptyNet", "isRebound", "isGoal", "xG", *slots,
    ))


GAMES: dict[str, Query] = {
    "game_shifts": lambda s, d: _game_shifts(s, d).select(
        "gameId", "playerId", "fullName", "teamId", "isHome", "positionCode", "jersey_number", "team_name", "period_number",
        "elapsed_time_start", "elapsed_time_end", "duration_seconds", "homeTeam", "awayTeam"),
    "game_players": lambda s, d: plans.build_players(_game_shifts(s, d)).select(
        "gameId", "playerId", "fullName", "firstName", "lastName", "team", "position", "sweaterNumber"),
    "game_pbp": _game_pbp,
    "game_pipeline": _game_pipeline,
}

QUERIES: dict[str, Query] = {**ICE, **SHIFTS, **ROWS, **SCALARS, **SHOTS, **REPORTS, **FEEDS, **GAMES}
