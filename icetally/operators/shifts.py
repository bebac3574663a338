"""Shift rows: change events, multiset strength segments, strength at a second."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icetally.functions.strength import side_label
from icetally.operators.joins import join_dimension

_CLOCKS = {
    "timeInPeriodSec": ("start_time_in_period_seconds", "end_time_in_period_seconds", "int"),
    "timeRemainingSec": ("start_time_remaining_seconds", "end_time_remaining_seconds", "int"),
    "timeInPeriod": ("start_time_in_period", "end_time_in_period", "string"),
    "timeRemaining": ("start_time_remaining", "end_time_remaining", "string"),
    "elapsedTime": ("elapsed_time_start", "elapsed_time_end", "int"),
}


def _goalie(shifts: DataFrame) -> Column:
    flags = []
    if "positionCode" in shifts.columns:
        flags.append(F.coalesce(F.col("positionCode") == "G", F.lit(False)))
    if "isGoalie" in shifts.columns:
        flags.append(F.coalesce(F.col("isGoalie").cast("int") == 1, F.lit(False)))
    out = F.lit(False)
    for f in flags:
        out = out | f
    return out


def shift_events(shifts: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    """Every shift as an ON row (start clock) and an OFF row (end clock), with ``more`` columns of the shift."""
    def column(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in shifts.columns else F.lit(None).cast(kind)

    def end(code: str, i: int) -> Column:
        return F.struct(
            F.lit(code).alias("Event"),
            *[column(cols[i], cols[2]).alias(out) for out, cols in _CLOCKS.items()],
        )

    period = column("period_number", "int")
    team = column("teamId", "bigint")
    base = {
        "gameId": F.col("gameId"), "player1Id": column("playerId", "bigint"),
        "player1Name": column("fullName", "string"), "teamId": team,
        "eventTeam": F.coalesce(column("eventTeam", "string"), team.cast("string")),
        "isHome": F.coalesce(column("isHome", "int"), F.lit(0)),
        "isGoalie": (
            F.coalesce(F.col("positionCode") == "G", F.lit(False)).cast("int")
            if "positionCode" in shifts.columns else F.lit(0)
        ),
        "Per": period, "period": period if "period_number" in shifts.columns else F.lit(1), **(more or {}),
    }
    kept = [c for c in ("shift_id", "seq", "homeTeam", "awayTeam") if c in shifts.columns]
    return shifts.select(
        *kept, *[c.alias(n) for n, c in base.items()],
        F.explode(F.array(end("ON", 0), end("OFF", 1))).alias("e"),
    ).select(*kept, *base, "e.*").withColumn("Time", F.col("timeInPeriod"))


_SIDES = ("home_skaters", "away_skaters", "home_goalie", "away_goalie")


def _changes(shifts: DataFrame) -> DataFrame:
    """Summed changes per game and second with a shift end, ``counts`` telling whether any shift with a
    length starts or ends there."""
    start = F.col("elapsed_time_start").try_cast("int")
    stop = F.col("elapsed_time_end").try_cast("int")
    home = F.coalesce(F.col("isHome").cast("int"), F.lit(0)) == 1
    ends = shifts.select(
        "gameId", home.alias("home"), _goalie(shifts).alias("goalie"), start.alias("a"), stop.alias("b")
    ).selectExpr(
        "gameId", "home", "goalie", "coalesce(b > a, false) AS counts",
        "explode(array(struct(a AS t, 1 AS d), struct(b AS t, -1 AS d))) AS e",
    ).where("e.t IS NOT NULL")
    kinds = ("home AND NOT goalie", "NOT home AND NOT goalie", "home AND goalie", "NOT home AND goalie")
    return ends.groupBy("gameId", F.expr("e.t AS t_start")).agg(
        F.max("counts").alias("counts"),
        *[F.expr(f"sum(CASE WHEN counts AND {c} THEN e.d ELSE 0 END) AS {n}") for n, c in zip(_SIDES, kinds)],
    )


def _running(changes: DataFrame, *more: str) -> DataFrame:
    game = "OVER (PARTITION BY gameId ORDER BY t_start"
    so_far = f"{game} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return changes.selectExpr(
        "gameId", "t_start", *[m.format(game=game) for m in more],
        *[f"CAST(sum({n}) {so_far} AS INT) AS {n}" for n in _SIDES],
    ).selectExpr(
        "*", "CAST(home_goalie = 0 AS INT) AS pulled_home", "CAST(away_goalie = 0 AS INT) AS pulled_away"
    )


def strength_segments_multiset(shifts: DataFrame) -> DataFrame:
    """(gameId, t_start, t_end, skaters and goalies per side, pulled flags) from shift intervals.

    Overlapping shifts of one player count twice; shifts without length or with a missing end do not
    count. Changes are summed per game and second before the running sum.
    """
    return _running(_changes(shifts).where("counts"), "lead(t_start) {game}) AS t_end").where("t_end > t_start")


def segment_labels(segments: DataFrame) -> DataFrame:
    """Adds team_str_home (no stars), home_strength and away_strength (starred)."""
    h, a = F.col("home_skaters"), F.col("away_skaters")
    return segments.withColumns({
        "team_str_home": F.concat(h.cast("string"), F.lit("v"), a.cast("string")),
        "home_strength": side_label(h, 1 - F.col("pulled_home")),
        "away_strength": side_label(a, 1 - F.col("pulled_away")),
    })


def strength_by_second(segments: DataFrame) -> DataFrame:
    """One row per game and second."""
    return segment_labels(segments).select(
        "gameId", F.explode(F.sequence("t_start", F.col("t_end") - 1)).alias("elapsedTime"),
        "team_str_home", "home_strength", "away_strength",
    )


def state_at(times: DataFrame, segments: DataFrame) -> DataFrame:
    """Label of the segment holding each distinct (gameId, elapsedTime), null outside all segments.

    Only seconds are compared, at most one row per game and second on either side.
    """
    labelled = segment_labels(segments)
    label = F.struct("t_end", "team_str_home", "home_strength", "away_strength")
    marks = labelled.select("gameId", F.col("t_start").alias("elapsedTime"), label.alias("seg"))
    asked = times.select("gameId", F.col("elapsedTime").cast("int").alias("elapsedTime")).where(
        F.col("elapsedTime").isNotNull()
    ).distinct()
    both = marks.unionByName(asked.withColumn("asked", F.lit(True)), allowMissingColumns=True)
    # up to a row means up to the end of its second, so the two sides need not be brought to one row a second
    upto = Window.partitionBy("gameId").orderBy("elapsedTime").rangeBetween(Window.unboundedPreceding, 0)
    inside = F.col("elapsedTime") < F.col("s.t_end")
    return (
        both.withColumn("s", F.last("seg", ignorenulls=True).over(upto)).where("asked")
        .select("gameId", "elapsedTime", *[
            F.when(inside, F.col(f"s.{c}")).alias(c)
            for c in ("team_str_home", "home_strength", "away_strength")
        ])
    )


def shift_event_strength(events: DataFrame, segments: DataFrame) -> DataFrame:
    """Adds gameStrength and detailedGameStrength at each change event's second."""
    events = events.withColumn("elapsedTime", F.col("elapsedTime").try_cast("int"))
    at = state_at(events, segments).select(
        "gameId", "elapsedTime", F.col("team_str_home").alias("gameStrength"),
        F.concat("home_strength", F.lit("v"), "away_strength").alias("detailedGameStrength"),
    )
    return events.join(at, ["gameId", "elapsedTime"], "left")


def shift_events_with_strength(shifts: DataFrame, whole: bool = False) -> DataFrame:
    """``shift_events`` with the strength of their own shifts' segments, as ``shift_event_strength`` gives.

    Every event lies on a second of the summed changes, so one equi-join on game and second suffices; if the shifts of
    any game fit into one task (``whole``), the changes are summed over the events themselves.
    """
    if whole:
        return _events_with_strength_whole(shifts)
    valid = "over (PARTITION BY gameId)"
    states = segment_labels(_running(
        _changes(shifts), f"min(CASE WHEN counts THEN t_start END) {valid} AS first_t",
        f"max(CASE WHEN counts THEN t_start END) {valid} AS last_t",
    )).where("t_start >= first_t AND t_start < last_t").selectExpr(
        "gameId", "t_start AS elapsedTime", "team_str_home AS gameStrength",
        "concat(home_strength, 'v', away_strength) AS detailedGameStrength",
    )
    return shift_events(shifts).join(states, ["gameId", "elapsedTime"], "left")


def _events_with_strength_whole(shifts: DataFrame) -> DataFrame:
    """``shift_events_with_strength`` by windows over whole games."""
    home = F.coalesce(F.col("isHome").cast("int"), F.lit(0)) == 1
    counts = F.coalesce(F.col("elapsed_time_end").try_cast("int") > F.col("elapsed_time_start").try_cast("int"), F.lit(False))
    side = F.when(_goalie(shifts), F.when(home, 2).otherwise(3)).otherwise(F.when(home, 0).otherwise(1))
    events = shift_events(shifts, {"_side": F.when(counts, side)})
    second = F.col("elapsedTime")
    game = Window.partitionBy("gameId").orderBy("elapsedTime")
    upto, all_of_it = game.rangeBetween(Window.unboundedPreceding, 0), game.rangeBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    timed = F.col("_side").isNotNull() & second.isNotNull()
    change = F.when(F.col("Event") == "ON", 1).otherwise(-1)
    states = {n: F.sum(F.when(timed & (F.col("_side") == i), change).otherwise(0)).over(upto).cast("int")
              for i, n in enumerate(_SIDES)}
    bounds = {"_first": F.min(F.when(timed, second)).over(all_of_it), "_last": F.max(F.when(timed, second)).over(all_of_it)}
    labels = segment_labels(events.withColumns(states | bounds).withColumns({
        "pulled_home": (F.col("home_goalie") == 0).cast("int"), "pulled_away": (F.col("away_goalie") == 0).cast("int"),
    }))
    inside = F.col("gameId").isNotNull() & (second >= F.col("_first")) & (second < F.col("_last"))
    return labels.select(
        "gameId", "elapsedTime", *[c for c in events.columns if c not in ("gameId", "elapsedTime", "_side")],
        F.when(inside, F.col("team_str_home")).alias("gameStrength"),
        F.when(inside, F.concat("home_strength", F.lit("v"), "away_strength")).alias("detailedGameStrength"),
    )


def attach_roster(shifts: DataFrame, roster: DataFrame) -> DataFrame:
    """Joins roster spots onto shifts by game, jersey number and side; a jersey listed twice matches twice."""
    spots = roster.withColumnRenamed("sweaterNumber", "jersey_number")
    return join_dimension(shifts, spots, ["gameId", "jersey_number", "isHome"])


def attach_position(rows: DataFrame, shifts: DataFrame) -> DataFrame:
    """Joins the distinct (player, position) pairs of the shifts onto rows by player1Id."""
    pairs = shifts.select("gameId", F.col("playerId").alias("player1Id"), "positionCode").distinct()
    return join_dimension(rows, pairs, ["gameId", "player1Id"])
