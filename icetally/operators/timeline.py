"""Who is on the ice when: the per-game ledger, player intervals, strength pieces and lineups.

Every operator on time on ice starts from one *ledger* built in a single scan of the play-by-play:

1. rows are reduced to one per (game, team, role, player, second) with map-side combine, so what
   reaches a game is bounded by its players and seconds, not by how many rows it holds;
2. one shuffle on ``gameId``; teams, game end, on/off transitions and interval ends are windows over it.

Lineups need every player next to every moment. Instead of joining the ledger with itself, intervals
and moments are dealt to (game, two-minute slot) groups, whose content is bounded by the players and
the 120 seconds of a slot, and matched inside the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icetally.functions.columns import first_present, require
from icetally.functions.events import GIVEAWAYS, PENALTIES, TAKEAWAYS, XG_COLUMNS, XG_EVENTS, is_change

SLOT_SECONDS = 120
TALLIES = ("shot", "goal", "miss", "block", "pen", "give", "take")
LINES = ("s1_ids", "s2_ids", "g1_ids", "g2_ids")
STATE = ("s1", "s2", "g1", "g2")


def _second() -> Column:
    return F.col("elapsedTime").cast("int")


def _tally_columns(pbp: DataFrame) -> list[Column]:
    kinds = {
        "shot": ("SHOT",), "goal": ("GOAL",), "miss": ("MISS",), "block": ("BLOCK",),
        "pen": PENALTIES, "give": GIVEAWAYS, "take": TAKEAWAYS,
    }

    def listed(codes: tuple[str, ...]) -> str:
        return ", ".join(f"'{c}'" for c in codes)

    counts = [F.expr(f"sum(CASE WHEN Event IN ({listed(c)}) THEN 1 ELSE 0 END) AS {k}") for k, c in kinds.items()]
    xg_col = first_present(pbp, XG_COLUMNS)
    if xg_col is None:
        return [*counts, F.lit(0.0).alias("xg")]
    xg = f"CAST({xg_col} AS DOUBLE)"
    counted = f"Event IN ({listed(XG_EVENTS)}) AND {xg} IS NOT NULL AND NOT isnan({xg})"
    return [*counts, F.expr(f"sum(CASE WHEN {counted} THEN {xg} ELSE 0D END) AS xg")]


def ledger(
    pbp: DataFrame, orientation: str = "alphabetical", changes_only: bool = False,
    with_plays: bool = False,
) -> DataFrame:
    """One row per on/off transition of a player and, with plays, per team and second with plays.

    Columns: gameId, t1, t2 (the sides), game_end, side1 (row belongs to side 1), isGoalie, player1Id,
    t, d (+1 on, -1 off, 0 no transition), t_off (end of the interval opened by ``d = 1``) and the play
    tallies. Side 1 is the alphabetically first team, or the home team with ``orientation='home'``.
    At one second OFF counts before ON; repeated ONs and OFFs without ON are no transitions. Games
    without exactly two teams drop out (see ``rejected_games``) unless the orientation is home.
    Rows at a game's last second always stay, so that time can be counted up to it.
    """
    require(pbp, "gameId", "Event", "elapsedTime", "eventTeam", "player1Id", "isGoalie")
    home = orientation == "home"
    change = is_change(F.col("Event"))
    rows = pbp.where(change) if changes_only else pbp
    moving = (
        change & F.col("eventTeam").isNotNull() & F.col("player1Id").isNotNull()
        & F.col("elapsedTime").isNotNull()
    )
    sided = ["isHome"] if home else []
    keyed = rows.select(
        "gameId", "eventTeam", *sided, "Event",
        *[c for c in XG_COLUMNS if with_plays and c in rows.columns],
        F.when(moving, F.coalesce(F.col("isGoalie").cast("int") == 1, F.lit(False))).alias("isGoalie"),
        F.when(moving, F.col("player1Id").cast("bigint")).alias("player1Id"),
        (_second() if with_plays else F.when(moving, _second())).alias("t"),
        _second().alias("second"),
    )
    base = keyed.groupBy("gameId", "eventTeam", *sided, "isGoalie", "player1Id", "t").agg(
        F.max(F.when(F.col("Event") == "ON", 1).otherwise(0)).alias("on"),
        F.max("second").alias("second"),
        *(_tally_columns(keyed) if with_plays else []),
    ).repartition("gameId")

    game = Window.partitionBy("gameId")
    team = F.col("eventTeam")
    if home:
        t1 = F.max(F.when(F.col("isHome") == 1, team)).over(game)
        t2 = F.max(F.when(F.col("isHome") == 0, team)).over(game)
    else:
        t1, t2 = F.min(team).over(game), F.max(team).over(game)
    base = base.withColumns({"t1": t1, "t2": t2, "game_end": F.max("second").over(game)})
    if not home:
        third = F.coalesce((team != F.col("t1")) & (team != F.col("t2")), F.lit(False))
        base = base.withColumn("third", F.max(third.cast("int")).over(game)).where(
            (F.col("third") == 0) & (F.col("t1") != F.col("t2"))
        )
    player = F.col("player1Id").isNotNull()
    own = Window.partitionBy("gameId", "eventTeam", "isGoalie", "player1Id").orderBy("t")
    moved = base.withColumn("t", F.coalesce("t", "game_end") if not with_plays else F.col("t")).where(
        F.col("t").isNotNull()
    ).withColumn(
        "d", F.when(player, F.col("on") - F.coalesce(F.lag("on").over(own), F.lit(0))).otherwise(0)
    ).where(~player | (F.col("d") != 0) | (F.col("t") == F.col("game_end")))
    side1 = F.coalesce(F.col("isHome") == 1, F.lit(False)) if home else team == F.col("t1")
    return moved.withColumns(
        {
            "t_off": F.when(
                F.col("d") == 1, F.coalesce(F.lead("t").over(own), F.col("game_end"))
            ),
            "side1": side1,
        }
    ).select(
        "gameId", "t1", "t2", "game_end", "eventTeam", *sided, "side1", "isGoalie", "player1Id",
        "t", "d", "t_off", *([*TALLIES, "xg"] if with_plays else []),
    )


def rejected_games(pbp: DataFrame, changes_only: bool = False) -> DataFrame:
    """(gameId, n_teams) of games the operators leave out: not exactly two teams."""
    rows = pbp.where(is_change(F.col("Event"))) if changes_only else pbp
    return (
        rows.select("gameId", "eventTeam").distinct().groupBy("gameId")
        .agg(F.count("eventTeam").alias("n_teams")).where(F.col("n_teams") != 2)
    )


def require_two_teams(pbp: DataFrame, changes_only: bool = False) -> None:
    """Strict mode: raises when any game lacks exactly two teams."""
    bad = rejected_games(pbp, changes_only).limit(1).collect()
    if bad:
        raise ValueError(f"expected 2 teams in game {bad[0][0]}, found {bad[0][1]}")


def player_intervals(
    pbp: DataFrame, orientation: str = "alphabetical", changes_only: bool = False
) -> DataFrame:
    """(gameId, eventTeam, isHome if home-oriented, isGoalie, player1Id, t_on, t_off), half-open;
    intervals still open end with the game."""
    book = ledger(pbp, orientation, changes_only)
    return book.where((F.col("d") == 1) & (F.col("t_off") > F.col("t"))).select(
        "gameId", "eventTeam", *(["isHome"] if orientation == "home" else []),
        F.col("isGoalie").cast("int").alias("isGoalie"), "player1Id",
        F.col("t").alias("t_on"), "t_off",
    )


def cells(book: DataFrame) -> DataFrame:
    """The ledger cut into pieces: per game and second with an entry, the state before that second.

    (gameId, t1, t2, t_start, t_end, s1, s2, g1, g2) where ``[t_start, t_end)`` had that state, plus
    the tallies of the plays at ``t_end`` per side when the ledger has plays.
    """
    names = [k for k in (*TALLIES, "xg") if k in book.columns]
    where = {"s1": "side1 AND NOT goalie", "s2": "NOT side1 AND NOT goalie", "g1": "side1 AND goalie", "g2": "NOT side1 AND goalie"}
    changes = [
        F.expr(f"CAST(sum(CASE WHEN {c} THEN d ELSE 0 END) AS INT) AS d_{k}")
        for k, c in ((k, c.replace("goalie", "coalesce(isGoalie, false)")) for k, c in where.items())
    ]
    sides = (("1", "side1"), ("2", "eventTeam = t2"))
    tallies = [
        F.expr(f"sum(CASE WHEN {c} THEN {k} ELSE 0 END) AS {k}{i}") for k in names for i, c in sides
    ]
    cut = book.groupBy("gameId", "t1", "t2", "t").agg(*changes, *tallies)
    game = "OVER (PARTITION BY gameId ORDER BY t"
    before = f"{game} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return cut.selectExpr(
        "gameId", "t1", "t2",
        f"greatest(coalesce(lag(t) {game}), 0), 0) AS t_start", "greatest(t, 0) AS t_end",
        *[f"CAST(coalesce(sum(d_{k}) {before}, 0) AS INT) AS {k}" for k in STATE],
        *[f"{k}{i}" for k in names for i, _ in sides],
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _side_sql(i: str, star: str) -> str:
    return f"concat(CAST(s{i} AS STRING), CASE WHEN g{i} > 0 THEN '' ELSE {_quoted(star)} END)"


def label_sql(orientation: str = "12", sep: str = "v", star: str = "*") -> str:
    a, b = orientation
    return f"concat({_side_sql(a, star)}, {_quoted(sep)}, {_side_sql(b, star)})"


def label(orientation: str = "12", sep: str = "v", star: str = "*") -> Column:
    """Strength label from s1, g1, s2, g2: side 1 first ("12") or side 2 first ("21")."""
    return F.expr(label_sql(orientation, sep, star))


def side_strings(star: str = "*") -> tuple[Column, Column]:
    return F.expr(_side_sql("1", star)), F.expr(_side_sql("2", star))


def strength_segments(
    pbp: DataFrame, orientation: str = "alphabetical", changes_only: bool = False
) -> DataFrame:
    """(gameId, t_start, t_end, skaters and goalies per side, strength) between changes."""
    return cells(ledger(pbp, orientation, changes_only)).where("t_end > t_start").select(
        "gameId", "t_start", "t_end",
        F.col("s1").alias("skaters1"), F.col("s2").alias("skaters2"),
        F.col("g1").alias("goalies1"), F.col("g2").alias("goalies2"),
        label("12").alias("strength"),
    )


def lineups(
    pbp: DataFrame, orientation: str = "alphabetical", changes_only: bool = False,
    plays: str | None = None,
) -> DataFrame:
    """Moments of every game with the sorted player ids on the ice.

    A moment is a piece between changes (``seconds`` > 0, no tallies) or, with ``plays``, the plays of
    one team at one second (``seconds`` = 0, tallies, ``play1`` tells whether side 1 made them). Plays
    see the state *before* the changes of their second or, with ``plays='after'``, from that second on
    (clipped to the seconds anybody is on).

    Columns: gameId, t1, t2, second, seconds, s1_ids, s2_ids, g1_ids, g2_ids, s1, s2, g1, g2
    [, play1, tallies].
    """
    book = ledger(pbp, orientation, changes_only, with_plays=plays is not None)
    moving = "OVER (PARTITION BY gameId, d != 0 ORDER BY t)"
    ice_end = ["max(t_off) OVER (PARTITION BY gameId) AS ice_end"] if plays == "after" else []
    book = book.selectExpr(
        "*", f"greatest(coalesce(lag(t) {moving}, 0), 0) AS t_prev", f"lead(t) {moving} IS NULL AS is_last", *ice_end
    )
    moment = "greatest(0, least(t, ice_end - 1))" if plays == "after" else "t - 1"
    names = (*TALLIES, "xg") if plays else ()
    fields = "".join(f", {k}: {'DOUBLE' if k == 'xg' else 'BIGINT'}" for k in names)
    entries = (
        "ARRAY<STRUCT<slot: INT, span: STRUCT<pid: BIGINT, side1: BOOLEAN, goalie: BOOLEAN, t_on: INT, t_off: INT>, "
        f"item: STRUCT<second: INT, seconds: INT, play1: BOOLEAN{fields}>>>"
    )

    def slot(second: str) -> str:
        return f"CAST(floor(({second}) / {SLOT_SECONDS}) AS INT)"

    def item(condition: str, second: str, seconds: str, tallied: bool = False) -> str:
        values = "".join(f", {k if tallied else '0'}" for k in names)
        entry = f"struct({slot(second)}, NULL, struct({second}, {seconds}, {'side1' if tallied else 'NULL'}{values}))"
        return f"CASE WHEN {condition} THEN CAST(array({entry}) AS {entries}) ELSE CAST(array() AS {entries}) END"

    opened = (
        f"CASE WHEN d = 1 AND t_off > t THEN CAST(transform(sequence({slot('t')}, {slot('t_off - 1')}), "
        "s -> struct(s, struct(player1Id, side1, isGoalie, t, t_off), NULL)) "
        f"AS {entries}) ELSE CAST(array() AS {entries}) END"
    )
    dealt = [
        opened,
        item("d != 0 AND t > t_prev", "t_prev", "t - t_prev"),
        item("d != 0 AND is_last AND game_end > t", "t", "game_end - t"),
    ]
    if plays:
        sided = "isHome" if orientation == "home" else "eventTeam"
        counted = " + ".join(TALLIES)
        dealt.append(item(f"d = 0 AND {sided} IS NOT NULL AND {counted} > 0 AND {moment} >= 0", moment, "0", True))

    slots = (
        book.selectExpr("gameId", "t1", "t2", f"explode(concat({', '.join(dealt)})) AS e")
        .selectExpr("gameId", "t1", "t2", "e.slot", "e.span", "e.item")
        # the windows above left a game in one partition; from here on its slots are spread over the tasks
        .repartition("gameId", "slot")
        .groupBy("gameId", "slot")
        .agg(F.expr("first(t1) AS t1"), F.expr("first(t2) AS t2"),
             F.expr("sort_array(collect_list(span)) AS spans"), F.expr("collect_list(item) AS items"))
    )
    on = slots.selectExpr("gameId", "t1", "t2", "spans", "explode(items) AS i").selectExpr(
        "gameId", "t1", "t2", "i.*", "filter(spans, x -> x.t_on <= i.second AND x.t_off > i.second) AS there"
    )
    kept = ("gameId", "t1", "t2", "second", "seconds", "play1", *names)
    sets = {
        "s1_ids": "x.side1 AND NOT x.goalie", "s2_ids": "NOT x.side1 AND NOT x.goalie",
        "g1_ids": "x.side1 AND x.goalie", "g2_ids": "NOT x.side1 AND x.goalie",
    }
    lined = on.selectExpr(*kept, *[f"transform(filter(there, x -> {c}), x -> x.pid) AS {k}" for k, c in sets.items()])
    return lined.selectExpr("*", *[f"size({ids}) AS {k}" for k, ids in zip(STATE, LINES)])


def members(side: int, goalies: bool) -> Column:
    """Sorted ids of one side of a lineup, optionally with its goalies."""
    if not goalies:
        return F.col(f"s{side}_ids")
    return F.array_sort(F.array_union(F.col(f"s{side}_ids"), F.col(f"g{side}_ids")))


def on_ice_at(pbp: DataFrame, orientation: str = "alphabetical") -> DataFrame:
    """Every piece between changes with its label and who is on, empty ice included."""
    return lineups(pbp, orientation).select(
        "gameId", F.col("second").alias("t_start"),
        (F.col("second") + F.col("seconds")).alias("t_end"),
        label("12").alias("strength"), "t1", "t2", *LINES,
    )


def player_names(pbp: DataFrame, last: bool = True) -> DataFrame:
    """(gameId, player1Id, name, team) as on the player's last (or first) change row.

    Change rows are ordered by second, OFF before ON, then row position ``seq``.
    """
    rows = pbp.where(
        is_change(F.col("Event")) & F.col("eventTeam").isNotNull() & F.col("player1Id").isNotNull()
        & F.col("elapsedTime").isNotNull()
    )
    order = F.struct(_second(), (F.col("Event") == "ON").cast("int"), F.col("seq"))
    pick = F.max_by if last else F.min_by
    name = F.col("player1Name") if "player1Name" in pbp.columns else F.lit(None).cast("string")
    return rows.groupBy("gameId", F.col("player1Id").cast("bigint").alias("player1Id")).agg(
        pick(F.struct(name.alias("name"), F.col("eventTeam").alias("team")), order).alias("x")
    ).select("gameId", "player1Id", "x.name", "x.team")
