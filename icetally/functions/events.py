"""Event vocabularies and the column expressions built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Feed event name -> report event code.
FEED_CODES = {
    "blocked-shot": "BLOCK",
    "delayed-penalty": "DELPEN",
    "faceoff": "FAC",
    "giveaway": "GIVE",
    "goal": "GOAL",
    "hit": "HIT",
    "missed-shot": "MISS",
    "penalty": "PENL",
    "shot-on-goal": "SHOT",
    "stoppage": "STOP",
    "takeaway": "TAKE",
    "game-end": "GEND",
    "period-end": "PEND",
    "period-start": "PSTR",
    "shootout-completed": "SOC",
}

# Rank of an event among the events of the same second; codes not listed rank 99.
EVENT_RANKS = {
    "PGSTR": 1, "PGEND": 2, "ANTHEM": 3, "EGT": 3, "CHL": 3, "DELPEN": 3, "BLOCK": 3, "GIVE": 3,
    "HIT": 3, "MISS": 3, "SHOT": 3, "TAKE": 3, "GOAL": 5, "STOP": 6, "PENL": 7, "PBOX": 7,
    "PSTR": 7, "ON": 8, "OFF": 8, "EISTR": 9, "EIEND": 10, "FAC": 12, "PEND": 13, "SOC": 14,
    "GEND": 15, "GOFF": 16,
}

# Which detail fields name player 1, 2 and 3 of each feed event.
EVENT_PLAYERS = {
    "faceoff": ("winningPlayerId", "losingPlayerId"),
    "hit": ("hittingPlayerId", "hitteePlayerId"),
    "blocked-shot": ("shootingPlayerId", "blockingPlayerId"),
    "shot-on-goal": ("shootingPlayerId",),
    "missed-shot": ("shootingPlayerId",),
    "goal": ("scoringPlayerId", "assist1PlayerId", "assist2PlayerId"),
    "giveaway": ("playerId",),
    "takeaway": ("playerId",),
    "penalty": ("committedByPlayerId", "drawnByPlayerId", "servedByPlayerId"),
    "failed-shot-attempt": ("shootingPlayerId",),
}

# Event codes by kind, and the names an expected-goals column may have.
CHANGES = ("ON", "OFF")
XG_EVENTS = ("GOAL", "SHOT", "MISS")
PENALTIES = ("PENL", "PEN", "PENALTY")
GIVEAWAYS = ("GIVE", "GIVEAWAY")
TAKEAWAYS = ("TAKE", "TAKEAWAY")
XG_COLUMNS = ("xG", "xg", "shot_xg", "xg_shot")


def _lookup(table: dict, key: Column) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def event_code(name: Column) -> Column:
    """Feed event name to report code; null when the name is not mapped."""
    return _lookup(FEED_CODES, name)


def event_rank(code: Column) -> Column:
    """Order of an event within its second."""
    return F.coalesce(_lookup(EVENT_RANKS, code), F.lit(99))


def is_change(event: Column) -> Column:
    return F.coalesce(event.isin(*CHANGES), F.lit(False))


def is_play(event: Column) -> Column:
    """Everything but ON/OFF; a null event counts as a play."""
    return ~is_change(event)


def event_players(df: DataFrame, name_col: str = "event_api") -> DataFrame:
    """Adds player1Id, player2Id and player3Id from the detail fields present in ``df``."""
    for slot in range(3):
        target = f"player{slot + 1}Id"
        chosen = None
        for event, fields in EVENT_PLAYERS.items():
            if slot < len(fields) and fields[slot] in df.columns:
                hit, value = F.col(name_col) == event, F.col(fields[slot]).cast("bigint")
                chosen = F.when(hit, value) if chosen is None else chosen.when(hit, value)
        kept = F.col(target).cast("bigint") if target in df.columns else F.lit(None).cast("bigint")
        df = df.withColumn(target, kept if chosen is None else chosen.otherwise(kept))
    return df
