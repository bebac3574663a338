"""Landed JSON payloads to tables.

A payload is one JSON document: a list of records or an object holding the list under the feed's
envelope key. Files are read whole, or payloads come as a text column of any table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NAME = "STRUCT<default: STRING>"
_TEAM = "STRUCT<id: BIGINT, abbrev: STRING, score: INT>"

SCHEDULE = f"""id BIGINT, season BIGINT, gameType INT, gameDate STRING, venue {_NAME}, neutralSite BOOLEAN,
 startTimeUTC STRING, easternUTCOffset STRING, venueUTCOffset STRING, gameState STRING,
 awayTeam {_TEAM}, homeTeam {_TEAM}"""
STANDINGS = f"""conferenceName STRING, divisionName STRING, date STRING, gamesPlayed INT, goalFor INT, goalAgainst INT,
 wins INT, losses INT, otLosses INT, points INT, pointPctg DOUBLE, teamName {_NAME}, teamAbbrev {_NAME}"""
ROSTER = f"""id BIGINT, headshot STRING, firstName {_NAME}, lastName {_NAME}, sweaterNumber INT, positionCode STRING,
 shootsCatches STRING, heightInInches INT, weightInPounds INT, birthDate STRING, birthCountry STRING"""
SKATERS = f"""playerId BIGINT, headshot STRING, firstName {_NAME}, lastName {_NAME}, positionCode STRING,
 gamesPlayed INT, goals INT, assists INT, points INT, plusMinus INT, penaltyMinutes INT, shots INT,
 shootingPctg DOUBLE, avgTimeOnIcePerGame DOUBLE"""
GOALIES = f"""playerId BIGINT, headshot STRING, firstName {_NAME}, lastName {_NAME}, gamesPlayed INT, wins INT,
 losses INT, goalsAgainstAverage DOUBLE, savePercentage DOUBLE, shutouts INT, timeOnIce INT"""
TEAMS = "id BIGINT, fullName STRING, teamCommonName STRING, teamPlaceName STRING, firstSeason STRUCT<id: BIGINT>, lastSeason STRUCT<id: BIGINT>"
PICKS = f"""round INT, pickInRound INT, overallPick INT, teamId BIGINT, teamAbbrev STRING, firstName {_NAME},
 lastName {_NAME}, positionCode STRING, countryCode STRING, height INT, weight INT, amateurLeague STRING"""
DRAFT = """id BIGINT, draftYear INT, roundNumber INT, pickInRound INT, overallPickNumber INT, playerId BIGINT,
 playerName STRING, position STRING, draftedByTeamId BIGINT, amateurClubName STRING, countryCode STRING,
 team STRUCT<id: BIGINT, fullName: STRING, triCode: STRING>"""


@dataclass(frozen=True)
class Feed:
    """How a feed's payload is unwrapped."""

    record: str
    source: str
    envelopes: tuple[str, ...] = ()
    single: bool = False
    every_list: bool = False
    extra: dict[str, str] = field(default_factory=dict)


# Envelope keys and source names.
FEEDS = {
    "teams": Feed(TEAMS, "default", ("data", "teams"), single=True),
    "schedule": Feed(SCHEDULE, "NHL Schedule API", ("games",)),
    "standings": Feed(STANDINGS, "NHL Standings API", ("standings",)),
    "roster": Feed(ROSTER, "NHL Roster API", every_list=True),
    "team_stats": Feed(SKATERS, "NHL Team Stats API", ("skaters",)),
    "team_stats_goalies": Feed(GOALIES, "NHL Team Stats API", ("goalies",)),
    "draft_picks": Feed(PICKS, "NHL Draft API", ("picks",), extra={"year": "string"}),
    "draft_records": Feed(DRAFT, "NHL Draft Records API", ("data",), extra={"year": "string"}),
    "team_draft_history": Feed(DRAFT, "NHL Team Draft History API", ("data",)),
}
TEAM_SOURCES = ("default", "calendar", "records")

DETAIL_IDS = (
    "eventOwnerTeamId", "winningPlayerId", "losingPlayerId", "hittingPlayerId", "hitteePlayerId",
    "shootingPlayerId", "blockingPlayerId", "scoringPlayerId", "assist1PlayerId", "assist2PlayerId",
    "goalieInNetId", "playerId", "committedByPlayerId", "drawnByPlayerId", "servedByPlayerId",
)
_DETAIL_FIELDS = ", ".join(f"{c}: BIGINT" for c in DETAIL_IDS)
PLAY = f"""eventId BIGINT, periodDescriptor STRUCT<number: INT, periodType: STRING>, timeInPeriod STRING,
 timeRemaining STRING, situationCode STRING, typeCode INT, typeDescKey STRING, sortOrder INT, pptReplayUrl STRING,
 details STRUCT<{_DETAIL_FIELDS}, xCoord: DOUBLE, yCoord: DOUBLE, zoneCode: STRING, shotType: STRING,
  homeScore: INT, awayScore: INT, homeSOG: INT, awaySOG: INT, reason: STRING, descKey: STRING, duration: INT>"""
SPOT = f"""teamId BIGINT, playerId BIGINT, firstName {_NAME}, lastName {_NAME}, sweaterNumber INT,
 positionCode STRING, headshot STRING"""
GAME = f"""id BIGINT, season BIGINT, gameType INT, gameDate STRING, venue {_NAME}, venueLocation {_NAME},
 startTimeUTC STRING, easternUTCOffset STRING, venueUTCOffset STRING, awayTeam {_TEAM}, homeTeam {_TEAM},
 plays ARRAY<STRUCT<{PLAY.replace(' BIGINT', ': BIGINT').replace(' STRING', ': STRING').replace(' INT', ': INT').replace(' STRUCT', ': STRUCT').replace('::', ':')}>>,
 rosterSpots ARRAY<STRUCT<{SPOT.replace(' BIGINT', ': BIGINT').replace(' STRING', ': STRING').replace(' INT', ': INT').replace(' STRUCT', ': STRUCT').replace('::', ':')}>>"""
META = ("gameDate", "gameType", "startTimeUTC", "easternUTCOffset", "venueUTCOffset")


def stamp(df: DataFrame, source: str) -> DataFrame:
    """Adds when and from where the rows were taken."""
    return df.withColumns({"scrapedOn": F.current_timestamp(), "source": F.lit(source)})


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(payload, path): one row per landed file."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("payload"), F.col("_metadata.file_path").alias("path")
    )


def _records(payload: Column, feed: Feed) -> Column:
    """Raw JSON text of the records of a payload; null when the payload has another shape."""
    text = F.trim(payload)
    listed = F.from_json(text, "array<string>")
    if feed.every_list:
        lists = F.filter(F.map_values(F.from_json(text, "map<string,string>")), lambda v: v.startswith("["))
        found = F.flatten(F.transform(lists, lambda v: F.from_json(v, "array<string>")))
        return F.when(text.startswith("{"), found)
    shape = T.StructType([T.StructField(e, T.ArrayType(T.StringType())) for e in feed.envelopes])
    parsed = F.from_json(text, shape)
    inside = F.coalesce(*[parsed[e] for e in feed.envelopes])
    if feed.single:
        inside = F.coalesce(inside, F.array(text))
    return F.when(text.startswith("["), listed).when(text.startswith("{"), inside)


def parse_feed(
    payloads: DataFrame, name: str, payload: str = "payload", record: str | None = None,
    source: str | None = None, keep: tuple[str, ...] = (), **extra: object,
) -> DataFrame:
    """Records of a feed from a table with one payload per row, with ``source`` and ``scrapedOn``.

    ``raw`` is the record as it came, with the fields that have no column of their own.

    Elements that are no objects and payloads of another shape are left out (``bad_payloads`` lists the
    latter). ``record`` overrides the record schema, ``keep`` carries columns of the payload table along,
    ``extra`` gives constants such as the draft ``year``.
    """
    feed = FEEDS[name]
    rows = payloads.select(*keep, F.explode(_records(F.col(payload), feed)).alias("r")).where(
        F.ltrim("r").startswith("{")
    )
    out = rows.select(*keep, F.from_json("r", record or feed.record).alias("r"), F.col("r").alias("raw")).select(*keep, "r.*", "raw")
    for c, kind in feed.extra.items():
        if c in extra:
            out = out.withColumn(c, F.lit(extra[c]).cast(kind))
    return stamp(out, source or feed.source)


def bad_payloads(payloads: DataFrame, name: str, payload: str = "payload") -> DataFrame:
    """Payloads whose shape the feed does not know."""
    return payloads.where(_records(F.col(payload), FEEDS[name]).isNull())


def read_feed(spark: SparkSession, path: str, name: str, **options: object) -> DataFrame:
    """A feed from landed files. For ``teams`` an unknown ``source`` falls back to ``default``."""
    if name == "teams":
        options["source"] = options.get("source") if options.get("source") in TEAM_SOURCES else "default"
    return parse_feed(read_payloads(spark, path), name, **options)


def default_standings_date() -> Column:
    """January 1 of last year, the day standings are read for unless told otherwise."""
    return F.make_date(F.year(F.current_date()) - 1, F.lit(1), F.lit(1))


def parse_game(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per game payload with typed fields; feeds ``plays``, ``roster_spots`` and ``game_meta``."""
    return payloads.select(F.from_json(payload, GAME).alias("g")).where("g.id is not null").select("g.*")


def game_meta(games: DataFrame) -> DataFrame:
    """(gameId, venue, dates, offsets, both teams): one row per game."""
    return games.select(
        F.col("id").alias("gameId"), F.col("venue.default").alias("venue"),
        F.col("venueLocation.default").alias("venueLocation"), *META,
        F.col("homeTeam.id").alias("homeId"), F.col("homeTeam.abbrev").alias("homeTeam"),
        F.col("awayTeam.id").alias("awayId"), F.col("awayTeam.abbrev").alias("awayTeam"),
    )


def plays(games: DataFrame) -> DataFrame:
    """Plays in feed order, flattened; ``seq`` is the position in the payload."""
    p = F.col("p")
    return games.select(
        F.col("id").alias("gameId"), F.col("homeTeam.id").alias("homeId"),
        F.col("homeTeam.abbrev").alias("homeTeam"), F.col("awayTeam.abbrev").alias("awayTeam"),
        F.posexplode("plays").alias("seq", "p"),
    ).select(
        "gameId", F.col("seq").cast("bigint").alias("seq"), "homeId", "homeTeam", "awayTeam",
        p["eventId"].alias("eventId"), p["periodDescriptor"]["number"].alias("period"),
        p["periodDescriptor"]["periodType"].alias("periodType"), p["timeInPeriod"].alias("timeInPeriod"),
        p["timeRemaining"].alias("timeRemaining"), p["situationCode"].alias("situationCode"),
        p["typeCode"].alias("typeCode"), p["typeDescKey"].alias("event_api"), p["sortOrder"].alias("sortOrder"),
        p["pptReplayUrl"].alias("pptReplayUrl"), "p.details.*",
    )


def roster_spots(games: DataFrame) -> DataFrame:
    """(gameId, teamId, playerId, sweaterNumber, positionCode, names, headshot, isHome)."""
    s = F.col("s")
    return games.select(
        F.col("id").alias("gameId"), F.col("homeTeam.id").alias("homeId"), F.explode("rosterSpots").alias("s")
    ).select(
        "gameId", s["teamId"].alias("teamId"), s["playerId"].alias("playerId"),
        s["sweaterNumber"].alias("sweaterNumber"), s["positionCode"].alias("positionCode"),
        F.concat(s["firstName"]["default"], F.lit(" "), s["lastName"]["default"]).alias("fullName"),
        s["firstName"]["default"].alias("firstName"), s["lastName"]["default"].alias("lastName"),
        s["headshot"].alias("headshot"),
        F.coalesce((s["teamId"] == F.col("homeId")).cast("int"), F.lit(0)).alias("isHome"),
    )


def replay_ids(url: Column) -> tuple[Column, Column]:
    """Game and event id from the last two parts of a replay address."""
    pattern = r"([0-9]+)/ev([0-9]+)[.]json$"
    return (
        F.regexp_extract(url, pattern, 1).try_cast("bigint"),
        F.regexp_extract(url, pattern, 2).try_cast("bigint"),
    )


def parse_goal_replay(payloads: DataFrame, payload: str = "payload", path: str = "path") -> DataFrame:
    """(gameId, eventId, frame_index, timeStamp, frame): replay frames in order; ``frame`` is JSON text."""
    game, event = replay_ids(F.col(path))
    return payloads.select(
        game.alias("gameId"), event.alias("eventId"),
        F.posexplode(F.from_json(payload, "array<string>")).alias("frame_index", "frame"),
    ).withColumn("timeStamp", F.get_json_object("frame", "$.timeStamp").try_cast("bigint"))


def read_goal_replay(spark: SparkSession, path: str) -> DataFrame:
    return parse_goal_replay(read_payloads(spark, path))


def enrich_plays(play_rows: DataFrame, meta: DataFrame, replay: DataFrame | None = None) -> DataFrame:
    """Plays with venue, date, game type and offsets, and optionally the replay payload of goals."""
    from icetally.operators.joins import join_dimension

    facts = meta.select("gameId", "venue", "venueLocation", *META)
    out = join_dimension(play_rows, facts, ["gameId"])
    if replay is None:
        return stamp(out.withColumn("pptReplayData", F.lit(None).cast("string")), "NHL Play-by-Play API")
    game, event = replay_ids(F.col("path"))
    data = replay.select(
        game.alias("gameId"), event.alias("eventId"), "path", "payload"
    ).groupBy("gameId", "eventId").agg(F.max_by("payload", "path").alias("pptReplayData"))
    return stamp(out.join(data, ["gameId", "eventId"], "left"), "NHL Play-by-Play API")
