"""Reports and payloads rendered from the sample tables, to be read back by the extraction queries.

Documents hold bounded groups of rows (key ranges), so their number grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from icetally import fixtures
from icetally.functions.events import is_play


def _text(*parts: object) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def mmss(seconds: Column) -> Column:
    return _text(F.floor(seconds / 60), ":", F.lpad((seconds % 60).cast("string"), 2, "0"))


def _documents(rows: DataFrame, keys: list[str], order: str, head: Column, tail: Column, line: str) -> DataFrame:
    """One document per key: head, the lines in order, tail."""
    lines = F.transform(
        F.sort_array(F.collect_list(F.struct(F.col(order), F.col(line).alias("line")))), lambda x: x["line"]
    )
    return rows.groupBy(*keys).agg(lines.alias("lines")).select(
        *keys, F.concat(head, F.array_join("lines", "\n"), tail).alias("html")
    )


def event_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays with report clocks and jersey numbers on the ice."""
    e, k = F.col("event_id"), F.col("k")
    return fixtures.pbp(spark, sf_dir).where(is_play(F.col("Event"))).select(
        "gameId", (F.floor(e / 100)).alias("part"), "event_id", "period", "Event", "k",
        (F.col("elapsedTime") % 1200).alias("clock"),
        (10 + e % 12).alias("h1"), (30 + e % 7).alias("h2"), (50 + k % 5).alias("a1"), (70 + k % 3).alias("a2"),
        (F.col("pulled_home") == 0).alias("hg"), (e % 23 != 0).alias("iced"),
    )


def event_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    def player(number: Column, letter: str) -> Column:
        return _text("<td align='center'><table border=\"0\"><tr><td><font title=\"Center - X\">", number,
                     "</font></td></tr><tr><td>", letter, "</td></tr></table></td>")

    def ice(*players: Column) -> Column:
        return F.concat(F.lit("<td class=\"bold\">\n<table><tr>"), *players, F.lit("</tr></table></td>"))

    none = F.lit("<td>&nbsp;</td>")
    away = ice(player(F.col("a1"), "C"), player(F.col("a2"), "D"), player(F.lit(90), "G"))
    home = ice(
        player(F.col("h1"), "L"), player(F.col("h2"), "R"),
        F.when(F.col("hg"), player(F.lit(91), "G")).otherwise(F.lit("")),
        F.when(~F.col("hg"), player(F.lit(99), "C")).otherwise(F.lit("")),
    )
    cells = [
        _text(F.col("event_id")), _text(F.col("period")), F.lit("EV&nbsp;"),
        F.concat(mmss(F.col("clock")), F.lit("<br>"), mmss(1200 - F.col("clock"))), F.col("Event"),
        _text("AAA #", F.col("k"), " A&amp;B&nbsp;"),
    ]
    row = F.concat(
        F.when(F.col("event_id") % 2 == 0, "<tr class=\"evenColor\">").otherwise("<tr id='r' class=\"oddColor + bold\">"),
        *[F.concat(F.lit("<td class=\"x\">"), c, F.lit("</td>\n")) for c in cells],
        F.when(F.col("iced"), away).otherwise(none), F.when(F.col("iced"), home).otherwise(none), F.lit("</tr>"),
    )
    rows = event_source(spark, sf_dir).withColumn("row", row)
    return _documents(
        rows, ["gameId", "part"], "event_id",
        F.lit("<html><body><table><tr class=\"heading\"><td>Play By Play</td></tr>"),
        F.lit("</table><table><tr><td><table><tr><td>12C13C14C</td></tr></table></td></tr></table></body></html>"), "row",
    )


def shift_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Home and away shift reports; a player's rows, a summary row and a TOT row under each heading."""
    start, length = F.col("elapsed_time_start"), F.col("length")
    tip = start % 1200
    doc = ["gameId", "team_type", "part"]
    # the numbers travel, once, not the texts made from them: both groupings below find their rows together
    dealt = fixtures.shifts(spark, sf_dir).select(
        "gameId", F.when(F.col("isHome") == 1, "Home").otherwise("Away").alias("team_type"),
        F.floor(F.col("shift_id") / 50000).alias("part"), "playerId", "shift_id", "elapsed_time_start",
        (F.col("elapsed_time_end") - start).alias("length"),
    ).repartition(*doc)
    rows = dealt.select(
        *doc, "playerId", "shift_id", "length",
        F.concat(
            F.lit("<tr class=\"oddColor\"><td>"), _text(F.col("shift_id") % 10), F.lit("</td><td>"),
            F.when(F.col("shift_id") % 50 == 0, "OT").otherwise(_text(F.floor(start / 1200) + 1)),
            F.lit("</td><td>"), mmss(tip), F.lit(" / "), mmss(1200 - tip), F.lit("</td><td>"),
            mmss(tip + length), F.lit(" / "), mmss(1200 - tip), F.lit("</td><td>"), mmss(length),
            F.lit("</td><td>&nbsp;</td></tr>"),
        ).alias("row"),
    )
    summed = rows.groupBy(*doc, "playerId").agg(
        F.sort_array(F.collect_list(F.struct("shift_id", "row"))).alias("lines"),
        F.count("*").alias("n"), F.sum("length").alias("total"),
    )
    plain = [F.col("n").cast("string"), mmss(F.floor(F.col("total") / F.col("n"))), mmss(F.col("total")),
             mmss(F.col("total") - 1), F.lit("0:01"), F.lit("")]
    summary = F.concat(
        F.lit("<tr class=\"evenColor\"><td>"), F.when(F.col("playerId") % 5 == 0, "OT").otherwise("1"),
        *[F.concat(F.lit("</td><td>"), c) for c in plain], F.lit("</td></tr>"),
    )
    section = F.concat(
        F.lit("<tr><td class=\"playerHeading + border\" colspan=\"8\">"), (F.col("playerId") + 10).cast("string"),
        F.lit(" PLAYER, NR"), F.col("playerId").cast("string"), F.lit("</td></tr>"),
        F.array_join(F.transform("lines", lambda x: x["row"]), "\n"), summary,
        F.lit("<tr class=\"oddColor\"><td>TOT</td><td>&nbsp;</td></tr>"),
    )
    return _documents(
        summed.withColumn("section", section), doc, "playerId",
        F.concat(F.lit("<table><tr><td class=\"teamHeading + border\">TEAM "), F.col("team_type"), F.lit("</td></tr>")),
        F.lit("</table>"), "section",
    )


def roster_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty customers per report: 16 dressed and 4 scratched players a side, officials, coaches."""
    k = F.col("c_custkey")
    spot = (k % 40).cast("int")
    letter = F.element_at(F.array(*[F.lit(x) for x in "CLRDG"]), (k % 5 + 1).cast("int"))
    rows = fixtures.table(spark, sf_dir, "customer").select(
        F.floor(k / 40).alias("report"), k.alias("c_custkey"), spot.alias("spot"), "c_name",
        F.concat(F.lit("<tr><td align=\"center\">"), _text(k % 98 + 1), F.lit("</td><td>"), letter,
                 F.lit("</td><td>"), F.col("c_name"), F.lit("</td></tr>\n")).alias("row"),
    )
    docs = rows.groupBy("report").agg(
        F.sort_array(F.collect_list(F.struct("spot", "row", "c_name"))).alias("p")
    )

    def lines(low: int, high: int) -> Column:
        return F.array_join(F.transform(
            F.filter("p", lambda x: x["spot"].between(low, high)), lambda x: x["row"]), "")

    def name(i: int) -> Column:
        return F.coalesce(F.try_element_at(F.filter("p", lambda x: x["spot"] == i), F.lit(1))["c_name"], F.lit(""))

    header = "<table border=\"1\"><tr><td>#</td><td>Pos</td><td>Name</td></tr>"
    r = F.col("report")
    day = F.date_format(F.date_add(F.to_date(F.lit("2024-01-01")), (r % 365).cast("int")), "EEEE, MMMM d, yyyy")
    place = F.concat(F.lit("Attendance "), F.format_number(10000 + r * 7, 0), F.lit(" at Rink "), r.cast("string"))
    times = F.when(r % 2 == 0, "Start 7:08 PM EDT; End 9:38 PM EDT").otherwise("Start 19:08 EST; End 99:99")
    plain = F.concat(
        F.lit("<table id=\"GameInfo\"><tr><td>LEAGUE</td></tr><tr><td>x</td></tr><tr><td>y</td></tr><tr><td>"), day,
        F.lit("</td></tr><tr><td>"), place, F.lit("</td></tr><tr><td>"), times, F.lit("</td></tr></table>"),
    )
    labelled = F.concat(
        F.lit("<table id=\"GameInfo\"><tr><td>Date</td><td>"), F.lit("unknown day"),
        F.lit("</td></tr><tr><td>Start End</td><td>"), times, F.lit("</td></tr><tr><td>Game Type</td><td>T"),
        r.cast("string"), F.lit("</td></tr></table>"),
    )
    html = F.concat(
        F.lit("<html><body>"), F.when(r % 3 == 0, labelled).otherwise(plain),
        F.lit("<table><tr><td>" + header), lines(0, 15), F.lit("</table></td><td>" + header), lines(16, 31),
        F.lit("</table></td></tr></table><table id=\"Scratches\"><tr><td><table>"), lines(32, 35),
        F.lit("</table></td><td><table>"), lines(36, 39),
        F.lit("</table></td></tr></table><table><tr id=\"HeadCoaches\"><td>"), name(0), F.lit("</td><td>"), name(16),
        F.lit("</td></tr></table><table id=\"Officials\"><tr><td>Referees</td></tr><tr><td>"), name(1),
        F.lit("</td></tr><tr><td>"), name(2), F.lit("</td></tr><tr><td>Linesmen</td></tr><tr><td>"), name(3),
        F.lit("</td></tr><tr><td>Standby</td></tr><tr><td>"), name(4), F.lit("</td></tr></table></body></html>"),
    )
    return docs.select("report", html.alias("html"))


def payloads(df: DataFrame, key: str, record: Column, envelope: str, size: int = 20) -> DataFrame:
    """JSON payloads of up to ``size`` consecutive keys: an object, or for every third a bare list."""
    group = F.floor(F.col(key) / size)
    docs = df.groupBy(group.alias("doc")).agg(F.collect_list(record).alias("records"))
    return docs.select(
        "doc",
        F.when(F.col("doc") % 3 == 2, F.to_json("records"))
        .otherwise(F.to_json(F.struct(F.col("records").alias(envelope), F.lit(1).alias("page")))).alias("payload"),
    )


def roster_payloads(df: DataFrame, key: str, record: Column, position: Column) -> DataFrame:
    """Payloads with one list per position group."""
    docs = df.groupBy(F.floor(F.col(key) / 20).alias("doc")).agg(*[
        F.collect_list(F.when(position == p, record)).alias(name)
        for p, name in (("C", "forwards"), ("D", "defensemen"), ("G", "goalies"))
    ])
    return docs.select("doc", F.to_json(F.struct("forwards", "defensemen", "goalies", F.lit(7).alias("season"))).alias("payload"))


def game_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Game payloads: up to a hundred plays each, with two roster spots."""
    e, k = F.col("event_id"), F.col("k")
    play = F.struct(
        e.alias("eventId"), F.struct(F.col("period").alias("number"), F.lit("REG").alias("periodType")).alias("periodDescriptor"),
        F.concat(F.lpad(F.floor(F.col("elapsedTime") % 1200 / 60).cast("string"), 2, "0"), F.lit(":"),
                 F.lpad((F.col("elapsedTime") % 60).cast("string"), 2, "0")).alias("timeInPeriod"),
        F.when(F.col("Event") == "GOAL", "goal").when(F.col("Event") == "SHOT", "shot-on-goal").otherwise("stoppage").alias("typeDescKey"),
        F.when(F.col("Event") == "GOAL", F.concat(F.lit("https://replays.example.org/"), F.floor(e / 100).cast("string"),
                                                 F.lit("/ev"), e.cast("string"), F.lit(".json"))).alias("pptReplayUrl"),
        F.struct(
            F.when(F.col("Event") == "GOAL", F.col("user_id")).alias("scoringPlayerId"),
            F.when(F.col("Event") == "SHOT", F.col("user_id")).alias("shootingPlayerId"),
            F.col("xCoord"), F.col("homeScore"), (k % 2 + 1).alias("eventOwnerTeamId"),
        ).alias("details"),
    )
    docs = fixtures.pbp(spark, sf_dir).where(is_play(F.col("Event"))).groupBy(F.floor(e / 100).alias("id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct(e.alias("o"), play.alias("p")))), lambda x: x["p"]).alias("plays")
    )
    gid = F.col("id")

    def name(text: Column) -> Column:
        return F.struct(text.alias("default"))

    def spot(team: int, player: int) -> Column:
        return F.struct(F.lit(team).alias("teamId"), (gid * 10 + player).alias("playerId"),
                        name(F.concat(F.lit("F"), gid.cast("string"))).alias("firstName"),
                        name(F.lit(f"L{player}")).alias("lastName"), F.lit(player).alias("sweaterNumber"),
                        F.lit("C").alias("positionCode"))

    body = F.struct(
        gid, F.lit(2).alias("gameType"), F.date_add(F.to_date(F.lit("2024-01-01")), (gid % 300).cast("int")).cast("string").alias("gameDate"),
        name(F.concat(F.lit("Rink "), gid.cast("string"))).alias("venue"), name(F.lit("Town")).alias("venueLocation"),
        F.lit("-05:00").alias("easternUTCOffset"),
        F.struct(F.lit(1).alias("id"), F.lit("AAA").alias("abbrev")).alias("homeTeam"),
        F.struct(F.lit(2).alias("id"), F.lit("BBB").alias("abbrev")).alias("awayTeam"),
        "plays", F.array(spot(1, 4), spot(2, 9)).alias("rosterSpots"),
    )
    return docs.select(gid, F.to_json(body).alias("payload"))


def replay_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay files of goals: three frames each, the path naming game and event."""
    e = F.col("event_id")
    frames = F.array(*[
        F.struct((e * 10 + i).alias("timeStamp"), F.struct(F.col("user_id").alias("id")).alias("onIce")) for i in range(3)
    ])
    return fixtures.pbp(spark, sf_dir).where("Event = 'GOAL'").select(
        F.concat(F.lit("/landing/replays/"), F.floor(e / 100).cast("string"), F.lit("/ev"), e.cast("string"), F.lit(".json")).alias("path"),
        F.to_json(frames).alias("payload"),
    )


# --- whole games: report, shift reports and payload of the same hundred events --------------------

_FEED_NAMES = {
    "SHOT": "shot-on-goal", "GOAL": "goal", "MISS": "missed-shot", "BLOCK": "blocked-shot", "PENL": "penalty",
    "GIVE": "giveaway", "TAKE": "takeaway", "FAC": "faceoff", "HIT": "hit", "STOP": "stoppage",
}


def _clock2(seconds: Column) -> Column:
    return F.lpad(mmss(seconds), 5, "0")


def _game_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.pbp(spark, sf_dir).withColumns({
        "gameId": F.floor(F.col("event_id") / 100), "clock": F.col("elapsedTime") % 1200, "pid": F.col("user_id") % 12,
    })


def whole_event_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")

    def ice(*players: tuple[Column, str]) -> Column:
        cells = [_text("<td><table><tr><td><font>", n, "</font></td></tr><tr><td>", p, "</td></tr></table></td>")
                 for n, p in players]
        return F.concat(F.lit("<td><table><tr>"), *cells, F.lit("</tr></table></td>"))

    away = ice((13 + e % 5 * 2, "C"), (13 + (e + 1) % 5 * 2, "D"), (F.lit(11), "G"))
    home = F.when(
        F.col("pulled_home") == 0, ice((12 + e % 5 * 2, "C"), (12 + (e + 2) % 5 * 2, "D"), (F.lit(10), "G"))
    ).otherwise(ice((12 + e % 5 * 2, "C"), (12 + (e + 2) % 5 * 2, "D"), (F.lit(99), "R")))
    cells = [_text(e), _text(F.col("period")), F.lit("EV"),
             F.concat(mmss(F.col("clock")), F.lit("<br>"), mmss(1200 - F.col("clock"))), F.col("Event"), F.lit("-")]
    row = F.concat(
        F.lit("<tr class=\"evenColor\">"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells],
        away, home, F.lit("</tr>"),
    )
    rows = _game_rows(spark, sf_dir).where(is_play(F.col("Event"))).withColumn("row", row)
    return _documents(rows, ["gameId"], "event_id", F.lit("<table>"), F.lit("</table>"), "row")


def whole_shift_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("clock")
    row = F.concat(
        F.lit("<tr class=\"oddColor\"><td>1</td><td>"), _text(F.col("period")), F.lit("</td><td>"), mmss(start),
        F.lit(" / 0:00</td><td>"), mmss(start + 30), F.lit(" / 0:00</td><td>0:30</td><td>&nbsp;</td></tr>"),
    )
    rows = _game_rows(spark, sf_dir).where("Event = 'ON'").withColumn("row", row).withColumn(
        "team_type", F.when(F.col("pid") % 2 == 0, "Home").otherwise("Away"))
    sections = rows.groupBy("gameId", "team_type", "pid").agg(
        F.sort_array(F.collect_list(F.struct("event_id", "row"))).alias("lines")
    ).withColumn("section", F.concat(
        F.lit("<tr><td class=\"playerHeading\">"), _text(F.col("pid") + 10), F.lit(" NAME, SOME</td></tr>"),
        F.array_join(F.transform("lines", lambda x: x["row"]), ""), F.lit("<tr class=\"evenColor\"><td>TOT</td></tr>"),
    ))
    return _documents(
        sections, ["gameId", "team_type"], "pid",
        F.concat(F.lit("<table><tr><td class=\"teamHeading\">"), F.col("team_type"), F.lit("</td></tr>")),
        F.lit("</table>"), "section",
    )


def whole_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    player, e = 1000 + F.col("pid"), F.col("event_id")
    name = F.lit(None).cast("string")
    for code, feed_name in _FEED_NAMES.items():
        name = F.when(F.col("Event") == code, feed_name).otherwise(name)
    play = F.struct(
        e.alias("eventId"), F.struct(F.col("period").alias("number")).alias("periodDescriptor"),
        _clock2(F.col("clock")).alias("timeInPeriod"), name.alias("typeDescKey"),
        F.struct(
            F.when(F.col("isHome") == 1, 1).otherwise(2).alias("eventOwnerTeamId"),
            F.when(F.col("Event").isin("SHOT", "MISS"), player).alias("shootingPlayerId"),
            F.when(F.col("Event") == "GOAL", player).alias("scoringPlayerId"), "xCoord", "yCoord", "homeScore",
        ).alias("details"),
    )
    rows = _game_rows(spark, sf_dir).where(is_play(F.col("Event")))
    docs = rows.groupBy("gameId").agg(F.sort_array(F.collect_list(F.struct(e.alias("o"), F.to_json(play).alias("p")))).alias("p"))
    spots = ",".join(
        f'{{"teamId":{1 + i % 2},"playerId":{1000 + i},"sweaterNumber":{10 + i},"positionCode":"{"G" if i < 2 else "D" if i % 3 else "C"}",'
        f'"firstName":{{"default":"F{i}"}},"lastName":{{"default":"L{i}"}}}}' for i in range(12)
    )
    return docs.select(F.concat(
        F.lit("{\"id\":"), F.col("gameId").cast("string"),
        F.lit(",\"gameType\":2,\"homeTeam\":{\"id\":1,\"abbrev\":\"AAA\"},\"awayTeam\":{\"id\":2,\"abbrev\":\"BBB\"},\"plays\":["),
        F.array_join(F.transform("p", lambda x: x["p"]), ","), F.lit(f"],\"rosterSpots\":[{spots}]}}"),
    ).alias("payload"))
