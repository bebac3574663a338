"""Reports, feeds and the whole-game plans on a small hand-made game."""

import json
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from icetally import rendered
from icetally.functions.arrays import running
from icetally.operators import metrics
from icetally.plans import game as plans
from icetally.sources import feeds, reports

GAME = 2024020001


def ice(*players):
    cells = "".join(
        f"<td><table><tr><td><font title='x'>{p[:-1]}</font></td></tr><tr><td>{p[-1]}</td></tr></table></td>" for p in players)
    return f"<table><tr>{cells}</tr></table>"


def event_row(n, per, clock, left, event, text="x&nbsp;", away=("18C", "7L", "35G"), home=("8C", "9D", "31G"), cls="evenColor"):
    lists = f"<td>{ice(*away)}</td>\n<td>{ice(*home)}</td>" if away else "<td>&nbsp;</td><td>&nbsp;</td>"
    return (f'<tr class="{cls}"><td>{n}</td><td>{per}</td><td>EV</td><td>{clock}<br>{left}</td><td>{event}</td>'
            f"<td>{text}</td>{lists}</tr>")


EVENTS = "<html><table>" + "".join([
    event_row(1, 1, "0:00", "20:00", "PSTR", away=None),
    event_row(2, 1, "0:00", "20:00", "FAC"),
    event_row(3, 1, "0:30", "19:30", "SHOT", cls="oddColor + bold"),
    event_row(4, 1, "0:30", "19:30", "SHOT"),
    event_row(5, 1, "0:45", "19:15", "GOAL", "HOM #8 &amp; co", home=("8C", "9D", "77D", "31G")),
    event_row(6, 5, "0:00", "0:00", "SOC", away=("18C",)),
]) + "</table><table><tr><td>99C98C97C</td></tr></table></html>"


def deep(text, depth):
    for _ in range(depth):
        text = f"<table><tr><td>{text}</td></tr></table>"
    return text


def test_nesting_has_no_bound(spark):
    row = '<tr class="oddColor"><td>1</td><td>2</td><td>{a}</td><td>{h}</td></tr>'
    html = "<table>" + "".join(row.format(a=deep("18C71C7L", d), h=deep("8C9D10D", d)) for d in range(1, 9)) + "</table>"
    rows = reports.extract_rows(spark.createDataFrame([(html,)], "html string")).orderBy("seq").collect()
    assert [(r.cells, r.ice) for r in rows] == [(["1", "2"], ["18C71C7L", "8C9D10D"])] * 8
    # a row without lists, and one whose table is never closed
    odd = '<tr class="oddColor"><td>1</td></tr><tr class="oddColor"><td>2</td><td><table><tr><td>x</td></tr>'
    assert [r.cells for r in reports.extract_rows(spark.createDataFrame([(odd,)], "html string")).orderBy("seq").collect()] == [["1"], ["2"]]


def test_long_blanks_do_not_end_the_job(spark):
    blanks = " " * 100_000 + "&nbsp;" * 1000
    doc = shift_doc("HOMES", [("8 HOME, EIGHT", [("1", "0:00", "1:00", "01:00")]), ("9 HOME, NINE", [("1", "0:00", "0:45", "00:45")])])
    doc = doc.replace("<td>1</td><td>1</td>", f"<td>{blanks}1{blanks}</td><td>1</td>").replace("<td>TOT</td>", f"<td>{blanks}<b>TOT</b>{blanks}</td>")
    rows = reports.shift_rows(spark.createDataFrame([(1, "Home", doc)], "gameId int, team_type string, html string")).orderBy("seq").collect()
    assert [(r.player_name, r.shift_number) for r in rows] == [("8 HOME, EIGHT", 1), ("9 HOME, NINE", 1)]


def test_shift_order_is_unique_in_a_game(spark):
    docs = spark.createDataFrame([(1, "Away", 0, AWAY), (1, "Home", 0, HOME), (1, "Home", 1, HOME)], "gameId int, team_type string, part int, html string")
    rows = reports.shift_rows(docs).orderBy("seq").collect()
    assert len({r.seq for r in rows}) == len(rows)
    assert [(r.team_type, r.part) for r in rows] == sorted(((r.team_type, r.part) for r in rows), key=lambda x: (x[0] != "Home", x[1]))


def test_records_keep_unlisted_fields(spark):
    df = spark.createDataFrame([(json.dumps({"games": [{"id": 1, "season": 2, "oddField": {"x": [1]}}]}),)], "payload string")
    assert json.loads(feeds.parse_feed(df, "schedule").first().raw)["oddField"] == {"x": [1]}


def shift_doc(team, players):
    out = [f'<table><tr><td class="teamHeading + border">{team}</td></tr>']
    for name, shifts in players:
        out.append(f'<tr><td class="playerHeading + border" colspan="8">{name}</td></tr>')
        out += [f'<tr class="oddColor"><td>{i}</td><td>{p}</td><td>{a} / 1:00</td><td>{b} / 0:30</td><td>{d}</td><td>&nbsp;</td></tr>'
                for i, (p, a, b, d) in enumerate(shifts, 1)]
        out.append('<tr class="evenColor"><td>1</td><td>2</td><td>00:30</td><td>01:00</td><td>00:50</td><td>00:10</td><td>00:00</td></tr>')
        out.append('<tr class="oddColor"><td>TOT</td><td>2</td></tr>')
    return "".join(out) + "</table>"


HOME = shift_doc("HOMES", [("8 HOME, EIGHT", [("1", "0:00", "1:00", "01:00"), ("OT", "0:10", "0:20", "00:10")]),
                           ("9 HOME, NINE", [("1", "0:00", "0:45", "00:45")]), ("31 HOME, GOALIE", [("1", "0:00", "20:00", "20:00")])])
AWAY = shift_doc("AWAYS", [("18 AWAY, ONE", [("1", "0:00", "0:30", "00:30"), ("1", "0:30", "1:00", "00:30")]),
                           ("7 AWAY, SEVEN", [("1", "0:00", "1:00", "x")]), ("35 AWAY, GOALIE", [("1", "0:00", "20:00", "20:00")])])


def spot(team, pid, number, pos):
    return {"teamId": team, "playerId": pid, "sweaterNumber": number, "positionCode": pos,
            "firstName": {"default": f"F{pid}"}, "lastName": {"default": f"L{pid}"}}


def play(event_id, key, clock, team=None, per=1, **details):
    return {"eventId": event_id, "periodDescriptor": {"number": per}, "timeInPeriod": clock, "typeDescKey": key,
            "details": {"eventOwnerTeamId": team, **details}}


PAYLOAD = {
    "id": GAME, "gameType": 2, "gameDate": "2024-10-10", "venue": {"default": "Rink"}, "venueLocation": {"default": "Town"},
    "homeTeam": {"id": 1, "abbrev": "HOM"}, "awayTeam": {"id": 2, "abbrev": "AWY"},
    "plays": [
        play(1, "period-start", "00:00"), play(2, "faceoff", "00:00", 1, winningPlayerId=108, losingPlayerId=218),
        play(3, "shot-on-goal", "00:30", 2, shootingPlayerId=218, awaySOG=1, xCoord=-60, yCoord=4),
        play(4, "shot-on-goal", "00:30", 1, shootingPlayerId=109, homeSOG=1, xCoord=70, yCoord=2),
        play(5, "mystery", "00:40", 1),
        play(6, "goal", "00:45", 1, scoringPlayerId=108, assist1PlayerId=109, homeScore=1, awayScore=0, xCoord=80, yCoord=1),
    ],
    "rosterSpots": [spot(1, 108, 8, "C"), spot(1, 109, 9, "D"), spot(1, 131, 31, "G"),
                    spot(2, 218, 18, "C"), spot(2, 207, 7, "L"), spot(2, 235, 35, "G")],
}


@pytest.fixture(scope="module")
def inputs(spark):
    events = spark.createDataFrame([(GAME, EVENTS), (GAME + 1, " ")], "gameId long, html string")
    shifts = spark.createDataFrame([(GAME, "Home", HOME), (GAME, "Away", AWAY), (GAME + 1, "Home", "")], "gameId long, team_type string, html string")
    payloads = spark.createDataFrame([(json.dumps(PAYLOAD),)], "payload string")
    return events, shifts, payloads


def test_event_table(inputs):
    rows = reports.event_table(inputs[0]).orderBy("seq").collect()
    assert len(rows) == 6 and rows[4]["Description"] == "HOM #8 & co"
    assert rows[1].away_on_ice == ["18", "7"] and rows[1].home_goalie == ["31"] and rows[2].timeInPeriod == "00:30"
    # no lists, or one list too short: all four empty
    assert rows[0].home_on_ice == [] and rows[5].home_on_ice == [] and rows[5].away_goalie == []
    assert reports.empty_reports(inputs[0]).count() == 1


def test_shift_rows(inputs):
    rows = reports.shift_rows(inputs[1])
    assert rows.count() == 8
    one = rows.where("player_name = '8 HOME, EIGHT'").orderBy("seq").collect()
    assert [(r.jersey_number, r.period_number, r.duration_seconds, r.start_time_in_period) for r in one] == [(8, 1, 60, "0:00"), (8, 4, 10, "0:10")]
    assert {r.team_name for r in rows.where("team_type = 'Away'").collect()} == {"AWAYS"}
    assert rows.where("jersey_number = 7").first().duration_seconds is None
    counts = {(r.gameId, r.team_type): (r.players_count, r.total_shifts, r.total_summary_records, r.parsing_successful)
              for r in reports.parse_report_counts(inputs[1]).collect()}
    assert counts == {(GAME, "Home"): (3, 4, 3, True), (GAME, "Away"): (3, 4, 3, True), (GAME + 1, "Home"): (0, 0, 0, False)}


def test_equal_headings(spark):
    doc = shift_doc("T", [("5 SAME, NAME", [("1", "0:00", "1:00", "01:00")]), ("5 SAME, NAME", [("1", "0:00", "0:30", "00:30")])])
    df = spark.createDataFrame([(1, "Home", doc)], "gameId long, team_type string, html string")
    assert [r.duration for r in reports.shift_rows(df).collect()] == ["00:30"]


def test_plans(spark, inputs):
    events, shift_docs, payloads = inputs
    games = feeds.parse_game(payloads)
    shifts = plans.build_shifts(shift_docs, games).cache()
    assert {(r.jersey_number, r.playerId) for r in shifts.collect()} == {(8, 108), (9, 109), (31, 131), (18, 218), (7, 207), (35, 235)}
    assert shifts.where("period_number = 4").first().elapsed_time_start == 3610
    players = {r.playerId: (r.team, r.position) for r in plans.build_players(shifts).collect()}
    assert players == {108: ("HOM", "F"), 109: ("HOM", "D"), 131: ("HOM", "G"), 218: ("AWY", "F"), 207: ("AWY", "F"), 235: ("AWY", "G")}

    pbp = plans.build_pbp(events, games, shifts).cache()
    rows = pbp.orderBy("#").collect()
    assert [r["#"] for r in rows] == list(range(1, 6 + 2 * 8 + 1))
    by_id = {r.eventId: r for r in rows if r.eventId is not None}
    assert by_id[3].eventTeam == "AWY" and by_id[4].eventTeam == "HOM"
    assert (by_id[3].awaySOG, by_id[3].homeSOG, by_id[4].homeSOG, by_id[6].homeScore) == (1, 0, 1, 1)
    assert (by_id[6].player1Id, by_id[6].player2Id, by_id[6].player1Name) == (108, 109, "F108 L108")
    assert by_id[6].home_on_id == [108, 109, None] and by_id[6].home_on_full_name == ["F108 L108", "F109 L109", "77"]
    assert by_id[6].unmapped_count == 1 and by_id[6].homeGoalie_on_id == [131]
    assert by_id[3].detailedGameStrength == "2v2" and by_id[6].detailedGameStrength == "3v2"
    assert by_id[2].elapsedTime == 0 and [r.elapsedTime for r in rows if r.Event == "SOC"] == [None]
    order = [r.Event for r in rows if r.elapsedTime == 0]
    assert order[0] == "PSTR" and order[-1] == "FAC" and set(order[1:-1]) == {"ON"}
    assert rows[0].venue == "Rink" and rows[0].homeTeam == "HOM"

    wide, who = plans.pipeline(events, shift_docs, payloads)
    row = wide.where("eventId = 4").first()
    assert (row.home_skater_id_1, row.home_skater_name_2, row.home_goalie_id, row.away_goalie_name) == (108, "F109 L109", 131, "F235 L235")
    assert row.previousEvent == "SHOT" and row.x_norm == 70.0 and who.count() == 6

    stats = {r.player1Id: (r.CF, r.CA) for r in metrics.on_ice_stats_by_player_strength(pbp).groupBy("player1Id").agg(
        F.sum("CF").alias("CF"), F.sum("CA").alias("CA")).collect()}
    # three attempts: one away shot, one home shot and the home goal, 109 leaving at the goal's second
    assert stats == {108: (2, 1), 109: (2, 1), 218: (1, 2), 207: (1, 2)}


def held_pbp(spark, inputs, held):
    events, shift_docs, payloads = inputs
    games = plans.hold(feeds.parse_game(payloads), held)
    shifts = plans.hold(plans.build_shifts(shift_docs, games), held)
    return plans.build_pbp(events, games, shifts, held=held)


def seen(df):
    return sorted(repr(r) for r in df.drop("scrapedOn").collect())


def test_rows_of_a_game_meet_once(spark, inputs):
    """Whatever travels when held tables are put together travels to its game, and by nothing else."""
    held = []
    try:
        pbp = held_pbp(spark, inputs, held)
        plan = pbp._jdf.queryExecution().executedPlan().toString()
        dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
        assert dealt and all(re.search(r"hashpartitioning\((gameId|id)#\d+L?, ", x) for x in dealt), plan
    finally:
        plans.release(spark, held)


def test_pipeline_orders_a_game_without_another_table(spark, inputs):
    """Features follow where the game was put together: the play-by-play table is not written in between."""
    held = []
    try:
        wide, _ = plans.pipeline(*inputs, held=held)
        assert len(held) == 5
        plain, _ = plans.pipeline(*inputs)
        assert wide.columns == plain.columns and seen(wide) == seen(plain)
    finally:
        plans.release(spark, held)


def test_games_beyond_the_bound(spark, monkeypatch):
    """Games put together in one task, in cells, or some this and some that way: the same rows."""
    other = GAME + 5
    few = "<html><table>" + event_row(1, 1, "0:30", "19:30", "SHOT") + "</table></html>"
    events = spark.createDataFrame([(GAME, EVENTS), (other, few), (None, few)], "gameId long, html string")
    shift_docs = spark.createDataFrame([(GAME, "Home", HOME), (GAME, "Away", AWAY), (other, "Home", HOME), (GAME + 9, "Away", AWAY)],
                                       "gameId long, team_type string, html string")
    payloads = spark.createDataFrame([(json.dumps(PAYLOAD | change),) for change in ({}, {"id": other}, {"id": GAME + 7, "plays": None})], "payload string")
    inputs = events, shift_docs, payloads
    games = feeds.parse_game(payloads)
    want, wide = seen(plans.build_pbp(events, games, plans.build_shifts(shift_docs, games))), seen(plans.pipeline(*inputs)[0])
    # GAME has 6 + 6 + 16 rows, the other game 1 + 6 + 8, the null one a single row
    for bound in (0, 20, 50_000):
        monkeypatch.setattr(plans, "GAME_ROWS", bound)
        held = []
        try:
            assert seen(held_pbp(spark, inputs, held)) == want
            assert seen(plans.pipeline(*inputs, held=held)[0]) == wide
        finally:
            plans.release(spark, held)


def test_plain_tables_are_not_counted_piece_by_piece(spark):
    """Rows whose tables a pattern takes out cost little; the same rows with one deeper table are counted."""
    def took(lists):
        docs = spark.range(40).select(F.repeat(F.lit(f'<tr class="oddColor"><td>1</td>{lists}</tr>'), 400).alias("html"))
        best = 1e9
        for _ in range(3):
            begin = time.time()
            reports.extract_rows(docs).write.format("noop").mode("overwrite").save()
            best = min(best, time.time() - begin)
        return best

    lists = f"<td>{ice('18C', '7L', '35G')}</td><td>{ice('8C', '9D', '31G')}</td>"
    assert took(lists) * 2 < took(lists + f"<td>{deep('x', 4)}</td>")


def test_feed_shapes(spark):
    df = spark.createDataFrame([('{"games":[{"id":1},5,{"id":2}],"n":0}',), ('[{"id":3}]',), ('{"other":1}',)], "payload string")
    assert {r.id for r in feeds.parse_feed(df, "schedule").collect()} == {1, 2, 3}
    assert feeds.bad_payloads(df, "schedule").count() == 1
    teams = spark.createDataFrame([('{"id":9,"fullName":"X"}',), ('{"teams":[{"id":4}]}',)], "payload string")
    assert {r.id for r in feeds.parse_feed(teams, "teams").collect()} == {9, 4}
    roster = spark.createDataFrame([('{"forwards":[{"id":1}],"season":7,"goalies":[{"id":2}],"extra":[]}',)], "payload string")
    assert {r.id for r in feeds.parse_feed(roster, "roster").collect()} == {1, 2}


def test_landed_files(spark, tmp_path):
    folder = tmp_path / "20242025"
    folder.mkdir()
    (folder / "PL020001.HTM").write_text(EVENTS)
    row = reports.read_reports(spark, str(tmp_path / "*")).first()
    assert (row.kind, row.gameId) == ("PL", GAME)
    assert reports.event_table(reports.read_reports(spark, str(tmp_path / "*"))).count() == 6
    (tmp_path / "teams.json").write_text('{"data":[{"id":1,"fullName":"A"}]}')
    got = feeds.read_feed(spark, str(tmp_path / "teams.json"), "teams", source="nonsense").first()
    assert got.id == 1 and got.source == "default" and got.scrapedOn is not None
    os.makedirs(tmp_path / str(GAME))
    (tmp_path / str(GAME) / "ev6.json").write_text('[{"timeStamp": 5},{"timeStamp": 6}]')
    frames = feeds.read_goal_replay(spark, str(tmp_path / str(GAME) / "*.json")).collect()
    assert [(r.gameId, r.eventId, r.frame_index, r.timeStamp) for r in frames] == [(GAME, 6, 0, 5), (GAME, 6, 1, 6)]


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "gameId long, html string")
    assert reports.event_table(none).count() == 0 and "home_on_ice" in reports.event_table(none).columns


def test_small_pieces(spark):
    df = spark.createDataFrame([(["a&nbsp;", " b ", "c", "d", "e", "f", "g"],), (["x"],)], "cells array<string>")
    assert [r[0] for r in df.select(reports.clean_cells(F.col("cells"))).collect()] == [
        ["a", "b", "c", "d", "e", "f"], ["x", "", "", "", "", ""]]
    day = spark.range(1).select(feeds.default_standings_date().alias("d"), F.year(F.current_date()).alias("y")).first()
    assert (day.d.year, day.d.month, day.d.day) == (day.y - 1, 1, 1)


def _shift_report(n: int) -> str:
    rows = "".join(
        f'<tr class="oddColor"><td>{i}</td><td>1</td><td>0:0{i % 10} / 19:00</td><td>0:40 / 1:00</td><td>00:40</td><td></td></tr>'
        + (f'<tr class="oddColor"><td>TOT</td></tr><tr><td class="playerHeading">{i} P{i % 500}</td></tr>' if i % 40 == 39 else "")
        for i in range(n)
    )
    return f'<td class="teamHeading">T</td><td class="playerHeading">1 FIRST</td>{rows}'


def test_values_along_a_list(spark):
    """Blocks of any size give what a plain fold gives."""
    df = spark.createDataFrame([([3, 1, None, 4, 1, 5, 9, 2],), ([],), (None,)], "xs array<int>")

    def step(s, x):
        total = s["total"] + F.coalesce(x, F.lit(0))
        return {"total": total}, F.when(x.isNotNull(), total)

    for block in (1, 3, 8, 100):
        got = [r.out for r in df.select(running(F.col("xs"), {"total": F.lit(0)}, step, "int", block).alias("out")).collect()]
        assert got[:2] == [[3, 4, None, 8, 9, 14, 23, 25], []] and not got[2]


def test_reports_are_linear(spark):
    """A report of twice the rows takes about twice the time, and no row is lost."""
    took = {}
    for n in (200, 10_000, 40_000):
        docs = spark.createDataFrame([(1, "Home", _shift_report(n))], "gameId bigint, team_type string, html string")
        start = time.time()
        rows = reports.shift_rows(docs).agg(
            F.count("*").alias("n"), F.countDistinct("seq").alias("seqs"), F.max("shift_number").alias("last")).first()
        took[n] = time.time() - start
        headings = ["1 FIRST"] + [f"{i} P{i % 500}" for i in range(39, n, 40)]
        lost = n % 40 == 0  # the last heading has no rows
        assert rows.n == rows.seqs == 40 * len(set(headings[: len(headings) - lost])) and rows.last == n - 1
    assert took[40_000] < 8 * took[10_000]


def test_many_tables_in_one_row(spark):
    """On-ice tables are cut in one pass, however many lie in a row; nested ones belong to their outermost one."""
    n = 20_000
    cells = "".join(f"<td><table><tr><td>{i}C<table><tr><td>x</td></tr></table></td></tr></table></td>" for i in range(n))
    docs = spark.createDataFrame([(f'<tr class="evenColor"><td>1</td>{cells}</tr>',)], "html string")
    row = reports.extract_rows(docs).first()
    assert row.cells == ["1"] and row.ice == [f"{i}Cx" for i in range(n)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shift_reports_are_dealt_once_as_numbers(spark, sf_dir):
    docs = rendered.shift_reports(spark, sf_dir)
    plan = plan_of(docs)
    assert plan.count("Exchange ") == 1
    # below the exchange there are no texts of rows yet
    assert "oddColor" in plan.split("Exchange ")[0] and "oddColor" not in plan.split("Exchange ")[1]


def test_report_counts_read_reports_once(spark, sf_dir):
    keys = ("gameId", "team_type", "part")
    plan = plan_of(reports.parse_report_counts(rendered.shift_reports(spark, sf_dir), keys))
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_report_counts_of_odd_reports(spark):
    docs = spark.createDataFrame(
        [(1, "Home", HOME), (1, "Home", AWAY), (2, "Home", None), (2, "Away", " "), (None, "Home", HOME), (3, "Home", "<p>no rows</p>")],
        "gameId long, team_type string, html string")
    counts = {(r.gameId, r.team_type): (r.players_count, r.total_shifts, r.total_summary_records, r.parsing_successful)
              for r in reports.parse_report_counts(docs).collect()}
    assert counts == {(1, "Home"): (6, 8, 6, True), (2, "Home"): (0, 0, 0, False), (2, "Away"): (0, 0, 0, False),
                      (None, "Home"): (3, 0, 0, True), (3, "Home"): (0, 0, 0, True)}


def test_cells_of_other_rows_are_not_cleaned(spark):
    """Rows of another width leave as markup: only rows asked for become entries."""
    doc = shift_doc("T", [("5 A, B", [("1", "0:00", "&lt;1:00&nbsp;", "01:00")])])
    df = spark.createDataFrame([(1, "Home", doc)], "gameId long, team_type string, html string")
    assert [r.end_time_elapsed_game for r in reports.shift_rows(df).collect()] == ["<1:00  / 0:30"]
    assert [(r.period, r.total_ice_time, r.short_handed_total) for r in reports.shift_summary(df).collect()] == [("1", "01:00", "00:00")]
    widths = reports._player_groups(df, lambda lines: reports._of_width(lines, 7)).first().groups
    assert [[len(e.cells) for e in g.lines] for g in widths] == [[7]]
