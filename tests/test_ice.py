"""Ice time and metrics against a set replay, on hand cases, random games and a very uneven key."""

import random

import pytest
from pyspark.sql import functions as F

from icetally.operators import combos, metrics, pairs, sorting, timeline, toi
from tests import replay

SCHEMA = ("gameId int, seq long, Event string, elapsedTime int, eventTeam string, isHome int, "
          "player1Id long, player1Name string, isGoalie int, xG double")


def game(spark, *games):
    rows = []
    for gid, events in enumerate(games, 1):
        for i, (event, t, team, pid, goalie, *xg) in enumerate(events):
            home = None if team is None else int(team == "A")
            rows.append((gid, i, event, t, team, home, pid, None if pid is None else f"P{pid}", goalie,
                         xg[0] if xg else None))
    return spark.createDataFrame(rows, SCHEMA)


def local(df):
    games = {}
    for r in df.collect():
        games.setdefault(r["gameId"], []).append(r.asDict())
    return games


def random_game(seed, n=120, seconds=90):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        team = rng.choice("AB")
        t = rng.randrange(seconds)
        kind = rng.random()
        if kind < 0.6:
            pid = rng.randrange(5) * 2 + (team == "B")
            out.append((rng.choice(["ON", "ON", "OFF"]), t, team, pid, int(pid < 2)))
        else:
            event = rng.choice(["SHOT", "GOAL", "MISS", "BLOCK", "PENL", "GIVE", "TAKE", "FAC"])
            out.append((event, t, team, None, None, rng.randrange(50) / 250))
    return out


EDGES = [
    # back-to-back shift, repeated ON, OFF without ON, play at 0, play exactly at a change, null player
    ("SHOT", 0, "A", None, None, 0.1), ("ON", 0, "A", 2, 0), ("ON", 0, "B", 3, 0), ("ON", 0, "A", 0, 1),
    ("OFF", 10, "A", 2, 0), ("ON", 10, "A", 2, 0), ("ON", 15, "A", 2, 0), ("OFF", 16, "B", 9, 0),
    ("BLOCK", 20, "B", None, None), ("OFF", 20, "B", 3, 0), ("ON", 20, "B", 5, 0), ("PENL", 25, "A", None, None),
    ("ON", 26, "A", None, 0), ("ON", 27, None, 4, 0), ("GOAL", 30, "A", None, None, 0.5), ("STOP", 300, None, None, None),
]


@pytest.fixture(scope="module")
def pbp(spark):
    return game(spark, EDGES, *[random_game(s) for s in range(6)]).cache()


def test_team_toi(pbp):
    want = {(g, k, v) for g, rows in local(pbp).items() for k, v in replay.team_toi(rows).items()}
    assert {(r.gameId, r.strength, r.seconds) for r in toi.toi_by_strength(pbp).collect()} == want


def test_player_toi(pbp):
    want = {(g, p, s, v) for g, rows in local(pbp).items() for (p, s), v in replay.player_toi(rows).items()}
    got = toi.toi_by_player_and_strength(pbp).collect()
    assert {(r.gameId, r.player1Id, r.strength, r.seconds) for r in got} == want


def test_combo_toi(pbp):
    for n in (1, 2, 3):
        got = combos.combo_toi(pbp, n, in_seconds=True).collect()
        want = {(g, t, c, s): v for g, rows in local(pbp).items() for (t, c, s), v in replay.combo_toi(rows, n).items()}
        assert {(r.gameId, r.team, tuple(r[f"p{i}_player1Id"] for i in range(1, n + 1)), r.Strength): r.TOI for r in got} == want


def test_player_corsi(pbp):
    got = {(r.gameId, r.player1Id, r.strength): (r.CF, r.CA)
           for r in metrics.on_ice_stats_by_player_strength(pbp).collect() if r.CF + r.CA}
    want = {(g, *k): v for g, rows in local(pbp).items() for k, v in replay.player_corsi(rows).items()}
    assert got == want


def test_goalies_in_stats(pbp):
    got = {(r.gameId, r.player1Id, r.strength): r.seconds
           for r in metrics.on_ice_stats_by_player_strength(pbp, include_goalies=True).collect()}
    want = {(g, p, s): v for g, rows in local(pbp).items() for (p, s), v in replay.player_toi(rows, False).items()}
    assert got == want and any(p < 2 for _, p, _ in got)


def test_edges(spark):
    pbp = game(spark, EDGES)
    spans = {(r.player1Id, r.t_on, r.t_off) for r in timeline.player_intervals(pbp).collect()}
    # the back-to-back shift is one unbroken stay; open stays last to the last row of any kind
    assert spans == {(0, 0, 300), (2, 0, 300), (3, 0, 20), (5, 20, 300)}
    stats = {r.player1Id: r for r in metrics.on_ice_stats_by_player_strength(pbp).collect()}
    # the block at 20 is credited before the change of that second: player 3 is still on
    assert (stats[3].CA, stats[2].CF, stats[2].PA, stats[5].PF) == (1, 2, 1, 1)
    teams = {(r.team, r.strength): r for r in metrics.team_strength_aggregates(pbp).collect()}
    # the shot at second 0 meets an empty ice that never lasts, so it has no row
    assert sum(r.CF for (t, _), r in teams.items() if t == "A") == 2


def test_team_rejects(spark):
    ok = [("ON", 0, "A", 2, 0), ("ON", 0, "B", 3, 0), ("OFF", 9, "A", 2, 0)]
    one = [("ON", 0, "A", 2, 0), ("OFF", 9, "A", 2, 0)]
    three = [*ok, ("SHOT", 5, "C", None, None)]
    pbp = game(spark, ok, one, three)
    assert {(r.gameId, r.n_teams) for r in timeline.rejected_games(pbp).collect()} == {(2, 1), (3, 3)}
    assert {r.gameId for r in metrics.team_strength_aggregates(pbp).collect()} == {1}
    # only change rows count here, so the third game has two teams
    assert {r.gameId for r in toi.toi_by_strength(pbp).collect()} == {1, 3}
    with pytest.raises(ValueError):
        timeline.require_two_teams(pbp)


def test_long_shared_time(spark):
    pbp = game(spark, [("ON", 0, "A", 2, 0), ("ON", 0, "A", 4, 0), ("ON", 0, "B", 3, 0), ("STOP", 900, "A", None, None)])
    rows = pairs.shared_toi_teammates(pbp, in_seconds=True).collect()
    assert {(r.player1Id, r.tm_player1Id, r.TOI) for r in rows} == {(2, 4, 900), (4, 2, 900)}


def test_invariants(pbp):
    for r in toi.toi_by_strength(pbp).groupBy("gameId").agg(F.sum("seconds").alias("s")).join(
        pbp.where("Event in ('ON','OFF')").groupBy("gameId").agg(F.max("elapsedTime").alias("e")), "gameId"
    ).collect():
        assert r.s == r.e
    team = metrics.team_strength_aggregates(pbp)
    sums = team.agg(F.sum("CF").alias("a"), F.sum("CA").alias("b"), F.sum("PF").alias("c"), F.sum("PA").alias("d")).first()
    assert sums.a == sums.b and sums.c == sums.d
    alone = combos.combo_on_ice_stats_both_teams(pbp, 1, 0, min_toi=1)
    single = metrics.on_ice_stats_by_player_strength(pbp)
    key = lambda r: (r.gameId, r.player1Id, r.strength, int(r.seconds), r.CF, r.CA, r.PF, r.PA)
    assert {key(r) for r in alone.collect()} == {key(r) for r in single.collect()}
    pair = pairs.shared_toi_teammates(pbp, in_seconds=True)
    swapped = pair.select("gameId", "eventTeam", F.col("tm_player1Id").alias("player1Id"),
                          F.col("player1Id").alias("tm_player1Id"), "Strength", "TOI")
    assert pair.exceptAll(swapped).count() == 0


def test_combo_shots_precomputed(pbp):
    one = combos.combo_shot_metrics(pbp, 2, 1)
    two = combos.combo_shot_metrics(pbp, 2, 1, precomputed_toi=combos.combo_toi(pbp, 2, 1))
    assert one.count() > 0
    assert one.select(*sorted(one.columns)).exceptAll(two.select(*sorted(one.columns))).count() == 0
    shares = one.where("`CorsiFor%` < 0 or `CorsiFor%` > 1").count()
    assert shares == 0
    home = combos.combo_shot_metrics(pbp, 1, 0, side="home", include_toi=False)
    assert "TOI" not in home.columns and {r.team for r in home.collect()} == {"A"}


def test_goalies_in_combos(pbp):
    with_goalies = combos.combo_toi(pbp, 1, 0, include_goalies_team=True, in_seconds=True)
    assert with_goalies.where("p1_player1Id < 2").count() > 0
    assert combos.combo_toi(pbp, 1, 0).where("p1_player1Id < 2").count() == 0
    focus = combos.combo_on_ice_stats(pbp, "A", 1, 0, include_goalies=True, min_toi=1)
    assert {r.team for r in focus.collect()} == {"A"} and focus.where("team_combo = 'P0'").count() > 0


def test_hot_game(spark):
    """One game holding most rows, many of them equal, gives what it gives without the repeats."""
    calm = game(spark, *[random_game(s) for s in range(4)])
    hot = calm.where("gameId = 1").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(200)))).where(
        "Event in ('ON','OFF')").drop("copy")
    pbp = calm.unionByName(hot)
    for query in (toi.toi_by_strength, toi.toi_by_player_and_strength,
                  lambda p: combos.combo_on_ice_stats_both_teams(p, 2, 1, min_toi=1),
                  metrics.team_strength_aggregates):
        assert sorted(map(str, query(pbp).collect())) == sorted(map(str, query(calm).collect()))


def test_one_game_spreads_over_tasks(spark):
    """The slots of a single game lie in several partitions when combinations are made of them."""
    rows = [x for k in range(40) for x in (("ON", 120 * k, "A", 2 + 2 * (k % 4), 0), ("ON", 120 * k + 1, "B", 3 + 2 * (k % 4), 0),
                                           ("OFF", 120 * k + 90, "A", 2 + 2 * (k % 4), 0))]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lined = timeline.lineups(game(spark, rows))
        used = lined.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert used > 1


def test_result_order(pbp):
    rows = sorting.in_result_order(toi.toi_by_strength(pbp), "toi_by_strength").collect()
    assert rows == sorted(rows, key=lambda r: (r.gameId, -r.seconds)) or all(
        a.gameId < b.gameId or a.seconds >= b.seconds for a, b in zip(rows, rows[1:]))


def test_after_and_before(spark):
    """An attempt at the second of a change: combos' shot metrics see the new line, stats the old one."""
    pbp = game(spark, [
        ("ON", 0, "A", 2, 0), ("ON", 0, "B", 3, 0), ("OFF", 10, "A", 2, 0), ("ON", 10, "A", 4, 0),
        ("SHOT", 10, "A", None, None), ("SHOT", 30, "A", None, None), ("STOP", 30, None, None, None)])
    after = {r.p1_player1Id: r.ShotsFor for r in combos.combo_shot_metrics(pbp, 1, 0, side="home").collect()}
    # the shot at the end falls on the last second anybody is on
    assert after == {4: 2}
    before = {r.player1Id: r.SF for r in metrics.on_ice_stats_by_player_strength(pbp).where("eventTeam = 'A'").collect()}
    assert before == {2: 1, 4: 1}


def test_empty(spark, pbp):
    none = pbp.limit(0)
    assert metrics.team_strength_aggregates(none).count() == 0
    assert combos.combo_on_ice_stats_both_teams(none, 2, 1).count() == 0
