"""Row order, on-ice lists, shifts, scalar functions and shot features on hand cases."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from icetally.functions import arrays, clock, columns, geometry, rates
from icetally.operators import forest, joins, onice, ordered, shifts, xg
from icetally.sources import sinks


def test_clock(spark):
    df = spark.createDataFrame([("1:05", "OT", 5), ("x", "SO", 5), (None, "2", 1), ("1:2:3", "5", 5)], "c string, p string, n int")
    got = df.select(
        clock.mmss_to_seconds(F.col("c")), clock.period_number(F.col("p")),
        clock.elapsed_time(F.lit(10), F.col("n")), clock.elapsed_time(F.lit(10), F.col("n"), F.lit(3)),
        clock.elapsed_time(F.lit(10), F.col("n"), F.lit("2")),
    ).collect()
    assert [tuple(r) for r in got] == [
        (65, 4, None, 4810, None), (None, None, None, 4810, None), (None, 2, 10, 10, 10), (None, 5, None, 4810, None)
    ]


def test_glued_clocks(spark):
    texts = ["0:0020:00", "10:059:55", "12:3407:26", "1:2:3", "12:34", "x0:0020:00", "0:0a20:00", "", None, "0:0020:00 x"]
    got = spark.createDataFrame([(t,) for t in texts], "c string").select(clock.split_clock(F.col("c")).alias("s")).select("s.*")
    assert [tuple(r) for r in got.collect()] == [
        ("00:00", "20:00"), ("10:05", "09:55"), ("12:34", "07:26"), *[(None, None)] * 6, ("00:00", "20:00")]


def test_geometry_edges(spark):
    df = spark.createDataFrame([(-95.0, 0.0), (None, 3.0), (95.0, 0.0), (-50.0, 10.0)], "xCoord double, yCoord double")
    rows = geometry.rink_geometry(df).collect()
    assert rows[0].angle_signed == -180.0 and rows[0].x_norm == 95.0
    assert rows[1].distanceFromGoal is None and rows[1].y_norm == 3.0
    assert rows[2].angle_signed == 180.0
    assert (rows[3].x_norm, rows[3].y_norm) == (50.0, -10.0)


def test_combos(spark):
    df = spark.createDataFrame([([1, 2, 3, 4],), ([],), ([7],)], "ids array<bigint>")
    got = [r[0] for r in df.select(arrays.combos(F.col("ids"), 2)).collect()]
    assert got == [[[1, 2], [1, 3], [1, 4], [2, 3], [2, 4], [3, 4]], [], []]
    assert df.select(arrays.combos(F.col("ids"), 3)).first()[0] == [[1, 2, 3], [1, 2, 4], [1, 3, 4], [2, 3, 4]]


def test_columns(spark):
    df = spark.createDataFrame([(1, (2, ("x",)))], "a int, b struct<c:int, d:struct<e:string>>")
    assert columns.flatten(df).columns == ["a", "b_c", "b_d_e"]
    twice = df.select("a", F.col("a").alias("a"))
    assert columns.dedupe_columns(twice).columns == ["a", "a_1"]
    assert columns.strip_prefixes(columns.flatten(df, "."), ("b.",)).columns == ["a", "c", "d.e"]


def test_rates(spark):
    df = spark.createDataFrame([(3, 1, 0), (0, 0, 60)], "CorsiFor int, CorsiAgainst int, seconds int")
    got = rates.differentials_and_shares(df, ("Corsi",)).collect()
    assert [r["CorsiFor%"] for r in got] == [0.75, None]
    assert [r.CorsiFor_per60 for r in rates.per60_filled(df, ("CorsiFor",)).collect()] == [0.0, 0.0]


def rows_of(spark, n=300):
    data = []
    for g in (1, 2):
        for i in range(n if g == 1 else 20):
            t = None if i % 41 == 0 else (i * 7) % 25
            data.append((g, i, t, ["SHOT", "FAC", "ON", "GOAL"][i % 4], None if i % 3 else f"S{i % 2}", i if i % 5 == 0 else None))
    return spark.createDataFrame(data, "gameId int, seq long, elapsedTime int, Event string, Str string, homeScore int")


def test_order_matches_sorting(spark):
    df = rows_of(spark)
    local = sorted(
        (r.asDict() for r in df.collect()),
        key=lambda r: (r["gameId"], r["elapsedTime"] is None, r["elapsedTime"] or 0,
                       {"SHOT": 3, "GOAL": 5, "ON": 8, "FAC": 12}[r["Event"]], r["Str"] is None, r["Str"] or "", r["seq"]))
    want, n, score, game, prev = {}, 0, 0, None, None
    for r in local:
        if r["gameId"] != game:
            game, n, score, prev = r["gameId"], 0, 0, None
        n += 1
        score = r["homeScore"] if r["homeScore"] is not None else score
        want[r["gameId"], r["seq"]] = (n, score, prev if r["Event"] != "ON" else None)
        if r["Event"] != "ON":
            prev = r["seq"]
    got = ordered.in_order(
        df, ordered.canonical_keys(df), fill=("homeScore",), number="#", previous={"before": F.col("seq")},
        among=F.col("Event") != "ON",
    ).collect()
    assert {(r.gameId, r.seq): (r["#"], r.homeScore, r.before) for r in got} == want


def _tasks_with_rows(df, key: str) -> dict:
    rows = df.select(F.spark_partition_id().alias("p"), F.col(key).alias("k")).distinct().groupBy("k").count().collect()
    return {r.k: r["count"] for r in rows}


def test_order_without_seconds_spreads(spark):
    """A game of which nine tenths have no second: right numbers and fills, rows in many tasks, one scan of the input."""
    n = 20_000
    df = spark.range(n).select(
        F.lit(1).alias("gameId"), F.col("id").alias("seq"), F.when(F.col("id") % 10 == 0, (F.col("id") % 97).cast("int")).alias("elapsedTime"),
        F.lit("SHOT").alias("Event"), F.when(F.col("id") % 50 == 0, (F.col("id") % 7).cast("int")).alias("homeScore"))
    order = sorted(range(n), key=lambda i: (i % 10 != 0, i % 97 if i % 10 == 0 else 0, i))
    want, score, before = {}, 0, None
    for place, i in enumerate(order, 1):
        score = i % 7 if i % 50 == 0 else score
        want[i] = (place, score, before)
        before = i
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = ordered.in_order(df, ordered.canonical_keys(df), fill=("homeScore",), number="#", previous={"before": F.col("seq")})
        assert {r.seq: (r["#"], r.homeScore, r.before) for r in out.collect()} == want
        dealt = ordered._in_cells(df, ["gameId"], F.lit(0), ordered.canonical_keys(df), F.lit(True))
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert _tasks_with_rows(dealt, "gameId")[1] > 5
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_order_reads_its_input_once(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "dayofyear(ts) as gameId", "event_id as seq", "hour(ts) as elapsedTime", "event_type as Event", "cast(value as int) as homeScore")
    for df in (ordered.canonical_order(events), ordered.scoreboard_ffill(events),
               ordered.occurrence(events, ("gameId", "Event"), F.col("seq"))):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") >= 1


def test_occurrence_of_a_hot_key(spark):
    """A key with most rows is numbered in many tasks; null keys are keys; places may be negative and far apart."""
    n = 12_000
    df = spark.range(n).select(
        F.when(F.col("id") % 5 != 0, "hot").when(F.col("id") % 3 == 0, F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))).alias("key"),
        (F.col("id") * 7 - 30_000).alias("seq"))
    rows = [(r.key, r.seq) for r in df.collect()]
    want, counts = {}, {}
    for key, seq in sorted(rows, key=lambda r: r[1]):
        want[key, seq] = counts.get(key, 0)
        counts[key] = want[key, seq] + 1
    assert {(r.key, r.seq): r.merge_idx for r in ordered.occurrence(df, ("key",), F.col("seq")).collect()} == want
    back = {(r.key, r.seq): counts[r.key] - 1 - r.merge_idx
            for r in ordered.occurrence(df, ("key",), F.col("seq"), descending=True).collect()}
    assert back == want
    texts = spark.createDataFrame([("a", "x"), ("a", "b"), (None, "c"), (None, None)], "key string, at string")
    assert sorted(repr(tuple(r)) for r in ordered.occurrence(texts, ("key",), F.col("at")).collect()) == sorted(
        repr(r) for r in [("a", "b", 0), ("a", "x", 1), (None, None, 0), (None, "c", 1)])


def test_occurrence_join(spark):
    left = spark.createDataFrame([(1, "A", "1", "0:1", i) for i in range(3)], "gameId int, Event string, Per string, Time string, seq long")
    right = spark.createDataFrame([(1, "A", "1", "0:1", i + 10) for i in range(2)], left.schema)
    got = {(r.seq, r.seq_api) for r in ordered.occurrence_join(left, right).collect()}
    assert got == {(0, 10), (1, 11), (2, None)}


def test_shift_strengths(spark):
    data = [(1, 2, 1, "C", 0, 10), (1, 4, 1, "C", 5, 10), (1, 3, 0, "D", 0, 20), (1, 0, 1, "G", 0, 20),
            (1, 6, 1, "C", 12, 12), (1, 8, 1, "C", None, 4), (1, 2, 1, "C", 3, 6)]
    df = spark.createDataFrame(data, "gameId int, playerId long, isHome int, positionCode string, elapsed_time_start int, elapsed_time_end int")
    segs = shifts.strength_segments_multiset(df)
    got = [(r.t_start, r.t_end, r.home_skaters, r.away_skaters, r.pulled_home, r.pulled_away)
           for r in segs.orderBy("t_start").collect()]
    # player 2 overlaps themselves from 3 to 6 and counts twice
    assert got == [(0, 3, 1, 1, 0, 1), (3, 5, 2, 1, 0, 1), (5, 6, 3, 1, 0, 1), (6, 10, 2, 1, 0, 1), (10, 20, 0, 1, 0, 1)]
    events = shifts.shift_event_strength(shifts.shift_events(df), segs)
    at = {(r.player1Id, r.Event, r.elapsedTime): r.detailedGameStrength for r in events.collect()}
    assert at[6, "ON", 12] == "0v1*" and at[3, "OFF", 20] is None and at[8, "ON", None] is None
    assert len(at) == 14
    fused = shifts.shift_events_with_strength(df)
    assert fused.select(*sorted(events.columns)).exceptAll(events.select(*sorted(events.columns))).count() == 0
    assert fused.count() == events.count()
    seconds = shifts.strength_by_second(segs).count()
    assert seconds == 20


def test_whole_games_give_the_same(spark):
    """Plain windows over games against cells: null games, seconds, keys and values, several games."""
    i = F.col("id")
    df = spark.range(900).select(
        F.when(i % 11 != 0, (i % 4).cast("int")).alias("gameId"), i.alias("seq"), F.when(i % 7 != 0, (i * 31 % 50).cast("int")).alias("elapsedTime"),
        F.when(i % 13 != 0, F.element_at(F.array(*[F.lit(x) for x in ("SHOT", "GOAL", "ON", "FAC")]), (i * 17 % 4 + 1).cast("int"))).alias("Event"),
        F.when(i % 3 == 0, (i % 5).cast("int")).alias("homeScore"), F.lit("1").alias("Per"), F.when(i % 9 != 0, (i % 6).cast("string")).alias("Time"))

    def same(a, b):
        assert a.schema.simpleString() == b.schema.simpleString()
        assert sorted(repr(r) for r in a.collect()) == sorted(repr(r) for r in b.collect())

    for among in (None, F.col("Event") != "ON"):
        same(*[ordered.in_order(
            df, ordered.canonical_keys(df), fill=("homeScore",), number="#", previous={"before": F.col("seq"), "score": F.col("homeScore")},
            among=among, whole=whole) for whole in (False, True)])
    right = df.where("seq % 5 <> 1").withColumn("more", F.col("seq") * 2)
    for down in (False, True):
        same(*[ordered.occurrence_join(df, right, right_descending=down, whole=whole) for whole in (False, True)])
    stays = df.select(
        "gameId", (F.col("seq") % 24).alias("playerId"), (F.col("seq") % 2).alias("isHome"),
        F.when(F.col("seq") % 12 == 0, "G").otherwise("C").alias("positionCode"), F.col("elapsedTime").alias("elapsed_time_start"),
        F.when(F.col("seq") % 8 != 0, F.col("seq") * 13 % 60).cast("int").alias("elapsed_time_end"))
    same(*[shifts.shift_events_with_strength(stays, whole) for whole in (False, True)])


def test_salted_join(spark):
    rows = spark.range(500).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id")).alias("gameId"), F.col("id").alias("seq"))
    dim = spark.createDataFrame([(1, "x"), (450, "y")], "gameId long, v string")
    got = joins.join_dimension(rows, dim, ["gameId"])
    assert got.count() == 500 and got.where("v = 'x'").count() == 400 and got.where("v = 'y'").count() == 1


def test_jersey_maps(spark):
    spots = spark.createDataFrame([(1, 9, 100, "A"), (1, 9, 101, "B"), (1, 4, 7, "C")], "gameId int, sweaterNumber int, playerId long, fullName string")
    row = joins.jersey_maps(spots, ["gameId"]).first()
    assert row.ids == {9: 101, 4: 7} and row.names[9] == "B"


def test_on_ice(spark):
    df = spark.createDataFrame(
        [(1, 1, [5, 6, 7], ["a", "b"], [7], ["g"]), (1, 2, [5, 6, 7], ["a", "b", "c"], None, None), (1, 3, None, None, None, None)],
        "gameId int, seq long, home_on_id array<bigint>, home_on_full_name array<string>, homeGoalie_on_id array<bigint>, homeGoalie_on_full_name array<string>")
    long = onice.on_ice_long(df).where("seq = 1").orderBy("slot_index").collect()
    assert [(r.slot_index, r.player_id, r.player_name) for r in long] == [(1, 5, "a"), (2, 6, "b"), (3, 7, None)]
    wide = {r.seq: r for r in onice.on_ice_wide(df, max_skaters=2).collect()}
    assert (wide[1].home_skater_id_1, wide[1].home_skater_id_2, wide[1].home_goalie_id, wide[1].home_goalie_name) == (5, 6, 7, "g")
    # no goalie list: the one id beyond the skater columns is the goalie
    assert (wide[2].home_goalie_id, wide[2].home_goalie_name) == (7, "c")
    assert wide[3].home_skater_id_1 is None and wide[3].away_goalie_id is None
    assert "home_on_id" not in onice.on_ice_wide(df, drop_list_cols=True).columns


def test_text_lists(spark):
    df = spark.createDataFrame([("[1, 2]",), ("('a', 'b')",), ("x, y,",), ("solo",), (None,)], "t string")
    got = [r[0] for r in df.select(arrays.as_array(F.col("t"), False)).collect()]
    assert got == [["1", "2"], ["a", "b"], ["x", "y"], [], []]


def features(spark):
    data = [
        (1, 1, 10, "SHOT", "A", 60.0, 5.0, 0, 0), (1, 2, 12, "SHOT", "A", 60.0, 5.0, 0, 0),
        (1, 3, 13, "ON", "A", None, None, None, None), (1, 4, 14, "GOAL", "A", -70.0, 3.0, 1, 0),
        (1, 5, 20, "SHOT", "B", None, None, 1, 0), (1, 6, 30, "FAC", None, 0.0, 0.0, 1, 0),
    ]
    return spark.createDataFrame(data, "gameId int, seq long, elapsedTime int, Event string, eventTeam string, xCoord double, "
                                 "yCoord double, homeScore int, awayScore int").withColumns(
        {"homeTeam": F.lit("A"), "awayTeam": F.lit("B"), "home_on_count": F.lit(5), "away_on_count": F.lit(4),
         "pulled_home": F.lit(0), "pulled_away": F.lit(1)})


def test_features(spark):
    rows = {r.seq: r for r in xg.engineer_xg_features(features(spark)).collect()}
    assert rows[2].isRebound is True and rows[1].isRebound is False and rows[3].isRebound is None
    # a goal off a shot is no rebound unless asked for
    assert rows[4].isRebound is False and rows[4].previousEvent == "SHOT" and rows[4].timeDiff == 2
    assert rows[4].scoreDiff == 0.0 and rows[5].scoreDiff == -1.0 and rows[6].scoreDiff is None
    assert (rows[4].strengthDiff, rows[5].strengthDiff, rows[6].strengthDiff) == (1.0, -1.0, None)
    assert rows[4].shootEmptyNet is True and rows[5].shootEmptyNet is False and rows[6].isHome is False
    assert rows[3].previousEvent is None and rows[5].previousEventSameTeam is False
    asked = xg.engineer_xg_features(features(spark), shot_like_events=("SHOT", "GOAL"))
    assert {r.seq: r for r in asked.collect()}[4].isRebound is True


def test_previous_play_in_final_order(spark):
    """Three plays of one second: the final order has the stoppage first, the source the penalty."""
    rows = [(1, 1, 180, "PENL", 2), (1, 2, 180, "STOP", 1), (1, 3, 180, "FAC", 3)]
    df = spark.createDataFrame(rows, "gameId int, seq int, elapsedTime int, Event string, `#` int")
    got = {r.Event: r.previousEvent for r in xg.engineer_xg_features(df, order="#").collect()}
    assert got == {"STOP": None, "PENL": "STOP", "FAC": "PENL"}
    got = {r.Event: r.previousEvent for r in xg.engineer_xg_features(df).collect()}
    assert got == {"PENL": None, "STOP": "PENL", "FAC": "STOP"}


def test_align(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    got = xg.align_columns(df, ["b", "z", "b"])
    assert got.columns == ["b", "z"] and tuple(got.first()) == (2.0, 0.0)


def test_model(spark):
    base = spark.range(400).select(
        (F.col("id") % 10).cast("int").alias("gameId"), F.col("id").alias("seq"), (F.col("id") % 300).cast("int").alias("elapsedTime"),
        F.when(F.col("id") % 5 == 0, "GOAL").when(F.col("id") % 7 == 0, "FAC").otherwise("SHOT").alias("Event"),
        F.lit("A").alias("eventTeam"), F.lit("A").alias("homeTeam"), F.lit("B").alias("awayTeam"),
        F.when(F.col("id") % 5 == 0, 85.0).otherwise(30.0).alias("xCoord"), F.lit(1.0).alias("yCoord"),
        F.lit("wrist").alias("shotType"),
    )
    feats = xg.engineer_xg_features(base)
    model = xg.fit_xg(feats, max_iter=3, max_depth=2)
    scored = xg.predict_xg(feats, model)
    assert scored.columns == [*feats.columns, "xG"]
    rows = scored.collect()
    assert all((r.xG is None) == (r.Event == "FAC") for r in rows)
    assert all(0 <= r.xG <= 1 for r in rows if r.xG is not None)
    assert min(r.xG for r in rows if r.Event == "GOAL") > max(r.xG for r in rows if r.Event == "SHOT")


def test_compiled_trees_equal_the_fitted_model(spark, tmp_path):
    """Random shots with missing numbers, unseen texts and flags: the expression gives the model's own probabilities."""
    rng = F.rand(5)
    n = 3000
    shots = spark.range(n).select(
        F.col("id").alias("event_id"), F.lit("SHOT").alias("Event"), F.lit(1).alias("gameId"),
        *[F.when(F.rand(i) > 0.1, F.round(F.rand(i + 50) * 100 - 40, 1)).alias(c) for i, c in enumerate(xg.NUMERIC)],
        *[(F.rand(i + 100) > 0.5).alias(c) for i, c in enumerate(xg.FLAGS)],
        F.element_at(F.array(*[F.lit(x) for x in ("wrist ", "slap", "tip-in", None)]), (F.col("id") % 4 + 1).cast("int")).alias("shotType"),
        F.element_at(F.array(F.lit("EV"), F.lit("it's")), (F.col("id") % 2 + 1).cast("int")).alias("strength"),
        F.element_at(F.array(F.lit("SHOT"), F.lit("FAC"), F.lit("HIT")), (F.col("id") % 3 + 1).cast("int")).alias("previousEvent"),
        (rng < F.when(F.col("id") % 4 == 1, 0.7).otherwise(0.2)).alias("isGoal"),
    ).cache()
    model = xg.fit_xg(shots.where("event_id % 4 != 2"), max_iter=6, max_depth=4)
    stored = forest.compile_forest(model)
    kinds = {k for t in stored["trees"] for k in _tests(t["root"])}
    assert kinds == {"at_most", "among"}
    forest.write_forest(spark, stored, str(tmp_path / "model"))
    assert forest.read_forest(spark, str(tmp_path / "model")) == stored
    own = {r.event_id: r.p for r in model.transform(xg.shots_design_matrix(shots)).select(
        "event_id", vector_to_array("probability")[1].alias("p")).collect()}
    got = {r.event_id: r.xG for r in xg.predict_xg(shots, stored).collect()}
    assert len(got) == n and max(abs(own[i] - got[i]) for i in own) < 1e-12
    assert len({round(p, 9) for p in got.values()}) > 50
    plan = xg.predict_xg(shots, stored)._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "Python" not in plan
    with pytest.raises(ValueError, match="do not have"):
        xg.predict_xg(shots, {"trees": [{"root": {"input": "weather", "at_most": 1.0, "yes": {"value": 1}, "no": {"value": 0}}}]})


def _tests(node):
    if "input" in node:
        yield "at_most" if "at_most" in node else "among"
        yield from _tests(node["yes"])
        yield from _tests(node["no"])


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_write(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, [1, 2])], "a int, b array<int>")
    path = str(tmp_path / "out")
    sinks.write_table(df, path, fmt)
    back = spark.read.option("header", True).format(fmt).load(path)
    assert back.count() == 1 and set(back.columns) == {"a", "b"}
    if fmt == "csv":
        assert back.first()["b"] == "[1,2]"
    with pytest.raises(ValueError):
        sinks.write_table(df, path, "xml")


def test_state_at_needs_no_row_per_second(spark):
    """Marks and asked seconds meet in the window of a game; they are not first grouped by second."""
    rows = spark.createDataFrame(
        [(1, 1, "C", 0, 10), (1, 0, "C", 0, 20), (1, 1, "C", 10, 20), (1, 1, "C", 5, 5), (2, 1, "G", 3, 9)],
        "gameId long, isHome int, positionCode string, elapsed_time_start int, elapsed_time_end int")
    segments = shifts.strength_segments_multiset(rows)
    asked = spark.createDataFrame([(1, 0), (1, 10), (1, 10), (1, 15), (1, 20), (1, 99), (2, 1), (2, 3), (3, 1)], "gameId long, elapsedTime int")
    at = shifts.state_at(asked, segments)
    assert {(r.gameId, r.elapsedTime): r.home_strength for r in at.collect()} == {
        (1, 0): "1*", (1, 10): "1*", (1, 15): "1*", (1, 20): None, (1, 99): None, (2, 1): None, (2, 3): "0", (3, 1): None}
    assert at.count() == 8
    # the sums of the segments, their running sums, the distinct seconds, the window over a game
    assert shifts.state_at(asked, segments)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 4
