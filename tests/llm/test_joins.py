"""N-gram Jaccard join, line dedup and their grouping, against brute force."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from icetally.llm import common, line_dedup, links, ngram_join

from .helpers import LOWER, WORD, Groups, changed, edits, empty, frame, kept_clashes, odd_rows


def shingle_set(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute_components(rows, n, percent):
    sets = [(i, shingle_set(t, n)) for i, t in rows]
    groups = Groups()
    for (i, a), (j, b) in combinations(sets, 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            groups.join(i, j)
    return {i: (len(s), groups.find(i)) for i, s in sets}


def near_texts(seed, families=40):
    rng, rows = random.Random(seed), []
    for g in range(families):
        base = [f"g{g}w{k}" for k in range(rng.choice([1, 3, 9, 10, 18, 19, 20, 21, 40, 70]))]
        for _ in range(rng.randint(1, 9)):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                i = rng.randint(0, len(words))
                if rng.random() < 0.3:
                    words.insert(i, f"g{g}x{rng.randint(0, 3)}")
                elif i < len(words):
                    words[i] = f"g{g}y{rng.randint(0, 3)}"
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("n, percent", [(1, 90), (3, 80), (2, 70)])
def test_components_match_brute_force(spark, n, percent):
    rows = near_texts(n * percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.components_of(frame(spark, rows), n, percent).collect()}
    assert got == brute_components(rows, n, percent)


def test_hot_group_is_not_expanded(spark):
    """A large group of copies with own edits: as many candidate rows as members and keys, not their square."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(120)] = f"e{rng.randint(0, 200)}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.components_of(frame(spark, rows), 3, 90).collect()}
    assert got == brute_components(rows, 3, 90)


def test_odd_rows_of_the_join(spark):
    found = ngram_join.components_of(frame(spark, odd_rows(), clashes=True)).collect()
    assert len(found) == len(odd_rows())
    by = {r.doc_id: r for r in found}
    assert [by[i].n_shingles for i in (2, 3, 4)] == [0, 0, 0] and [by[i].component_id for i in (2, 3, 4)] == [2, 3, 4]
    assert by[6].component_id == 1 and by[10].component_id == 9 and by[None].component_id is None
    kept = ngram_join.representatives(frame(spark, odd_rows(), clashes=True), 5, 80).collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 1, 2, 3, 4, 5, 7, 8, 9] and kept_clashes(kept)
    assert ngram_join.components_of(empty(spark)).collect() == []
    assert ngram_join.representatives(empty(spark, True)).collect() == []


def test_boundary_follows_cost():
    sizes = ngram_join.Sizes(90)
    assert sizes.common(19, 19) == 18 and sizes.common(9, 10) == 9
    assert 10 < sizes.boundary({n: 100 for n in range(1, 60)}) <= 21
    # every linked pair of sizes meets in a level of segments
    for n in range(1, 400):
        for m in range(n, 100 * n // 90 + 1):
            if sizes.common(n, m) <= n:
                level = sizes.level(n)
                assert sizes.level(m) in (level, level + 1)
                assert n + m - 2 * sizes.common(n, m) <= sizes.differing(level) < sizes.segments(level)


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100, 180)] + [(7, 3), (3, 9)], "a bigint, b bigint")
    got = {r.id: r.label for r in links.components(edges).collect()}
    assert set(got[i] for i in range(100, 181)) == {100} and (got[7], got[3], got[9]) == (3, 3, 3)


def test_banded_edit_distance(spark):
    rng = random.Random(1)
    pairs = []
    for _ in range(800):
        a = [rng.choice("abcdé😀") for _ in range(rng.randint(0, 22))]
        pairs.append(("".join(a), "".join(changed(rng, a, rng.randint(0, 4), "abcd"))))
    df = spark.createDataFrame(pairs, "a string, b string")
    for t in (1, 2, 3):
        rows = df.select("a", "b", line_dedup.within(F.col("a"), F.col("b"), t).alias("near")).collect()
        assert [r for r in rows if r.near != (edits(r.a, r.b) <= t)] == []


def brute_dedup(rows, threshold, least):
    every = Counter(x for _, t in rows for x in (t or "").split("\n") if WORD.search(x))
    lines = sorted(x for x in every if len(x) >= least)
    groups = Groups()
    for a, b in combinations(lines, 2):
        if abs(len(a) - len(b)) <= threshold and edits(a, b) <= threshold:
            groups.join(a, b)
    seen, out = set(), {}
    for i, t in sorted(rows):
        kept = []
        for x in (t or "").split("\n"):
            c = groups.find(x) if len(x) >= least else x if every[x] >= line_dedup.SHORT_TIMES else None
            if c is None or c not in seen:
                kept.append(x)
            if c is not None:
                seen.add(c)
        out[i] = "\n".join(kept)
    return out


def test_lines_match_brute_force(spark):
    rng = random.Random(11)
    bases = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(20, 60))) for _ in range(12)]
    rows = []
    for i in range(60):
        lines = ["".join(changed(rng, list(rng.choice(bases)), rng.choice([0, 0, 1, 2, 3, 5]), "abcxyz")) for _ in range(rng.randint(1, 6))]
        rows.append((i, "\n".join([*lines, rng.choice(["short", "shorts", f"own {i}", "", "  "]), "Share this"])))
    for i in range(9):
        rows.append((100 + i, "nine times\nten times\n\nten times" if i == 4 else "nine times\nten times"))
    got = {r.doc_id: r.text for r in line_dedup.deduped(frame(spark, rows), drop_emptied=False).collect()}
    assert got == brute_dedup(rows, line_dedup.THRESHOLD, line_dedup.MIN_CHARS)


def test_without_broadcasts(spark, monkeypatch):
    """Tables too large to broadcast are shuffled, with the same results."""
    monkeypatch.setattr(line_dedup, "COMMON_TIMES", 2)  # equal lines are merged before they are dealt by key
    for module in (line_dedup, ngram_join):
        monkeypatch.setattr(module, "sized", lambda df, more=None: df)
    rows = near_texts(4, 12)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.components_of(frame(spark, rows), 3, 80).collect()}
    assert got == brute_components(rows, 3, 80)
    lines = [(i, "\n".join([f"a shared line number {i % 7} of the text", f"own line of document {i} {'x' * i}"])) for i in range(25)]
    got = {r.doc_id: r.text for r in line_dedup.deduped(frame(spark, lines), drop_emptied=False).collect()}
    assert got == brute_dedup(lines, line_dedup.THRESHOLD, line_dedup.MIN_CHARS)


def test_long_lists_of_keys_are_not_broadcast(spark, monkeypatch):
    """Above BROADCAST_KEYS only a sieve of the keys passes through the driver, with the same results."""
    sent, broadcast, most = [], F.broadcast, 5
    monkeypatch.setattr(F, "broadcast", lambda df: sent.append(df) or broadcast(df))
    for module in (common, line_dedup):
        monkeypatch.setattr(module, "BROADCAST_KEYS", most, raising=False)
    monkeypatch.setattr(line_dedup, "COMMON_TIMES", 2)
    lines = [(i, "\n".join([f"a shared line number {i % 9} of the text", f"own line of document {i} {'x' * i}"])) for i in range(40)]
    lines += [(50 + i, f"each of these many lines stands twice {i % 8:b}") for i in range(16)] + [(70, None), (71, "")]
    got = {r.doc_id: r.text for r in line_dedup.deduped(frame(spark, lines), drop_emptied=False).collect()}
    assert got == brute_dedup(lines, line_dedup.THRESHOLD, line_dedup.MIN_CHARS) | {70: None}
    texts = near_texts(7, 12)
    texts += [(1000 + i, texts[i][1]) for i in range(0, len(texts), 3)]
    rows = [*texts, *texts[:9]]
    components = brute_components(texts, 3, 80)
    found = ngram_join.components_of(frame(spark, rows), 3, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == components and len(found) == len(rows)
    kept = ngram_join.representatives(frame(spark, rows), 3, 80).collect()
    assert sorted(r.doc_id for r in kept) == sorted(i for i, (n, c) in components.items() if n == 0 or i == c)
    assert [df.columns for df in sent if "bits" not in df.columns and df.count() > most] == []
    assert any("bits" in df.columns for df in sent)


def test_keys_pick_and_drop(spark, monkeypatch):
    """The rows with a key and the others, for few and for many keys, with nulls, repeated keys and clashing names."""
    rng = random.Random(8)
    rows = [(rng.choice([None, *range(-300, 300)]), f"v{i}") for i in range(2000)]
    df = spark.createDataFrame(rows, "bits bigint, bucket string").withColumn("mark", F.lit("own"))
    for values in ([], [None], [5, 5, None, -7], [None, *range(-400, 400, 3), 3, 3, 1 << 62, -(1 << 63)]):
        keys = spark.createDataFrame([(v,) for v in values], "k bigint")
        want = sorted(v for k, v in rows if k is not None and k in values)
        for most in (0, 1000):
            monkeypatch.setattr(common, "BROADCAST_KEYS", most)
            held = common.Keys(keys)
            assert held.few == (len(values) <= most)
            assert sorted(r.bucket for r in held.picked(df, "bits").collect()) == want
            rest = held.dropped(df, "bits").collect()
            assert sorted(r.bucket for r in rest) == sorted({v for _, v in rows} - set(want)) and {r.mark for r in rest} <= {"own"}
    # few other rows pass the sieve
    monkeypatch.setattr(common, "BROADCAST_KEYS", 0)
    held = common.Keys(spark.range(0, 40_000, 2))
    passed = held._marked(spark.range(40_000), "id", "mark").where("mark").agg(F.count("*"), F.sum((F.col("id") % 2 == 0).cast("int"))).first()
    assert passed[1] == 20_000 and passed[0] < 22_000


def test_odd_rows_of_line_dedup(spark):
    kept = line_dedup.deduped(frame(spark, odd_rows(), clashes=True)).collect()
    assert kept_clashes(kept) and sorted(r.doc_id or 0 for r in kept) == [0, 1, 2, 3, 4, 5, 7, 8, 9, 10]
    by = {r.doc_id: r for r in kept}
    assert by[2].text is None and by[4].text == "  \t\n " and by[1].n_removed == 0 if "n_removed" in kept[0] else True
    twice = frame(spark, [(1, "a line of some length here\nand another long line here"), (2, "a line of some length hers\nnew one, also long enough")])
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.deduped(twice).collect()}
    assert got[2] == ("new one, also long enough", 2, 1) and got[1][2] == 0
    assert line_dedup.deduped(empty(spark, True)).collect() == []
