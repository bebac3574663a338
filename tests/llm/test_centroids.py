"""Centroid clustering against a plain re-implementation."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from icetally.llm import centroids, queries


def plain(rows, k=40, rounds=5, dimensions=64):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    points = [list(v) for _, v in order[:k]]

    def assign():
        out = []
        for _, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in points]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        found = assign()
        for n in {c for c, _ in found}:
            own = [v for (_, v), (c, _) in zip(kept, found) if c == n]
            points[n] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    inertia = {n: sum(d for c, d in found if c == n) for n, _ in found}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in points]
    return sorted(repr((i, c, d, inertia[c], sum(inertia.values()), names[c])) for (i, _), (c, d) in zip(kept, found))


def vectors(seed, n, spread, dimensions=64, whole=False):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, spread) for _ in range(dimensions)] for _ in range(7)]
    rows = []
    for i in range(n):
        v = [m + rng.gauss(0, spread / 4) for m in rng.choice(middle)]
        rows.append((i, [float(round(x)) if whole else float(np.float32(x)) for x in v]))
    return rows


def odd(rows):
    base = rows[0][1]
    return rows + [
        (None, base), (3, None), (5, base[:-1]), (6, [*base, 0.0]), (7, [None, *base[1:]]), (8, [float("nan"), *base[1:]]),
        (9, [float("-inf"), *base[1:]]), (10, []), (11, base), (11, base), (12, [0.0] * 64), (13, [0.0] * 64),
    ]


def got(spark, rows, entries=centroids.ENTRIES, kind="float", report=None):
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>").selectExpr(
        "*", "'x' as cluster", "'y' as distance", "1 as codes")
    return sorted(repr(tuple(r)) for r in centroids.clusters(df, entries=entries, report=report).collect())


@pytest.mark.parametrize("entries", [centroids.ENTRIES, 3000, 10])
def test_rounds(spark, entries):
    """Shared dictionaries for all, some and no dimensions give the same rows."""
    rows, seen = odd(vectors(1, 150, 0.1)), []
    assert got(spark, rows, entries, report=seen.append) == plain(rows)
    (coding,) = seen
    assert sum(map(len, coding.numbers)) <= entries
    assert bool(coding.wide) == (entries < 10_000) and bool(coding.blocks) == (entries > 10)


def test_wide_blocks_and_ties(spark):
    """Few distinct components: blocks of several dimensions, many equal distances and empty centroids."""
    rng, seen = random.Random(5), []
    rows = [(i, [rng.choice((0.0, 1 / 256)) if d < 8 else 0.0 for d in range(64)]) for i in range(120)]
    assert got(spark, rows, kind="double", report=seen.append) == plain(rows)
    assert max(map(len, seen[0].blocks)) == 8
    same = [(i, [0.5] * 64) for i in range(60)]
    assert got(spark, same) == plain(same)


def test_large_components_and_few_rows(spark):
    rows = vectors(2, 12, 3000.0, whole=True)
    assert got(spark, rows, kind="double") == plain(rows)
    assert got(spark, []) == [] and got(spark, [(1, None)]) == []
    with pytest.raises(Exception, match="too large"):
        got(spark, [(1, [1e30] * 64), (2, [0.0] * 64)], kind="double")


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = queries.QUERIES["op13_centroid_clusters"](spark, sf_dir)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(repr(tuple(r)) for r in found.collect()) == plain(rows)
