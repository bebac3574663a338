"""Centroid clustering by subvector dictionaries (operator 13).

Vectors of integers are cut into blocks of neighbouring dimensions, and each block is dictionary-encoded without loss:
a vector becomes one code per block, a code stands for one distinct subvector. In each round the exact squared distance
of every distinct subvector to its part of every centroid is computed once; the distance of a vector is the sum of what
its codes look up. New centroids are exact integer means, summed in the tasks before anything is shuffled.

Which dictionaries are shared is decided by the least and largest component of each dimension: the number of subvectors
that a block can have is at most the product of its ranges, so the shared dictionaries have at most ENTRIES entries
whatever the number of vectors, and so have the tables that are broadcast in each round. Blocks are made as wide as
that allows. Dimensions whose own range is too wide for it stay as they are and are dictionary-encoded anew within
each batch: the same distances, without a table that grows with the data.

Defined results: vectors of another length, null vectors and those with a null, NaN or infinite component are left out;
repeated rows and repeated ids are vectors of their own; a null id hashes after all others; equal hashes are ordered by
the components; equal distances go to the smaller number; with fewer kept vectors than centroids each kept vector starts
one; an empty table gives an empty result. Other columns do not stay. Components so large that a squared distance may
not fit a long raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, written

DIMENSIONS, CENTROIDS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2
#: Entries of all shared dictionaries together.
ENTRIES = 1 << 16
WIDTHS = (8, 4, 2, 1)
#: Vectors whose distances are held at a time.
BATCH = 4096


def integers(vectors: DataFrame, vec_id: str, embedding: str, dimensions: int, scale: int) -> DataFrame:
    """vec_id, v: the kept vectors as whole numbers, floor(scale * x) of each component."""
    x = F.col(embedding)
    whole = (F.size(x) == dimensions) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))
    limit = float(int((2**62 / dimensions) ** 0.5) // 2)
    fits = F.forall(x, lambda c: F.abs(c.cast("double") * F.lit(float(scale))) < limit)
    safe = F.when(fits, scaled).otherwise(F.raise_error(F.lit("a component is too large for exact distances")))
    return vectors.where(F.coalesce(whole, F.lit(False))).select(F.col(vec_id).alias("vec_id"), safe.alias("v"))


def first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k kept vectors whose ids hash lowest, in that order; a top-k that Spark merges."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    top = kept.orderBy(digest.asc_nulls_last(), "v").limit(k).collect()
    return np.array([r.v for r in top], np.int64)


def ranges(kept: DataFrame, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest component of each dimension."""
    found = kept.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    rows = {r.d: (r.lo, r.hi) for r in found.collect()}
    bounds = np.array([rows[d] for d in range(dimensions)], np.int64)
    return bounds[:, 0], bounds[:, 1]


def blocks_of(lo: np.ndarray, hi: np.ndarray, entries: int = ENTRIES) -> tuple[list[tuple[int, ...]], list[int]]:
    """Blocks with a shared dictionary, and the dimensions that are too wide for one.

    Dimensions are taken from the narrowest on as long as their ranges add up to `entries`; the blocks are the widest for
    which the products of the ranges still do.
    """
    span = [int(h) - int(l) + 1 for l, h in zip(lo, hi)]
    narrow, total = [], 0
    for d in sorted(range(len(span)), key=lambda d: (span[d], d)):
        if total + span[d] > entries:
            break
        total += span[d]
        narrow.append(d)
    narrow.sort()
    for width in WIDTHS:
        blocks = [tuple(narrow[i : i + width]) for i in range(0, len(narrow), width)]
        if sum(_product(span[d] for d in b) for b in blocks) <= entries:
            break
    return blocks, sorted(set(range(len(span))) - set(narrow))


def _product(numbers) -> int:
    out = 1
    for n in numbers:
        out *= n
    return out


@dataclass
class Coding:
    """Where the dictionaries of the blocks lie: a subvector's mixed-radix number finds its code."""

    blocks: list[tuple[int, ...]]
    wide: list[int]
    lo: np.ndarray
    span: np.ndarray
    #: of each block the numbers of its distinct subvectors, ascending; the place of a number is its code
    numbers: list[np.ndarray] | None = None

    def number(self, block: tuple[int, ...], v: np.ndarray) -> np.ndarray:
        out = np.zeros(len(v), np.int64)
        for d in block:
            out = out * self.span[d] + (v[:, d] - self.lo[d])
        return out

    def subvectors(self, b: int) -> np.ndarray:
        """The distinct subvectors of block b, by code."""
        block, left = self.blocks[b], self.numbers[b].copy()
        out = np.empty((len(left), len(block)), np.int64)
        for i in range(len(block) - 1, -1, -1):
            left, out[:, i] = np.divmod(left, self.span[block[i]])
            out[:, i] += self.lo[block[i]]
        return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def dictionaries(kept: DataFrame, coding: Coding) -> Coding:
    """coding with the distinct subvectors of each block; at most as many as its ranges allow are collected."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = [np.empty(0, np.int64)] * len(coding.blocks)
        for batch in batches:
            v = _matrix(batch.column(0), len(coding.lo))
            met = [np.union1d(m, coding.number(b, v)) for m, b in zip(met, coding.blocks)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(met)), [len(m) for m in met]), pa.int32()),
             pa.array(np.concatenate([*met, np.empty(0, np.int64)]), pa.int64())], ["b", "number"])

    rows = kept.select("v").mapInArrow(distinct, "b int, number bigint").distinct().toPandas()
    numbers = [np.sort(rows.number[rows.b == b].to_numpy(np.int64)) for b in range(len(coding.blocks))]
    return Coding(coding.blocks, coding.wide, coding.lo, coding.span, numbers)


def encoded(kept: DataFrame, coding: Coding) -> DataFrame:
    """vec_id, codes (one per block), rest (components of wide dimensions); written to the shared folder."""
    shared = kept.sparkSession.sparkContext.broadcast(coding)
    kind = kept.schema["vec_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        for batch in batches:
            v = _matrix(batch.column("v"), len(at.lo))
            codes = [np.searchsorted(n, at.number(b, v)) for n, b in zip(at.numbers, at.blocks)]
            codes = np.stack(codes, 1) if codes else np.empty((len(v), 0), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), _lists(codes, pa.int32()), _lists(v[:, at.wide], pa.int64())],
                ["vec_id", "codes", "rest"])

    return written(kept.mapInArrow(encode, f"vec_id {kind}, codes array<int>, rest array<bigint>"))


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(values.ravel(), kind))


def distance_tables(coding: Coding, centroids: np.ndarray) -> list[np.ndarray]:
    """Of each block: the squared distance of each distinct subvector (row) to its part of each centroid (column)."""
    return [_distances(coding.subvectors(b), centroids[:, block]) for b, block in enumerate(coding.blocks)]


def _distances(sub: np.ndarray, parts: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sub), len(parts)), np.int64)
    for i in range(sub.shape[1]):
        out += (sub[:, i, None] - parts[None, :, i]) ** 2
    return out


def nearest(codes: np.ndarray, rest: np.ndarray, tables: list[np.ndarray], wide: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of each vector; wide: the centroids' wide components."""
    total = np.zeros((len(codes), len(wide)), np.int64)
    for b, table in enumerate(tables):
        total += table[codes[:, b]]
    for i in range(rest.shape[1]):
        values, where = np.unique(rest[:, i], return_inverse=True)
        total += _distances(values[:, None], wide[:, i, None])[where]
    best = total.argmin(1)
    return best, total[np.arange(len(total)), best]


def _slices(batches: Iterator[pa.RecordBatch], coding: Coding) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH):
            part = batch.slice(start, BATCH)
            yield part, _matrix(part.column("codes"), len(coding.blocks)), _matrix(part.column("rest"), len(coding.wide))


def _round(coded: DataFrame, shared, coding: Coding, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: sums and counts per task, added up by (centroid, dimension), then exact means."""
    k, dimensions = centroids.shape
    tables = coded.sparkSession.sparkContext.broadcast((distance_tables(coding, centroids), centroids[:, coding.wide]))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, (known, wide) = shared.value, tables.value
        parts = [at.subvectors(b) for b in range(len(at.blocks))]
        total, count = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for _, codes, rest in _slices(batches, at):
            best, _ = nearest(codes, rest, known, wide)
            count += np.bincount(best, minlength=k)
            for b, block in enumerate(at.blocks):
                for i, d in enumerate(block):
                    total[:, d] += _sum_by(best, parts[b][codes[:, b], i], k)
            for i, d in enumerate(at.wide):
                total[:, d] += _sum_by(best, rest[:, i], k)
        n, d = np.nonzero(np.broadcast_to(count[:, None] > 0, total.shape))
        yield pa.RecordBatch.from_arrays(
            [pa.array(n, pa.int32()), pa.array(d, pa.int32()), pa.array(total[n, d]), pa.array(count[n])],
            ["cluster", "d", "total", "n"])

    found = coded.select("codes", "rest").mapInArrow(sums, "cluster int, d int, total bigint, n bigint")
    after = centroids.copy()
    for r in found.groupBy("cluster", "d").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        after[r.cluster, r.d] = r.total // r.n
    tables.unpersist()
    return after


def _sum_by(group: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
    """Exact sums of whole numbers by group: high and low halves are added apart, so that no float rounds them."""
    high, low = values >> 20, values & 0xFFFFF
    return (np.bincount(group, high, k).astype(np.int64) << 20) + np.bincount(group, low, k).astype(np.int64)


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dimensions: int = DIMENSIONS,
            k: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED, entries: int = ENTRIES,
            report: Callable[[Coding], None] | None = None) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance of each kept vector, and the final centroids; report gets the dictionaries."""
    spark = vectors.sparkSession
    kept = written(integers(vectors, vec_id, embedding, dimensions, scale))
    kind = kept.schema["vec_id"].dataType.simpleString()
    centroids = first_centroids(kept, k, seed)
    schema = f"vec_id {kind}, cluster int, distance bigint"
    if not len(centroids):
        return spark.createDataFrame([], schema), np.empty((0, dimensions), np.int64)
    lo, hi = ranges(kept, dimensions)
    blocks, wide = blocks_of(lo, hi, entries)
    coding = dictionaries(kept, Coding(blocks, wide, lo, hi - lo + 1))
    if report:
        report(coding)
    coded = encoded(kept, coding)
    shared = spark.sparkContext.broadcast(coding)
    for _ in range(rounds):
        centroids = _round(coded, shared, coding, centroids)
    tables = spark.sparkContext.broadcast((distance_tables(coding, centroids), centroids[:, coding.wide]))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, (known, parts) = shared.value, tables.value
        for part, codes, rest in _slices(batches, at):
            best, distance = nearest(codes, rest, known, parts)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(best, pa.int32()), pa.array(distance, pa.int64())],
                ["vec_id", "cluster", "distance"])

    return coded.mapInArrow(assign, schema), centroids


def clusters(vectors: DataFrame, **options) -> DataFrame:
    """Per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    The assignments are written once; what is collected and joined back is one row per centroid.
    """
    assigned, centroids = cluster(vectors, **options)
    assigned = cut(assigned)
    own = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    every = sum(own.values())
    rows = [(c, s, every, centroid_digest(centroids[c])) for c, s in sorted(own.items())]
    sums = vectors.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(sums), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
