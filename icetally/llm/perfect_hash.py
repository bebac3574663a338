"""Minimal perfect hashing of a set of whole numbers, built bucket by bucket in Spark tasks.

Every level of a bucket has a bit for each place; a key that meets no other key at its place is settled there, the rest go
to the next level. The number of set bits before a key's bit, over all levels of all buckets, is its slot: n keys get the
slots 0 to n - 1. A number that is no key also lands on some slot or none, so the keys are kept by slot and compared.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys of one bucket, on average; bits of a level for each key that comes to it.
BUCKET_KEYS, SPACE = 1 << 14, 1.5
LEVELS = 64


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of keys and seed."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def levels_of(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The bits of each level of a bucket, and its keys by slot."""
    levels, order, left = [], [], np.unique(keys)
    while len(left):
        if len(levels) == LEVELS:
            raise RuntimeError("keys of a bucket did not settle")
        size = max(64, int(SPACE * len(left)))
        place = (mixed(left, len(levels) + 1) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        settled = alone[place]
        order.append(left[settled][np.argsort(place[settled])])
        levels.append(alone)
        left = left[~settled]
    return levels, np.concatenate(order) if order else left


@dataclass
class PerfectHash:
    """Bits of all levels in words of 64, set bits before each word, where the levels of each bucket lie, keys by slot."""

    words: np.ndarray
    before: np.ndarray
    first: np.ndarray
    size: np.ndarray
    keys: np.ndarray

    def __len__(self) -> int:
        return len(self.keys)

    def slots(self, wanted: np.ndarray) -> np.ndarray:
        """The slot of each number, -1 if it is no key."""
        wanted = np.asarray(wanted, np.int64)
        out = np.full(len(wanted), -1, np.int64)
        if not len(self.keys):
            return out
        left = np.arange(len(wanted))
        bucket = (mixed(wanted, 0) % np.uint64(len(self.first))).astype(np.int64)
        for level in range(self.first.shape[1]):
            size = self.size[bucket[left], level]
            left, size = left[size > 0], size[size > 0]
            if not len(left):
                break
            place = (mixed(wanted[left], level + 1) % size.astype(np.uint64)).astype(np.int64)
            place += self.first[bucket[left], level]
            word, bit = self.words[place >> 6], (place & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            lower = word & ((np.uint64(1) << bit) - np.uint64(1))
            found = left[here]
            out[found] = (self.before[place >> 6] + np.bitwise_count(lower))[here]
            left = left[~here]
        known = out >= 0
        known[known] = self.keys[out[known]] == wanted[known]
        return np.where(known, out, -1)


def joined(parts: Iterable[tuple[list[np.ndarray], np.ndarray]]) -> PerfectHash:
    """One hash from the levels and keys of all buckets, in the order of their numbers."""
    parts = list(parts)
    depth = max((len(levels) for levels, _ in parts), default=0)
    first, size = np.zeros((len(parts), depth), np.int64), np.zeros((len(parts), depth), np.int64)
    bits, at = [], 0
    for b, (levels, _) in enumerate(parts):
        for i, level in enumerate(levels):
            first[b, i], size[b, i] = at, len(level)
            at += len(level)
            bits.append(level)
    flat = np.concatenate([*bits, np.zeros(-at % 64, bool)])
    words = np.packbits(flat, bitorder="little").view(np.uint64)
    counts = np.bitwise_count(words).astype(np.int64)
    keys = np.concatenate([np.empty(0, np.int64), *(k for _, k in parts)])
    return PerfectHash(words, np.cumsum(counts) - counts, first, size, keys)


def built(keys: DataFrame, n: int) -> PerfectHash:
    """The hash of the distinct numbers in column `key`; n: how many they are. Buckets are built in tasks.

    What is collected are the bits and the keys, some nine bytes a key; the caller bounds n.
    """
    buckets = max(1, -(-n // BUCKET_KEYS))

    def numbered(batches):
        for frame in batches:
            frame["bucket"] = (mixed(frame.key.to_numpy(np.int64), 0) % np.uint64(buckets)).astype(np.int32)
            yield frame

    def bucket(frame: pd.DataFrame) -> pd.DataFrame:
        levels, order = levels_of(frame.key.to_numpy(np.int64))
        sizes = np.array([len(x) for x in levels], np.int64)
        return pd.DataFrame({
            "bucket": [int(frame.bucket.iloc[0])], "sizes": [sizes.tobytes()],
            "bits": [np.packbits(np.concatenate(levels)).tobytes()], "keys": [order.tobytes()]})

    rows = (
        keys.select(F.col("key").cast("bigint")).mapInPandas(numbered, "key bigint, bucket int").groupBy("bucket")
        .applyInPandas(bucket, "bucket int, sizes binary, bits binary, keys binary").collect())
    parts: list = [([], np.empty(0, np.int64))] * buckets
    for r in rows:
        sizes = np.frombuffer(r.sizes, np.int64)
        flat = np.unpackbits(np.frombuffer(r.bits, np.uint8), count=int(sizes.sum())).astype(bool)
        parts[r.bucket] = np.split(flat, np.cumsum(sizes)[:-1]), np.frombuffer(r.keys, np.int64)
    return joined(parts)
