"""N-gram Jaccard join: size-aware heavy-light join (operator 1).

The sets are the distinct n-word shingles of whole texts. Two documents link when 100 * intersection >= percent *
union. Equal sets are one set from the start. A boundary splits the sets by size:

* Light sets enumerate fixed-size subsets: for each partner size the size of the intersection that a link needs is
  fixed, so linked sets share a subset of that size. There are few such subsets while sets are small.
* Heavy sets scan inverted lists. First, sets without any near partner are found by counting: elements are dealt to
  more segments than a link may have differing elements, so linked sets agree on a whole segment. Segments that many
  sets share are told beforehand, block by block, and do not travel; the others travel once. The rest order
  their elements by document frequency, rarest first, and are listed under those elements that a first common
  element can be; a set's place of the element bounds the sizes of its partners.

The boundary is where the estimated number of emitted rows is least, from the histogram of small sizes. Both kinds of
lists go through links.groups: hubs first, then only pairs across groups, each verified on the whole sets. So no
group is expanded into all its pairs, and no link between groups is lost.

Defined results: a null, empty or blank text has the empty set, links with nothing and is its own component; with
fewer words than n, the whole sequence is the only shingle; rows repeated with id and text come back each, in one
component; a null id counts only if a component has no other; an empty table gives an empty result; other columns
are not carried by `components_of`, and stay in `representatives`.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icetally.session import delete_path, shared_path

from .common import Keys, cut, free_name, lower_ascii, sized, text_of, words
from .links import groups

#: Sizes among which the boundary between light and heavy sets is looked for.
LIGHTEST, MOST_LIGHT = 2, 40

#: A segment that stands so many times among so many segments of neighbouring rows is hot and is not dealt by its key.
#: Any choice gives the same result: hot segments are shared ones, and the others are counted.
HOT_TIMES, HOT_BLOCK = 20, 1 << 20


def shingles(text: Column, n: int) -> Column:
    """The sorted hashes of the distinct n-word shingles; the whole sequence if there are fewer words."""
    def of(found: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(found) - n), lambda i: F.xxhash64(*(F.get(found, i + k) for k in range(n))))
        whole = F.array(F.xxhash64(F.array_join(found, " ")))
        none = F.array().cast("array<bigint>")
        return F.array_sort(F.array_distinct(F.when(F.size(found) >= n, each).when(F.size(found) > 0, whole).otherwise(none)))

    return F.flatten(F.transform(F.array(words(lower_ascii(text))), of))


class Sizes:
    """What a Jaccard bound of `percent` says about set sizes."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.starts = [1]  # of the levels; partners lie in the same or the next level
        while self.starts[-1] < 1 << 40:
            last = self.starts[-1]
            self.starts.append(max(last + 1, 100 * (last - 1) // percent + 1))

    def common(self, n: int, m: int) -> int:
        """The least intersection of linked sets of sizes n and m."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def least(self, n: int) -> int:
        return -(-self.percent * n // 100)

    def level(self, n: int) -> int:
        return bisect_right(self.starts, n) - 1

    def differing(self, level: int) -> int:
        """The most elements in which linked sets of this level and the next can differ."""
        n = self.starts[level + 1] - 1
        return (n + 100 * n // self.percent) * (100 - self.percent) // (100 + self.percent)

    def segments(self, level: int) -> int:
        """More than those elements, and some more, so that nearly all sets fill one segment more than that."""
        least = self.differing(level) + 1
        return least + max(2, least // 10)

    def partners(self, n: int, below: int) -> list[int]:
        return [m for m in range(self.least(n), min(below - 1, 100 * n // self.percent) + 1) if self.common(n, m) <= min(n, m)]

    def subset_rows(self, n: int, below: int) -> int:
        return sum(comb(n, self.common(n, m)) for m in self.partners(n, below) if not (m == n == self.common(n, m)))

    def list_rows(self, n: int) -> int:
        """Segments, and the elements that are listed and compared if the set may have a partner."""
        level = self.level(n)
        return self.segments(level) + (self.segments(level - 1) if level else 0) + n

    def boundary(self, histogram: dict[int, int], largest: int = MOST_LIGHT) -> int:
        """The first heavy size: the one for which both kinds of lists together have fewest rows."""
        def cost(b: int) -> int:
            light = sum(c * self.subset_rows(n, b) for n, c in histogram.items() if n < b)
            return light + sum(c * self.list_rows(n) for n, c in histogram.items() if n >= self.least(b))

        return min(range(LIGHTEST, largest + 1), key=cost)


_MIX = np.uint64(0x9E3779B97F4A7C15)  # an odd number near 2^64 over the golden ratio


def _mixed(x: np.ndarray) -> np.ndarray:
    y = x * _MIX
    return (y ^ (y >> np.uint64(31))) * _MIX


def segment_keys(elements: np.ndarray, sizes: Sizes) -> np.ndarray:
    """A hash of each filled segment of the set, for its own level and the one below.

    A set that fills more segments than a link may have differing elements agrees on a filled segment with each
    partner. The few that fill no more get a common mark, by which they meet each other.
    """
    x = _mixed(elements.astype(np.uint64))
    level, keys = sizes.level(len(x)), []
    for base in (level, level - 1):
        if base < 0:
            continue
        parts = sizes.segments(base)
        place = ((x >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
        content = np.zeros(parts, np.uint64)
        np.bitwise_xor.at(content, place, x)
        filled = np.unique(place)
        tag = np.arange(parts + 1, dtype=np.uint64) + np.uint64((base + 1) << 40)
        keys.append(_mixed(content[filled] + _mixed(tag[filled])))
        if len(filled) <= sizes.differing(base):
            keys.append(_mixed(_mixed(tag[parts:])))
    return np.concatenate(keys).view(np.int64)


def subset_keys(elements: np.ndarray, sizes: Sizes, below: int) -> list[tuple[int, int]]:
    """(hash, partner size) of the subsets that a light set shares with linked light sets of each size."""
    x = [int(v) for v in _mixed(elements.astype(np.uint64))]
    n, whole, out = len(x), 0, []
    for v in x:
        whole ^= v
    for m in sizes.partners(n, below):
        c = sizes.common(n, m)
        if m == n == c:
            continue  # only an equal set
        tag = (min(n, m) << 20 | max(n, m)) * 0x9E3779B97F4A7C15
        for gone in combinations(x, n - c):
            left = whole
            for v in gone:
                left ^= v
            out.append((((left + tag) & (1 << 64) - 1) - (1 << 63), m))
    return out


def _sets(docs: DataFrame, doc_id: str, text: str, n: int) -> DataFrame:
    source = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    each = source.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), shingles(F.col("text"), n).alias("elements"))
    return each.select("doc_id", "row", F.size("elements").alias("n"), F.xxhash64("elements").alias("sid"), "elements")


def _light(described: DataFrame, sizes: Sizes, boundary: int) -> DataFrame:
    """key, id, n, at, lo, hi of the light sets."""

    @F.arrow_udf("array<struct<key: bigint, m: int>>")
    def keys(sets: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("key", pa.int64()), ("m", pa.int32())]))
        return pa.array([[{"key": k, "m": m} for k, m in subset_keys(np.array(s.as_py(), np.int64), sizes, boundary)] for s in sets], kind)

    each = described.where((F.col("n") > 0) & (F.col("n") < boundary)).select("sid", "n", F.explode(keys("few")).alias("k"))
    return each.select("k.key", F.col("sid").alias("id"), "n", F.lit(0).alias("at"), F.col("k.m").alias("lo"), F.col("k.m").alias("hi"))


def hot_keys(described: DataFrame) -> DataFrame:
    """key: the segments that stand HOT_TIMES or more in one block of HOT_BLOCK segments. Holds one block in memory."""

    def often(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, times = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys[times >= HOT_TIMES], pa.int64())], ["key"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).flatten().to_numpy(zero_copy_only=False))
            n += len(held[-1])
            if n >= HOT_BLOCK:
                yield often(held)
                held, n = [], 0
        if held:
            yield often(held)

    return described.select("segments").mapInArrow(blocks, "key bigint").distinct()


def with_partner(described: DataFrame) -> DataFrame:
    """place: of the sets that agree on a segment with another one; described holds every set once."""
    each = described.select("place", F.explode("segments").alias("key"))
    hot = sized(hot_keys(described))
    spread = each.join(hot, "key", "left_anti").repartition("key")
    # both branches ask for place and key, so they read one exchange
    shared = spread.groupBy("key").agg(F.min("place").alias("low"), F.max("place").alias("high")).where("low != high").select("key")
    return spread.join(shared, "key").select("place").union(each.join(hot, "key", "left_semi").select("place")).distinct()


def _heavy(docs: DataFrame, every: DataFrame, described: DataFrame, sizes: Sizes, boundary: int, doc_id: str, text: str, n: int) -> tuple[DataFrame, DataFrame]:
    """key, id, n, at, lo, hi of the sets that can have a heavy partner; and sid, n, elements of those sets."""
    percent = sizes.percent
    near = described.where(F.col("n") >= sizes.least(boundary))
    rows = Keys(near.select("place", "row").join(with_partner(near), "place").select("row"))
    again = docs.withColumn(row := free_name(docs, "row"), F.xxhash64(F.col(doc_id), text_of(text)))
    chosen = rows.picked(again, row)
    # rows repeated with id and text come back each; only they are brought together, the other sets stay in place
    twice = every.groupBy("row").count().where("count > 1").select("row")
    repeated = Keys(rows.table.join(twice, "row", "left_semi"))
    each = cut(_sets(chosen, doc_id, text, n).select("row", "sid", "n", "elements"))
    sets = repeated.dropped(each, "row").unionByName(
        repeated.picked(each, "row", lambda held: held.dropDuplicates(["row"]))).select("sid", "n", "elements")

    listed = sets.select("sid", "n", F.explode("elements").alias("e"))
    often = listed.groupBy("e").count().where("count > 1")
    common = listed.join(often, "e").groupBy("sid", "n").agg(F.array_sort(F.collect_set(F.struct("count", "e"))).alias("all"))
    least = F.ceil(F.col("n") * percent / 100)
    alone = F.col("n") - F.size("all")  # elements of no other set come first in the order
    room = (F.col("n") - least + 1 - alone).cast("int")
    placed = common.where(room > 0).select(
        "sid", "n", alone.alias("alone"), least.cast("int").alias("lo"), F.posexplode(F.slice("all", F.lit(1), F.greatest(room, F.lit(0)))).alias("i", "one"))
    at = F.col("alone") + F.col("i")
    most = F.floor((F.col("n") - at) * (100 + percent) / percent) - F.col("n")
    return placed.select(
        F.col("one.e").alias("key"), F.col("sid").alias("id"), "n", at.alias("at"), "lo",
        F.least(most, F.floor(F.col("n") * 100 / percent)).cast("int").alias("hi")), sets


def describe(docs: DataFrame, doc_id: str, text: str, n: int, percent: int) -> DataFrame:
    """place, doc_id, row, n, sid, few (elements of small sets), segments: one row per document, without its text.

    place is a number of the row, which takes little room where rows of a place stand together.
    """
    sizes = Sizes(percent)
    smallest = sizes.least(LIGHTEST)

    @F.arrow_udf("array<bigint>")
    def segments(sets: pa.Array) -> pa.Array:
        flat, ends = sets.values.to_numpy(zero_copy_only=False), sets.offsets.to_numpy()
        found = [segment_keys(flat[a:b], sizes) if b - a >= smallest else np.empty(0, np.int64) for a, b in zip(ends[:-1], ends[1:])]
        offsets = np.concatenate([[0], np.cumsum([len(k) for k in found])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found or [np.empty(0, np.int64)])))

    few = F.when(F.col("n") < MOST_LIGHT, F.col("elements")).otherwise(F.array().cast("array<bigint>"))
    return _sets(docs, doc_id, text, n).select(
        F.monotonically_increasing_id().alias("place"), "doc_id", "row", "n", "sid", few.alias("few"), segments("elements").alias("segments"))


def components_of(docs: DataFrame, n: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, row, n_shingles, component, component_id of every row of docs; component_id: its smallest doc_id."""
    sizes, spark = Sizes(percent), docs.sparkSession
    segmented = shared_path(spark, "segments")  # read until the sets with a partner are known, then deleted
    describe(docs, doc_id, text, n, percent).write.parquet(segmented)
    wide = spark.read.parquet(segmented)
    every = cut(wide.drop("segments"))
    first = every.groupBy("sid").agg(F.min("place").alias("first"))
    copies = Keys(every.select("sid", "place").join(first, "sid").where("place != first").select("place"))
    once = copies.dropped(every, "place")
    small = {r["n"]: r["count"] for r in once.where(F.col("n").between(1, 2 * MOST_LIGHT)).groupBy("n").count().collect()}
    boundary = sizes.boundary(small)
    heavy, sets = _heavy(docs, every, copies.dropped(wide, "place"), sizes, boundary, doc_id, text, n)
    delete_path(spark, segmented)
    light = _light(once, sizes, boundary)
    members = cut(light.union(heavy).distinct())
    only_light = once.where((F.col("n") > 0) & (F.col("n") < boundary)).join(sets, "sid", "left_anti").join(
        light.select(F.col("id").alias("sid")).distinct(), "sid", "left_semi")
    elements = sets.union(cut(only_light.select("sid", "n", F.col("few").alias("elements"))))

    def meets(a: str, b: str) -> Column:
        return F.col(f"{a}n").between(F.col(f"{b}lo"), F.col(f"{b}hi")) & F.col(f"{b}n").between(F.col(f"{a}lo"), F.col(f"{a}hi"))

    def check(pairs: DataFrame) -> DataFrame:
        left, right = (elements.select(F.col("sid").alias(k), F.col("elements").alias(f"{k}_set"), F.col("n").alias(f"{k}_n")) for k in "ab")
        both = F.size(F.array_intersect("a_set", "b_set"))
        return pairs.join(left, "a").join(right, "b").where(
            100 * both >= percent * (F.col("a_n") + F.col("b_n") - both)).select("a", "b")

    purest = F.struct((-F.col("at")).alias("at"), (-F.col("n")).alias("n"))
    labels, _ = groups(members, purest, meets, check)
    known = every.select("doc_id", "row", "n", "sid").join(labels.withColumnRenamed("id", "sid"), "sid", "left")
    labelled = known.select("doc_id", "row", "n", F.when(F.col("n") > 0, F.coalesce("label", "sid")).alias("component"))
    smallest = labelled.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    full = labelled.where("n > 0").join(smallest, "component").unionByName(
        labelled.where("n = 0").withColumn("component_id", F.col("doc_id")))
    return full.select("doc_id", "row", F.col("n").cast("bigint").alias("n_shingles"), "component", "component_id")


def representatives(docs: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, one of each component: that of the smallest id. Rows without words all stay."""
    found = cut(components_of(docs, n, percent, doc_id, text))
    placed = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("row"))
    chosen = found.where("n_shingles > 0").groupBy("component").agg(F.min(placed).alias("first")).select("first.row").withColumn("keep", F.lit(True))
    twice = found.groupBy("row").count().where("count > 1").select("row")
    gone = Keys(found.where("n_shingles > 0").select("row").distinct().join(chosen, "row", "left_anti"))
    repeated = Keys(chosen.join(twice, "row", "left_semi").select("row"))
    row = free_name(docs, "row")
    keyed = docs.withColumn(row, F.xxhash64(F.col(doc_id), text_of(text)))
    kept = gone.dropped(keyed, row)
    single = repeated.dropped(kept, row)
    copies = repeated.picked(kept, row, lambda held: held.dropDuplicates([row]))
    return single.unionByName(copies).select(*docs.columns)
