"""Groups from similar pairs without making all pairs: stars first, then only what crosses groups.

Members of a key are candidates of each other. Each key's heaviest member is its hub; the others are checked against
the hub, which is linear in the key's size. Checked links give groups. What is left to check for exact groups are
pairs of one key in different groups; they start from the members outside the key's largest group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Rounds of label passing; every round at least doubles the reach of a label.
ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """id, label: for each id in the edges (a, b) the smallest id it can reach. Written to the shared folder.

    Each round takes the smallest label among the neighbours and then the label of the label. Nothing is collected
    but the number of changes.
    """
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("label")))
    for _ in range(ROUNDS):
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("label").alias("m"))
        lower = labels.join(near.withColumnRenamed("a", "id"), "id").select(
            "id", F.least("label", "m").alias("label"), F.col("label").alias("old"))
        lower = cut(lower)
        at = lower.select(F.col("id").alias("label"), F.col("label").alias("next"))
        jumped = cut(lower.join(at, "label", "left").select("id", F.least("label", F.coalesce("next", "label")).alias("label"), "old"))
        changed = jumped.where(F.col("label") != F.col("old")).limit(1).count()
        labels = jumped.select("id", "label")
        if not changed:
            return labels
    raise RuntimeError(f"groups did not settle in {ROUNDS} rounds")


def star_pairs(members: DataFrame, weight: Column, meets: Callable[[str, str], Column]) -> DataFrame:
    """a, b: each member with the hub of each of its keys, where `meets(prefix, prefix)` holds.

    members: key, id and columns that `weight` and `meets` use; meets gets the prefixes "a_" and "b_".
    """
    names = [c for c in members.columns if c != "key"]
    hubs = members.groupBy("key").agg(F.max(F.struct(weight.alias("w"), *names)).alias("hub"))
    hubs = hubs.select("key", *(F.col(f"hub.{c}").alias(f"b_{c}") for c in names))
    own = members.select("key", *(F.col(c).alias(f"a_{c}") for c in names))
    pairs = own.join(hubs, "key").where((F.col("a_id") != F.col("b_id")) & meets("a_", "b_"))
    return pairs.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")).distinct()


def stray_pairs(members: DataFrame, labels: DataFrame, meets: Callable[[str, str], Column]) -> DataFrame:
    """a, b: the pairs of a key in different groups, where `meets` holds; ids without a label are groups of one."""
    names = [c for c in members.columns if c != "key"]
    grouped = members.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    sizes = grouped.groupBy("key", "label").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("k"))
    mixed = mixed.where("k > 1").select("key", "main")
    open_keys = cut(grouped.join(mixed, "key"))
    left = open_keys.where("label != main").select("key", *(F.col(c).alias(f"a_{c}") for c in [*names, "label"]))
    right = open_keys.select("key", *(F.col(c).alias(f"b_{c}") for c in [*names, "label"]), (F.col("label") == F.col("main")).alias("b_main"))
    pairs = left.join(right, "key").where(
        (F.col("a_label") != F.col("b_label")) & (F.col("b_main") | (F.col("a_id") < F.col("b_id"))) & meets("a_", "b_"))
    return pairs.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")).distinct()


def groups(members: DataFrame, weight: Column, meets: Callable[[str, str], Column],
           check: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(id, label) of all linked ids, and the checked links (a, b) that hold the groups together."""
    first = cut(check(star_pairs(members, weight, meets)))
    labels = components(first)
    more = cut(check(stray_pairs(members, labels, meets)))
    if more.limit(1).count() == 0:
        return labels, first
    links = first.union(more)
    return components(links), links
