"""Token counts by an exact length histogram (operator 8).

Documents are reduced to one row per encoded length, with partial sums before the shuffle. Suffix sums over the
lengths then answer, for every context limit: how many documents are longer, how many tokens there are in total,
how many remain if each document is cut at the limit, and the quantiles of the length. Suffix sums run inside
blocks of lengths and over the blocks, so no window holds all lengths.

Defined results: a null or empty text has length 0; repeated rows count each; an empty table gives an empty
histogram; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe import RANKS, token_counts
from .common import cut

#: Lengths in a block of the suffix sums.
BLOCK = 1024


def histogram(docs: DataFrame, text: str = "text", ranks_path: str = RANKS) -> DataFrame:
    """n_tokens, docs: the number of documents of each encoded length."""
    counted = token_counts(docs.select(F.col(text).alias("text")), "text", "n_tokens", ranks_path)
    return counted.groupBy("n_tokens").agg(F.count("*").alias("docs"))


def suffix_sums(lengths: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row per length L that occurs, from a histogram: its documents, and the answers for the limit L.

    docs_longer, tokens_longer: of documents over L; docs_total, tokens_total: of all; truncated_total: tokens
    left if each document is cut at L; quantile: the share of documents of length L or less.
    """
    lengths = cut(lengths)  # one row per length; read three times below, and the texts are encoded once
    tokens = F.col("n_tokens") * F.col("docs")
    blocked = lengths.withColumn("block", F.expr(f"n_tokens div {block}")).withColumn("tokens", tokens)
    sums = blocked.groupBy("block").agg(F.sum("docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    above = sums.select(
        "block",
        F.coalesce(F.sum("block_docs").over(later), F.lit(0)).alias("above_docs"),
        F.coalesce(F.sum("block_tokens").over(later), F.lit(0)).alias("above_tokens"),
        F.sum("block_docs").over(everything).alias("docs_total"),
        F.sum("block_tokens").over(everything).alias("tokens_total"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    longer = blocked.withColumns({
        "in_docs": F.coalesce(F.sum("docs").over(inside), F.lit(0)),
        "in_tokens": F.coalesce(F.sum("tokens").over(inside), F.lit(0)),
    })
    return longer.join(above, "block").select(
        "n_tokens", "docs",
        (F.col("in_docs") + F.col("above_docs")).alias("docs_longer"),
        (F.col("in_tokens") + F.col("above_tokens")).alias("tokens_longer"),
        "docs_total", "tokens_total",
    ).withColumns({
        "truncated_total": F.col("tokens_total") - F.col("tokens_longer") + F.col("docs_longer") * F.col("n_tokens"),
        "quantile": (F.col("docs_total") - F.col("docs_longer")) / F.col("docs_total"),
    })


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """limit, truncated_total, docs_longer for any limits, also lengths that do not occur.

    Between two lengths the number of longer documents is that of the next smaller length, so the answer of a
    limit is a sum over the histogram's rows; the given limits are few and stated by the caller.
    """
    def one(limit: int) -> Column:
        over = F.when(F.col("n_tokens") > limit, F.col("docs")).otherwise(0)
        kept = F.col("docs") * F.least(F.col("n_tokens"), F.lit(limit))
        return F.struct(
            F.lit(limit).cast("bigint").alias("limit"),
            F.coalesce(F.sum(kept), F.lit(0)).alias("truncated_total"),
            F.coalesce(F.sum(over), F.lit(0)).alias("docs_longer"),
        )

    return sums.agg(F.array(*map(one, limits)).alias("answers")).selectExpr("inline(answers)")


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """share, n_tokens: the smallest length that at least this share of the documents does not exceed."""
    def one(share: float) -> Column:
        return F.struct(
            F.lit(share).cast("double").alias("share"),
            F.min(F.when(F.col("quantile") >= share, F.col("n_tokens"))).alias("n_tokens"),
        )

    return sums.agg(F.array(*map(one, shares)).alias("answers")).selectExpr("inline(answers)")
