"""Quality classifier: regularised quadratic discriminant (operator 7).

Each text is described by transformed statistics of its bytes and words. Class sums, means and second moments of
all labelled training rows are added up by Spark; the two covariances are shrunk towards their pooled covariance
and a multiple of the identity, factored once, and shipped as two triangular matrices. A score is the logistic of
the log-density difference, from the Mahalanobis distances to the two classes and the class shares.

Defined results: a null or empty text has the statistics of no words and gets a score as any other; a row without
an id is never used to learn; an id labelled twice counts once if its labels agree and not at all if they differ;
null labels are ignored; repeated rows are scored each; without rows of both classes every score is the share of
label 1 among the rows there are (0.5 without any); other columns stay, a clashing output takes a free name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, remainder

#: Share of the pooled covariance and of the identity in a class covariance.
POOLED, IDENTITY = 0.1, 0.02
THRESHOLD = 0.3
_SYMBOLS = [ord(c) for c in "#*$%&|<>"]


def statistics(text: str) -> list[float]:
    """Transformed statistics of one whole text; shares are smoothed, so that short texts lie near the middle."""
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    found = text.split()
    n, visible = len(found), max(1, int(raw.sum() - raw[32] - raw[9:14].sum()))
    distinct = len(set(found))
    doubled = sum(map(str.__eq__, found, found[1:]))
    pairs = len(set(zip(found, found[1:])))

    def share(part: float, whole: float, prior: float, weight: float = 8.0) -> float:
        p = (part + prior * weight) / (whole + weight)
        return float(np.log(p / (1 - p)))

    return [
        float(np.log1p(n)),
        float(np.log((visible + 40.0) / (n + 8.0))),
        share(raw[_SYMBOLS].sum(), visible, 0.002, 20),
        share(raw[ord("!")], visible, 0.002, 20),
        share(raw[65:91].sum(), visible, 0.03, 20),
        share(raw[48:58].sum(), visible, 0.005, 20),
        share(raw[ord("|")], n, 0.005),
        share(min(doubled, n), n, 0.01),
        # distinct words and pairs against what a text of this length usually has
        share(distinct, n, 0.8) + 0.35 * float(np.log1p(n)),
        share(pairs, max(n - 1, 0), 0.95),
        float(np.log1p(raw[10]) - 0.7 * np.log1p(n)),
    ]


N_STATISTICS = len(statistics(""))


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _statistics(texts: pa.Array) -> pa.Array:
    return pa.array([statistics(x.as_py() or "") for x in texts], pa.list_(pa.float64()))


@dataclass(frozen=True)
class Discriminant:
    """Class means, inverse Cholesky factors of the class covariances, half log-determinants, log class shares."""

    means: np.ndarray
    factors: np.ndarray
    half_logdets: np.ndarray
    log_shares: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Log of the odds of label 1 for the rows of x."""
        logs = []
        for k in (0, 1):
            z = (x - self.means[k]) @ self.factors[k].T
            logs.append(self.log_shares[k] - self.half_logdets[k] - 0.5 * (z * z).sum(axis=1))
        return logs[1] - logs[0]


def fit(docs: DataFrame, labels: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text",
        label: str = "quality") -> Discriminant:
    """Learns from the rows of docs that have a label and for which `train` holds.

    Only sums reach the driver: for each class a count, a vector and a matrix.
    """
    agreed = (
        labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("id"))
        .agg(F.min(label).alias("k"), F.max(label).alias("other")).where("k = other").drop("other")
    )
    described = docs.where(train & F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("id"), _statistics(F.coalesce(F.col(text), F.lit(""))).alias("x")
    )
    rows = described.join(agreed, "id")
    d = N_STATISTICS
    sums = [F.count("*").alias("n")]
    sums += [F.sum(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(d)]
    sums += [F.sum(F.get("x", F.lit(i)) * F.get("x", F.lit(j))).alias(f"m{i}_{j}") for i in range(d) for j in range(i + 1)]
    found = {r["k"]: r for r in rows.groupBy("k").agg(*sums).collect()}  # at most two rows
    return _discriminant(found, d)


def _discriminant(found: dict, d: int) -> Discriminant:
    n = np.array([found[k]["n"] if k in found else 0 for k in (0, 1)], float)
    log_shares = np.log((n + 1.0) / (n.sum() + 2.0)) if n.sum() else np.log([0.5, 0.5])
    means, spreads = np.zeros((2, d)), np.array([np.eye(d), np.eye(d)])
    if n.min() > 0:
        for k in (0, 1):
            r = found[k]
            means[k] = [r[f"s{i}"] / n[k] for i in range(d)]
            for i in range(d):
                for j in range(i + 1):
                    spreads[k, i, j] = spreads[k, j, i] = r[f"m{i}_{j}"] / n[k] - means[k, i] * means[k, j]
        pooled = (n[0] * spreads[0] + n[1] * spreads[1]) / n.sum()
        unit = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
        spreads = (1 - POOLED) * spreads + POOLED * pooled
        spreads = (1 - IDENTITY) * spreads + IDENTITY * np.diag(unit * unit)
    roots = [np.linalg.cholesky(s) for s in spreads]
    return Discriminant(
        means, np.array([np.linalg.inv(r) for r in roots]), np.array([np.log(np.diag(r)).sum() for r in roots]), log_shares
    )


def score(docs: DataFrame, model: Discriminant, text: str = "text", out: str = "score") -> DataFrame:
    """docs and the probability of label 1 of each row."""

    @F.arrow_udf("double")
    def logistic(texts: pa.Array) -> pa.Array:
        x = np.array([statistics(t.as_py() or "") for t in texts]).reshape(-1, N_STATISTICS)
        return pa.array(1.0 / (1.0 + np.exp(-np.clip(model.log_odds(x), -500, 500))))

    return docs.withColumn(free_name(docs, out), logistic(F.coalesce(F.col(text), F.lit(""))))


def good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, with the columns of docs; learns from all but a fifth."""
    model = fit(docs, labels, remainder(F.col("doc_id")) != 0)
    name = free_name(docs, "score")
    return score(docs, model, out="score").where(F.col(name) >= threshold).select(*docs.columns)
