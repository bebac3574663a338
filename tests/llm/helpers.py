"""Small tables with awkward rows, and plain re-implementations to hold the operators against."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Columns that have the names of outputs and helper columns.
CLASHES = ("score", "row", "digest", "label", "key", "token_ids", "n_tokens", "n_lines", "gone", "spans", "measured", "rules")
LONG = " ".join(f"word{i % 977} thing{i % 13}." for i in range(30_000))


def odd_rows() -> list[tuple]:
    """doc_id, text: null and empty texts, a null id, a very long text, repeated rows, characters of many bytes."""
    return [
        (1, "The cat sat on the mat and looked at the moon."), (2, None), (3, ""), (4, "  \t\n "), (None, "A row without an id"),
        (5, LONG), (6, "The cat sat on the mat and looked at the moon."), (6, "The cat sat on the mat and looked at the moon."),
        (7, "日本語のテキスト 😀😀 ÀÉ naïve\r\nzwei Zeilen"), (8, "x" * 50_000), (9, "one"), (10, "ONE"),
    ]


def frame(spark, rows, clashes: bool = False):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    if clashes:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit(f"own {c}") for c in CLASHES})
    return df


def empty(spark, clashes: bool = False):
    return frame(spark, [], clashes)


def kept_clashes(rows) -> bool:
    return all(r[c] == f"own {c}" for r in rows for c in CLASHES)


def edits(a: str, b: str) -> int:
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


def changed(rng: random.Random, letters: list, n: int, alphabet: str) -> list:
    out = list(letters)
    for _ in range(n):
        kind, i = rng.randint(0, 2), rng.randint(0, len(out))
        if kind == 0:
            out.insert(i, rng.choice(alphabet))
        elif i < len(out):
            if kind == 1:
                del out[i]
            else:
                out[i] = rng.choice(alphabet)
    return out


class Groups:
    def __init__(self) -> None:
        self.parent: dict = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
