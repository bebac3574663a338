"""Positions of regular-expression matches as column expressions: no Python runs on the rows.

Matches are framed by a private character, the text is split at it, and starts are running sums of the lengths of
the parts, in code points. The frame character is replaced in the text beforehand by another single character; the
patterns used here match ASCII only, so no match changes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from icetally.functions.arrays import let, running

FRAME = "\ue000"
#: Characters kept before and after a match.
BEFORE, AFTER = 24, 12
TYPE = "array<struct<start: int, end: int, value: string, before: string, after: string>>"


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: start, end (exclusive), value, and some text before and after."""
    framed = F.regexp_replace(F.replace(text, F.lit(FRAME), F.lit("\ufffd")), F.lit(pattern), F.lit(f"{FRAME}$0{FRAME}"))

    def located(parts: Column) -> Column:
        begins = running(
            parts, {"at": F.lit(0)}, lambda s, part: ({"at": s["at"] + F.length(part)}, s["at"]), "int"
        )
        odd = F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: i % 2 == 1)
        return let(begins, lambda at: F.transform(odd, lambda i: F.struct(
            F.get(at, i).alias("start"),
            (F.get(at, i) + F.length(F.get(parts, i))).alias("end"),
            F.get(parts, i).alias("value"),
            F.right(F.get(parts, i - 1), F.lit(BEFORE)).alias("before"),
            F.left(F.get(parts, i + 1), F.lit(AFTER)).alias("after"),
        )))

    return let(F.split(framed, FRAME), located)


def none() -> Column:
    return F.array().cast(TYPE)


def matches_if(gate: Column, text: Column, pattern: str) -> Column:
    """The matches of texts for which the cheap test `gate` holds; none for the others."""
    return F.when(gate, matches(text, pattern)).otherwise(none())


def labelled(found: Column, kind: str, rank: int) -> Column:
    """Spans as start, rank, end, kind: the order in which they are listed."""
    return F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
    ))


def listed(spans: Column) -> Column:
    """kind:start:end of all spans by start, then rank, joined by commas."""
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def covered(spans: Column, others: list[Column]) -> Column:
    """Per span an array that tells for each list of others whether one of it overlaps the span.

    All are sorted by start and swept twice: from the left with the furthest end of each list so far, from the right
    with its nearest start. The time grows with their number, not with its square. No span is empty.
    """
    lists = range(len(others))

    def marks(listed: Column, of: int, place) -> Column:
        return F.transform(listed, lambda s, i: F.struct(
            s["start"].alias("start"), F.lit(of).alias("of"), s["end"].alias("end"), place(i).alias("place")))

    # at one start a span comes after the others, so the sweep from the left sees them
    ordered = F.array_sort(F.concat(
        marks(spans, len(others), lambda i: i), *(marks(o, k, lambda i: F.lit(-1)) for k, o in enumerate(others))))
    right = running(
        ordered, {f"end_{k}": F.lit(0) for k in lists},
        lambda s, m: (
            {f"end_{k}": F.when(m["of"] == k, F.greatest(s[f"end_{k}"], m["end"])).otherwise(s[f"end_{k}"]) for k in lists},
            F.struct(m["start"], m["of"], m["end"], m["place"], F.array(*(s[f"end_{k}"] > m["start"] for k in lists))),
        ),
        "struct<start: int, of: int, end: int, place: int, hit: array<boolean>>",
    )
    left = running(
        F.reverse(right), {f"start_{k}": F.lit(2**31 - 1) for k in lists},
        lambda s, m: (
            {f"start_{k}": F.when(m["of"] == k, m["start"]).otherwise(s[f"start_{k}"]) for k in lists},
            F.struct(m["place"], F.array(*(F.get(m["hit"], F.lit(k)) | (s[f"start_{k}"] < m["end"]) for k in lists))),
        ),
        "struct<place: int, hit: array<boolean>>",
    )
    swept = F.transform(F.array_sort(F.filter(left, lambda m: m["place"] >= 0)), lambda m: m["hit"])
    alone = F.array_repeat(F.array(*(F.lit(False) for _ in lists)), F.size(spans))
    return F.when(sum((F.size(o) for o in others), F.lit(0)) > 0, swept).otherwise(alone)


def apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others."""
    return let(covered(spans, [others]), lambda hits: F.filter(spans, lambda s, i: ~F.get(F.get(hits, i), F.lit(0))))
