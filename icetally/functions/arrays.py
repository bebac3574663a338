"""Array expressions: list coercion, combinations, labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_array(c: Column, is_array: bool) -> Column:
    """A list column with null as empty.

    Text like ``[1, 2]`` or ``(1, 2)`` is read as a list, other text with a comma is split, anything
    else is an empty list of strings.
    """
    if is_array:
        return F.coalesce(c, F.array())
    text = F.trim(c.cast("string"))
    bracketed = F.concat(F.lit("["), F.regexp_replace(text, r"^[\[(]|[\])]$", ""), F.lit("]"))
    single = F.regexp_replace(bracketed, "'", '"')
    parsed = F.coalesce(
        F.from_json(bracketed, "array<string>"), F.from_json(single, "array<string>")
    )
    pieces = F.filter(
        F.transform(F.split(text, ","), lambda p: F.trim(p)), lambda p: p != ""
    )
    comma = F.when(F.instr(text, ",") > 0, pieces).otherwise(F.array().cast("array<string>"))
    return (
        F.when(text.rlike(r"^(\[.*\]|\(.*\))$"), F.coalesce(parsed, comma))
        .when(text.isNotNull(), comma)
        .otherwise(F.array().cast("array<string>"))
    )


def let(value: Column, use) -> Column:
    """``use`` applied to a value that is worked out once, even where ``use`` needs it inside lambdas."""
    return F.transform(F.array(value), use).getItem(0)


def running(
    items: Column, start: dict[str, Column], step: Callable[[Column, Column], tuple[dict[str, Column], Column]],
    kind: str, block: int = 128,
) -> Column:
    """What `step` yields for each item of a list, with a state handed on from item to item.

    step gets the state and an item and returns the new state and a value of type `kind`. A fold that adds each value to
    the end of its list copies that list at every step; here values are gathered in blocks and the blocks in a list of
    blocks, so the time grows with the number of items.
    """
    state = lambda s: [s[k].alias(k) for k in start]
    none = F.array().cast(f"array<{kind}>")

    def through(s: Column, part: Column) -> Column:
        def one(t: Column, item: Column) -> Column:
            new, value = step(t, item)
            return F.struct(*[new[k].alias(k) for k in start], F.concat(t["out"], F.array(value.cast(kind))).alias("out"))

        return F.aggregate(
            part, F.struct(*state(s), none.alias("out")), one,
            lambda t: F.struct(*state(t), F.concat(s["out"], F.array(t["out"])).alias("out")),
        )

    def over(xs: Column) -> Column:
        last = F.floor((F.size(xs) - 1) / block).cast("int")
        parts = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda b: F.slice(xs, b * block + 1, block))
        begin = F.struct(*[v.alias(k) for k, v in start.items()], F.array().cast(f"array<array<{kind}>>").alias("out"))
        return F.aggregate(parts, begin, through, lambda s: F.flatten(s["out"]))

    return let(items, over)


def combos(ids: Column, n: int) -> Column:
    """All n-element subsets of a sorted array of distinct ids, each in ascending order."""
    if n == 0:
        return F.array(F.slice(ids, 1, 0))
    return let(ids, lambda held: _subsets(held, n))


def _subsets(ids: Column, n: int) -> Column:
    grown = F.transform(ids, lambda x: F.array(x))
    for _ in range(n - 1):
        grown = F.flatten(
            F.transform(
                grown,
                lambda c: F.transform(
                    F.filter(ids, lambda y: y > F.element_at(c, -1)),
                    lambda y: F.concat(c, F.array(y)),
                ),
            )
        )
    return grown


def combo_label(ids: Column, players: Column) -> Column:
    """Names joined by " / " in id order; a player without name shows as the id. ``players`` is a map
    of id to struct with a ``name`` field."""
    return F.array_join(
        F.transform(
            ids,
            lambda i: F.coalesce(F.try_element_at(players, i)["name"], i.cast("string")),
        ),
        " / ",
    )


def combo_positions(ids: Column, players: Column) -> Column:
    """Position signature such as ``2F1D``; groups nobody belongs to are left out."""

    def part(letter: str) -> Column:
        n = F.size(F.filter(ids, lambda i: F.try_element_at(players, i)["pos"] == letter))
        return F.when(n > 0, F.concat(n.cast("string"), F.lit(letter)))

    return F.concat_ws("", *[part(p) for p in ("F", "D", "G")])
