"""Row-order operators inside a game: forward fill, previous row, row number, k-th occurrence.

A game may hold a large share of all rows, so no window runs over a whole game of rows. Rows are ordered
inside one (game, second) cell; what crosses cells (the last known value, the last row, the number of
rows so far) is first reduced to one row per cell, carried over the cells of a game and joined back. Rows
without a second are cut into cells by their order keys, so they spread like any others.

Both branches, the rows and the cells' sums, read one exchange: the input is evaluated once.

Where the caller knows that every game is bounded (``whole``), plain windows over a game do the same without cells: the
rows of a game meet once, and what follows finds them together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from icetally.functions.columns import ensure_columns
from icetally.functions.events import event_rank

SCOREBOARD = ("awaySOG", "homeSOG", "homeScore", "awayScore")
_LAST_CELL = 2147483647
#: Neighbouring places (values of the last order key) of one cell where there is no second.
PLACES = 1024


def nulls_last(name: str) -> list[Column]:
    """Sort keys putting nulls behind all values."""
    return [F.col(name).isNull().alias(f"{name}_missing"), F.col(name)]


def canonical_keys(df: DataFrame) -> list[Column]:
    """Order of rows within a second: event rank, strength text, source (plays, then shifts), position."""
    keys = [event_rank(F.col("Event")).alias("rank")]
    text = next((c for c in ("Str", "strength") if c in df.columns), None)
    if text:
        keys += nulls_last(text)
    if "src" in df.columns:
        keys.append(F.col("src"))
    return [*keys, F.col("seq")]


def in_order(
    df: DataFrame, keys: list[Column], fill: tuple[str, ...] = (), fill_value: object = 0,
    previous: dict[str, Column] | None = None, number: str | None = None,
    among: Column | None = None, game: str = "gameId", second: str = "elapsedTime", whole: bool = False,
) -> DataFrame:
    """Adds order-dependent columns; rows without a second come last in their game.

    ``fill`` columns take the last non-null value, ``fill_value`` before the first. ``previous`` names
    values to be taken from the row before; with ``among`` only rows meeting it are looked at and get a
    value. ``number`` counts rows from 1. ``whole`` says that the rows of any game fit into one task.
    """
    previous = previous or {}
    among = F.lit(True) if among is None else F.coalesce(among, F.lit(False))
    cell = F.coalesce(F.col(second).cast("int"), F.lit(_LAST_CELL))
    if whole:
        return _in_order_whole(df, Window.partitionBy(game).orderBy(cell, *keys), fill, fill_value, previous, number, among)
    df = _in_cells(df.withColumn("_among", among), [game], cell, keys, cell == _LAST_CELL)
    order = F.struct(*keys)
    seen = F.struct(*[v.alias(k) for k, v in previous.items()]) if previous else None

    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(f"_last_{c}") for c in fill]
    if previous:
        aggs.append(F.max_by(seen, F.when(F.col("_among"), order)).alias("_last_seen"))
    if number:
        aggs.append(F.count(F.lit(1)).alias("_rows"))
    so_far = _cells_before([game])
    carried = [F.last(f"_last_{c}", ignorenulls=True).over(so_far).alias(f"_carry_{c}") for c in fill]
    if previous:
        carried.append(F.last("_last_seen", ignorenulls=True).over(so_far).alias("_carry_seen"))
    if number:
        carried.append(F.coalesce(F.sum("_rows").over(so_far), F.lit(0)).alias("_carry_rows"))
    carry = _cell_sums(df, aggs).select("_at", *carried)

    inside = Window.partitionBy("_at").orderBy(*keys)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new: dict[str, Column] = {f"_own_{c}": F.last(c, ignorenulls=True).over(upto) for c in fill}
    if number:
        new["_own_rows"] = F.row_number().over(inside)
    if previous:
        before = inside.rowsBetween(Window.unboundedPreceding, -1)
        new["_own_seen"] = F.last(F.when(F.col("_among"), seen), ignorenulls=True).over(before)
    out = df.withColumns(new).join(carry, "_at", "left")
    done: dict[str, Column] = {c: F.coalesce(f"_own_{c}", f"_carry_{c}", F.lit(fill_value)) for c in fill}
    if number:
        done[number] = F.col("_carry_rows") + F.col("_own_rows")
    if previous:
        last = F.coalesce("_own_seen", "_carry_seen")
        done |= {k: F.when(F.col("_among"), last[k]) for k in previous}
    return out.withColumns(done).drop("_at", "_among", *new, *[c for c in carry.columns if c.startswith("_carry")])


def _in_order_whole(
    df: DataFrame, game: Window, fill: tuple[str, ...], fill_value: object, previous: dict[str, Column],
    number: str | None, among: Column,
) -> DataFrame:
    """``in_order`` by windows over whole games."""
    upto = game.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new = {f"_own_{c}": F.last(c, ignorenulls=True).over(upto) for c in fill}
    if number:
        new["_own_rows"] = F.row_number().over(game)
    if previous:
        seen = F.when(among, F.struct(*[v.alias(k) for k, v in previous.items()]))
        new |= {"_among": among, "_own_seen": F.last(seen, ignorenulls=True).over(
            game.rowsBetween(Window.unboundedPreceding, -1))}
    done: dict[str, Column] = {c: F.coalesce(f"_own_{c}", F.lit(fill_value)) for c in fill}
    if number:
        done[number] = F.col("_own_rows").cast("bigint")
    done |= {k: F.when(F.col("_among"), F.col("_own_seen")[k]) for k in previous}
    return df.withColumns(new).withColumns(done).drop(*new)


def _in_cells(df: DataFrame, groups: list[str], cell: Column, keys: list[Column], cut: Column) -> DataFrame:
    """df dealt to cells ``_at`` of (groups, cell); where ``cut`` holds, a cell is cut by all keys but the last, and that by PLACES.

    Cells of a group are ordered like its rows. They are structs, so that null groups are groups as well.
    """
    last = keys[-1]
    numeric = isinstance(df.select(last.alias("k")).schema["k"].dataType, T.NumericType)
    places = F.floor(last / PLACES).cast("bigint") if numeric else F.lit(None).cast("bigint")
    parts = [F.when(cut, k).alias(f"k{i}") for i, k in enumerate([*keys[:-1], places])]
    at = F.struct(*[F.col(g).alias(f"g{i}") for i, g in enumerate(groups)], cell.alias("cell"), *parts)
    return df.withColumn("_at", at).repartition("_at")


def _cells_before(groups: list[str]) -> Window:
    """The cells of a group that lie before a cell."""
    group = [F.col(f"_at.g{i}") for i in range(len(groups))]
    return Window.partitionBy(*group).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)


def _cell_sums(df: DataFrame, aggs: list[Column]) -> DataFrame:
    """One row per cell.

    The sums ask for every column of df, so that their exchange is the same as that of the rows and is made once;
    with fewer columns Spark would make another one, from another evaluation of the input.
    """
    maps = [f.name for f in df.schema if isinstance(f.dataType, T.MapType)]
    every = F.xxhash64(*[F.size(f"`{c}`") if c in maps else F.col(f"`{c}`") for c in df.columns])
    return df.groupBy("_at").agg(*aggs, F.max(every).alias("_every")).where("_every is not null")


def scoreboard_ffill(df: DataFrame, keys: list[Column] | None = None) -> DataFrame:
    """Scores and shot totals carried forward, 0 before the first."""
    df = ensure_columns(df, {c: "int" for c in SCOREBOARD})
    return in_order(df, keys or [F.col("seq")], fill=SCOREBOARD)


def canonical_order(df: DataFrame) -> DataFrame:
    """Adds ``#``: position in its game by second, event rank, strength text, source and row position."""
    return in_order(df, canonical_keys(df), number="#")


def occurrence(
    df: DataFrame, keys: tuple[str, ...], order: Column, out: str = "merge_idx", descending: bool = False
) -> DataFrame:
    """Numbers the rows sharing a key from 0, in the order of a column; rows without a value come first.

    A key may hold a large share of all rows: its rows are dealt to cells of neighbouring places, numbered inside them,
    and the sizes of the cells before are added.
    """
    df = df.withColumn("_place", order)
    place = F.col("_place")
    if descending and isinstance(df.schema["_place"].dataType, T.NumericType):
        df, descending = df.withColumn("_place", -place), False
    df = _in_cells(df, [*keys], F.lit(0), [place], F.lit(True))
    ahead = F.coalesce(F.sum("_rows").over(_cells_before([*keys])), F.lit(0)).alias("_ahead")
    sums = _cell_sums(df, [F.count(F.lit(1)).alias("_rows")]).select("_at", ahead)
    inside = Window.partitionBy("_at").orderBy(place.desc_nulls_first() if descending else place)
    return df.withColumn("_own", F.row_number().over(inside) - 1).join(sums, "_at", "left").withColumn(
        out, (F.col("_own") + F.col("_ahead")).cast("int")).drop("_at", "_place", "_own", "_ahead")


def occurrence_join(
    left: DataFrame, right: DataFrame, keys: tuple[str, ...] = ("gameId", "Event", "Per", "Time"),
    left_order: Column | None = None, right_order: Column | None = None, right_descending: bool = False,
    whole: bool = False,
) -> DataFrame:
    """Left join pairing the k-th left row of a key with the k-th right row of that key. Columns both
    sides have take the suffix ``_api`` on the right. ``whole`` says that the rows of any first key fit into one task."""
    left_order = F.col("seq") if left_order is None else left_order
    right_order = F.col("seq") if right_order is None else right_order
    if whole:
        return _paired_whole(left, right, keys, left_order, right_order, right_descending)
    a = occurrence(left, keys, left_order)
    b = occurrence(right, keys, right_order, descending=right_descending)
    on = [*keys, "merge_idx"]
    b = b.withColumnsRenamed({c: f"{c}_api" for c in b.columns if c in a.columns and c not in on})
    return a.join(b, on, "left")


def _paired_whole(
    left: DataFrame, right: DataFrame, keys: tuple[str, ...], left_order: Column, right_order: Column, right_descending: bool,
) -> DataFrame:
    """``occurrence_join`` with both sides brought together by their first key once, numbered and paired by windows."""
    own = [c for c in left.columns if c not in keys]
    api = {c: f"{c}_api" if c in own else c for c in right.columns if c not in keys}
    a = left.repartition(keys[0]).select(
        *keys, F.lit(0).alias("_side"), left_order.alias("_place"), F.struct(*own).alias("_left"))
    b = right.select(
        *keys, F.lit(1).alias("_side"), right_order.alias("_turn"), F.struct(*[F.col(c).alias(n) for c, n in api.items()]).alias("_right"))
    turn = F.col("_turn").desc_nulls_first() if right_descending else F.col("_turn")
    each = Window.partitionBy(*keys, "_side").orderBy("_place", turn)
    both = a.unionByName(b, allowMissingColumns=True).withColumn("merge_idx", F.row_number().over(each) - 1)
    found = F.first("_right", ignorenulls=True).over(Window.partitionBy(*keys, "merge_idx"))
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()  # null keys meet in a window, but match nothing
    return both.withColumn("_right", found).where("_side = 0").select(
        *[F.col(k).cast(left.schema[k].dataType).alias(k) for k in keys], "merge_idx", "_left.*",
        *[F.when(known, F.col("_right")[n]).alias(n) for n in api.values()],
    )
