"""On-ice lists of play rows: long and wide forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from icetally.functions.arrays import as_array
from icetally.functions.strength import list_size

LIST_COLUMNS = (
    "home_on_id", "away_on_id", "home_on_full_name", "away_on_full_name",
    "homeGoalie_on_id", "awayGoalie_on_id", "homeGoalie_on_full_name", "awayGoalie_on_full_name",
)


def _list(df: DataFrame, name: str, kind: str) -> Column:
    empty = F.array().cast(f"array<{kind}>")
    if name not in df.columns:
        return empty
    is_array = isinstance(df.schema[name].dataType, T.ArrayType)
    return F.coalesce(as_array(F.col(name), is_array).cast(f"array<{kind}>"), empty)


def _pairs(ids: Column, names: Column) -> Column:
    """(pid, name) per id; missing names are null, surplus names dropped."""
    return F.transform(
        ids, lambda x, i: F.struct(x.alias("pid"), F.get(names, i).alias("name"))
    )


def _without(pairs: Column, ids: Column) -> Column:
    return F.filter(pairs, lambda x: ~F.coalesce(F.array_contains(ids, x["pid"]), F.lit(False)))


def _name_of(pairs: Column, pid: Column) -> Column:
    return F.try_element_at(F.filter(pairs, lambda x: x["pid"] == pid), F.lit(-1))["name"]


def on_ice_long(df: DataFrame) -> DataFrame:
    """One row per event, side and slot."""
    def side(name: str) -> Column:
        pairs = _pairs(_list(df, f"{name}_on_id", "bigint"), _list(df, f"{name}_on_full_name", "string"))
        return F.transform(
            pairs,
            lambda x, i: F.struct(
                F.lit(name).alias("team_side"), (i + 1).alias("slot_index"),
                x["pid"].alias("player_id"), x["name"].alias("player_name"),
            ),
        )

    kept = [c for c in ("seq", "gameId", "elapsedTime", "Per", "Event") if c in df.columns]
    return df.select(*kept, F.explode(F.concat(side("home"), side("away"))).alias("x")).select(*kept, "x.*")


def on_ice_wide(
    df: DataFrame, max_skaters: int = 6, include_goalie: bool = True, drop_list_cols: bool = False
) -> DataFrame:
    """Adds skater id/name columns 1..max_skaters and the goalie per side.

    Goalies are taken out of the skater list. Without a goalie list the goalie is the one id that did
    not fit into the skater columns, if there is exactly one.
    """
    new: dict[str, Column] = {}
    for side in ("home", "away"):
        ids = _list(df, f"{side}_on_id", "bigint")
        names = _list(df, f"{side}_on_full_name", "string")
        goalies = _list(df, f"{side}Goalie_on_id", "bigint")
        goalie_names = _list(df, f"{side}Goalie_on_full_name", "string")
        df = df.withColumns({
            f"_{side}_pairs": _pairs(ids, names), f"_{side}_goalies": goalies,
        })
        pairs, gone = F.col(f"_{side}_pairs"), F.col(f"_{side}_goalies")
        df = df.withColumn(f"_{side}_skaters", _without(pairs, gone))
        line = F.col(f"_{side}_skaters")

        for i in range(1, max_skaters + 1):
            pid = F.try_element_at(line, F.lit(i))["pid"]
            new[f"{side}_skater_id_{i}"] = pid
            new[f"{side}_skater_name_{i}"] = _name_of(pairs, pid)
        if include_goalie:
            shown = F.transform(F.slice(line, 1, max_skaters), lambda x: x["pid"])
            left = _without(pairs, shown)
            lone = F.when(F.size(left) == 1, F.try_element_at(left, F.lit(1))["pid"])
            named = F.try_element_at(gone, F.lit(1)).isNotNull()
            gid = F.coalesce(F.try_element_at(gone, F.lit(1)), lone)
            new[f"{side}_goalie_id"] = gid
            new[f"{side}_goalie_name"] = F.when(
                named, F.try_element_at(goalie_names, F.lit(1))
            ).otherwise(_name_of(pairs, lone))
    out = df.withColumns(new).drop(*[f"_{s}_{k}" for s in ("home", "away") for k in ("pairs", "goalies", "skaters")])
    if drop_list_cols:
        out = out.drop(*[c for c in LIST_COLUMNS if c in out.columns])
    return out


def map_on_ice(
    df: DataFrame, lists: dict[str, str], table: str, keep_text: bool = False
) -> DataFrame:
    """Maps jersey lists through a map column: ``lists`` gives source list -> new column.

    Ids that are not in the map become null; names keep the jersey as text.
    """
    new = {}
    for source, target in lists.items():
        found = lambda x: F.try_element_at(F.col(table), x.cast("int"))
        if keep_text:
            new[target] = F.transform(source, lambda x: F.coalesce(found(x), x.cast("string")))
        else:
            new[target] = F.transform(source, found)
    return df.withColumns(new)


def unmapped_count(ids: str) -> Column:
    return list_size(F.filter(ids, lambda x: x.isNull()))
