"""Customary row order of the results; operators themselves leave rows unordered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDERS: dict[str, tuple[str, ...]] = {
    "toi_by_strength": ("-seconds",),
    "toi_by_player_and_strength": ("eventTeam", "player1Name", "strength"),
    "on_ice_stats_by_player_strength": ("eventTeam", "player1Name", "strength"),
    "combo_toi": ("Strength", "-TOI"),
    "combo_shot_metrics": ("Strength", "-CorsiFor", "-CorsiAgainst"),
    "combo_on_ice_stats": ("strength", "team_combo", "opp_combo"),
    "combo_on_ice_stats_both_teams": ("team", "strength", "team_combo", "opp_combo"),
    "team_strength_aggregates": ("team", "strength"),
}


def in_result_order(df: DataFrame, operator: str) -> DataFrame:
    """Sorts an operator's result by game and its customary columns (``-`` means descending)."""
    keys = [F.col(k[1:]).desc() if k.startswith("-") else F.col(k).asc() for k in ORDERS[operator]]
    return df.orderBy("gameId", *keys)
