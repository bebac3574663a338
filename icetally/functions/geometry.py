"""Rink coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icetally.functions.clock import to_double


def origin_distance(df: DataFrame, x: str = "xCoord", y: str = "yCoord") -> DataFrame:
    """Coordinates with missing values as 0 and their distance from centre ice."""
    xf = F.coalesce(to_double(F.col(x)), F.lit(0.0))
    yf = F.coalesce(to_double(F.col(y)), F.lit(0.0))
    return df.withColumns(
        {
            "x_normalized": xf,
            "y_normalized": yf,
            "distance_from_goal": F.sqrt(xf * xf + yf * yf),
        }
    )


def rink_geometry(df: DataFrame, goal_x: float = 89.0, goal_y: float = 0.0) -> DataFrame:
    """Mirrors shots to the +x end and adds distance and signed angle to the net."""
    x, y = to_double(F.col("xCoord")), to_double(F.col("yCoord"))
    sign = F.when(x < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    df = df.withColumns({"x_norm": sign * x, "y_norm": sign * y})
    dx: Column = F.lit(float(goal_x)) - F.col("x_norm")
    angle = F.degrees(F.atan2(F.col("y_norm"), dx))
    # mirroring turns y = 0 into -0, which atan2 here reads as +0: behind the net that is -180 degrees
    behind = (x < 0) & (y == 0) & (dx < 0)
    return df.withColumns(
        {
            "distanceFromGoal": F.hypot(dx, F.lit(float(goal_y)) - F.col("y_norm")),
            "angle_signed": F.when(behind, F.lit(-180.0)).otherwise(angle),
        }
    )
