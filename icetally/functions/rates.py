"""Differentials, shares and per-60 rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RATE_FIELDS = ("CF", "CA", "FF", "FA", "SF", "SA", "xG", "xGA", "GF", "GA", "PF", "PA")
FAMILIES = ("Shots", "Fenwick", "Corsi")


def toi_value(seconds: str, in_seconds: bool):
    """Time in seconds, or in minutes."""
    return F.col(seconds) if in_seconds else F.col(seconds) / F.lit(60.0)


def differentials_and_shares(df: DataFrame, families: tuple[str, ...] = FAMILIES) -> DataFrame:
    """For - Against and For / (For + Against), null where nothing happened."""
    out = {}
    for f in families:
        won, lost = F.col(f"{f}For"), F.col(f"{f}Against")
        out[f"{f}Differential"] = won - lost
        out[f"{f}For%"] = F.try_divide(won.cast("double"), (won + lost).cast("double"))
    return df.withColumns(out)


def per60(df: DataFrame, minutes, families: tuple[str, ...] = FAMILIES) -> DataFrame:
    """``X/60`` columns from a minutes expression; null where there is no time."""
    names = [f"{f}{k}" for f in families for k in ("For", "Against", "Differential")]
    return df.withColumns(
        {f"{n}/60": F.try_divide(F.col(n) * F.lit(60.0), minutes.cast("double")) for n in names}
    )


def per60_filled(df: DataFrame, fields=RATE_FIELDS, seconds: str = "seconds") -> DataFrame:
    """``X_per60`` columns; 0 where there is no time."""
    columns = set(df.columns)
    return df.selectExpr("*", *[
        f"coalesce(try_divide(CAST({f} AS DOUBLE), {seconds} / 3600D), 0D) AS {f}_per60"
        for f in fields if f in columns
    ])
