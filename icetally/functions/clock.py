"""Clock, period and number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIOD_SECONDS = 1200


def to_int(c: Column) -> Column:
    return c.try_cast("int")


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def clock_part(c: Column, i: int) -> Column:
    """The i-th colon-separated part as a number."""
    return to_int(F.split_part(c, F.lit(":"), F.lit(i)))


def mmss_to_seconds(c: Column) -> Column:
    """``"MM:SS"`` to seconds; null for null or any other shape."""
    one_colon = F.length(c) - F.length(F.replace(c, F.lit(":"), F.lit(""))) == 1
    return F.when(one_colon, clock_part(c, 1) * 60 + clock_part(c, 2))


def split_clock(c: Column) -> Column:
    """Two clocks glued together (``"0:0020:00"``) as a struct of zero-padded elapsed / remaining."""
    width = F.instr(c, ":") + 2
    rest = F.substring(c, width + 1, F.length(c))
    rest_width = F.instr(rest, ":") + 2
    elapsed, remaining = F.substring(c, F.lit(1), width), F.substring(rest, F.lit(1), rest_width)
    whole = (
        width.between(4, 5) & rest_width.between(4, 5) & (F.length(elapsed) == width) & (F.length(remaining) == rest_width)
        & (F.translate(F.concat(elapsed, remaining), "0123456789", "") == "::")
    )
    return F.struct(*[F.when(whole, F.lpad(part, 5, "0")).alias(name)
                      for part, name in ((elapsed, "elapsed"), (remaining, "remaining"))])


def period_number(c: Column) -> Column:
    """``OT`` is period 4, digits are themselves, anything else is null."""
    return F.when(c == "OT", F.lit(4)).otherwise(to_int(c))


def elapsed_time(seconds_in_period: Column, period: Column, game_type: Column | None = None) -> Column:
    """Game second of a period clock. Period 5 is a shootout, hence null, unless the game is a playoff
    game (``game_type`` 3). Without ``game_type`` period 5 is always null."""
    value = (seconds_in_period + (period - 1) * PERIOD_SECONDS).cast("int")
    timed = period != 5
    if game_type is not None:
        timed = timed | F.coalesce(game_type.cast("string") == "3", F.lit(False))
    return F.when(timed, value)


def jersey_number(name: Column) -> Column:
    """Leading number of ``"91 STAMKOS, STEVEN"``; null when there is no space or no number."""
    return F.when(F.instr(name, " ") > 0, to_int(F.split(name, " ").getItem(0)))


def report_key(game_id: Column, kind: str) -> Column:
    """``season/KINDnnnnnn`` part of a report's file name for a ten-digit game id."""
    text = game_id.cast("string")
    year = F.substring(text, 1, 4)
    short = F.lpad(F.when(F.length(text) > 6, F.substring(text, -6, 6)).otherwise(text), 6, "0")
    return F.concat(year, (year.cast("int") + 1).cast("string"), F.lit(f"/{kind}"), short)


def full_name(first: Column, last: Column) -> Column:
    """Null when either part is null."""
    return F.concat(first, F.lit(" "), last)


def player_team(is_home: Column, home: Column, away: Column) -> Column:
    return F.when(is_home.cast("int") == 1, home).otherwise(away)


def position_group(position: Column) -> Column:
    """Forwards of any kind become F; G and D stay."""
    return F.when(position.isin("G", "D"), position).otherwise(F.lit("F"))


def position_letter(position: Column) -> Column:
    """First letter upper-cased, kept only when it is F, D or G."""
    letter = F.upper(F.substring(position.cast("string"), 1, 1))
    return F.when(letter.isin("F", "D", "G"), letter)
