"""Landed HTML game reports to tables, with SQL functions only.

A report table has one row per document with an ``html`` column; other columns (``gameId``,
``report_key``, ``team_type``) are carried along. Rows of one document are told apart inside that
document's row, so extraction needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from icetally.functions.arrays import let, running
from icetally.functions.clock import clock_part, jersey_number, mmss_to_seconds, period_number, split_clock, to_int

# Markup of data rows, cells and headings in the reports.
ROW = r"""(?s)<[tT][rR]\b[^>]*\b[cC][lL][aA][sS][sS]\s*=\s*["']?(?:[^"'>]*\s)?(?:oddColor|evenColor)(?=[\s"'>])[^>]*>"""
CELL = r"(?is)<td\b[^>]*>(.*?)</td>"
HEADING = r"""(?is)<td(?!>)\b[^>]*\bclass\s*=\s*["']?[^"'>]*\b%s\b[^>]*>(.*?)</td>"""
POSITIONS = ("C", "L", "R", "D", "G")
ODD = "\u00a0\u2009"


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """(html, path, kind, game): one row per report file; kind is PL, TH, TV, RO, ... from the name."""
    p = F.col("_metadata.file_path")
    name = r"(\d{4})\d{4}/([A-Z]{2})(\d{6})[.]HTM"
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("html"), p.alias("path"),
        F.regexp_extract(p, name, 2).alias("kind"),
        F.concat(F.regexp_extract(p, name, 1), F.regexp_extract(p, name, 3)).try_cast("bigint").alias("gameId"),
    )


def empty_reports(reports: DataFrame) -> DataFrame:
    """Reports without content, which are errors."""
    return reports.where(F.col("html").isNull() | (F.trim("html") == ""))


def _filled(reports: DataFrame) -> DataFrame:
    return reports.where(F.col("html").isNotNull() & (F.trim("html") != ""))


def plain_text(c: Column) -> Column:
    """Entities decoded, odd spaces made plain, ends trimmed."""
    return F.when(_has(c, f"&{ODD}"), _trimmed(_decoded(_spaced(c)))).otherwise(_trimmed(c))


def _spaced(c: Column) -> Column:
    for odd in ("&nbsp;", "&#160;", "&#xA0;", *ODD):
        c = F.replace(c, F.lit(odd), F.lit(" "))
    return c


def _decoded(c: Column) -> Column:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def _has(c: Column, chars: str) -> Column:
    found = F.lit(False)
    for char in chars:
        found = found | F.contains(c, F.lit(char))
    return found


def _trimmed(c: Column) -> Column:
    return F.trim(c, F.lit(" \t\r\n\f\u000b"))


def inner_text(c: Column) -> Column:
    """Text of a piece of markup: every text node trimmed, then joined without separator."""
    def bare(c: Column) -> Column:
        # a run of blanks is looked at from its start only, however long it is
        return F.regexp_replace(c, r"(?<!\s)\s*+<[^>]*+>\s*+", "")

    # most cells hold neither tags nor entities and are only trimmed; texts of tables hold tags, but seldom entities
    return (
        F.when(_has(c, f"&{ODD}"), _trimmed(_decoded(bare(_spaced(c)))))
        .when(_has(c, "<"), _trimmed(bare(c))).otherwise(_trimmed(c))
    )


def _after_first(pieces: Column) -> Column:
    """What follows each separator of a split text."""
    return F.filter(pieces, lambda _, i: i > 0)


def _raw_cells(row: Column) -> Column:
    """Markup inside the cells of a row without nested tables."""
    return F.regexp_extract_all(row, F.lit(CELL), 1)


def _flat_cells(row: Column) -> Column:
    """Cell texts of a row without nested tables."""
    return F.transform(_raw_cells(row), inner_text)


# --- event rows ---------------------------------------------------------------------------------

OPEN, CLOSE, HOLE = "\u0001", "\u0002", "\u0003"


def _table_numbers(pieces: Column) -> Column:
    """For each piece of a text cut at its table marks, the number of the outermost table it lies in; 0 outside.

    A depth counter goes over the pieces, so tables may be nested as deep as they like. A closing mark without
    its opening one belongs to a table around the row and counts as outside.
    """
    def step(s: Column, piece: Column) -> tuple[dict[str, Column], Column]:
        opens, closes = piece == OPEN, piece == CLOSE
        tables = s["tables"] + (opens & (s["depth"] == 0)).cast("int")
        depth = F.greatest(s["depth"] + opens.cast("int") - closes.cast("int"), F.lit(0))
        inside = (depth > 0) | (closes & (s["depth"] > 0))
        return {"depth": depth, "tables": tables}, F.when(inside, tables).otherwise(0)

    return running(pieces, {"depth": F.lit(0), "tables": F.lit(0)}, step, "int")


def _table_pattern(depth: int) -> str:
    """A marked table with tables inside it down to a depth.

    All repetitions are possessive: the text of a table is looked at once a level, and no length of it fills a stack.
    """
    plain = f"[^{OPEN}{CLOSE}]*+"
    table = f"{OPEN}{plain}{CLOSE}"
    for _ in range(depth - 1):
        table = f"{OPEN}{plain}(?:{table}{plain})*+{CLOSE}"
    return table


TABLE = _table_pattern(3)


def _unmarked(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit(OPEN), F.lit("")), F.lit(CLOSE), F.lit(""))


def extract_rows(reports: DataFrame) -> DataFrame:
    """One row per data row of each report: ``seq``, ``cells`` and the nested-table texts ``ice``.

    A row's on-ice lists are tables inside its cells, nested to any depth. Tables are marked by single characters;
    what lies in an outermost table becomes one text, and what is left is cut at the row's own end and split into
    cells. Where a pattern takes out all tables of a row, which leaves no opening mark, they are the outermost ones;
    only rows with deeper or unclosed tables are counted piece by piece.
    """
    kept = [c for c in reports.columns if c != "html"]
    marked = F.regexp_replace(
        F.regexp_replace("chunk", r"(?i)<table\b[^>]*>", OPEN), r"(?i)</table\s*>", CLOSE
    )
    either = f"(?<=[{OPEN}{CLOSE}])|(?=[{OPEN}{CLOSE}])"
    plain = ~F.contains("around", F.lit(OPEN)) & ~F.contains("marked", F.lit(HOLE))
    rows = (
        _filled(reports)
        .select(*kept, F.posexplode(_after_first(F.split("html", ROW))).alias("seq", "chunk"))
        .select(*kept, "seq", F.explode(F.array(marked)).alias("marked"))
        .select(*kept, "seq", "marked", F.explode(F.array(F.regexp_replace("marked", TABLE, HOLE))).alias("around"))
        .select(*kept, "seq", "marked", "around", F.explode(F.array(F.when(~plain, F.split("marked", either)))).alias("pieces"))
        .select(*kept, "seq", "marked", "around", "pieces", F.explode(F.array(
            F.when(F.col("pieces").isNotNull(), _table_numbers(F.col("pieces"))))).alias("of"))
    )
    counted = F.col("of").isNotNull()
    number = lambda i: F.get("of", i)
    first = lambda i: (number(i) > 0) & ((i == 0) | (number(i) != F.coalesce(F.get("of", i - 1), F.lit(0))))
    outside = F.transform("pieces", lambda p, i: F.when(number(i) == 0, F.translate(p, CLOSE, "")).when(first(i), F.lit(HOLE)).otherwise(""))
    around = F.when(counted, F.array_join(outside, "")).otherwise(F.replace(F.col("around"), F.lit(CLOSE), F.lit("")))
    own = F.regexp_replace(around, "(?is)</tr>.*", "")
    rows = rows.select(*kept, "seq", "marked", "pieces", "of", F.explode(F.array(own)).alias("own"))
    # the texts of all tables in one pass: each begins with a mark
    inside = F.transform("pieces", lambda p, i: F.when(number(i) == 0, "").otherwise(
        F.concat(F.when(first(i), F.lit(HOLE)).otherwise(""), F.translate(p, OPEN + CLOSE, ""))))
    tables = F.when(counted, _after_first(F.split(F.array_join(inside, ""), HOLE))).otherwise(
        F.transform(F.regexp_extract_all("marked", F.lit(TABLE), 0), _unmarked))
    tables = F.slice(tables, 1, F.size(F.split("own", HOLE)) - 1)
    cells = F.filter(
        F.regexp_extract_all("own", F.lit(CELL), 1), lambda c: ~F.contains(c, F.lit(HOLE))
    )
    return rows.where(F.col("own").rlike(r"(?i)</td>")).select(
        *kept, F.col("seq").cast("bigint").alias("seq"),
        F.transform(cells, inner_text).alias("cells"),
        F.transform(tables, inner_text).alias("ice"),
    )


def on_ice_text(ice: Column, team: int) -> Column:
    """On-ice text of the away (0) or home (1) team.

    Texts of five characters or less do not count; unless exactly two remain there is none.
    """
    return let(
        F.filter(ice, lambda t: F.length(t) > 5), lambda teams: F.when(F.size(teams) == 2, teams[team])
    )


def on_ice_numbers(text: Column, goalies: bool) -> Column:
    """Jersey numbers of the goalies or of the skaters in a text like ``18C71C7L3D72D35G``."""
    found = F.regexp_extract_all(text, F.lit(r"(\d+)G" if goalies else r"(\d+)[CLRD]"), 1)
    return F.coalesce(found, F.array().cast("array<string>"))


def clean_cells(cells: Column) -> Column:
    """First six cells, padded with empty text."""
    six = F.slice(cells, 1, 6)
    return F.concat(F.transform(six, plain_text), F.array_repeat(F.lit(""), F.lit(6) - F.size(six)))


def event_table(reports: DataFrame) -> DataFrame:
    """Play rows of play-by-play reports with clocks and on-ice jersey lists."""
    kept = [c for c in reports.columns if c != "html"]
    names = ("#", "Per", "Str", "Time:Elapsed Game", "Event", "Description")
    # cells come out of extract_rows cleaned, so only missing ones are left to fill
    rows = extract_rows(reports).select(
        *kept, "seq", *[F.coalesce(F.get("cells", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)],
        on_ice_text(F.col("ice"), 1).alias("home_text"), on_ice_text(F.col("ice"), 0).alias("away_text"),
    )
    clock = split_clock(F.col("Time:Elapsed Game"))
    out = rows.select(
        *kept, "seq", *names,
        on_ice_numbers(F.col("home_text"), False).alias("home_on_ice"),
        on_ice_numbers(F.col("away_text"), False).alias("away_on_ice"),
        on_ice_numbers(F.col("home_text"), True).alias("home_goalie"),
        on_ice_numbers(F.col("away_text"), True).alias("away_goalie"),
        clock["elapsed"].alias("timeInPeriod"), clock["remaining"].alias("timeRemaining"),
    )
    return out.withColumns({
        "timeInPeriodSec": mmss_to_seconds(F.col("timeInPeriod")),
        "timeRemainingSec": mmss_to_seconds(F.col("timeRemaining")),
    })


# --- shift rows ---------------------------------------------------------------------------------


def _player_groups(reports: DataFrame, use: Callable[[Column], Column]) -> DataFrame:
    """One row per shift report: its columns, ``full``, ``team``, ``players`` (headings) and ``groups``.

    A TOT row ends a player's rows; the k-th group of rows belongs to the k-th player heading, groups
    and headings without partner drop out, and of equal headings the last counts. The document is cut into
    rows once; a group begins at a row that is no TOT row and follows one, or none. A group has its ``player_name``
    and in ``lines`` what ``use`` makes of its rows, whose cells are markup still. ``groups`` are null where there is
    no document.
    """
    kept = [c for c in reports.columns if c != "html"]
    # a pattern to split at is compiled for every row, one to replace only once
    cells = F.transform(
        _after_first(F.split("html", ROW)), lambda r: _raw_cells(F.regexp_replace(r, "(?is)</tr>.*", ""))
    )
    docs = reports.select("*", F.explode(F.array(cells)).alias("rows")).select(
        *kept, (F.trim("html") != "").alias("full"), "rows",
        F.transform(F.regexp_extract_all("html", F.lit(HEADING % "playerHeading"), 1), inner_text).alias("players"),
        inner_text(F.regexp_extract("html", HEADING % "teamHeading", 1)).alias("team"),
    )
    total = F.transform("rows", lambda cells: F.coalesce(inner_text(F.get(cells, F.lit(0))) == "TOT", F.lit(False)))

    def begins(total: Column) -> Column:
        return F.filter(
            F.transform(total, lambda t, i: F.when(~t & ((i == 0) | F.get(total, i - 1)), i)), lambda i: i.isNotNull())

    def groups(total: Column, starts: Column) -> Column:
        matched = F.slice("players", 1, F.least(F.size("players"), F.size(starts)))
        # of equal headings the last counts: sorted by name and place it is the one without an equal successor
        by_name = F.array_sort(F.transform(matched, lambda p, k: F.struct(p.alias("p"), k.alias("k"))))
        last = let(by_name, lambda xs: F.array_sort(F.transform(
            F.filter(xs, lambda x, i: F.coalesce(x["p"] != F.get(xs, i + 1)["p"], F.lit(True))), lambda x: x["k"])))

        def lines(start: Column, end: Column) -> Column:
            return use(F.filter(
                F.transform(F.slice("rows", start + 1, end - start), lambda cells, j: F.struct(
                    (start + j).alias("i"), cells.alias("cells"))),
                lambda e: ~F.get(total, e["i"]),
            ))

        return F.transform(last, lambda k: F.struct(
            F.get("players", k).alias("player_name"),
            lines(F.get(starts, k), F.coalesce(F.get(starts, k + 1), F.size("rows"))).alias("lines"),
        ))

    found = let(total, lambda t: let(begins(t), lambda starts: groups(t, starts)))
    return docs.select(*kept, "full", "players", "team", F.explode(F.array(found)).alias("groups"))


def _of_width(lines: Column, width: int) -> Column:
    return F.filter(lines, lambda e: F.size(e["cells"]) == width)


def _shift_groups(reports: DataFrame, width: int) -> DataFrame:
    """Rows of so many cells of shift reports next to the player they belong to (see ``_player_groups``).

    ``seq`` orders the rows of a game: home before away, then part of the report, then place in it.
    """
    kept = [c for c in reports.columns if c != "html"]
    side = F.when(F.col("team_type") == "Home", 0).otherwise(1).cast("bigint") if "team_type" in kept else F.lit(0).cast("bigint")
    part = F.coalesce(F.col("part").cast("bigint"), F.lit(0)) if "part" in kept else F.lit(0).cast("bigint")

    def clean(lines: Column) -> Column:
        return F.transform(_of_width(lines, width), lambda e: F.struct(
            e["i"].alias("i"), F.transform(e["cells"], inner_text).alias("cells")))

    # what all rows of a report or a player share is worked out before they are dealt out
    return _player_groups(_filled(reports), clean).select(
        *kept, (F.shiftleft(side, 60) + F.shiftleft(part, 40)).alias("place"),
        F.when(F.col("team") != "", F.col("team"))
        .otherwise(F.concat(F.lit("Unknown "), F.col("team_type"))).alias("team_name"), F.explode("groups").alias("g"),
    ).select(
        *kept, "place", "team_name", F.col("g.player_name").alias("player_name"),
        jersey_number(F.col("g.player_name")).alias("jersey_number"), F.explode("g.lines").alias("e"),
    ).select(
        *kept, (F.col("place") + F.col("e.i")).alias("seq"), F.col("e.cells").alias("cells"),
        "player_name", "jersey_number", "team_name",
    )


def _clock_part(c: Column, i: int) -> Column:
    return F.when(F.instr(c, "/") > 0, F.split_part(c, F.lit(" / "), F.lit(i)))


def _loose_seconds(c: Column) -> Column:
    return F.when(F.instr(c, ":") > 0, clock_part(c, 1) * 60 + clock_part(c, 2))


def shift_rows(reports: DataFrame) -> DataFrame:
    """One row per shift; ``reports`` carries ``team_type`` (Home / Away)."""
    names = ("shift_number", "period", "start_time_elapsed_game", "end_time_elapsed_game", "duration", "event")
    rows = _shift_groups(reports, 6)
    out = rows.select(
        *[c for c in rows.columns if c != "cells"], *[F.col("cells")[i].alias(n) for i, n in enumerate(names)]
    )
    clocks = {
        f"{end}_time_{what}": _clock_part(F.col(f"{end}_time_elapsed_game"), i + 1)
        for end in ("start", "end") for i, what in enumerate(("in_period", "remaining"))
    }
    return out.withColumns(clocks).withColumns({
        "duration_seconds": _loose_seconds(F.col("duration")),
        "shift_number": to_int(F.col("shift_number")),
        "period_number": period_number(F.col("period")),
        **{f"{c}_seconds": mmss_to_seconds(F.col(c)) for c in clocks},
    })


def shift_summary(reports: DataFrame) -> DataFrame:
    """One row per player and period of the reports' summary tables."""
    names = ("period", "shifts_count", "average_duration", "total_ice_time", "even_strength_total",
             "power_play_total", "short_handed_total")
    rows = _shift_groups(reports, 7)
    out = rows.select(
        *[c for c in rows.columns if c != "cells"], *[F.col("cells")[i].alias(n) for i, n in enumerate(names)]
    )
    return out.withColumns({
        **{f"{c}_seconds": _loose_seconds(F.col(c)) for c in names[2:]},
        "period_number": period_number(F.col("period")),
        "shifts_count": to_int(F.col("shifts_count")),
    })


def parse_report_counts(reports: DataFrame, keys: tuple[str, ...] = ("gameId", "team_type")) -> DataFrame:
    """Players, shifts and summary rows found per report, and whether there was anything to parse."""
    def counted(lines: Column) -> Column:
        return F.struct(F.size(_of_width(lines, 6)).alias("shifts"), F.size(_of_width(lines, 7)).alias("summaries"))

    def sum_of(what: str) -> Column:
        return F.coalesce(F.aggregate("groups", F.lit(0), lambda n, g: n + g["lines"][what]), F.lit(0)).alias(what)

    named = F.lit(True)
    for k in keys:
        named = named & F.col(k).isNotNull()  # rows of reports without a key belong to none
    return _player_groups(reports, counted).select(
        *keys, F.when(F.col("full"), F.size("players")).otherwise(0).alias("players"),
        F.coalesce("full", F.lit(False)).alias("full"), sum_of("shifts"), sum_of("summaries"),
    ).groupBy(*keys).agg(
        F.sum("players").alias("players_count"), F.min("full").alias("parsing_successful"),
        F.sum(F.when(named, F.col("shifts")).otherwise(0)).alias("total_shifts"),
        F.sum(F.when(named, F.col("summaries")).otherwise(0)).alias("total_summary_records"),
    )


# --- roster reports -----------------------------------------------------------------------------


def _section(html: Column, name: str) -> Column:
    """Markup inside the element with this id, nested elements of its tag included; null when absent."""
    marker = rf"""\bid\s*=\s*["']?{name}\b["']?"""
    tag = F.regexp_extract(html, rf"(?i)<([a-z]+)\b[^>]*{marker}", 1)
    after = F.get(F.split(html, f"(?i){marker}", 2), F.lit(1))
    pieces = F.split(after, F.concat(F.lit("(?i)</"), tag, F.lit(r"\s*>")))
    opening = F.concat(F.lit("(?i)<"), tag, F.lit(r"\b"))
    start = F.struct(F.lit(1), F.lit(0)).cast("struct<depth:int,n:int>")
    closed = F.aggregate(
        pieces, start,
        lambda s, p: F.when(s["depth"] <= 0, s).otherwise(
            F.struct(
                (s["depth"] + F.size(F.split(p, opening)) - 2).alias("depth"), (s["n"] + 1).alias("n")
            ).cast("struct<depth:int,n:int>")
        ),
        lambda s: s["n"],
    )
    return F.when(tag != "", F.array_join(
        F.transform(F.slice(pieces, 1, closed), lambda p: F.concat(p, F.lit("</"), tag, F.lit(">"))), ""
    ))


def _tables(html: Column) -> Column:
    """Innermost tables in document order, as markup."""
    return F.transform(
        _after_first(F.split(html, r"(?i)<table\b[^>]*>")), lambda t: F.split(t, "(?i)</table>").getItem(0)
    )


def _rows(table: Column) -> Column:
    return _after_first(F.split(table, r"(?i)<tr\b[^>]*>"))


def _players(table: Column, name_length: int = 1) -> Column:
    """(number, position, name) rows of a table."""
    cells = F.transform(_rows(table), _flat_cells)
    good = F.filter(
        cells,
        lambda c: (F.size(c) == 3) & F.get(c, F.lit(0)).rlike(r"^\d+$") & F.get(c, F.lit(1)).isin(*POSITIONS)
        & (F.length(F.get(c, F.lit(2))) >= name_length),
    )
    return F.transform(good, lambda c: F.struct(c[0].alias("number"), c[1].alias("position"), c[2].alias("name")))


def report_rosters(reports: DataFrame, min_player_rows: int = 15) -> DataFrame:
    """(team_type, status, seq, number, position, name, is_goalie): dressed players and scratches.

    The first table with a Pos/Name header and enough player rows is the away team, the second the home
    team; likewise for the two scratch tables.
    """
    kept = [c for c in reports.columns if c != "html"]
    dressed = F.filter(
        _tables(F.col("html")),
        lambda t: t.rlike(r"(?s)Pos.*Name") & (F.size(_players(t, 4)) >= min_player_rows),
    )
    scratched = _tables(F.coalesce(_section(F.col("html"), "Scratches"), F.lit("")))

    def listed(tables: str, i: int, team: str, status: str) -> Column:
        table = F.coalesce(F.get(tables, F.lit(i)), F.lit(""))
        return F.transform(
            _players(table),
            lambda p, n: F.struct(
                F.lit(team).alias("team_type"), F.lit(status).alias("status"), n.alias("seq"),
                p["number"].alias("number"), p["position"].alias("position"), p["name"].alias("name"),
            ),
        )

    docs = _filled(reports).select(*kept, dressed.alias("dressed"), scratched.alias("scratched"))
    everyone = F.concat(
        listed("dressed", 0, "Away", "roster"), listed("dressed", 1, "Home", "roster"),
        listed("scratched", 0, "Away", "scratch"), listed("scratched", 1, "Home", "scratch"),
    )
    return docs.select(*kept, F.explode(everyone).alias("p")).select(*kept, "p.*").withColumn(
        "is_goalie", (F.col("position") == "G").cast("int")
    )


def report_coaches(reports: DataFrame) -> DataFrame:
    """(away_coach, home_coach) per roster report."""
    kept = [c for c in reports.columns if c != "html"]
    cells = F.filter(
        _flat_cells(F.coalesce(_section(F.col("html"), "HeadCoaches"), F.lit(""))), lambda t: F.length(t) > 1
    )
    return _filled(reports).select(
        *kept, F.coalesce(F.get(cells, F.lit(0)), F.lit("")).alias("away_coach"),
        F.coalesce(F.get(cells, F.lit(1)), F.lit("")).alias("home_coach"),
    )


def report_officials(reports: DataFrame) -> DataFrame:
    """(section, seq, name): referees, linesmen and standby officials, lower-cased.

    A header row starts a section; the rows up to the next header belong to it.
    """
    kept = [c for c in reports.columns if c != "html"]
    texts = F.transform(_rows(F.coalesce(_section(F.col("html"), "Officials"), F.lit(""))),
                        lambda r: F.lower(inner_text(r)))

    def section(t: Column) -> Column:
        return (
            F.when(F.instr(t, "referee") > 0, F.lit("referees"))
            .when(t.rlike("linesm[ae]n"), F.lit("linesmen"))
            .when(F.instr(t, "standby") > 0, F.lit("standby"))
        )

    docs = _filled(reports).select(
        *kept, F.transform(texts, lambda t, i: F.struct(i.alias("pos"), t.alias("t"), section(t).alias("head"))).alias("rows")
    ).withColumn("heads", F.filter("rows", lambda r: r["head"].isNotNull()))
    return (
        docs.select(*kept, "heads", F.explode("rows").alias("r"))
        .where(F.col("r.head").isNull() & (F.col("r.t") != ""))
        .withColumn("last_head", F.try_element_at(F.filter("heads", lambda h: h["pos"] < F.col("r.pos")), F.lit(-1)))
        .where(F.col("last_head").isNotNull())
        .select(*kept, F.col("last_head.head").alias("section"), F.col("r.pos").alias("seq"), F.col("r.t").alias("name"))
    )


def report_game_info(reports: DataFrame) -> DataFrame:
    """Date, attendance, venue, start and end of roster reports; texts that do not parse stay as they are.

    Labelled rows are kept in ``labels`` (snake-case keys); without any, the fourth to sixth row of the
    table hold date, attendance and venue, and times.
    """
    kept = [c for c in reports.columns if c != "html"]
    section = F.coalesce(_section(F.col("html"), "GameInfo"), F.lit(""))
    docs = _filled(reports).select(*kept, F.transform(_rows(section), _flat_cells).alias("rows"))
    labelled = F.filter(
        "rows",
        lambda c: (F.size(c) >= 2) & (F.get(c, F.lit(0)) != "") & (F.get(c, F.lit(1)) != ""),
    )
    entries = F.transform(
        labelled, lambda c: F.struct(F.replace(F.lower(c[0]), F.lit(" "), F.lit("_")).alias("k"), c[1].alias("v"))
    )
    docs = docs.withColumn("entries", entries)

    def field(key: str, row: int) -> Column:
        found = F.try_element_at(F.filter("entries", lambda e: e["k"] == key), F.lit(-1))["v"]
        plain = F.get(F.get("rows", F.lit(row)), F.lit(0))
        return F.when(F.size("entries") > 0, found).otherwise(plain)

    docs = docs.withColumns({"date_raw": field("date", 3), "place": field("attendance_venue", 4), "times": field("start_end", 5)})
    days = "Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday"
    date_text = F.regexp_extract("date_raw", rf"^(?:{days}), (\w+ \d{{1,2}}, \d{{4}})$", 1)
    docs = docs.withColumn("day", F.to_date(F.try_to_timestamp(date_text, F.lit("MMMM d, yyyy"))))

    def words(c: Column) -> Column:
        return F.filter(F.split(c, r"\s+"), lambda w: w != "")

    def from_word(c: Column, word: str) -> Column:
        """The words of a text behind the first one that equals `word`, whatever its case; none without it."""
        return let(words(c), lambda ws: let(F.array_position(F.transform(ws, F.lower), word).cast("int"), lambda at: F.when(
            at > 0, F.slice(ws, at + 1, F.size(ws))).otherwise(F.array().cast("array<string>"))))

    def filled(c: Column) -> Column:
        return F.when(c != "", c)

    docs = docs.withColumns({
        "attendance": filled(F.regexp_replace(F.get(from_word(F.col("place"), "attendance"), F.lit(0)), "[^0-9]", "")),
        "venue": filled(F.array_join(from_word(F.col("place"), "at"), " ")),
        **{
            # times stand apart by semicolons, each behind its name
            f"{end}_time_raw": F.array_max(F.transform(
                F.split("times", ";"), lambda t: filled(F.array_join(from_word(t, end), " "))))
            for end in ("start", "end")
        },
    })
    for end in ("start", "end"):
        raw = f"{end}_time_raw"
        ws = F.split(raw, " ")
        clock = F.split(F.get(ws, F.lit(0)), ":")
        hour, minute = to_int(F.get(clock, F.lit(0))), to_int(F.get(clock, F.lit(1)))
        after = F.upper(F.coalesce(F.get(ws, F.lit(1)), F.lit("")))
        half = F.when(after.isin("AM", "PM"), after).otherwise("")
        is_clock = (F.size(clock) == 2) & hour.isNotNull() & minute.isNotNull()
        h24 = (
            F.when((half == "") & hour.between(0, 23), hour)
            .when((half == "AM") & hour.between(1, 12), hour % 12)
            .when((half == "PM") & hour.between(1, 12), hour % 12 + 12)
        )
        valid = h24.isNotNull() & minute.between(0, 59)
        hhmm = F.concat(F.lpad(h24.cast("string"), 2, "0"), F.lit(":"), F.lpad(minute.cast("string"), 2, "0"), F.lit(":00"))
        full = F.when(F.col("day").isNotNull(), F.concat(F.col("day").cast("string"), F.lit("T"), hhmm)).otherwise(hhmm)
        zone = F.coalesce(F.when(half == "", F.get(ws, F.lit(1))).otherwise(F.get(ws, F.lit(2))), F.lit(""))
        docs = docs.withColumns({
            f"{end}_time": F.when(valid, full).when(is_clock, F.col(raw)),
            f"{end}_timezone": F.when(valid & (zone != ""), zone),
        })
    return docs.select(
        *kept,
        F.coalesce(F.concat(F.col("day").cast("string"), F.lit("T00:00:00")), F.col("date_raw")).alias("date"),
        "date_raw", "attendance", "venue", "start_time_raw", "start_time", "start_timezone",
        "end_time_raw", "end_time", "end_timezone",
        F.when(F.size("entries") > 0, F.transform("entries", lambda e: F.concat(e["k"], F.lit("="), e["v"])))
        .otherwise(F.array().cast("array<string>")).alias("labels"),
    )
