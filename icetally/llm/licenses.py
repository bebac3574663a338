"""License scans by fuzzy search for short notices (operator 12).

A text is reduced to its words in lower case, joined by single blanks, so that line breaks, comment marks and punctuation
inside a notice do not count. A notice of n characters may be found with up to n / EDIT_EVERY edits. It is split into one
seed more than that: by the pigeonhole principle one of them stands unchanged in every place that is near enough. One
automaton finds the seeds of all notices in one pass over the whole text; what the notice has before and after a seed is
verified by regular expressions with bounded errors, which also report edits and span. Where found notices overlap,
the one with the smaller share of edits stays (then the longer, the first label, the first place).

Beside that, base phrases are looked for word for word. Everything happens inside the row; nothing is shuffled.

Defined results: a null or empty text, or one without words, has no words, places, notices or labels and a score of 0;
repeated rows are scanned each; an empty table gives an empty table; other columns stay, clashing outputs take free
names. Spans are code points of the text as given, end exclusive, from the first to the last word that a match touches.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, free_name, text_of

#: What a word is, the base phrases and their labels.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Wordings of public licenses as their words in lower case.
NOTICES = (
    ("agpl", "under the terms of the gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("boost", "distributed under the boost software license version 1 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "dedicated to the public domain under the creative commons zero"),
    ("epl", "the terms of the eclipse public license"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "released under the mit license"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", "this software is provided as is without any express or implied warranty"),
)
#: One edit (a character added, taken out or changed) is allowed for so many characters of a notice.
EDIT_EVERY = 12
#: Sides of seeds whose verdict a worker remembers; it starts afresh beyond that.
REMEMBERED = 50_000

_WORDS = re.compile(WORD)
_LOWER = str.maketrans(UPPER, LOWER)


class Match(NamedTuple):
    """A notice at characters start to end of the joined words."""

    notice: int
    start: int
    end: int
    edits: int


class Searcher:
    """Seeds of all notices in one automaton, and expressions with bounded errors for what surrounds a seed."""

    def __init__(self, notices: tuple[tuple[str, str], ...]) -> None:
        self.notices = notices
        self.allowed = [max(1, len(text) // EDIT_EVERY) for _, text in notices]
        self.remembered: dict[tuple, tuple[int, int] | None] = {}
        places: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text) in enumerate(notices):
            for start, end in seeds(len(text), self.allowed[n]):
                places.setdefault(text[start:end], []).append((n, start))
        self.automaton = ahocorasick.Automaton()
        for seed, found in places.items():
            self.automaton.add_word(seed, (len(seed), found))
        self.automaton.make_automaton()

    def matches(self, joined: str) -> set[Match]:
        """The best match around every seed that occurs.

        The edits of a match lie before or after the seed that they leave unchanged, so both sides are verified apart:
        the shorter expressions, tied to the seed, are far quicker than one for the whole notice.
        """
        found = set()
        for last, (length, places) in self.automaton.iter(joined):
            start, end = last + 1 - length, last + 1
            for n, offset in places:
                text, k = self.notices[n][1], self.allowed[n]
                before = self._side(text[:offset], k, joined[max(0, start - offset - k) : start], True)
                if before is None:
                    continue
                rest = text[offset + length :]
                after = self._side(rest, k - before[1], joined[end : end + len(rest) + k], False)
                if after is not None:
                    found.add(Match(n, start - before[0], end + after[0], before[1] + after[1]))
        return found

    def _side(self, wording: str, edits: int, context: str, before: bool) -> tuple[int, int] | None:
        """Characters and edits of the best match of wording at the end (before a seed) or the start of context."""
        if not wording:
            return 0, 0
        key = wording, edits, context, before
        if key not in self.remembered:
            if len(self.remembered) >= REMEMBERED:
                self.remembered.clear()
            m = _bounded(wording, edits, before).search(context)
            self.remembered[key] = (len(m.group()), sum(m.fuzzy_counts)) if m else None
        return self.remembered[key]

    def apart(self, matches: Iterable[Match]) -> list[Match]:
        """The matches without those that overlap a better one, in order of place."""

        def rank(m: Match):
            label, text = self.notices[m.notice]
            return m.edits / len(text), -len(text), label, m.start, m.end, m.notice

        kept: list[tuple[int, int, Match]] = []
        for m in sorted(matches, key=rank):
            i = bisect_left(kept, (m.start, m.end))
            if (i == 0 or kept[i - 1][1] <= m.start) and (i == len(kept) or kept[i][0] >= m.end):
                kept.insert(i, (m.start, m.end, m))
        return [m for _, _, m in kept]


def seeds(length: int, edits: int) -> Iterator[tuple[int, int]]:
    """edits + 1 neighbouring ranges of nearly equal length: as many edits leave one of them unchanged."""
    n = edits + 1
    for i in range(n):
        yield length * i // n, length * (i + 1) // n


@lru_cache(maxsize=4096)
def _bounded(wording: str, edits: int, before: bool) -> regex.Pattern:
    """Best match of wording with at most so many errors, tied to the end or the start of what it is searched in."""
    body = f"(?:{regex.escape(wording, literal_spaces=True)}){{e<={edits}}}"
    return regex.compile(f"(?b){body}\\Z" if before else f"(?b)\\A{body}")


@lru_cache(maxsize=4)
def _searcher(notices: tuple[tuple[str, str], ...]) -> Searcher:
    return Searcher(notices)


def lowered(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_LOWER)


def phrase_places(joined: str) -> list[tuple[str, int]]:
    """label and first word (from 0) of every place of a base phrase, in order of phrase and place.

    joined: the words with one blank between them and at both ends.
    """
    out = []
    for phrase, label in BASE:
        wanted, word, last = f" {phrase} ", 0, 0
        at = joined.find(wanted)
        while at >= 0:
            word += joined.count(" ", last, at)
            last = at
            out.append((label, word))
            at = joined.find(wanted, at + 1)
    return out


def scan_text(text: str, notices: tuple[tuple[str, str], ...] = NOTICES) -> dict:
    """The fields of `scan` for one text."""
    low = lowered(text)
    found = _WORDS.findall(low)
    joined = f" {' '.join(found)} "
    places = phrase_places(joined)
    searcher = _searcher(notices)
    best = searcher.apart(searcher.matches(joined))
    spans = []
    if best:
        bounds = [m.span() for m in _WORDS.finditer(low)]
        word, last = 0, 0
        for m in best:
            word += joined.count(" ", last, m.start)
            last = m.start
            # a match that begins with a blank begins with the word after it, one that ends with one with the word before
            first = word if joined[m.start] == " " else word - 1
            final = first + len(joined[m.start : m.end].split()) - 1
            label, wording = notices[m.notice]
            spans.append({"label": label, "start": bounds[first][0], "end": bounds[final][1], "edits": m.edits,
                          "length": len(wording)})
    base = sorted({label for label, _ in places})
    closeness = max((1 - s["edits"] / (s["length"] // EDIT_EVERY + 1) for s in spans), default=0.0)
    return {
        "n_words": len(found),
        "places": [{"label": label, "word": word} for label, word in places],
        "notices": spans,
        "base_labels": ",".join(base),
        "labels": ",".join(sorted({*base, *(s["label"] for s in spans)})),
        "score": 0.5 * bool(places or spans) + 0.5 * closeness,
    }


_PLACES = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
_NOTICES = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                               ("edits", pa.int32()), ("length", pa.int32())]))
_FIELDS = {
    "n_words": ("bigint", pa.int64()),
    "places": ("array<struct<label: string, word: bigint>>", _PLACES),
    "notices": ("array<struct<label: string, start: bigint, end: bigint, edits: int, length: int>>", _NOTICES),
    "base_labels": ("string", pa.string()),
    "labels": ("string", pa.string()),
    "score": ("double", pa.float64()),
}


def scan(docs: DataFrame, text: str = "text", notices: tuple[tuple[str, str], ...] = NOTICES) -> DataFrame:
    """docs with n_words, places of base phrases, notices (label, span, edits), base_labels, labels and score.

    score: 0 without any find, 0.5 for a base phrase, and up to 1 the fewer of the allowed edits the nearest notice has.
    """

    @F.arrow_udf("struct<" + ", ".join(f"{k}: {v}" for k, (v, _) in _FIELDS.items()) + ">")
    def scanned(texts: pa.Array) -> pa.Array:
        rows = [scan_text(x.as_py(), notices) for x in texts]
        return pa.StructArray.from_arrays(
            [pa.array([r[k] for r in rows], kind) for k, (_, kind) in _FIELDS.items()], names=list(_FIELDS))

    packed = free_name(docs, "scanned")
    found = docs.withColumn(packed, scanned(text_of(text)))
    return found.withColumns({free_name(docs, f): F.col(f"{packed}.{f}") for f in _FIELDS}).drop(packed)
