"""License scans against a plain search by edit distance and a plain search for phrases."""

from __future__ import annotations

import random
import re

from icetally.llm import licenses, queries

from .helpers import LONG, LOWER, changed, empty, frame, kept_clashes, odd_rows


def least_edits(wording: str, text: str) -> int:
    """Edits of wording to the nearest part of text."""
    last = list(range(len(wording) + 1))
    best = last[-1]
    for c in text:
        now = [0]
        for i, x in enumerate(wording, 1):
            now.append(min(last[i] + 1, now[-1] + 1, last[i - 1] + (x != c)))
        last = now
        best = min(best, now[-1])
    return best


def joined_words(text: str) -> tuple[list[str], str]:
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
    return words, f" {' '.join(words)} "


def base(text: str):
    words, _ = joined_words(text)
    found = [(label, i) for phrase, label in licenses.BASE for i in range(len(words))
             if words[i : i + len(phrase.split())] == phrase.split()]
    at = [i for _, i in found]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for x, _ in found}))


def test_seeds_miss_nothing():
    """A notice is found if and only if a part of the text is near enough, with the least number of edits."""
    rng, searcher = random.Random(12), licenses._searcher(licenses.NOTICES)
    for _ in range(120):
        n = rng.randrange(len(licenses.NOTICES))
        near = "".join(changed(rng, list(licenses.NOTICES[n][1]), rng.randint(0, searcher.allowed[n] + 2), "abe tr"))
        _, text = joined_words(f"some words before {near} and after it the licensed end")
        found = searcher.matches(text)
        for q, (_, wording) in enumerate(licenses.NOTICES):
            edits = min((m.edits for m in found if m.notice == q), default=None)
            true = least_edits(wording, text)
            assert edits == (true if true <= searcher.allowed[q] else None)
        for m in found:
            assert least_edits(licenses.NOTICES[m.notice][1], text[m.start : m.end]) <= m.edits


def test_seed_ranges():
    for length in (3, 24, 97):
        for k in (1, 2, 5):
            found = list(licenses.seeds(length, k))
            assert len(found) == k + 1 and found[0][0] == 0 and found[-1][1] == length
            assert all(a[1] == b[0] for a, b in zip(found, found[1:]))


def test_spans_and_overlaps(spark):
    rows = [
        (1, "x\n# Licensed under the Apache\n#   License, Version 2.0.\nmore"),
        (2, "Licensed under CC BY-SA 4.0. And: licensed under CC-BY-NC 4.0!"),
        (3, "Releasd undr the MTI License, no more. RELEASED UNDER THE MIT LICENSE"),
        (4, "Die Lizenz; mit License, apache-license, the General\n\nPublic  (License) mit license mit LICENSE."),
        (5, "limit license, mit licenses, apache licence"),
    ]
    found = {r.doc_id: r for r in licenses.scan(frame(spark, rows)).collect()}

    def spans(i):
        return [(n.label, rows[i - 1][1][n.start : n.end], n.edits) for n in found[i].notices]

    assert spans(1) == [("apache", "Licensed under the Apache\n#   License, Version 2.0", 0)]
    assert spans(2) == [("cc-by-sa", "Licensed under CC BY-SA 4.0", 0), ("cc-by-nc", "licensed under CC-BY-NC 4.0", 0)]
    assert [(x[0], x[2]) for x in spans(3)] == [("mit", 0)] and found[3].labels == "mit"
    assert [(p.label, p.word) for p in found[4].places] == [("mit", 2), ("mit", 10), ("mit", 12), ("apache", 4), ("gpl", 7)]
    assert (found[4].labels, found[4].score) == ("apache,gpl,mit", 0.5)
    assert (found[5].labels, found[5].score) == ("", 0.0)
    one = licenses.scan(frame(spark, [(1, "This is fre and unencumbred software, released into the public-domain")])).first()
    assert one.notices[0].edits == 2 and one.base_labels == "" and one.labels == "unlicense" and 0.5 < one.score < 1
    assert licenses.scan(frame(spark, [(1, "released under the mit license")])).first().score == 1


def test_many_places_in_one_text():
    text = "Licensed under the Apache License, Version 2.0. MIT license. " * 20_000
    found = licenses.scan_text(text)
    assert len(found["notices"]) == 20_000 and len(found["places"]) == 40_000
    assert found["notices"][-1]["end"] == len(text) - len(". MIT license. ")


def test_query(spark, tmp_path):
    rows = [*odd_rows(), (20, "MIT License " * 3), (21, "ſ K MIT\x85License mit license MIT license " + LONG)]
    frame(spark, rows, clashes=True).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.QUERIES["op12_license_scan"](spark, str(tmp_path))
    got = sorted(repr((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in found.collect())
    assert got == sorted(repr((i, *base(t or ""))) for i, t in rows)
    assert kept_clashes(licenses.scan(frame(spark, rows, clashes=True)).collect())
    none = licenses.scan(frame(spark, [(1, None), (2, ""), (3, " .. ")])).collect()
    assert all((r.n_words, r.places, r.notices, r.labels, r.score) == (0, [], [], "", 0.0) for r in none)
    assert licenses.scan(empty(spark, True)).collect() == []
