"""Quality discriminant, fertility rules, lattice likelihood."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from icetally.llm import fertility, lattice, quality
from icetally.llm.common import remainder

from .helpers import LONG, LOWER, WORD, empty, frame, kept_clashes, odd_rows


def labelled(spark, n=400):
    rng, rows, labels = random.Random(9), [], []
    for i in range(n):
        words = ["".join(rng.choice("aeionrst") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(20, 90))]
        good = i % 5 != 3
        rows.append((i, " ".join(words) + "." if good else " ".join(w.upper() + "!!" for w in words[:9] * 4)))
        labels.append((i, int(good), 0))
    return rows, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_discriminant_on_held_out_rows(spark):
    rows, labels = labelled(spark)
    docs = frame(spark, rows + [(1000, None), (1001, "")], clashes=True)
    model = quality.fit(docs, labels, remainder(F.col("doc_id")) != 0)
    got = quality.score(docs, model).collect()
    assert kept_clashes(got) and len(got) == len(rows) + 2
    scores = {r.doc_id: r.score_1 for r in got}
    assert all(0 <= s <= 1 for s in scores.values())
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((scores[i] >= quality.THRESHOLD) == (i % 5 != 3) for i in held) / len(held) > 0.97
    assert {r.doc_id for r in quality.good(docs, labels).collect()} >= {i for i, _ in rows if i % 5 != 3}


def test_labels_are_not_learned_from_held_out_rows(spark):
    rows, labels = labelled(spark)
    other = labels.withColumn("quality", F.when(remainder(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.fit(frame(spark, rows), x, remainder(F.col("doc_id")) != 0) for x in (labels, other))
    assert np.allclose(a.means, b.means) and np.allclose(a.factors, b.factors)


def test_discriminant_without_labels(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    model = quality.fit(frame(spark, odd_rows()), none, F.lit(True))
    assert [r.score for r in quality.score(frame(spark, odd_rows()), model).collect()] == [0.5] * len(odd_rows())
    one = spark.createDataFrame([(1, 1), (1, 1), (5, None), (9, 1), (9, 0)], "doc_id bigint, quality int")
    model = quality.fit(frame(spark, odd_rows()), one, F.lit(True))
    assert all(abs(r.score - 2 / 3) < 1e-9 for r in quality.score(frame(spark, odd_rows()), model).collect())
    assert quality.score(empty(spark, True), model).collect() == []


def brute_counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, c in Counter(windows).items() if c > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines, dup = (text or "").split("\n"), 0
    for i, x in enumerate(lines):
        dup += bool(WORD.search(x)) and x in lines[:i]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_fertility_counts(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["a", "b", "c#", "<d>", "e\n", "\n"]) for _ in range(rng.randint(0, 70)))) for i in range(150)] + odd_rows()
    docs = frame(spark, rows, clashes=True).withColumn("lang", F.lit(None).cast("string"))
    got = fertility.judge(docs).collect()
    assert kept_clashes(got)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((-1 if r.doc_id is None else r.doc_id, *(r[n] for n in names)) for r in got) == sorted((i if i is not None else -1, *brute_counts(t)) for i, t in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    assert fertility.judge(empty(spark, True)).collect() == []


def test_fertility_measures():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(120)]
    per_token, fallback, entropy = fertility.fertility(words)
    model = fertility._vocabulary(fertility.VOCABULARY)[0]
    ids = [i for w in words for i in model.encode(w)]
    assert math.isclose(per_token, 720 / len(ids)) and fallback == sum(model.is_byte(i) for i in ids) / len(ids)
    assert math.isclose(entropy, -sum(c / len(ids) * math.log2(c / len(ids)) for c in Counter(ids).values()) / math.log2(len(ids)))
    assert fertility.fertility(["؁؂"])[1] > 0 and fertility.fertility([]) == (0.0, 0.0, 0.0)
    assert fertility.script("Привет мир") == "cyrillic" and fertility.script("日本語") == "cjk" and fertility.script("hello") == "latin"


PROSE = {
    "en": (
        "The committee met on Tuesday to discuss the new proposals for the library. Most of the members agreed that the"
        " building needed repairs before winter, although nobody could say where the money would come from. A retired "
        "teacher offered to organise a sale of used books, and several parents promised to bring cakes. In the end they"
        " decided to write to the council once more and to ask the local newspaper for help with the campaign, because "
        "people in the town still read it every morning."
    ),
    "de": (
        "Am Dienstag traf sich der Ausschuss, um über die neuen Vorschläge für die Bibliothek zu sprechen. Die meisten "
        "Mitglieder waren der Meinung, dass das Gebäude noch vor dem Winter repariert werden müsse, obwohl niemand "
        "sagen konnte, woher das Geld kommen sollte. Eine pensionierte Lehrerin bot an, einen Verkauf gebrauchter "
        "Bücher zu organisieren, und mehrere Eltern versprachen, Kuchen mitzubringen. Schließlich beschlossen sie, noch"
        " einmal an die Gemeinde zu schreiben."
    ),
    "fr": (
        "Le comité s'est réuni mardi pour discuter des nouvelles propositions concernant la bibliothèque. La plupart "
        "des membres pensaient que le bâtiment devait être réparé avant l'hiver, mais personne ne savait d'où viendrait"
        " l'argent. Une institutrice à la retraite a proposé d'organiser une vente de livres d'occasion, et plusieurs "
        "parents ont promis d'apporter des gâteaux. Finalement, ils ont décidé d'écrire encore une fois à la mairie et "
        "de demander l'aide du journal local."
    ),
    "es": (
        "El comité se reunió el martes para hablar de las nuevas propuestas sobre la biblioteca. La mayoría de los "
        "miembros pensaba que el edificio necesitaba reparaciones antes del invierno, aunque nadie sabía de dónde "
        "vendría el dinero. Una maestra jubilada se ofreció a organizar una venta de libros usados y varios padres "
        "prometieron llevar pasteles. Al final decidieron escribir otra vez al ayuntamiento y pedir ayuda al periódico "
        "local, porque la gente del pueblo todavía lo lee."
    ),
}


def test_ordinary_prose_is_kept(spark):
    rng = random.Random(12)
    junk = " ".join("".join(rng.choice("0123456789{}=؁؂") for _ in range(9)) for _ in range(80))
    rows = [(k, lang, t) for k, t in PROSE.items() for lang in (k, None)] + [("junk", lang, junk) for lang in PROSE]
    docs = spark.createDataFrame(rows, "doc_id string, lang string, text string")
    got = [(r.doc_id, r.lang, r.kept) for r in fertility.judge(docs).collect()]
    assert sorted(got, key=str) == sorted(((k, lang, k != "junk") for k, lang, _ in rows), key=str)


def brute_word(word, pieces, in_bytes):
    """Summed probability over all segmentations, by plain recursion."""
    s = lattice.MARK + word

    def rest(i):
        if i == len(s):
            return 1.0
        total = sum(math.exp(pieces[s[i:j]]) * rest(j) for j in range(i + 1, len(s) + 1) if s[i:j] in pieces)
        if s[i] not in pieces:
            total += math.exp(sum(in_bytes[b] for b in s[i].encode())) * rest(i + 1)
        return total

    return math.log10(rest(0))


def test_lattice_sums_all_segmentations():
    pieces, in_bytes, _ = lattice.piece_scores({300: 50, 400: 7, 5000: 3}, 4, lattice.VOCABULARY)
    for word in ("a", "reading", "Ciónes", "zzz؁z", "😀b"):
        want = brute_word(word, pieces, in_bytes)
        assert math.isclose(lattice.word_score(word.encode(), pieces, in_bytes, max(map(len, pieces))), want, rel_tol=1e-9)


def test_lattice_scores(spark):
    rows = [r for r in odd_rows() if r[0] != 5] + [(20, LONG[:4000]), (21, "the cat the cat"), (24, "unseen words here")]
    tokens = {i: WORD.findall((t or "").translate(LOWER)) for i, t in rows}
    rest = {i: (zlib.crc32(str(i).encode()) % 5 if i is not None else -1) for i, _ in rows}
    counts, ends = Counter(), 0
    for i, _ in rows:
        if rest[i] != 1:
            counts.update(tokens[i])
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    for frequent in (3, 50_000):
        got = lattice.score(frame(spark, rows, clashes=True), frequent=frequent).collect()
        assert len(got) == len(rows)
        for r in got:
            words = tokens[r.doc_id]
            base = sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in [*(counts[w] for w in words), ends])
            assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.train_tokens == n
            assert (r.held_out, r.n_tokens, r.n_known) == (rest[r.doc_id] == 1, len(words) + 1, sum(counts[w] > 0 for w in words) + 1)
            assert r.score < 0
    assert lattice.score(empty(spark)).collect() == []
