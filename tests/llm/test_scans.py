"""Personal data and secrets, against the patterns run by Python."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from icetally.llm import pii, secret_scan, spans

from .helpers import empty, frame, kept_clashes, odd_rows

PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SECRETS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def luhn(digits: str) -> bool:
    back = [int(c) for c in reversed(digits)]
    return sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(back)) % 10 == 0


def valid(kind, m):
    digits = re.sub("[^0-9]", "", m[0])
    return {
        "email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
        "card": lambda: 14 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 10 <= len(digits) <= 15,
        "assign": lambda: len(m[1]) >= 8, "access": lambda: len(m[0]) >= 16, "hex": lambda: len(m[0]) >= 32,
    }[kind]()


def brute(text, patterns):
    found = [(m.start(), r, m.end(), k) for r, (k, p) in enumerate(patterns.items()) for m in re.finditer(p, text or "") if valid(k, m)]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def noisy(alphabet, seed, n=400):
    rng = random.Random(seed)
    return [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))) for i in range(n)]


CARD = "4539578763621486"


def test_base_personal_data_matches(spark):
    rows = noisy(list("ab1.@-+ _%") + ["é", "😀", "255.", "10.0.0.1", CARD, "+1 (555) 123-4567", "a@b.co"], 2) + odd_rows()
    got = pii.redactions(frame(spark, rows)).select("doc_id", spans.listed(F.col("base_spans")).alias("s")).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.s) for r in got) == sorted((i if i is not None else -1, brute(t, PII)) for i, t in rows)


def test_added_personal_data(spark):
    """A phone number that runs into a card number is lost to the base rules; the trees bring both back."""
    rng = random.Random(4)
    rows = []
    for i in range(600):
        body = rng.choice([f"call +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} now", f"pay {CARD} today", "nothing 12345 here",
                           f"ref {rng.randint(10**12, 10**13)} and {rng.randint(100, 999)} {rng.randint(100, 999)} {rng.randint(1000, 9999)}"])
        rows.append((i, f"é {body} end"))
    glued = f"x +1 (212) 555-0199 {CARD} y"
    rows.append((1000, glued))
    got = {r.doc_id: r for r in pii.redactions(frame(spark, rows)).withColumns({"b": spans.listed(F.col("base_spans")), "s": spans.listed(F.col("spans"))}).collect()}
    assert got[1000].b == "" and got[1000].s == "phone:2:19,card:20:36"
    for i, text in rows[:600]:
        assert set(filter(None, got[i].b.split(","))) <= set(got[i].s.split(","))
        if "nothing" in text:
            assert got[i].s == ""
    hidden = frame(spark, [(1, glued)]).withColumn("spans", F.array(F.struct(F.lit(2).alias("start"), F.lit(19).alias("end"))))
    assert hidden.select(pii.masked(hidden)).first()[0] == "x " + "█" * 17 + f" {CARD} y"


FORMATS = {  # text with a span in bars, and its kind
    "email": ["write |ann.lee{i} (at) mail{i} (dot) example (dot) org|. Then", "or |bob{i}[at]host.example[dot]net| now"],
    "ip": ["host |10[.]{j}[.]0[.]7| is up", "from |192[.]168[.]{j}[.]1|, again"],
    "card": ["old |4222222222222| left", "card |4111.1111.1111.1111| left"],
    "phone": ["ring |(0{j}) 555-0199|, or", "ring |212-555-{n}|, or"],
}


@pytest.mark.parametrize("times", [1, 15, 150])
def test_other_formats_however_many(spark, times):
    rows, want = [], {}
    for i in range(times):
        for kind, texts in FORMATS.items():
            for text in texts:
                head, value, tail = text.format(i=i, j=100 + i % 100, n=1000 + i).split("|")
                want[len(rows)] = f"{kind}:{len(head)}:{len(head) + len(value)}"
                rows.append((len(rows), head + value + tail))
    for i in range(3 * times):  # what the base rules find, and what is none
        for text in (f"a{i}@b.co", f"10.0.0.{i % 256}", f"card {CARD}", f"+1 212 555 {1000 + i}", f"see 300[.]1[.]2[.]{i}", f"order {10**12 + i}",
                     f"token: 4222222222222 {i}", f"ref 212-555-{1000 + i}"):
            rows.append((len(rows), text))
    got = {r.doc_id: (r.b, r.s) for r in pii.redactions(frame(spark, rows)).select(
        "doc_id", spans.listed(F.col("base_spans")).alias("b"), spans.listed(F.col("spans")).alias("s")).collect()}
    assert {i: got[i][1] for i in want} == want and all(got[i][0] != s for i, s in want.items())
    assert all(b == s for i, (b, s) in got.items() if i not in want)


def test_thresholds_of_a_rare_kind(spark):
    """One kind has nearly all candidates; the rare ones get thresholds, and files and partitions change nothing."""
    rows = [(i, " ".join(f"10[.]{i % 200}[.]{j}[.]{k}" for j in range(10) for k in (1, 400))) for i in range(60)]
    rows += [(1000 + i, f"ring +1 212 555 {1000 + i} now") for i in range(40)]
    found = []
    for parts in (1, 7):
        described = pii.describe(pii.find(frame(spark, rows[::-1] if parts == 7 else rows).repartition(parts), "doc_id", "text"))
        model, limits = pii.learn(described, 400)
        found.append((limits, model.toDebugString.split("\n", 1)[1]))
    assert found[0] == found[1] and found[0][0].keys() == {1, 3} and all(t < 2 for t in found[0][0].values())


def test_no_candidates(spark):
    assert pii.redactions(empty(spark)).collect() == []
    only = pii.redactions(frame(spark, [(1, "no numbers"), (2, None)])).collect()
    assert all(r.spans == [] and r.base_spans == [] for r in only) and len(only) == 2


def test_base_secrets_match(spark):
    rows = noisy(list("abcdef0123456789= :\"'") + ["token", "PassWord=", "api_key", "AKIA", "AKIAABCDEFGHIJ12", "é", "0123456789abcdef"], 3) + odd_rows()
    found = secret_scan.scan(frame(spark, rows, clashes=True))
    out = [c for c in found.columns if c.startswith("base_spans")][0]
    got = found.select("*", spans.listed(F.col(out)).alias("s")).collect()
    assert kept_clashes(got)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.s) for r in got) == sorted((i if i is not None else -1, brute(t, SECRETS)) for i, t in rows)
    assert secret_scan.scan(empty(spark, True)).collect() == []


def test_trigram_queries_cover_their_rules(spark):
    assert secret_scan.trigram_query(r"AKIA[A-Z0-9]+") == [frozenset({"aki", "kia"})]
    assert secret_scan.trigram_query(r"[0-9a-f]{32,}") == []
    assert secret_scan.trigram_query("ab") == [] and secret_scan.trigram_query("(abc|de)f") == [frozenset({"abc", "bcf"}), frozenset({"def"})]
    rows = [(1, "ghp_" + "a" * 36), (2, "password= token = 'abcdefgh1'"), (3, "eyJabcdefgh.eyJabcdefgh.abcdefgh"), (4, "ghp_short")]
    got = {r.doc_id: r.s for r in secret_scan.scan(frame(spark, rows)).select("doc_id", spans.listed(F.col("spans")).alias("s")).collect()}
    assert got == {1: got[1], 2: "assign:10:28", 3: "jwt:0:32", 4: ""}
    assert "github:0:40" in got[1]


def test_frame_character_in_texts(spark):
    rows = [(1, " a@b.co ")]
    got = pii.redactions(frame(spark, rows)).select(spans.listed(F.col("base_spans"))).first()[0]
    assert got == "email:3:9"


def test_overlaps_against_all_pairs(spark):
    rng = random.Random(8)
    place = lambda n: [(a, a + rng.randint(1, 6)) for a in sorted(rng.randint(0, 60) for _ in range(n))]
    rows = [(i, place(rng.randint(0, 6)), place(rng.randint(0, 3)), place(rng.randint(0, 3))) for i in range(300)]
    kind = "array<struct<start: int, end: int>>"
    got = spark.createDataFrame(rows, f"i int, a {kind}, b {kind}, c {kind}").select(
        "i", spans.covered(F.col("a"), [F.col("b"), F.col("c")]).alias("hits"), spans.apart(F.col("a"), F.col("b")).alias("free")).collect()
    touch = lambda s, others: any(o[0] < s[1] and s[0] < o[1] for o in others)
    for r in got:
        _, a, b, c = rows[r.i]
        assert [tuple(h) for h in r.hits] == [(touch(s, b), touch(s, c)) for s in a]
        assert [tuple(s) for s in r.free] == [s for s in a if not touch(s, b)]


def test_very_many_matches_in_one_text(spark):
    """Time grows with the number of matches: 50,000 in one text, of several kinds, next to ordinary rows."""
    log = " ".join(f"10.{i % 256}.{i // 256 % 256}.7 token=abcdefgh{i}" for i in range(25_000))
    rows = [(1, log), (2, "from 10.0.0.1"), (3, None)]
    began = time.monotonic()
    got = {r.doc_id: r.s for r in pii.redactions(frame(spark, rows)).select("doc_id", spans.listed(F.col("base_spans")).alias("s")).collect()}
    held = {r.doc_id: r.s for r in secret_scan.scan(frame(spark, rows)).select("doc_id", spans.listed(F.col("base_spans")).alias("s")).collect()}
    assert got == {i: brute(t, PII) for i, t in rows} and held == {i: brute(t, SECRETS) for i, t in rows}
    assert time.monotonic() - began < 60  # the square took minutes
