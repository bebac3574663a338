"""Personal data: candidate gradient boosting (operator 5). DataFrame and pyspark.ml functions only.

Base rules find e-mail addresses, IP addresses, card and phone numbers. High-recall generators propose further,
overlapping spans of the same kinds. Each candidate is described by its format and its surroundings. Evidence other
than the base rules labels it (`evidence`): sums and ranges that hold or do not, words before it, secrets and
identifiers; a candidate without evidence has no label, whether a base rule finds it or not. What has evidence is
decided by it, however often its format occurs. Boosted trees learn from the labelled candidates, a threshold per kind
is calibrated on labelled ones not learned from, and decides the others. Candidates taken that no base span covers are
added; those of one kind never overlap each other. Base spans always stay.

The texts are read once: what is found is written to the shared folder, a few numbers per document.

Defined results: a null or empty text has no spans; repeated rows are searched each; without labelled
candidates of both sorts, only what has evidence is added; an empty table gives an empty result; a null id stays null. The result has the id and the
spans; other columns are not carried, so their names cannot clash.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icetally.functions.arrays import let

from .common import cut, text_of, written
from .spans import apart, covered, labelled, listed, matches_if

KINDS = ("email", "ip", "card", "phone")
#: Labelled candidates that the trees learn from, of each kind the same number at most, those with the smallest hash;
#: thresholds are set on all labelled candidates of the other half.
LEARNED_FROM = 20_000
#: Share of true candidates above a threshold that calibration asks for, and the thresholds it tries.
PRECISION, GRID = 0.95, (0.5, 0.6, 0.7, 0.8, 0.9, 0.95)
TREES, DEPTH, LEAF = 12, 4, 20

#: The base patterns. Lookbehinds and possessive quantifiers only keep long runs from being scanned
#: again; \G lets an address begin where the last one ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators of further candidates.
GENERATORS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?"
             r"[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20\.\x20|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:(?:\.|\[\.\])[0-9]{1,3}+){3}+(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{12,19}+|[0-9]{4}(?:[\x20.-][0-9]{4}){3}|[0-9]{4}[\x20.-][0-9]{6}[\x20.-][0-9]{5})(?![0-9])",
    "phone": r"(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)|(?<![0-9])[0-9]{2,4})[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])",
}
GATES = {"email": r"@|at[)\]]", "ip": r"[0-9]\[?\.", "card": r"[0-9]", "phone": r"[0-9]"}
FEATURES = (
    "kind", "length", "digits", "groups", "separators", "brackets", "plus", "ats", "letters", "luhn", "largest_part",
    "first_digit", "touches_before", "touches_after", "word_before", "secret_before", "identifier_before",
)
#: Words before a candidate.
CONTACT = r"(?i)(mail|phone|tel|call|card|fax|address|ip)\W{0,3}$"
SECRET = r"(?i)(password|token|secret|key)\W{0,6}[0-9a-f]*$"
IDENTIFIER = r"(?i)\b(ref|reference|order|invoice|isbn|sku|serial|tracking|ticket|id|version|build|release)\W{0,3}$"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits of a short string pass the Luhn sum."""
    n = F.length(digits)
    at = lambda i: F.substring(digits, n - i, F.lit(1)).cast("int")
    doubled = lambda d: d * 2 - F.when(d > 4, 9).otherwise(0)
    total = F.aggregate(
        F.sequence(F.lit(0), n - 1), F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, doubled(at(i))).otherwise(at(i)),
    )
    return total % 10 == 0


def _small(part: Column) -> Column:
    """Whether a run of digits, zeros in front allowed, is 255 at most."""
    bare = F.regexp_replace(part, "^0+", "")
    return (F.length(bare) <= 3) & (F.coalesce(F.left(bare, F.lit(3)).try_cast("int"), F.lit(0)) <= 255)


def _valid(kind: str, span: Column) -> Column:
    n = F.length(_digits(span["value"]))
    if kind == "ip":
        return F.forall(F.split(span["value"], r"\."), _small)
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(_digits(span["value"]))).otherwise(False)
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def evidence(value: Column, before: Column, after: Column, other: Column) -> dict[str, Column]:
    """Per kind 1 for a candidate with evidence that it is personal data, 0 with evidence against it, else null.

    other: whether a base span of another kind covers part of it.
    """
    digits = _digits(value)
    n = F.length(digits)
    contact, named = before.rlike(CONTACT), before.rlike(SECRET) | before.rlike(IDENTIFIER)
    inner = before.rlike("[A-Za-z0-9]$") | after.rlike("^[A-Za-z0-9]")
    against = named | inner | other
    # a longer dotted or dashed number; after a blank it may be the next number
    longer = before.rlike(r"[0-9][.-]$") | after.rlike(r"^(?:[.-]|\[\.\])[0-9]")
    near = before.rlike(r"[0-9]\x20$") | after.rlike(r"^\x20[0-9]")
    small = F.forall(F.regexp_extract_all(value, F.lit("[0-9]+"), 0), _small)
    issued = (n >= 14) | digits.rlike("^(?:4[0-9]{12}$|5[0678]|6)") | contact
    plus = value.startswith("+")
    shaped = (
        value.contains("(") | contact | value.startswith("0")
        | value.rlike(r"^[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4}$")
    )
    decided = lambda no, yes: F.when(no, 0).when(yes, 1)
    return {
        "email": decided(before.rlike(SECRET) | ~value.rlike(r"[.)\]]\x20?[A-Za-z]{2,24}$"), ~value.rlike(r"\x20@|@\x20")),
        "ip": decided(against | longer | ~small, F.lit(True)),
        "card": decided(against | ~_luhn(digits), issued),
        "phone": decided(against | longer | (n > 15), n.between(10, 15) & (plus | (shaped & ~near))),
    }


def find(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """row, doc_id, digest of id and text, and per kind the base spans and the candidates; written to the shared folder."""
    source = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    found = source.select("doc_id", F.xxhash64(F.col("doc_id"), F.col("text")).alias("digest"), *(
        matches_if(F.col("text").rlike(GATES[k]), F.col("text"), patterns[k]).alias(f"{stem}_{k}")
        for stem, patterns in (("base", PATTERNS), ("more", GENERATORS)) for k in KINDS
    ))
    kept = found.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "digest",  # fixed from here on: the rows are written
        *(F.transform(F.filter(f"base_{k}", (lambda kind: lambda s: _valid(kind, s))(k)),
                      lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(f"base_{k}") for k in KINDS),
        *(F.col(f"more_{k}") for k in KINDS),
    )
    return cut(kept)


def describe(found: DataFrame) -> DataFrame:
    """A row per candidate: row, digest, kind number, start, end, its features, whether a base span covers part of it, label.

    What evidence speaks against is no negative example if a base span covers it: it has no label then.
    """
    hit = lambda hits, i, k: F.get(F.get(hits, i), F.lit(k))

    def proposed(n: int, kind: str) -> Column:
        return let(covered(F.col(f"more_{kind}"), [F.col(f"base_{k}") for k in KINDS]), lambda hits: F.transform(
            f"more_{kind}", lambda s, i: F.struct(
                F.lit(n).alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
                s["before"].alias("before"), s["after"].alias("after"), hit(hits, i, n).alias("known"),
                reduce(or_, (hit(hits, i, o) for o in range(len(KINDS)) if o != n)).alias("other"),
            )))

    proposals = F.flatten(F.array(*(proposed(n, k) for n, k in enumerate(KINDS))))
    each = found.select("row", "digest", F.explode(proposals).alias("c")).select("row", "digest", "c.*")
    value, digits = F.col("value"), _digits(F.col("value"))
    count = lambda p: F.regexp_count(value, F.lit(p))
    parts = F.transform(F.regexp_extract_all(value, F.lit("[0-9]+"), 0), lambda p: F.left(p, F.lit(9)).cast("int"))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    numbers = {
        "kind": F.col("k"), "length": F.length(value), "digits": F.length(digits), "groups": count("[0-9]+"),
        "separators": count(r"[\x20.-]"), "brackets": count(r"[()\[\]]"), "plus": count(r"\+"), "ats": count("@|at[)\\]]"),
        "letters": count("[A-Za-z]"),
        "luhn": F.when(F.length(digits).between(12, 19), flag(_luhn(digits))).otherwise(0),
        "largest_part": F.coalesce(F.array_max(parts), F.lit(0)), "first_digit": F.coalesce(F.left(digits, F.lit(1)).try_cast("int"), F.lit(-1)),
        "touches_before": flag(F.col("before").rlike("[A-Za-z0-9]$")), "touches_after": flag(F.col("after").rlike("^[A-Za-z0-9]")),
        "word_before": flag(F.col("before").rlike(CONTACT)), "secret_before": flag(F.col("before").rlike(SECRET)),
        "identifier_before": flag(F.col("before").rlike(IDENTIFIER)),
    }
    found_by = evidence(value, F.col("before"), F.col("after"), F.col("other"))
    label = F.coalesce(*(F.when(F.col("k") == i, found_by[k]) for i, k in enumerate(KINDS)))
    label = F.when(~(F.col("known") & (label == 0)), label).cast("double").alias("label")
    return each.select("row", "digest", "k", "start", "end", flag(F.col("known")).alias("known"), label,
                       *(numbers[f].cast("double").alias(f"f_{f}") for f in FEATURES))


def learn(described: DataFrame, learned_from: int = LEARNED_FROM) -> tuple[object, dict[int, float]] | None:
    """The boosted trees and a threshold per kind; None without labelled candidates of both sorts to learn from."""
    order = F.xxhash64("digest", "k", "start")  # of the data, not of its place in files and partitions
    assembled = VectorAssembler(inputCols=[f"f_{f}" for f in FEATURES], outputCol="features").transform(
        described.where("label is not null"))
    chosen = assembled.select("k", "features", "label", order.alias("h"))
    half = F.pmod("h", F.lit(2))
    each = max(1, learned_from // len(KINDS))
    train = cut(reduce(DataFrame.unionAll, (
        chosen.where((half == 0) & (F.col("k") == k)).orderBy("h").limit(each) for k in range(len(KINDS)))))
    sorts = {r["label"] for r in train.select("label").distinct().collect()}
    if len(sorts) < 2:
        return None
    model = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, minInstancesPerNode=LEAF, seed=1, stepSize=0.3, cacheNodeIds=False, maxBins=32
    ).fit(train)
    scored = held_scores(model.transform(chosen.where(half == 1)))
    tried = scored.groupBy("k").agg(*(
        (F.sum(F.when(F.col("p") >= t, F.col("label"))) / F.count(F.when(F.col("p") >= t, 1))).alias(f"t{i}")
        for i, t in enumerate(GRID)
    )).collect()
    limits = {r["k"]: next((t for i, t in enumerate(GRID) if (r[f"t{i}"] or 0) >= PRECISION), 2.0) for r in tried}
    return model, limits


def held_scores(transformed: DataFrame) -> DataFrame:
    return transformed.withColumn("p", F.get(vector_to_array("probability"), F.lit(1)))


def redactions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", learned_from: int = LEARNED_FROM) -> DataFrame:
    """doc_id, base_spans, spans of every row: arrays of start, rank, end, kind; end exclusive, in code points."""
    found = find(docs, doc_id, text)
    described = written(describe(found))
    learned = learn(described, learned_from)
    base = F.concat(*(labelled(F.col(f"base_{k}"), k, n) for n, k in enumerate(KINDS)))
    result = found.select("row", "doc_id", base.alias("base_spans"))
    open_ones = described.where("known = 0")
    passed = open_ones.where("label = 1").select("row", "k", "start", "end")
    if learned is not None:
        model, limits = learned
        assembled = VectorAssembler(inputCols=[f"f_{f}" for f in FEATURES], outputCol="features").transform(
            open_ones.where("label is null"))
        limit = F.coalesce(*(F.when(F.col("k") == k, t) for k, t in limits.items()), F.lit(2.0))
        scored = held_scores(model.transform(assembled)).where(F.col("p") >= limit)
        passed = passed.unionByName(scored.select("row", "k", "start", "end"))
    # candidates of one kind come from one pattern, left to right, and never overlap each other
    best = passed.groupBy("row").agg(F.collect_list(F.struct(
        "start", F.col("k").alias("rank"), "end", F.get(F.array(*map(F.lit, KINDS)), F.col("k")).alias("kind"),
    )).alias("added"))
    joined = result.join(best, "row", "left")
    return joined.select(
        "doc_id", "base_spans", F.concat("base_spans", F.coalesce("added", F.filter("base_spans", lambda s: F.lit(False)))).alias("spans")
    )


def masked(docs: DataFrame, spans: str = "spans", text: str = "text") -> Column:
    """The text with each code point of a span replaced by a block; the length stays."""
    inside = lambda i: F.exists(F.col(spans), lambda s: (s["start"] <= i) & (i < s["end"]))
    chars = F.split(text_of(text), "")
    return F.array_join(F.transform(chars, lambda c, i: F.when(inside(i), F.lit("█")).otherwise(c)), "")


__all__ = ["KINDS", "PATTERNS", "apart", "find", "describe", "learn", "listed", "masked", "redactions"]
