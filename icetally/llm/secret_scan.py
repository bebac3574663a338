"""Secret scans by a trigram inverted index (operator 6). DataFrame functions only.

A Boolean trigram query is derived from each rule's pattern: an OR of alternatives, each an AND of trigrams that any
match must contain in lower case. Postings (trigram, text digest) are built for the trigrams of the queries, and are
intersected by counting the trigrams of each alternative. Rules are then verified on their candidates only; a rule
without mandatory trigrams scans every text.

Defined results: a null or empty text has no spans; repeated rows are scanned each; equal texts share their postings;
an empty table gives an empty result; other columns stay, also with the name of an output (it takes a free name).
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, sized, text_of
from .spans import apart, labelled, listed, matches_if

with warnings.catch_warnings():
    warnings.simplefilter("ignore", DeprecationWarning)
    import sre_parse

#: Strings in one alternative list while a query is derived; more are cut back to what they share.
ALTERNATIVES = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret. `group` and `least`: the group whose length must reach `least`, else the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base rules. Possessive quantifiers only keep long runs from being scanned again.
_KEYWORDS = r"(?i:(password|passwd|secret|token|api_?key))"
BASE = (
    Rule("assign", _KEYWORDS + r"""["']?+\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]++)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]++", 0, 16),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}+"),
)
#: Formats that are added: public token prefixes, keys in text form, and assignments that a shorter match hid.
ADDED = (
    Rule("assign", _KEYWORDS + r"""["']?+\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]{8,}+)"""),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}+"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}+"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}+"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
)


def _strings(pattern: list) -> list[set[str]]:
    """Sets of lower-case strings of which each match contains one, for the stretches of a parsed pattern."""
    stretches: list[set[str]] = []
    current = {""}

    def close() -> None:
        nonlocal current
        stretches.append(current)
        current = {""}

    def extend(options: set[str]) -> None:
        nonlocal current
        if len(current) * len(options) > ALTERNATIVES:
            close()
        current = {a + b for a, b in product(current, options)}

    for op, value in pattern:
        name = str(op)
        if name == "LITERAL":
            extend({chr(value).lower()})
        elif name == "IN":
            options = _members(value)
            extend(options) if options else close()
        elif name == "SUBPATTERN":
            inner = _whole(list(value[3]))
            if inner:
                extend(inner)
            else:
                close()
                stretches.extend(_strings(list(value[3])))
        elif name == "BRANCH":
            options = [_whole(list(b)) for b in value[1]]
            if all(options):
                extend(set().union(*options))
            else:
                close()
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, inner = value
            exact = _whole(list(inner))
            if exact and (least, most) == (0, 1):
                extend(exact | {""})
            elif exact and least == most and len(exact) ** least <= ALTERNATIVES:
                for _ in range(least):
                    extend(exact)
            else:
                close()
                if least:
                    stretches.extend(_strings(list(inner)))
        elif name == "AT" or name.startswith("ASSERT"):
            continue
        else:
            close()
    close()
    return stretches


def _members(items: list) -> set[str]:
    """The lower-case members of a small character class; empty if it is large or negated."""
    out: set[str] = set()
    for op, value in items:
        if str(op) == "LITERAL":
            out.add(chr(value).lower())
        elif str(op) == "RANGE" and value[1] - value[0] < 4:
            out.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return set()
    return out if len(out) <= 8 else set()


def _whole(pattern: list) -> set[str]:
    """All strings a pattern can match, in lower case, if they are few; else nothing."""
    found = _strings(pattern)
    return found[0] if len(found) == 1 and found[0] != {""} else set()


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of trigrams of which one must be wholly in the lower-case text; none: every text must be read."""
    best: list[frozenset[str]] = []
    needed: frozenset[str] = frozenset()
    for strings in _strings(list(sre_parse.parse(pattern))):
        sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
        if not all(sets):
            continue
        if len(sets) == 1:
            needed |= next(iter(sets))
        elif not best or min(map(len, sets)) > min(map(len, best)):
            best = sorted(sets, key=sorted)
    best = [b for b in best if not any(other < b for other in best)]
    return [needed | b for b in best] if best else [needed] if needed else []


def postings(docs: DataFrame, trigrams: list[str], text: str = "text") -> DataFrame:
    """trigram, digest: which of the trigrams occur in which texts, each pair once."""
    each = F.array(*map(F.lit, trigrams))
    # the one-element transform binds the lower-case text, which would otherwise be made for every trigram
    found = F.flatten(F.transform(F.array(F.lower(text_of(text))), lambda low: F.filter(each, lambda t: F.contains(low, t))))
    return docs.select(F.md5(text_of(text).cast("binary")).alias("digest"), F.explode(found).alias("trigram")).distinct()


def candidates(docs: DataFrame, rules: tuple[Rule, ...], text: str = "text") -> DataFrame:
    """digest, rules: the numbers of the indexed rules whose query a text satisfies."""
    spark = docs.sparkSession
    wanted = [
        (t, number, k, len(alternative))
        for number, rule in enumerate(rules)
        for k, alternative in enumerate(trigram_query(rule.pattern))
        for t in sorted(alternative)
    ]
    queries = spark.createDataFrame(wanted or [("", 0, 0, 0)], "trigram string, rule int, alternative int, needed int")
    held = postings(docs, sorted({w[0] for w in wanted}) or [" " * 3], text)
    met = held.join(F.broadcast(queries), "trigram").groupBy("digest", "rule", "alternative", "needed").count()
    return met.where(F.col("count") == F.col("needed")).groupBy("digest").agg(F.collect_set("rule").alias("rules"))


def _kept(found: Column, rule: Rule) -> Column:
    if not rule.least:
        return found
    part = (lambda v: v) if rule.group == 0 else (lambda v: F.regexp_extract(v, rule.pattern, rule.group))
    return F.filter(found, lambda s: F.length(part(s["value"])) >= rule.least)


def scan(docs: DataFrame, text: str = "text", base: tuple[Rule, ...] = BASE, added: tuple[Rule, ...] = ADDED) -> DataFrame:
    """docs with base_spans and spans, arrays of start, rank, end, kind; end exclusive, in code points.

    `base` rules drop failing matches. Spans of `added` rules count where they overlap no base span of their kind.
    """
    rules = base + added
    ranks = {k: i for i, k in enumerate(dict.fromkeys(r.kind for r in rules))}
    digest, listed_rules = free_name(docs, "digest"), free_name(docs, "rules")
    found = candidates(docs, rules, text).select(F.col("digest").alias(digest), F.col("rules").alias(listed_rules))
    keyed = docs.withColumn(digest, F.md5(text_of(text).cast("binary")))
    joined = keyed.join(sized(found, F.size(listed_rules)), digest, "left")

    def spans_of(number: int, rule: Rule) -> Column:
        if trigram_query(rule.pattern):
            gate = F.coalesce(F.array_contains(listed_rules, number), F.lit(False))
        else:
            gate = text_of(text).rlike(rule.pattern)
        return labelled(_kept(matches_if(gate, text_of(text), rule.pattern), rule), rule.kind, ranks[rule.kind])

    each = {free_name(docs, f"rule_{n}"): spans_of(n, r) for n, r in enumerate(rules)}
    scanned = joined.withColumns(each)
    names = list(each)
    of_base = {r.kind: F.col(n) for n, r in zip(names, base)}
    more = [apart(F.col(n), of_base[r.kind]) if r.kind in of_base else F.col(n) for n, r in zip(names[len(base):], added)]
    out = scanned.withColumns({
        free_name(docs, "base_spans"): F.concat(*of_base.values()),
        free_name(docs, "spans"): F.concat(*of_base.values(), *more),
    })
    return out.drop(digest, listed_rules, *names)


__all__ = ["ADDED", "BASE", "Rule", "candidates", "listed", "postings", "scan", "trigram_query"]
