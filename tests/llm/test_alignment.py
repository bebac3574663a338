"""Alignment of two tokenizers against a plain version, and the perfect hash."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import tokenizers

from icetally.llm import alignment, perfect_hash, queries
from icetally.llm.bpe import SAFE

from .helpers import LONG, empty, frame, odd_rows

PARTS = ["word", " ", "  ", "\n", " a", "'s", "12", "...", "é", " ", "日本", "<|endoftext|>", " 😀", "\t", "▁", "<0x41>", "<s>",
         "Straße", "’", "ﬁ", "\u0085", " ", "\x1c", "İ", "ǅ"]


def plain(texts):
    """The result columns of every text, from whole texts and Python loops."""
    both = alignment.load(alignment.A_PATH, alignment.B_PATH)
    a = tokenizers.Tokenizer.from_file(alignment.A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.B_PATH)
    documents = []
    for text in texts:
        sides = []
        if text:
            whole = (" " + text).encode()
            for ids, table in ((a.encode(" " + text, add_special_tokens=False).ids, both.a_bytes), (b.encode(text), both.b_bytes)):
                if b"".join(table[i] for i in ids) == whole:
                    ends, at = [], 0
                    for i in ids:
                        at += len(table[i])
                        ends.append(at)
                    sides.append((ids, ends))
        groups = []
        if len(sides) == 2:
            shared = sorted(set(sides[0][1]) & set(sides[1][1]))
            where = [{e: next(g for g, s in enumerate(shared) if e <= s) for e in ends} if len(ends) < 2000 else
                     dict(zip(ends, np.searchsorted(shared, ends).tolist())) for _, ends in sides]
            groups = [([], []) for _ in shared]
            for side, ((ids, ends), w) in enumerate(zip(sides, where)):
                for i, e in zip(ids, ends):
                    groups[w[e]][side].append(i)
        documents.append(groups)
    count = Counter()
    held = []
    for groups in documents:
        links = Counter()
        for x, y in groups:
            for i, m in Counter(x).items():
                for j, n in Counter(y).items():
                    links[i, j] += m * n
        held.append(links)
        count.update(links.keys())
    best = defaultdict(int)
    for (i, _), c in count.items():
        best[i] = max(best[i], c)
    out = []
    for groups, links in zip(documents, held):
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((
            sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
            sum(n for p, n in links.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in links.items()),
            hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


def rows_of(df):
    return sorted(repr((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)) for r in df.collect())


def mixed_rows():
    rng = random.Random(11)
    rows = [(100 + i, "".join(rng.choice(PARTS) for _ in range(rng.randint(1, 60)))) for i in range(80)]
    return [*odd_rows(), *rows, *rows[:9], (300, "aaaa" * 900 + " " + "ab" * 700), (301, " " * 300 + "x"), (302, "\0 null")]


@pytest.fixture(scope="module")
def expected():
    rows = mixed_rows()
    return sorted(repr((i, *r)) for (i, _), r in zip(rows, plain([t for _, t in rows])))


def test_query_with_odd_rows(spark, tmp_path, expected):
    frame(spark, mixed_rows(), clashes=True).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.QUERIES["op11_token_alignment"](spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows_of(found) == expected


def test_several_parts(spark, expected):
    """A part holds few pairs: many passes give the same sums."""
    docs = frame(spark, mixed_rows())
    pairs = len(set(alignment.links(_aligned(mixed_rows()), 32000)[1].tolist()))
    assert rows_of(alignment.alignments(docs, part=pairs // 3)) == expected


def _aligned(rows):
    both, (a_size, b_size) = alignment.Pair().load(), alignment.Pair().sizes()
    coded = [both.encode(t or "") for _, t in rows]
    return alignment.align([a for a, _ in coded], [b for _, b in coded], a_size, b_size)


def test_slices_and_wide_groups_list_the_same_links():
    x = _aligned(mixed_rows())
    usual = [c.tolist() for c in alignment.links(x, 32000)]
    for wide, size in ((1, 7), (10**9, 50), (3, 10**6)):
        assert [c.tolist() for c in alignment.links(x, 32000, wide, size)] == usual


def test_plain_texts_take_the_quick_encoder_and_give_the_same_ids():
    both, rng = alignment.load(alignment.A_PATH, alignment.B_PATH), random.Random(3)
    assert both.quick is not None and both.cuts
    letters = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(0xC0, 0x250), *range(0x2010, 0x2028)]]
    for _ in range(300):
        text = "".join(rng.choice(letters if rng.random() < 0.5 else " \nab1'") for _ in range(80))
        assert alignment.PLAIN.fullmatch(text)
        assert both.ids_a(text).tolist() == both.a.encode(text, add_special_tokens=False).ids


def test_cut_texts_have_the_ids_of_whole_ones():
    both = alignment.load(alignment.A_PATH, alignment.B_PATH)
    assert len(LONG) > 200_000 and SAFE.search(LONG)
    a, b = both.encode(LONG)
    assert a.tolist() == both.a.encode(" " + LONG, add_special_tokens=False).ids and b.tolist() == both.b.encode(LONG)


def test_other_columns_and_empty_tables(spark):
    docs = frame(spark, [(1, "a cat"), (2, None)]).selectExpr("*", "'own' as n_a", "'mine' as row", "doc_id as a")
    found = {r.doc_id: r for r in alignment.alignments(docs).collect()}
    assert (found[1].n_a, found[1].row, found[1].a, found[1].n_a_1) == ("own", "mine", 1, 2)
    assert (found[2].n_a_1, found[2].n_links, found[2].count_sum, found[2].groups_sha256) == (0, 0, 0, "")
    assert alignment.alignments(empty(spark)).collect() == []
    assert alignment.alignments(frame(spark, [(1, None), (2, "")])).count() == 2


def test_perfect_hash(spark):
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 1 << 40, 60_000))
    table = perfect_hash.built(spark.createDataFrame([(int(k),) for k in keys], "key bigint"), len(keys))
    slots = table.slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys))) and len(table.first) > 1
    others = np.setdiff1d(rng.integers(0, 1 << 40, 50_000), keys)
    assert (table.slots(others) == -1).all()
    none = perfect_hash.built(spark.createDataFrame([], "key bigint"), 0)
    assert len(none) == 0 and none.slots(np.array([5])).tolist() == [-1]


def test_parts():
    assert alignment.parts_of([(5, 3), (1, 4), (9, 30), (10, 1)], 8) == [(1, 5, 7), (9, 9, 30), (10, 10, 1)]
    assert alignment.parts_of([], 8) == []
