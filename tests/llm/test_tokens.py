"""Byte-level BPE, the length histogram, decontamination and the pipeline."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from icetally.llm import bpe, decontaminate, lengths

from .helpers import LONG, empty, frame, kept_clashes, odd_rows


def test_round_trip(spark):
    coded = bpe.decode(bpe.encode(frame(spark, odd_rows(), clashes=True), out="token_ids"), "token_ids_1").collect()
    assert kept_clashes(coded)
    plain = bpe.encoding(bpe.RANKS)
    for r in coded:
        assert bytes(r.decoded) == (r.text or "").encode() and r.token_ids_1 == plain.encode_ordinary(r.text or "")
    assert bpe.encode(empty(spark, True)).collect() == []
    assert bpe.decode(spark.createDataFrame([(None,)], "token_ids array<int>")).first().decoded == b""


def test_cuts_do_not_change_ids():
    rng = random.Random(8)
    parts = ["word", " ", "  ", "\n", " a", "'s", "12", "...", "é", " ", "日本", "<|endoftext|>", " 😀", "\t"]
    for _ in range(60):
        text = "".join(rng.choice(parts) for _ in range(400))
        assert list(bpe.encode_text(text, size=50)) == bpe.encoding(bpe.RANKS).encode_ordinary(text)
        assert "".join(bpe.pieces(text, 50)) == text
    assert len(list(bpe.pieces(LONG, 1000))) > 100


def test_histogram_answers(spark):
    docs = frame(spark, odd_rows(), clashes=True)
    sizes = np.array([len(bpe.encoding(bpe.RANKS).encode_ordinary(t or "")) for _, t in odd_rows()])
    sums = lengths.suffix_sums(lengths.histogram(docs), block=5)
    rows = {r.n_tokens: r for r in sums.collect()}
    assert set(rows) == set(sizes.tolist())
    for n, r in rows.items():
        assert (r.docs, r.docs_longer, r.tokens_longer) == ((sizes == n).sum(), (sizes > n).sum(), sizes[sizes > n].sum())
        assert (r.docs_total, r.tokens_total, r.truncated_total) == (len(sizes), sizes.sum(), np.minimum(sizes, n).sum())
        assert r.quantile == pytest.approx((sizes <= n).mean())
    at = {r.limit: (r.truncated_total, r.docs_longer) for r in lengths.at_limits(sums, [0, 7, 10**9]).collect()}
    assert at == {x: (np.minimum(sizes, x).sum(), (sizes > x).sum()) for x in (0, 7, 10**9)}
    middle = {r.share: r.n_tokens for r in lengths.quantiles(sums, [0.5, 1.0]).collect()}
    assert middle == {0.5: np.quantile(sizes, 0.5, method="inverted_cdf"), 1.0: sizes.max()}
    assert lengths.suffix_sums(lengths.histogram(empty(spark))).collect() == []


def invented(rng, n):
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "ren", "tu", "va", "so"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_leaks(spark):
    rng = random.Random(3)
    items = [(i, invented(rng, 40) + ". " + invented(rng, 6) + ".") for i in range(12)] + [(50, invented(rng, 200)), (51, None), (52, "")]
    rows, want = [], set()
    for i in range(120):
        text, item = invented(rng, 300).split(), rng.choice(items[:12])
        if i % 6 == 0:
            passage = item[1].split()
            if i % 12 == 0:  # a paraphrase: one word in six changed, dropped or added
                passage = [w for k, w in enumerate(passage) for w in ([w] if k % 6 else rng.choice([["other"], [], [w, "more"]]))]
            at = rng.randint(0, 300)
            text[at:at] = passage
            want.add((i, item[0]))
        rows.append((i, " ".join(text)))
    rows += [(200, LONG + " " + items[0][1] + " " + LONG), (201, items[12][1]), *((i, t) for i, t in odd_rows() if i is None or i < 5)]
    want |= {(200, 0), (201, 50)}
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = frame(spark, rows, clashes=True)
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()} == want
    kept = decontaminate.clean(docs, bench).collect()
    assert len(kept) == len(rows) - len({i for i, _ in want}) and kept_clashes(kept)
    assert decontaminate.leaks(empty(spark), bench).collect() == []
    assert decontaminate.leaks(docs, bench.where("false")).collect() == []


def test_benchmark_in_several_blocks(spark, monkeypatch):
    rng = random.Random(13)
    items = [(i, invented(rng, 30)) for i in range(9)]
    rows = [(i, invented(rng, 80) + " " + (items[i][1] if i < 9 else "") + " " + invented(rng, 80)) for i in range(30)]
    monkeypatch.setattr(decontaminate, "BLOCK", 4)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame(spark, rows), bench).collect()} == {(i, i) for i in range(9)}


def test_copies_of_every_passage(spark):
    """1,000 short items and one of 20,000 words, of shared words: more than a block, and an item over several blocks."""
    rng = random.Random(21)
    words = [invented(rng, 1) for _ in range(3000)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.randint(8, 20))) for i in range(1000)] + [(2000, text(20_000))]
    rows = [(i, f"{text(50)} {t} {text(50)}") for i, t in items[:1000]]
    long = items[1000][1].split()
    rows += [(5000 + k, f"{text(60)} {' '.join(long[k * 64 : k * 64 + 128])} {text(60)}") for k in range(0, 300, 10)]
    rows += [(9000, items[1000][1])] * 2
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = [(r.doc_id, r.item_id) for r in decontaminate.leaks(frame(spark, rows), bench).collect()]
    want = Counter([(i, i) for i in range(1000)] + [(i, 2000) for i, _ in rows[1000:]])
    assert not want - Counter(got) and got.count((9000, 2000)) == 2
    assert len(got) <= 1.02 * len(rows)  # so short a passage of so few words is met by chance at times


def test_blocks_are_bounded(spark):
    items = [(i, f"w{i} " * (i % 200)) for i in range(300)]
    numbered, total = decontaminate.numbered_passages(spark.createDataFrame(items, "item_id bigint, text string").repartition(5))
    rows = numbered.collect()
    assert sorted(r.n for r in rows) == list(range(total)) and total == sum(-(-(i % 200) // 64) for i in range(300))
    assert all(0 < len(r.words) <= decontaminate.PASSAGE for r in rows)


def test_lcs_and_svd(spark):
    def plain(a, b):
        last = [0] * (len(b) + 1)
        for x in a:
            now = [0]
            for j, y in enumerate(b):
                now.append(last[j] + 1 if x == y else max(last[j + 1], now[-1]))
            last = now
        return last[-1]

    rng = random.Random(7)
    for _ in range(200):
        a, b = ([rng.randint(-1, 6) for _ in range(rng.randint(1, 40))] for _ in "ab")
        assert decontaminate.lcs(decontaminate.masks_of(a), len(a), b) == plain(a, b)
    matrix = np.random.default_rng(1).standard_normal((30, 5)) @ np.random.default_rng(2).standard_normal((5, 40))
    rows = spark.createDataFrame([(list(range(40)), r.tolist()) for r in matrix], "terms array<int>, weights array<double>")
    vectors, values = decontaminate.randomised_svd(rows, 40, rank=5)
    assert np.allclose(values, np.linalg.svd(matrix)[1][:5]) and np.allclose(matrix @ vectors @ vectors.T, matrix)


def test_pipeline(spark, sf_dir, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "ngram_join", "decontaminate", "byte_bpe"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert 0 < len(out) < docs.count() and all(r.round_trip and r.n_tokens == len(r.token_ids) for r in out)
    assert len({r.doc_id for r in out}) == len(out)
    none = docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, none, sf_dir)
        assert found.collect() == []
        assert found.columns[: len(docs.columns)] == docs.columns if name == "byte_bpe" else found.columns == docs.columns
