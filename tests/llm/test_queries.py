"""Every registered query of the subpackage on a small table: its columns, its rows, and what its contract fixes."""

from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from icetally.llm import decontaminate, queries

from .helpers import frame, odd_rows

COLUMNS = {
    "op1_ngram_jaccard": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op3_lm_scoring": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op4_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
                         "base_failed boolean, kept boolean",
    "op5_personal_data": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op6_secret_scan": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op7_quality_classifier": "doc_id bigint, held_out boolean, score double, predicted int",
    "op9_line_dedup": "doc_id bigint, n_lines int, n_removed int, text_sha256 string",
    "op10_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op11_token_alignment": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
    "op12_license_scan": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
}


@pytest.fixture(scope="module")
def small_dir(spark, tmp_path_factory):
    """Odd rows and sentences in two languages, labels for some of them."""
    rows = [r for r in odd_rows() if r[0] is not None] + [
        (100 + i, f"Sentence number {i} has words, mail me{i}@example.org or call +49 30 1234567{i % 10}. "
                  f"password = secretword{i} " + "The quick brown fox jumps over the lazy dog. " * (i % 5)) for i in range(40)]
    top = str(tmp_path_factory.mktemp("small"))
    docs = frame(spark, rows).selectExpr("*", "if(doc_id % 2 = 0, 'en', 'de') as lang", "'web' as source", "cast(length(text) as bigint) as n_chars")
    docs.write.parquet(f"{top}/documents.parquet")
    docs.where("doc_id >= 100").selectExpr(
        "doc_id", "cast(doc_id % 5 > 1 as int) as quality", "0 as toxic").write.parquet(f"{top}/labels.parquet")
    spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog again and again")], "item_id bigint, text string").write.parquet(
        f"{top}/benchmark.parquet")
    return top


@pytest.mark.parametrize("name", [*COLUMNS])
def test_one_row_per_document(spark, small_dir, name):
    found = queries.QUERIES[name](spark, small_dir)
    kinds = {c.split()[0]: c.split()[1] for c in COLUMNS[name].split(", ")}
    given = dict(found.dtypes)
    whole = {"int", "bigint"}
    assert all(given[c] == k or {given[c], k} <= whole for c, k in kinds.items())
    rows = found.collect()
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect())
    assert sorted(r.doc_id for r in rows) == ids
    if "held_out" in kinds:
        left = 1 if name.startswith("op3") else 0
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == left) for r in rows)
    if name.startswith("op7"):
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    for r in rows:
        digests = [c for c in kinds if c.endswith("sha256")]
        assert all((r[c] is None and name.startswith("op9")) or (r[c] == "" and name.startswith("op11")) or len(r[c]) == 64 for c in digests)


def test_items_of_any_id_type(spark):
    """Ids of the benchmark may be of any type that Arrow knows."""
    text = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = frame(spark, [(1, f"before {text} after"), (2, "nothing of that kind is here")])
    for kind in ("smallint", "decimal(10,0)", "date", "string"):
        value = F.lit("2024-01-02") if kind in ("date", "string") else F.lit(7)
        items = spark.range(1).select(value.cast(kind).alias("item_id"), F.lit(text).alias("text"))
        found = decontaminate.leaks(docs, items)
        assert dict(found.dtypes)["item_id"] == kind and [r.doc_id for r in found.collect()] == [1]
