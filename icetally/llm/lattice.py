"""LM scoring: subword lattice likelihood (operator 3).

A public subword vocabulary is taken as it is; its unigram scores are learned here. Words of the training rows are
counted, each distinct word is encoded once, and the pieces get the word's count. The probability of a word is the
sum over all its segmentations, by a forward recursion in log space over the lattice of its pieces; characters that
are no piece go through their byte pieces. A text is its words and one end, so its score is a sum over words.

The recursion runs once for each distinct word. The most frequent words (a fixed number) are sent to the scoring
tasks, which add them up inside each text; the rarer ones are joined by word, so no word of the join is frequent.

Defined results: a null or empty text is one end token; a row without an id is neither held out nor left out of
learning (its remainder is no 1); rows repeated as a whole count each in learning and come back each; without
training rows all counts are 0; an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, remainder

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
#: Words that are sent to every scoring task.
FREQUENT = 50_000
#: Distinct words that a counting task holds before it hands them on.
HELD = 300_000
MARK = "▁"


def tokens_of(text: str | None) -> list[bytes]:
    """The words of a text with A-Z in lower case, as bytes; bytes.split knows just the blanks meant here."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_counts(docs: DataFrame, text: str, train: str) -> DataFrame:
    """word, c, n: how often each word occurs in training rows and in all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, learnt = Counter(), Counter()

        def out() -> pa.RecordBatch:
            names = list(both)
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array([learnt[w] for w in names], pa.int64()),
                 pa.array([both[w] for w in names], pa.int64())], names=["word", "c", "n"])

        for batch in batches:
            for t, is_train in zip(batch.column(0), batch.column(1).to_pylist()):
                found = tokens_of(t.as_py())
                both.update(found)
                if is_train:
                    learnt.update(found)
                if len(both) > HELD:
                    yield out()
                    both.clear()
                    learnt.clear()
        yield out()

    held = docs.select(F.col(text), F.col(train)).mapInArrow(count, "word binary, c bigint, n bigint")
    return held.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


@lru_cache(maxsize=2)
def _model(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def _text(word: bytes) -> str:
    return word.decode("utf-8", "replace")


def piece_counts(counts: DataFrame, path: str) -> dict[int, int]:
    """How often each piece of the vocabulary is used by the training words; one number per piece at most."""

    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used: Counter = Counter()
        for batch in batches:
            found = _model(path).encode([_text(w) for w in batch.column(0).to_pylist()], num_threads=1)
            for ids, c in zip(found, batch.column(1).to_pylist()):
                for i in ids:
                    used[i] += c
        yield pa.RecordBatch.from_arrays([pa.array(list(used), pa.int32()), pa.array(list(used.values()), pa.int64())],
                                         names=["piece", "c"])

    rows = counts.where("c > 0").select("word", "c").mapInArrow(use, "piece int, c bigint")
    return {r["piece"]: r["c"] for r in rows.groupBy("piece").agg(F.sum("c").alias("c")).collect()}


def piece_scores(used: dict[int, int], ends: int, path: str) -> tuple[dict[str, float], list[float], float]:
    """Natural log-probabilities: of the pieces by text, of the 256 byte pieces, of the end."""
    model = _model(path)
    size = model.get_piece_size()
    whole = math.log(sum(used.values()) + ends + 0.5 * (size + 1))
    score = lambda c: math.log(c + 0.5) - whole
    pieces, in_bytes = {}, [0.0] * 256
    for i in range(size):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            in_bytes[int(name[1:-1], 16)] = score(used.get(i, 0))
        elif not model.is_control(i) and not model.is_unknown(i):
            pieces[name] = score(used.get(i, 0))
    return pieces, in_bytes, score(ends)


def word_score(word: bytes, pieces: dict[str, float], in_bytes: list[float], longest: int) -> float:
    """log10 of the summed probability of all segmentations of a word."""
    s = MARK + _text(word)
    forward = [0.0]
    for j in range(1, len(s) + 1):
        terms = []
        for i in range(max(0, j - longest), j):
            p = pieces.get(s[i:j])
            if p is not None:
                terms.append(forward[i] + p)
        if s[j - 1] not in pieces:
            terms.append(forward[j - 1] + sum(in_bytes[b] for b in s[j - 1].encode("utf-8", "surrogatepass")))
        if len(terms) == 1:
            forward.append(terms[0])
        else:
            top = max(terms)
            forward.append(top + math.log(sum([math.exp(t - top) for t in terms])))
    return forward[-1] / math.log(10)


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = VOCABULARY,
          held_out: int = 1, modulus: int = 5, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of docs.

    Rows whose crc32 of the id leaves `held_out` are not learned from. base_score: smoothed word unigrams;
    score: the lattice likelihood; both log10.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
        (remainder(F.col(doc_id), modulus) != held_out).alias("train"),
    )
    counts = cut(word_counts(rows, "text", "train"))
    total = counts.agg(F.sum("c").alias("c"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    ends = rows.where("train").count()
    n_train, distinct = (total["c"] or 0) + ends, total["v"] + (ends > 0)
    whole = math.log10(n_train + 0.5 * (distinct + 1))
    base = lambda c: math.log10(c + 0.5) - whole
    pieces, in_bytes, end = piece_scores(piece_counts(counts, path), ends, path)
    longest = max(map(len, pieces))
    lattice = spark.sparkContext.broadcast((pieces, in_bytes, longest))  # bounded by the vocabulary

    @F.arrow_udf("double")
    def marginal(found: pa.Array) -> pa.Array:
        return pa.array([word_score(w, *lattice.value) for w in found.to_pylist()], pa.float64())

    often = {
        r["word"]: (r["c"] > 0, base(r["c"]), r["s"])
        for r in counts.orderBy(F.desc("n"), "word").limit(frequent).withColumn("s", marginal("word")).collect()
    }
    sent = spark.sparkContext.broadcast(often)
    end_known, base_end, end10 = ends > 0, base(ends), end / math.log(10)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in batches:
            out = []
            for i, t, learnt, key in zip(*(c.to_pylist() for c in batch.columns)):
                n, known, b, s, rare = 1, int(end_known), base_end, end10, []
                for w, tf in Counter(tokens_of(t)).items():
                    n += tf
                    row = table.get(w)
                    if row is None:
                        rare.append({"word": w, "tf": tf})
                    else:
                        known += tf * row[0]
                        b += tf * row[1]
                        s += tf * row[2]
                out.append((i, key, learnt, n, known, b, s, rare))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)

    id_type = rows.schema["doc_id"].dataType.simpleString()
    keyed = rows.select("doc_id", "text", "train", F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("key"))
    arrow_id = pa.int64() if id_type == "bigint" else pa.int32() if id_type == "int" else pa.string()
    if id_type not in ("bigint", "int", "string"):
        keyed = keyed.withColumn("doc_id", F.col("doc_id").cast("string"))
    schema = pa.schema([
        ("doc_id", arrow_id), ("key", pa.string()), ("train", pa.bool_()), ("n", pa.int64()), ("known", pa.int64()),
        ("b", pa.float64()), ("s", pa.float64()), ("rare", pa.list_(pa.struct([("word", pa.binary()), ("tf", pa.int64())]))),
    ])
    spark_id = keyed.schema["doc_id"].dataType.simpleString()
    texts = keyed.mapInArrow(
        add_up, f"doc_id {spark_id}, key string, train boolean, n bigint, known bigint, b double, s double,"
                " rare array<struct<word: binary, tf: bigint>>")
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0
    lone = F.concat(F.lit(" "), F.col("key")).cast("binary")  # no word has a blank: such rows meet no other
    spread = texts.select("*", F.posexplode_outer("rare").alias("pos", "one")).select(
        "doc_id", "key", "train", F.coalesce(F.col("one.word"), lone).alias("word"), F.col("one.tf").alias("tf"),
        *(F.when(first, F.col(c)).otherwise(0).alias(c) for c in ("n", "known", "b", "s")), F.when(first, 1).otherwise(0).alias("rows"),
    )
    fewer = counts.join(F.broadcast(spark.createDataFrame([(w,) for w in often], "word binary")), "word", "left_anti") \
        if often else counts
    scored = fewer.select("word", "c", marginal("word").alias("word_s"))
    tf, c = F.coalesce(F.col("tf"), F.lit(0)), F.coalesce(F.col("c"), F.lit(0))
    sums = spread.join(scored, "word", "left").groupBy("doc_id", "key", "train").agg(
        F.sum("rows").alias("rows"),
        F.sum("n").alias("n"),
        F.sum(F.col("known") + F.when(c > 0, tf).otherwise(0)).alias("known"),
        F.sum(F.col("b") + F.when(tf > 0, tf * (F.log10(c + 0.5) - whole)).otherwise(0.0)).alias("b"),
        F.sum(F.col("s") + F.when(tf > 0, tf * F.col("word_s")).otherwise(0.0)).alias("s"),
    )
    return sums.select(
        F.col("doc_id").cast(id_type).alias("doc_id"), (~F.col("train")).alias("held_out"),
        F.expr("n div rows").alias("n_tokens"), F.expr("known div rows").alias("n_known"),
        F.lit(n_train).cast("bigint").alias("train_tokens"), (F.col("b") / F.col("rows")).alias("base_score"),
        (F.col("s") / F.col("rows")).alias("score"), F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("copy"),
    ).drop("copy")
