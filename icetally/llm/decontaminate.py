"""Benchmark decontamination by latent semantic retrieval (operator 2).

The benchmark's items are cut into passages, which are numbered and dealt to blocks of a fixed number; each block is a
query set that meets all documents. What an item's passages in several blocks find in a document is put together.
Words of a block's passages are its terms, weighted by TF-IDF with frequencies over all documents. A randomised SVD
of the block's passage-term matrix (a random start, subspace iterations whose products Spark adds up over the rows,
orthonormalised in between) gives the latent space. Windows of the documents are folded into it, and passages whose
cosine with a window is high enough are candidates. So are passages of eight words or more of which a window may hold
a whole copy: two neighbouring windows hold all of a copy, so one has half of the passage's squared norm. Such a
candidate is a leak if it is there word for word. Any other candidate is a leak if the longest common subsequence of the
passage and the text around the window covers enough of the passage, and enough of its answer (its last sentence),
so that changed, dropped and added words do not hide it.

A document meets all passages of a block inside its own row; nothing is shuffled but counts of terms and, where there
are several blocks, the leaks.

Defined results: null or empty texts leak nothing and have no passages; a null item id is reported as null; repeated
rows are reported each; an empty benchmark or table gives an empty result; other columns of docs stay in `clean`.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import cut, free_name, sized, text_of

#: Words of a passage at most; a window is two neighbouring blocks of half of that.
PASSAGE, STEP = 64, 32
#: Passages of the benchmark in one block at most; the latent space has as many dimensions as the block has passages,
#: so that the least of them is still represented. Extra random directions and rounds of the SVD.
BLOCK, EXTRA, ROUNDS = 256, 10, 2
#: Terms in a larger share of the documents are no candidates' terms, unless a passage has too few others.
MAX_SHARE, LEAST_TERMS = 0.1, 4
COSINE, LCS_SHARE, ANSWER_SHARE = 0.35, 0.6, 0.5
#: Share of a passage's squared norm that a window next to a whole copy holds, less rounding; words from which a passage
#: is told by a part of it, or by a copy however little it weighs in the window.
COPIED, LEAST_WORDS = 0.49, 8
#: Words of documents that one matrix product takes.
CHUNK_WORDS = 40_000
_TABLE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_SENTENCE = re.compile(r"(?<=[.!?\n])\s+")


def terms_of(text: str | None) -> list[bytes]:
    """Words in lower case, without ASCII punctuation."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_TABLE).split()


def answer_words(text: str) -> int:
    """Words of the last sentence: the answer. A third of the words if it is longer than that."""
    whole = len(terms_of(text))
    last = next((n for s in reversed(_SENTENCE.split(text.strip())) if (n := len(terms_of(s)))), 0)
    return max(1, min(last, -(-whole // 3)))


def lcs(masks: dict[int, int], size: int, words: list[int]) -> int:
    """Bits of the longest common subsequence of a passage (masks of its places by term) and words."""
    full = (1 << size) - 1
    v = full
    for w in words:
        m = masks.get(w)
        if m:
            u = v & m
            v = (v + u) | (v - u)
    return (full & ~v).bit_count()


def masks_of(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


@dataclass
class Block:
    """A block of passages ready to be compared: sent to every task, its size is bounded by BLOCK and PASSAGE."""

    items: list
    words: list[list[int]]
    answers: list[int]
    vocabulary: dict[bytes, int]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    folded: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    latent: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    lengths: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    masks: list = field(default_factory=list)
    copies: list = field(default_factory=list)


def passages(rows: list) -> Block:
    """A block of (item, words, answer words) rows."""
    vocabulary: dict[bytes, int] = {}
    block = Block([], [], [], vocabulary)
    for item, words, answer in rows:
        block.items.append(item)
        block.words.append([vocabulary.setdefault(bytes(w), len(vocabulary)) for w in words])
        block.answers.append(answer)
    return block


def numbered_passages(items: DataFrame) -> tuple[DataFrame, int]:
    """n, item_id, words, answer of the passages of all items, n running from 0 without gaps, and their number.

    An item is cut into passages of at most PASSAGE words; the answer belongs to the last one.
    """
    kind = items.schema["item_id"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, words, answers = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                found = terms_of(text)
                parts = -(-len(found) // PASSAGE)
                size = -(-len(found) // max(1, parts))
                starts = range(0, len(found), max(1, size))
                for start in starts:
                    part = found[start : start + size]
                    where.append(i)
                    words.append(part)
                    answers.append(min(len(part), answer_words(text)) if start == starts[-1] else 0)
            taken = batch.column(0).take(pa.array(where, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [taken, pa.array(words, pa.list_(pa.binary())), pa.array(answers, pa.int32())], names=["item_id", "words", "answer"])

    rows = cut(items.mapInArrow(split, f"item_id {kind}, words array<binary>, answer int").select(
        F.monotonically_increasing_id().alias("id"), "*"))  # fixed from here on: the rows are written
    part, within = F.shiftright("id", 33), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r["part"]: r["n"] for r in rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for p in sorted(sizes):
        before += [F.lit(p).cast("bigint"), F.lit(total).cast("bigint")]
        total += sizes[p]
    if not total:
        return rows.select(F.col("id").alias("n"), "item_id", "words", "answer"), 0
    return rows.select((F.create_map(*before)[part] + within).alias("n"), "item_id", "words", "answer"), total


def document_frequencies(docs: DataFrame, text: str, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, int]:
    """In how many documents each term occurs, and the number of documents. One number per term reaches the driver."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found, n = sent.value, Counter(), 0
        for batch in batches:
            for t in batch.column(0):
                found.update(known.keys() & set(terms_of(t.as_py())))
                n += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *(known[w] for w in found)], pa.int32()), pa.array([n, *found.values()], pa.int64())], names=["term", "df"])

    rows = docs.select(text).mapInArrow(count, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(len(vocabulary))
    n = 0
    for r in rows:
        if r["term"] < 0:
            n = r["df"]
        else:
            df[r["term"]] = r["df"]
    return df, n


def weigh(block: Block, df: np.ndarray, n: int) -> None:
    """Inverse document frequencies; terms that are too common weigh nothing where a passage has enough others."""
    idf = np.log((n + 1.0) / (df + 0.5))
    rare = df <= MAX_SHARE * n
    for words in block.words:
        if len({w for w in words if rare[w]}) < LEAST_TERMS:
            rare[words] = True
    block.weights = np.where(rare, np.maximum(idf, 0.05), 0.0).astype(np.float32)


def randomised_svd(rows: DataFrame, n_terms: int, rank: int, extra: int = EXTRA, rounds: int = ROUNDS,
                   seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (terms by rank) and singular values of a sparse matrix.

    rows: terms array<int>, weights array<float>, one row per passage. Each product with the matrix is a Spark job
    whose tasks add up their rows; the sums, terms by rank at most, are what a model of this size is.
    """
    width = min(rank + extra, n_terms)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_terms, width)))[0]

    def summed(basis: np.ndarray, square: bool) -> np.ndarray:
        sent = rows.sparkSession.sparkContext.broadcast(basis)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            z = sent.value
            total = np.zeros((z.shape[1], z.shape[1]) if square else z.shape)
            for batch in batches:
                for terms, weights in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    w = np.array(weights)
                    y = w @ z[terms]
                    if square:
                        total += np.outer(y, y)
                    else:
                        np.add.at(total, terms, np.outer(w, y))
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

        parts = rows.mapInArrow(add, "part binary").toLocalIterator()
        return sum(np.frombuffer(p["part"]).reshape(width if square else n_terms, width) for p in parts)

    for _ in range(rounds):
        basis = np.linalg.qr(summed(basis, False))[0]
    values, turned = np.linalg.eigh(summed(basis, True))
    order = np.argsort(values)[::-1][:rank]
    order = order[values[order] > 1e-9 * max(values.max(), 1e-30)]
    return basis @ turned[:, order], np.sqrt(values[order])


def fit(docs: DataFrame, text: str, rows: list) -> Block:
    """A block of passages with its weights and latent space."""
    spark = docs.sparkSession
    block = passages(rows)
    weigh(block, *document_frequencies(docs, text, block.vocabulary))
    sparse = [Counter(w for w in words if block.weights[w] > 0) for words in block.words]
    rows = [([*c], [float(n * block.weights[w]) for w, n in c.items()]) for c in sparse]
    frame = spark.createDataFrame(rows, "terms array<int>, weights array<double>").repartition(4)
    vectors, _ = randomised_svd(frame, len(block.vocabulary), len(block.words))
    block.folded = (block.weights[:, None] * vectors).astype(np.float32)
    latent = np.array([sum(n * block.folded[w] for w, n in c.items()) for c in sparse], np.float32)
    block.lengths = np.maximum(np.linalg.norm(latent, axis=1), 1e-9)
    block.latent = latent / block.lengths[:, None]
    block.copies = [np.array(words, np.int64).tobytes() for words in block.words]
    block.masks = [(masks_of(words), masks_of(words[len(words) - a:]) if a else None) for words, a in zip(block.words, block.answers)]
    return block


def candidates(block: Block, texts: list[np.ndarray], cosine: float) -> list[tuple[int, int, int, float]]:
    """(text, window start, passage, cosine) of the windows near a passage in the latent space or with half of its norm.

    The norm of a window is that of its whole vector of terms, so words outside the space count against it.
    """
    spans = [len(t) // STEP + 2 for t in texts]  # an empty block after each text keeps windows apart
    offsets = np.concatenate([[0], np.cumsum(spans)])
    words = np.concatenate(texts)
    place = np.concatenate([o + np.arange(len(t)) // STEP for o, t in zip(offsets, texts)])
    weighed = (words >= 0) & (block.weights[words] > 0)
    words, place = words[weighed], place[weighed]
    if not len(words):
        return []
    starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    folded = np.zeros((offsets[-1] + 1, block.folded.shape[1]), np.float32)
    folded[place[starts]] = np.add.reduceat(block.folded[words], starts, axis=0)
    # squared norms of the raw windows: term counts within two neighbouring blocks
    pairs = np.concatenate([np.stack([place, words], 1), np.stack([place - 1, words], 1)])
    kept, times = np.unique(pairs[pairs[:, 0] >= 0], axis=0, return_counts=True)
    norms = np.bincount(kept[:, 0], (times * block.weights[kept[:, 1]]) ** 2, minlength=len(folded))
    windows = folded[:-1] + folded[1:]
    shared = windows @ block.latent.T
    near = shared / np.sqrt(np.maximum(norms[: len(windows), None], 1e-9))
    long = np.array([len(words) >= LEAST_WORDS for words in block.words])
    at, passage = np.nonzero((near >= cosine) | (shared >= np.where(long, COPIED * block.lengths, np.inf).astype(np.float32)))
    owner = np.searchsorted(offsets, at, side="right") - 1
    return [(int(o), int(a - offsets[o]) * STEP, int(p), float(near[a, p])) for o, a, p in zip(owner, at, passage)]


def holds(words: np.ndarray, copy: bytes) -> bool:
    """Whether words hold a passage (its words as bytes) word for word."""
    text = words.tobytes()
    at = text.find(copy)
    while at % words.itemsize and at > 0:
        at = text.find(copy, at + 1)
    return at >= 0


def leaks_in(block: Block, texts: list[np.ndarray], cosine: float, share: float, answer: float) -> list[tuple]:
    """(text, item, cosine, lcs share, answer share) of the verified candidates, the best for each item."""
    best: dict[tuple, tuple] = {}
    for o, at, p, near in candidates(block, texts, cosine):
        passage, answers = block.masks[p]
        n, a = len(block.words[p]), block.answers[p]
        margin = n // 2
        around = texts[o][max(0, at - margin) : at + PASSAGE + margin]
        if near >= cosine:
            around = around.tolist()
            whole = lcs(passage, n, around) / n
            part = lcs(answers, a, around) / a if answers else 1.0
        else:
            whole = part = float(holds(around, block.copies[p]))
        if whole >= (share if n >= LEAST_WORDS else 1.0) and part >= answer:
            key = (o, p)
            best[key] = max(best.get(key, (0.0,)), (whole, part, near))
    return [(o, block.items[p], near, whole, part) for (o, p), (whole, part, near) in best.items()]


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text", cosine: float = COSINE, share: float = LCS_SHARE, answer: float = ANSWER_SHARE) -> DataFrame:
    """doc_id, item_id, cosine, lcs_share, answer_share of the documents that hold a benchmark item."""
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    items = benchmark.select(F.col(item_id).alias("item_id"), text_of(item_text).alias("text")).where("text != ''")
    numbered, total = numbered_passages(items)
    blocks = -(-total // BLOCK)
    # with several blocks, which row a leak is of must be known: equal rows find the same in each block
    digest = F.xxhash64("text") if blocks > 1 else F.lit(0).cast("bigint")
    source = source.withColumn("digest", digest)
    id_type, item_type = (f.dataType.simpleString() for f in (source.schema["doc_id"], items.schema["item_id"]))
    item_kind = to_arrow_type(items.schema["item_id"].dataType)
    measures = "cosine double, lcs_share double, answer_share double"
    schema = f"doc_id {id_type}, digest bigint, item_id {item_type}, {measures}"
    found = spark.createDataFrame([], schema).withColumn("block", F.lit(0))
    for b in range(blocks):
        mine = numbered.where(F.col("n").between(b * BLOCK, (b + 1) * BLOCK - 1)).orderBy("n")
        sent = spark.sparkContext.broadcast(fit(source, "text", [(r["item_id"], r["words"], r["answer"]) for r in mine.collect()]))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            get = block.vocabulary.get
            for batch in batches:
                texts, rows, held, n = batch.column(1), [], [], 0
                where: list[int] = []

                def close() -> None:
                    nonlocal held, where, n
                    if n:
                        rows.extend((where[o], *rest) for o, *rest in leaks_in(block, held, cosine, share, answer))
                    held, where, n = [], [], 0

                for i, t in enumerate(texts):
                    known = np.array([get(w, -1) for w in terms_of(t.as_py())], np.int64)
                    for start in range(0, max(1, len(known)), CHUNK_WORDS):  # a very long text in overlapping chunks
                        part = known[start : start + CHUNK_WORDS + 2 * PASSAGE]
                        held.append(part)
                        where.append(i)
                        n += len(part)
                        if n >= CHUNK_WORDS:
                            close()
                close()
                best: dict[tuple, tuple] = {}
                for i, item, near, whole, part in rows:
                    best[i, item] = max(best.get((i, item), (0.0,)), (whole, part, near))
                at = pa.array([i for i, _ in best], pa.int64())
                items_out = pa.array([item for _, item in best]) if best else pa.array([], pa.null())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(2).take(at), items_out.cast(item_kind), *(pa.array([v[k] for v in best.values()], pa.float64()) for k in (2, 0, 1))],
                    names=["doc_id", "digest", "item_id", "cosine", "lcs_share", "answer_share"])

        found = found.union(source.mapInArrow(search, schema).withColumn("block", F.lit(b)))
    if blocks > 1:
        key = ("doc_id", "digest", "item_id")
        found = (
            found.groupBy(*key, "block").agg(F.max(F.struct("lcs_share", "answer_share", "cosine")).alias("best"), F.count("*").alias("rows"))
            .groupBy(*key).agg(F.max("best").alias("best"), F.max("rows").alias("rows"))
            .select("doc_id", "item_id", "best.*", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("copy"))
        )
    return found.select("doc_id", "item_id", "cosine", "lcs_share", "answer_share")


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that hold no benchmark item, with the columns of docs."""
    row = free_name(docs, "row")
    key: Column = F.xxhash64(F.col(doc_id), text_of(text))
    marked = docs.withColumn(row, key)
    bad = leaks(marked, benchmark, row, text).select(F.col("doc_id").alias(row)).distinct()
    return marked.join(sized(bad), row, "left_anti").select(*docs.columns)
