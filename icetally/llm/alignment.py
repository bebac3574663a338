"""Cross-tokenizer alignment by a minimal perfect hash of linked token pairs (operator 11).

Two tokenizers encode each text: A a byte-level BPE (of a blank and the text), B a BPE with byte fallback (which puts the
blank before the text itself). Byte offsets where tokens of both end cut a text into groups; every A token of a group is
linked with every B token of it. A pair of ids counts in how many documents it is linked.

1. The texts are encoded once and their ids written to the shared folder, with the first groups, links and digest. Each
   task lists the pairs of ids it meets for the first time.
2. The distinct pairs get a minimal perfect hash, built in buckets by Spark tasks.
3. First pass over the ids: each task aligns its documents and counts in one dense vector, indexed by the hash. The
   vectors are cut into chunks (empty ones are left out) and summed in a tree.
4. Second pass: the documents are aligned again and look up the counts of their links; keys by slot are compared.

What a task holds are the pairs of one part: A ids are dealt to ranges of at most PART pairs (or one id, which has at
most one pair for each B id). A part's counts include all pairs of its A ids, so the highest count of an A id is known
inside its part. With more parts the passes are repeated and their sums added; nothing grows with the documents.

Defined results: a null or empty text, or one whose tokens of A or B do not join to the blank and the text, has no
tokens, zeros and the digest ''; repeated rows are documents of their own; an empty table gives an empty table; other
columns stay but for the text, clashing outputs take free names.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import pieces
from .common import cut, free_name, text_of, written
from .perfect_hash import built

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")
#: Linked pairs of one part; slots of one chunk of a count vector; vectors that one step of the tree adds.
PART, CHUNK, FAN = 1 << 21, 1 << 14, 16
#: Tokens that are aligned at a time, and links that are listed at a time.
PORTION, SLICE = 1 << 18, 1 << 21
#: Links above which a group is counted by distinct ids first.
WIDE_GROUP = 1 << 12
#: Texts of these characters only are split alike by every version of the pattern's character classes.
PLAIN = re.compile("[\t\n\r\x20-\x7eÀ-ɏ‐-‧]*")


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the rest in turn."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Spelling:
    """The bytes of every entry of a list, one after another, so that whole sequences of entries are spelled at once."""

    def __init__(self, entries: list[bytes]) -> None:
        self.sizes = np.array([len(x) for x in entries], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(entries), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(sizes.sum())]


@dataclass
class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and a quicker encoder of A for plain texts if its file allows one."""

    a: tokenizers.Tokenizer
    b: sentencepiece.SentencePieceProcessor
    a_bytes: list[bytes]
    b_bytes: list[bytes]
    spelled: tuple[Spelling, Spelling]
    quick: tiktoken.Encoding | None
    cuts: bool

    def ids_a(self, text: str) -> np.ndarray:
        if self.quick is not None and PLAIN.fullmatch(text):
            return self.quick.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        return np.array(self.a.encode(text, add_special_tokens=False).ids, np.int64)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of blank and text by A and of the text by B; none if the tokens' bytes are not those of the text."""
        none = np.empty(0, np.int64)
        if not text:
            return none, none
        parts = list(pieces(text)) if self.cuts else [text]
        a = np.concatenate([self.ids_a(p if i else " " + p) for i, p in enumerate(parts)])
        # a later part begins with the blank that B adds itself
        b = np.concatenate([np.array(self.b.encode(p[1:] if i else p), np.int64) for i, p in enumerate(parts)])
        whole = (" " + text).encode("utf-8", "surrogatepass")
        if any(table.of(ids).tobytes() != whole for ids, table in zip((a, b), self.spelled)):
            return none, none
        return a, b


@lru_cache(maxsize=2)
def load(a_path: str, b_path: str) -> Tokenizers:
    with open(a_path, encoding="utf-8") as file:
        model = json.load(file)
    a = tokenizers.Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    letters, vocabulary = byte_of(), model["model"]["vocab"]
    a_bytes = [b""] * a.get_vocab_size()
    for token, i in vocabulary.items():
        if all(c in letters for c in token):
            a_bytes[i] = bytes(letters[c] for c in token)
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    b_bytes, joins = [], False
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        b_bytes.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
        joins |= re.search("[^▁]▁", piece) is not None
    return Tokenizers(a, b, a_bytes, b_bytes, (Spelling(a_bytes), Spelling(b_bytes)), _quick(model, a_bytes), not joins)


def _quick(model: dict, a_bytes: list[bytes]) -> tiktoken.Encoding | None:
    """The same vocabulary in an encoder that ranks merges by id: only if the file's merges are in the order of their ids
    and its words are split by the usual pattern."""
    vocabulary, splitter = model["model"]["vocab"], model.get("pre_tokenizer") or {}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
    made = [vocabulary["".join(m)] for m in merges]
    usual = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
    if model.get("normalizer") or not usual or made != sorted(set(made)) or made[:1] != [256]:
        return None
    added = {t["id"] for t in model.get("added_tokens", [])}
    ranks = {b: i for i, b in enumerate(a_bytes) if b and i not in added}
    return tiktoken.Encoding("local-a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@dataclass
class Aligned:
    """Groups of some documents: of each token its document and group, of each group its document and tokens of A and B."""

    a: np.ndarray
    b: np.ndarray
    doc_a: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    doc: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray


def align(a_lists: list[np.ndarray], b_lists: list[np.ndarray], a_size: np.ndarray, b_size: np.ndarray) -> Aligned:
    """Documents one after another: their last tokens end together, so no group reaches over two of them."""
    a, b = _flat(a_lists), _flat(b_lists)
    end_a, end_b = np.cumsum(a_size[a]), np.cumsum(b_size[b])
    both_a, both_b = _in(end_a, end_b), _in(end_b, end_a)  # the last ends are equal
    group_a, group_b = np.cumsum(both_a) - both_a, np.cumsum(both_b) - both_b
    doc_a = np.repeat(np.arange(len(a_lists)), [len(x) for x in a_lists])
    n = int(both_a.sum())
    return Aligned(a, b, doc_a, group_a, group_b, doc_a[both_a],
                   np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n))


def _flat(lists: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int64), *lists]).astype(np.int64)


def _in(some: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of the byte offsets `some` are among `others`; the largest of both is the same."""
    marked = np.zeros(int(others[-1]) + 1 if len(others) else 0, bool)
    marked[others] = True
    return marked[some]


def links(x: Aligned, n_ids: int, wide_group: int = WIDE_GROUP, slice_size: int = SLICE) -> tuple[np.ndarray, ...]:
    """document, pair (A id * n_ids + B id) and number of links of each pair that a document holds, once each."""
    found = [_merged(d, k, w) for d, k, w in _listed(x, n_ids, wide_group, slice_size)]
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none
    return found[0] if len(found) == 1 else _merged(*(np.concatenate(c) for c in zip(*found)))


def _listed(x: Aligned, n_ids: int, wide_group: int, slice_size: int) -> Iterator[tuple[np.ndarray, ...]]:
    first_b = np.cumsum(x.n_b) - x.n_b
    wide = x.n_a * x.n_b > wide_group
    own = np.flatnonzero(~wide[x.group_a])
    each = x.n_b[x.group_a[own]]
    until = np.cumsum(each)
    start = 0
    while start < len(own):
        stop = max(start + 1, int(np.searchsorted(until, (until[start - 1] if start else 0) + slice_size, "right")))
        token, n = own[start:stop], each[start:stop]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        partner = x.b[np.repeat(first_b[x.group_a[token]], n) + step]
        yield np.repeat(x.doc_a[token], n), np.repeat(x.a[token] * n_ids, n) + partner, None
        start = stop
    first_a = np.cumsum(x.n_a) - x.n_a
    for g in np.flatnonzero(wide):
        ids_a, count_a = np.unique(x.a[first_a[g] : first_a[g] + x.n_a[g]], return_counts=True)
        ids_b, count_b = np.unique(x.b[first_b[g] : first_b[g] + x.n_b[g]], return_counts=True)
        rows = max(1, slice_size // len(ids_b))
        for i in range(0, len(ids_a), rows):
            pairs = (ids_a[i : i + rows, None] * n_ids + ids_b).ravel()
            yield np.full(len(pairs), x.doc[g]), pairs, (count_a[i : i + rows, None] * count_b).ravel()


def _merged(doc: np.ndarray, pair: np.ndarray, weight: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """Each (document, pair) once, with the sum of its weights; without weights each counts one."""
    span = int(pair.max(initial=0)) + 1
    both = doc * span + pair
    if weight is None:
        both.sort()
    else:
        order = np.argsort(both)
        both, weight = both[order], weight[order]
    new = np.flatnonzero(np.diff(both, prepend=-1))
    if weight is None:
        total = np.diff(new, append=len(both))
    else:
        total = np.add.reduceat(weight, new) if len(new) else weight
    return *np.divmod(both[new], span), total


def digests(x: Aligned, n_docs: int, names: Spelling, width: int) -> list[str]:
    """The digest of the groups of each document written out as `a1,a2|b1;a3|b2,b3`; '' without tokens."""
    end_a, end_b = np.cumsum(x.n_a), np.cumsum(x.n_b)
    out = np.empty(len(x.a) + len(x.b), np.int64)
    is_last = np.zeros(len(x.a), bool)
    is_last[end_a - 1] = True
    out[np.arange(len(x.a)) + (end_b - x.n_b)[x.group_a]] = x.a + width * is_last
    is_last = np.zeros(len(x.b), bool)
    is_last[end_b - 1] = True
    out[np.arange(len(x.b)) + end_a[x.group_b]] = x.b + width * (2 + is_last)
    text = memoryview(names.of(out))
    tokens = np.cumsum(_total(x.doc, x.n_a + x.n_b, n_docs))
    letters = np.concatenate([[0], np.cumsum(names.sizes[out])])
    stops = letters[np.concatenate([[0], tokens])].tolist()
    return [hashlib.sha256(text[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(stops, stops[1:])]


@lru_cache(maxsize=2)
def _names(width: int) -> Spelling:
    """An id followed by what comes after it: A inside and at the end of its side, B inside and at the end of its group."""
    return Spelling([f"{i}{mark}".encode() for mark in ",|,;" for i in range(width)])


def _portions(sizes: list[int], most: int = PORTION) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring rows of about `most` tokens."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        total += n
        if total >= most or i + 1 == len(sizes):
            yield start, i + 1
            start, total = i + 1, 0


def _kind(n_ids: int) -> type:
    """The narrowest type that holds the ids of a vocabulary."""
    return np.uint16 if n_ids <= 1 << 16 else np.uint32


def _ids(column: pa.Array, n_ids: int) -> list[np.ndarray]:
    kind = _kind(n_ids)
    return [np.frombuffer(x.as_buffer(), kind) if x.as_buffer().size else np.empty(0, kind) for x in column]


def _total(doc: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.add.at(out, doc, values)
    return out


@dataclass
class Pair:
    """Paths of both tokenizers, loaded where they are used."""

    a_path: str = A_PATH
    b_path: str = B_PATH

    def load(self) -> Tokenizers:
        return load(self.a_path, self.b_path)

    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(table.sizes for table in self.load().spelled)

    def aligned(self, batch: pa.RecordBatch) -> Iterator[tuple[int, int, Aligned]]:
        """Ranges of rows of a batch with columns a and b, aligned."""
        a_size, b_size = self.sizes()
        a, b = _ids(batch.column("a"), len(a_size)), _ids(batch.column("b"), len(b_size))
        for i, j in _portions([len(x) + len(y) for x, y in zip(a, b)]):
            yield i, j, align(a[i:j], b[i:j], a_size, b_size)


def encoded(docs: DataFrame, text: str, pair: Pair) -> DataFrame:
    """row (the other columns), a, b (ids as bytes), n_a, n_b, n_groups, n_links, groups_sha256, new_pairs; written.

    new_pairs: the pairs that a task meets for the first time, on the first row of the documents aligned together.
    """
    rest = [F.col(c) for c in docs.columns if c != text] or [F.lit(0).alias("none")]
    wide = docs.select(F.struct(*rest).alias("row"), text_of(text).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, (a_size, b_size) = pair.load(), pair.sizes()
        width, n_ids = max(len(a_size), len(b_size)), len(b_size)
        met = np.empty(0, np.int64)
        for batch in batches:
            coded = [both.encode(t.as_py()) for t in batch.column("text")]
            for i, j in _portions([len(a) + len(b) for a, b in coded]):
                a, b = [x for x, _ in coded[i:j]], [x for _, x in coded[i:j]]
                x = align(a, b, a_size, b_size)
                pairs = np.unique(links(x, n_ids)[1])
                new = np.setdiff1d(pairs, met, assume_unique=True)
                met = np.union1d(met, new)
                n = j - i
                yield pa.RecordBatch.from_arrays([
                    batch.column("row").slice(i, n),
                    pa.array([v.astype(_kind(len(a_size))).tobytes() for v in a], pa.binary()),
                    pa.array([v.astype(_kind(n_ids)).tobytes() for v in b], pa.binary()),
                    pa.array([len(v) for v in a], pa.int64()), pa.array([len(v) for v in b], pa.int64()),
                    pa.array(np.bincount(x.doc, minlength=n), pa.int64()), pa.array(_total(x.doc, x.n_a * x.n_b, n)),
                    pa.array(digests(x, n, _names(width), width), pa.string()),
                    pa.array([new.tolist()] + [None] * (n - 1), pa.list_(pa.int64())),
                ], ["row", "a", "b", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "new_pairs"])

    kind = wide.schema["row"].dataType.simpleString()
    return written(wide.mapInArrow(
        encode, f"row {kind}, a binary, b binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                "groups_sha256 string, new_pairs array<bigint>"), "zstd")


def parts_of(counts: list[tuple[int, int]], most: int) -> list[tuple[int, int, int]]:
    """Ranges of A ids (from, to, pairs) of at most `most` pairs, or one id."""
    out: list[tuple[int, int, int]] = []
    for a, n in sorted(counts):
        if out and out[-1][2] + n <= most:
            out[-1] = (out[-1][0], a, out[-1][2] + n)
        else:
            out.append((a, a, n))
    return out


def counted(coded: DataFrame, shared, pair: Pair, chunk: int = CHUNK, fan: int = FAN) -> np.ndarray:
    """Documents of each slot: a dense vector per task, in chunks, summed `fan` at a time until one of each is left."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table, n_ids = shared.value, len(pair.sizes()[1])
        total = np.zeros(len(table), np.int64)
        for batch in batches:
            for _, _, x in pair.aligned(batch):
                slots = table.slots(links(x, n_ids)[1])
                np.add.at(total, slots[slots >= 0], 1)
        task = TaskContext.get().partitionId()
        for i in range(0, len(total), chunk):
            part = total[i : i + chunk]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i // chunk], pa.int32()), pa.array([task], pa.int32()),
                     pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], ["chunk", "branch", "vector"])

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(v), np.int64) for v in frame.vector)
        return pd.DataFrame({"chunk": frame.chunk[:1], "branch": frame.branch[:1] // fan,
                             "vector": [zlib.compress(total.tobytes(), 1)]})

    schema = "chunk int, branch int, vector binary"
    ids = coded.select("a", "b")
    tree, branches = ids.mapInArrow(vectors, schema), ids.rdd.getNumPartitions()
    while branches > 1:
        up = tree.groupBy("chunk", F.floor(F.col("branch") / fan).alias("next")).applyInPandas(added, schema)
        tree, branches = up, -(-branches // fan)
    total = np.zeros(len(shared.value), np.int64)
    for r in tree.collect():
        part = np.frombuffer(zlib.decompress(r.vector), np.int64)
        total[r.chunk * chunk : r.chunk * chunk + len(part)] += part
    return total


def looked_up(coded: DataFrame, shared, pair: Pair) -> DataFrame:
    """coded with n_best and count_sum raised by what the links of a part give."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, count, best = shared.value
        n_ids = len(pair.sizes()[1])
        for batch in batches:
            sums = [np.empty((0, 2), np.int64)]
            for i, j, x in pair.aligned(batch):
                doc, key, n = links(x, n_ids)
                slots = table.slots(key)
                doc, n, slots = doc[slots >= 0], n[slots >= 0], slots[slots >= 0]
                sums.append(np.stack([_total(doc, n * best[slots], j - i), _total(doc, n * count[slots], j - i)], 1))
            sums = np.concatenate(sums)
            for i, name in enumerate(("n_best", "count_sum")):
                at = batch.schema.get_field_index(name)
                batch = batch.set_column(at, name, pa.array(batch.column(at).to_numpy() + sums[:, i]))
            yield batch

    return coded.mapInArrow(look, coded.schema)


def alignments(docs: DataFrame, text: str = "text", a_path: str = A_PATH, b_path: str = B_PATH,
               part: int = PART) -> DataFrame:
    """docs without the text, with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    spark, pair = docs.sparkSession, Pair(a_path, b_path)
    coded = encoded(docs, text, pair)
    n_ids = len(pair.sizes()[1])
    pairs = cut(coded.select(F.explode("new_pairs").alias("key")).distinct())
    sizes = pairs.groupBy(F.expr(f"key div {n_ids}").alias("a")).count().collect()
    ranges = parts_of([(r.a, r["count"]) for r in sizes], part)
    zero = F.lit(0).cast("bigint")
    coded = coded.drop("new_pairs").withColumns({"n_best": zero, "count_sum": zero})
    for at, (low, high, n) in enumerate(ranges):
        if at:
            coded = written(coded)
        own = pairs.where(F.col("key").between(low * n_ids, (high + 1) * n_ids - 1))
        table = built(own, n)
        if len(table) != n:
            raise RuntimeError("the perfect hash does not hold every pair")
        count = counted(coded, spark.sparkContext.broadcast(table), pair)
        most = np.zeros(high - low + 1, np.int64)
        first = table.keys // n_ids - low
        np.maximum.at(most, first, count)
        known = spark.sparkContext.broadcast((table, count, (count == most[first]).astype(np.int64)))
        coded = looked_up(coded, known, pair)
    others = [c for c in docs.columns if c != text]
    plain = docs.select(*others)
    outputs = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return coded.select(*(F.col("row")[c].alias(c) for c in others), *(F.col(c).alias(free_name(plain, c)) for c in outputs))
