"""Byte-level BPE encoding and decoding with a local rank file (operator 10).

Encoding runs tiktoken inside Arrow batches. A long text is first cut at places where the splitting pattern
starts a new match whatever surrounds it, so that one call never holds more than a piece of it; the ids are those
of the whole text. Nothing is shuffled.

Defined results: a null or empty text has no ids and decodes to no bytes; repeated rows are encoded each on their
own; an empty table gives an empty table; other columns stay, also one that has the name of an output (the output
then takes a free name, see `encode`). A null list of ids decodes to no bytes.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Characters of a text that one call encodes, up to the next safe boundary.
PIECE = 1 << 16
#: A blank after one of these and before one of these always starts a match of the pattern: nothing but a run of
#: blanks reaches across a blank, and a run of blanks does not begin before it.
SAFE = re.compile(r"(?<=[A-Za-z0-9.,;:!?]) (?=[A-Za-z0-9])")


@lru_cache(maxsize=4)
def encoding(ranks_path: str) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces of about `size` characters, cut at safe boundaries only."""
    start = 0
    while len(text) - start > size:
        found = SAFE.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


def encode_text(text: str, ranks_path: str = RANKS, size: int = PIECE) -> np.ndarray:
    code = encoding(ranks_path)
    if len(text) <= size:
        return code.encode_to_numpy(text, disallowed_special=())
    return np.concatenate([code.encode_to_numpy(x, disallowed_special=()) for x in pieces(text, size)])


def encode(docs: DataFrame, text: str = "text", out: str = "token_ids", ranks_path: str = RANKS) -> DataFrame:
    """docs and the ids of each text as `array<int>`; `out` gets a number if docs has a column of that name."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        found = [encode_text(x.as_py() or "", ranks_path) for x in texts]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
        flat = np.concatenate(found).astype(np.int32) if found else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return docs.withColumn(free_name(docs, out), ids(F.coalesce(F.col(text), F.lit(""))))


def token_counts(docs: DataFrame, text: str = "text", out: str = "n_tokens", ranks_path: str = RANKS) -> DataFrame:
    """docs and the number of tokens of each text; the ids stay in the worker."""

    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array([len(encode_text(x.as_py() or "", ranks_path)) for x in texts], pa.int64())

    return docs.withColumn(free_name(docs, out), count(F.coalesce(F.col(text), F.lit(""))))


def decode(docs: DataFrame, ids: str = "token_ids", out: str = "decoded", ranks_path: str = RANKS) -> DataFrame:
    """docs and the bytes of each list of ids; ids without a rank raise an error."""

    @F.arrow_udf("binary")
    def raw(lists: pa.Array) -> pa.Array:
        code = encoding(ranks_path)
        flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        return pa.array([code.decode_bytes(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.binary())

    return docs.withColumn(free_name(docs, out), raw(F.coalesce(F.col(ids), F.array().cast("array<int>"))))
