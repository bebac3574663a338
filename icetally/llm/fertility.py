"""Quality rules by tokeniser fertility (operator 4).

A public vocabulary with byte fallback encodes the words of each whole text. Characters per token, the share of
byte-fallback tokens and the entropy of the tokens (as a share of the largest that a text of this many tokens can
have) must lie inside a band, chosen by the language of the row or, if it is unknown, by the script of most
letters. Before that the counting rules of `counts` apply. Everything happens inside the row; nothing is shuffled.

Defined results: a null or blank text has no words, no tokens and fails the base rules; repeated rows are judged
each; a null or unknown language falls back to the script; other columns stay, clashing outputs take free names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, free_name

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
#: Tokens above which the largest possible entropy is no longer raised.
ENTROPY_TOKENS = 2000
#: Characters per token (least, most), largest byte-fallback share, least entropy share. The least values are set from
#: the spread of texts of each language with a margin. The most is that of the script: ordinary prose has 2.8 to 4.3
#: characters per token, well above invented words, and long tokens are no sign of a bad text. Scripts without a
#: language have wide bands.
LANGUAGE_BANDS = {
    "de": (1.95, 8.0, 0.05, 0.57),
    "en": (1.78, 8.0, 0.05, 0.57),
    "es": (1.70, 8.0, 0.05, 0.57),
    "fr": (1.60, 8.0, 0.05, 0.57),
}
SCRIPT_BANDS = {
    "latin": (1.2, 8.0, 0.2, 0.5),
    "cyrillic": (0.8, 8.0, 0.3, 0.5),
    "cjk": (0.3, 4.0, 0.8, 0.4),
    "other": (0.2, 8.0, 1.0, 0.4),
}
#: Words whose ids one worker remembers; it starts afresh beyond that.
REMEMBERED = 200_000
_WORDS = re.compile(WORD)
_SYMBOLS = re.compile(r"[#*$%&|<>]")


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> tuple[sentencepiece.SentencePieceProcessor, np.ndarray, dict]:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return model, np.array([model.is_byte(i) for i in range(model.get_piece_size())]), {}


def counts(text: str, found: list[str]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of a text and its words."""
    seen: set[str] = set()
    dup_lines = 0
    for line in text.split("\n"):
        if line in seen:
            dup_lines += 1
        elif _WORDS.search(line):
            seen.add(line)
    windows = list(zip(found, found[1:], found[2:]))
    often = {w for w, c in Counter(windows).items() if c > 1}
    repeated, end = 0, 0
    if often:
        for i, w in enumerate(windows):
            if w in often:
                repeated += i + 3 - max(i, end)
                end = i + 3
    return sum(map(len, found)), len(_SYMBOLS.findall(text)), dup_lines, repeated


def fertility(found: list[str], path: str = VOCABULARY) -> tuple[float, float, float]:
    """Characters per token, byte-fallback share, entropy share of the words of a text."""
    if not found:
        return 0.0, 0.0, 0.0
    model, is_byte, known = _vocabulary(path)
    often = Counter(found)
    new = [w for w in often if w not in known]
    if len(known) + len(new) > REMEMBERED:
        known.clear()
        new = list(often)
    known.update(zip(new, model.encode(new, num_threads=1)))
    lists = [known[w] for w in often]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    weights = np.repeat(np.fromiter(often.values(), np.int64, len(often)), sizes)
    ids = np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))
    n = int(weights.sum())
    if not n:
        return 0.0, 0.0, 0.0
    kinds, where = np.unique(ids, return_inverse=True)
    each = np.bincount(where, weights)
    entropy = math.log2(n) - float((each * np.log2(each)).sum()) / n
    most = math.log2(max(2, min(n, ENTROPY_TOKENS)))
    return sum(map(len, found)) / n, float(each[is_byte[kinds]].sum()) / n, entropy / most


def script(text: str) -> str:
    """The script that most letters of a text belong to, by code point ranges."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = {
        "latin": ((points >= 65) & (points <= 90) | (points >= 97) & (points <= 122) | (points >= 192) & (points < 592)).sum(),
        "cyrillic": ((points >= 0x400) & (points < 0x530)).sum(),
        "cjk": ((points >= 0x3040) & (points < 0xA000) | (points >= 0xAC00) & (points < 0xD7B0)).sum(),
    }
    best = max(letters, key=letters.get)
    return best if 2 * letters[best] >= (points > 64).sum() and letters[best] else "other"


def inside(text: str, lang: str | None, chars_per_token: float, fallback: float, entropy: float) -> bool:
    least, most, bytes_most, entropy_least = LANGUAGE_BANDS.get(lang) or SCRIPT_BANDS[script(text)]
    return least <= chars_per_token <= most and fallback <= bytes_most and entropy >= entropy_least


_FIELDS = {
    "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
    "n_repeat_words": "bigint", "base_failed": "boolean", "chars_per_token": "double", "fallback_share": "double",
    "entropy_share": "double", "kept": "boolean",
}


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", path: str = VOCABULARY) -> DataFrame:
    """docs, the counts, the three measures, base_failed and kept."""

    @F.arrow_udf(", ".join(f"{k} {v}" for k, v in _FIELDS.items()))
    def rules(texts: pa.Array, langs: pa.Array) -> pa.Array:
        rows = []
        for t, code in zip(texts.to_pylist(), langs.to_pylist()):
            found = _WORDS.findall(t)
            chars, symbols, dup_lines, repeated = counts(t, found)
            failed = len(found) < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * len(found)
            measures = fertility(found, path)
            rows.append((len(found), chars, symbols, dup_lines, repeated, failed, *measures,
                         not failed and inside(t, code, *measures)))
        columns = list(zip(*rows)) or [()] * len(_FIELDS)
        kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
        return pa.StructArray.from_arrays(
            [pa.array(c, kinds[k]) for c, k in zip(columns, _FIELDS.values())], names=list(_FIELDS)
        )

    packed = free_name(docs, "measured")
    language = F.col(lang).cast("string") if lang in docs.columns else F.lit(None).cast("string")
    judged = docs.withColumn(packed, rules(F.coalesce(F.col(text), F.lit("")), language))
    return judged.withColumns({free_name(docs, f): F.col(f"{packed}.{f}") for f in _FIELDS}).drop(packed)
