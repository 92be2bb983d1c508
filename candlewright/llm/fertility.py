"""Quality rules by tokeniser fertility.

Two public vocabularies read every whole text: a byte-level BPE gives characters per token and the
entropy of the token distribution, a piece vocabulary gives the share of pieces that fall back to
bytes. Each text must stay inside the bands of its language, or of its script where no band is
stated for the language. Words are encoded on their own, so each different word of a piece of input
is encoded once.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewright.llm.common import pieces, ragged, sparing, strings, sums, words

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
#: Bytes of text that `drop_rejected` works on at once; the arrays over words and tokens take many times as much.
STAGE_BYTES = 2 << 20
#: Share of the most bits of entropy that a text of so many tokens can have.
ENTROPY_SHARE = 0.6


@dataclass(frozen=True)
class Band:
    """Texts outside are rejected: characters per token, share of byte pieces, bits of entropy per token.

    n tokens have log2(n) bits at most, so the entropy floor grows as ENTROPY_SHARE * log2(n), from
    `min_entropy` (about that of MIN_WORDS tokens) up to `full_entropy`.
    """

    min_chars: float
    max_chars: float
    max_bytes: float
    min_entropy: float
    full_entropy: float

    def entropy_floor(self, n_tokens: float) -> float:
        return min(self.full_entropy, max(self.min_entropy, ENTROPY_SHARE * math.log2(max(n_tokens, 1))))


# Bands by language.
LANGUAGE_BANDS = {
    "de": Band(1.85, 7.0, 0.05, 2.5, 4.3),
    "en": Band(1.80, 7.0, 0.05, 2.5, 4.3),
    "es": Band(1.72, 7.0, 0.05, 2.5, 4.3),
    "fr": Band(1.67, 7.0, 0.05, 2.5, 4.3),
}

# Bands by script, for texts without a language of the list above.
SCRIPT_BANDS = {
    "Latin": Band(1.2, 7.5, 0.10, 2.5, 4.0),
    "Cyrillic": Band(0.8, 6.0, 0.10, 2.5, 4.0),
    "Greek": Band(0.6, 4.0, 0.30, 2.5, 4.0),
    "Arabic": Band(0.6, 4.0, 0.30, 2.5, 4.0),
    "Hebrew": Band(0.6, 4.0, 0.40, 2.5, 4.0),
    "Devanagari": Band(0.3, 4.0, 0.60, 2.5, 3.5),
    "Thai": Band(0.3, 4.0, 0.70, 2.5, 3.5),
    "Han": Band(0.3, 3.0, 0.70, 2.5, 3.5),
    "Hiragana": Band(0.3, 3.0, 0.60, 2.5, 3.5),
    "Hangul": Band(0.3, 3.0, 0.80, 2.5, 3.5),
    "other": Band(0.2, 8.0, 1.00, 2.5, 3.5),
}


@dataclass
class Vocabularies:
    """File contents of the two vocabularies, small enough to go to every executor."""

    byte_bpe: Broadcast
    pieces: Broadcast
    pattern: str

    @staticmethod
    def load(spark: SparkSession, byte_bpe_path: str, piece_path: str, pattern: str) -> Vocabularies:
        contents = []
        for path in (byte_bpe_path, piece_path):
            with open(path, "rb") as file:
                contents.append(spark.sparkContext.broadcast(file.read()))
        return Vocabularies(*contents, pattern)


_loaded: dict[tuple[int, int], tuple] = {}


def ranks_of(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


def encoding_of(content: bytes, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks_of(content), special_tokens={})


def _tokenizers(vocabularies: Vocabularies) -> tuple:
    """Encoder, piece processor and which piece ids are bytes; built once for each worker."""
    key = hash(vocabularies.byte_bpe.value), hash(vocabularies.pieces.value)
    if key not in _loaded:
        _loaded.clear()
        model = sentencepiece.SentencePieceProcessor(model_proto=vocabularies.pieces.value)
        is_byte = np.array([model.is_byte(i) for i in range(model.vocab_size())])
        _loaded[key] = encoding_of(vocabularies.byte_bpe.value, vocabularies.pattern), model, is_byte
    return _loaded[key]


def _ragged_ids(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum())), np.concatenate(([0], np.cumsum(counts)))


def _scramble(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def repeated_words(ids: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each text the number of words inside windows that occur twice or more in it."""
    texts = np.diff(offsets)
    counts = np.maximum(texts - window + 1, 0)
    starts = ragged(offsets[:-1], counts)
    if not len(starts):
        return np.zeros(len(texts), np.int64)
    marks = _scramble(ids)
    rolled = np.zeros(len(starts), np.uint64)
    for k in range(window):
        rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + marks[starts + k]
    rolled ^= _scramble(np.repeat(np.arange(len(texts)), counts) + (1 << 40))
    ordered = np.sort(rolled)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(texts), np.int64)
    at = np.minimum(np.searchsorted(twice, rolled), len(twice) - 1)
    hits = starts[twice[at] == rolled]
    edges = np.zeros(len(ids) + 1, np.int32)
    np.add.at(edges, hits, 1)
    np.add.at(edges, hits + window, -1)
    return sums(np.cumsum(edges[:-1]) > 0, offsets)


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def token_entropy(token_ids: np.ndarray, offsets: np.ndarray, word_ids: np.ndarray, word_offsets: np.ndarray) -> np.ndarray:
    """Bits per token of each text's token distribution; tokens are given by different word."""
    per_word = np.diff(offsets)[word_ids]
    of = np.repeat(np.repeat(np.arange(len(word_offsets) - 1), np.diff(word_offsets)), per_word)
    seen = np.sort((of << 32) | token_ids[ragged(offsets[:-1][word_ids], per_word)])
    first = np.flatnonzero(np.concatenate(([True], seen[1:] != seen[:-1]))) if len(seen) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(seen))).astype(float)
    texts = seen[first] >> 32
    totals = np.bincount(of, minlength=len(word_offsets) - 1)
    spread = np.bincount(texts, counts * np.log2(counts), len(word_offsets) - 1)
    return np.where(totals > 0, np.log2(np.maximum(totals, 1)) - spread / np.maximum(totals, 1), 0.0)


def script_of(texts: pa.StringArray) -> list[str]:
    """Script of most letters of each text; `other` where no listed script has a letter."""
    names = [name for name in SCRIPT_BANDS if name != "other"]
    counts = np.stack([pc.count_substring_regex(texts, f"\\p{{{name}}}").to_numpy(zero_copy_only=False) for name in names])
    return [names[i] if top else "other" for i, top in zip(counts.argmax(0), counts.max(0))]


MEASURES = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "base_failed": "boolean",
    "kept": "boolean", "n_tokens": "long", "chars_per_token": "double", "byte_share": "double", "token_entropy": "double", "band": "string",
}


def measure(texts: pa.StringArray, languages: list[str | None], vocabularies: Vocabularies) -> dict[str, pa.Array]:
    """The columns of MEASURES for each text."""
    encoding, model, is_byte = _tokenizers(vocabularies)
    flat, offsets = words(texts)
    encoded = flat.dictionary_encode()
    ids, distinct = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary
    spelled = distinct.to_pylist()

    def total(per_word: np.ndarray) -> np.ndarray:
        return sums(per_word[ids], offsets)

    tokens, token_offsets = _ragged_ids([encoding.encode_ordinary(" " + word) for word in spelled])
    model_pieces, piece_offsets = _ragged_ids(model.encode(spelled, num_threads=1) if spelled else [])
    n_words, n_tokens, n_pieces = np.diff(offsets), total(np.diff(token_offsets)), total(np.diff(piece_offsets))
    chars = total(pc.utf8_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64))
    symbols = total(pc.count_substring_regex(distinct, "[#*$%&|<>]").to_numpy(zero_copy_only=False).astype(np.int64))
    repeated = repeated_words(ids, offsets)
    failed = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n_words)
    per_token = chars / np.maximum(n_tokens, 1)
    bytes_share = total(sums(is_byte[model_pieces], piece_offsets)) / np.maximum(n_pieces, 1)
    entropy = token_entropy(tokens, token_offsets, ids, offsets)

    names = [language if language in LANGUAGE_BANDS else None for language in languages]
    unknown = [i for i, name in enumerate(names) if name is None]
    for i, script in zip(unknown, script_of(texts.take(pa.array(unknown, pa.int64())))):
        names[i] = script
    bands = [LANGUAGE_BANDS.get(name) or SCRIPT_BANDS[name] for name in names]
    lowest, highest, most_bytes = (np.array([getattr(b, f) for b in bands]) for f in ("min_chars", "max_chars", "max_bytes"))
    least_entropy = np.array([b.entropy_floor(n) for b, n in zip(bands, n_tokens.tolist())])
    inside = (per_token >= lowest) & (per_token <= highest) & (bytes_share <= most_bytes) & (entropy >= least_entropy)
    duplicates = [duplicate_lines(text) for text in texts.to_pylist()]
    columns = [n_words, chars, symbols, np.array(duplicates, np.int64), repeated, failed, ~failed & inside, n_tokens, per_token, bytes_share, entropy]
    return dict(zip(MEASURES, [*map(pa.array, columns), pa.array(names)]))


def quality(docs: DataFrame, vocabularies: Vocabularies, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id and MEASURES of every row.

    Null texts have no words and fail the base rule, as blank ones do. Null and unlisted languages are
    judged by script. Repeated rows each get a row; an empty table gives an empty result; other columns
    are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            columns = measure(strings(piece.column("text")), piece.column("lang").to_pylist(), vocabularies)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *columns.values()], names=["doc_id", *columns])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(judge, f"doc_id {kind}, " + ", ".join(f"{name} {kind}" for name, kind in MEASURES.items()))


def drop_rejected(docs: DataFrame, vocabularies: Vocabularies, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of `docs` that `quality` keeps, with all their columns."""
    text_at, lang_at = docs.columns.index(text_col), docs.columns.index(lang_col)
    names = [f"c{i}" for i in range(len(docs.columns))]

    @sparing
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, names[text_at], STAGE_BYTES):
            yield piece.filter(measure(strings(piece.column(text_at)), piece.column(lang_at).to_pylist(), vocabularies)["kept"])

    renamed = docs.toDF(*names)
    return renamed.mapInArrow(judge, renamed.schema).toDF(*docs.columns)
