"""Exact token counts at every prefix of a text, by dynamic programming over the merges of a byte-level BPE.

The ids of a prefix end in exactly one token: the one that ends there and stands rightly behind the last
token of the prefix before it. Two tokens stand rightly together if their joined bytes are encoded as
these two. So the count at a place is one more than at the place where its last token begins, and one
pass over a pre-token gives the counts of all its prefixes. A pre-token that occurs again is looked up.

Counts of the pre-tokens add up along a text, but for three places where cutting a text changes how it
is split: between the last two characters of a run of white space (the run is one pre-token if nothing
follows), inside a contraction, and inside the string of a special token (ordinary until it is complete).

A stored text answers how many tokens any prefix has, and how much of it fits a budget, without its text
and without encoding. Counts are differences in packed chunks of CHUNK characters, each with the count
before it.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from candlewright.llm.blocks import pack, unpack
from candlewright.llm.common import pieces, ragged, strings

CHUNK = 1 << 18
#: A longer text is read in parts, cut where white space begins.
PART = 1 << 19
#: Pre-tokens that a task remembers.
KNOWN_WORDS = 1 << 19
#: Pairs of tokens that a task remembers.
KNOWN_PAIRS = 1 << 21
LIMIT = 1024


def byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: itself if printable, else one above 255 in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _view(values: array) -> np.ndarray:
    """The values, not copied; the array can't grow while the view is held."""
    return np.frombuffer(values, values.typecode) if values else np.zeros(0, values.typecode)


class Counter(dict):
    """Slot of each pre-token in the arrays of its counts, computed when it is first met."""

    def __init__(self, content: str, pattern: str):
        told = json.loads(content)
        self.letters = byte_letters()
        bytes_of = {c: b for b, c in self.letters.items()}
        specials = sorted((t["content"] for t in told["added_tokens"]), key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None
        library = Tokenizer.from_str(content)
        self.model, self.splitter = library.model, library.pre_tokenizer
        self.tokens = {bytes(bytes_of[c] for c in t): i for t, i in told["model"]["vocab"].items() if set(t) <= bytes_of.keys()}
        self.ends = dict.fromkeys((t[i:] for t in self.tokens for i in range(1, len(t))), -1) | self.tokens
        self.data = {i: t for t, i in self.tokens.items()}
        self.pairs: dict[int, bool] = {}
        self.pattern = regex.compile(pattern)
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.names: list[str] = []
        self.counts = array("i")
        self.starts = array("q")
        self.sizes = array("q")
        self.totals = array("q")
        self.blank = array("b")
        self.begins_blank = array("b")

    def ids(self, data: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize("".join(map(self.letters.__getitem__, data)))]

    def rest(self) -> None:
        """Forget what has grown too large, between two texts."""
        if len(self) > KNOWN_WORDS:
            self.reset()
        if len(self.pairs) > KNOWN_PAIRS:
            self.pairs.clear()

    def matches(self, text: str) -> list[str]:
        """The pre-tokens of a text, as the library splits it."""
        if _RARE.search(text):
            return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]
        return self.pattern.findall(text)

    def together(self, one: int, other: int) -> bool:
        """Whether two tokens stand rightly one behind the other; -1 is the beginning."""
        ids = [other] if one < 0 else [one, other]
        return self.ids(b"".join(self.data[i] for i in ids)) == ids

    def prefixes(self, data: bytes) -> list[int]:
        """Tokens of each prefix of a pre-token's bytes, from one byte on."""
        ends, known = self.ends, self.pairs.get
        last, counts = [0], [0]  # a last token counts from one and stands in the upper half of a pair
        for stop in range(1, len(data) + 1):
            start = stop - 1
            while True:  # the bytes from `start` on end a token as long as no last token is found
                token = ends[data[start:stop]]
                if token >= 0:
                    good = known(last[start] | token)
                    if good is None:
                        good = self.pairs[last[start] | token] = self.together((last[start] >> 32) - 1, token)
                    if good:
                        break
                start -= 1
            last.append(token + 1 << 32)
            counts.append(counts[start] + 1)
        del counts[0]
        return counts

    def by_character(self, word: str) -> list[int]:
        if len(word) > 2 and word[0] == "'" and word[1].isalpha():  # a contraction: cut short it is two pre-tokens
            cut = [sum(self.prefixes(m.encode())[-1] for m in self.matches(word[:i])) for i in range(1, len(word))]
            return [*cut, self.prefixes(word.encode())[-1]]
        data = word.encode()
        counts = self.prefixes(data)
        if len(data) == len(word):
            return counts
        return [n for n, after in zip(counts, data[1:] + b"a") if after & 0xC0 != 0x80]

    def __missing__(self, word: str) -> int:
        counts = self.by_character(word)
        self[word] = slot = len(self.names)
        self.names.append(word)
        self.starts.append(len(self.counts))
        self.sizes.append(len(counts))
        self.totals.append(counts[-1])
        self.blank.append(word.isspace())
        self.begins_blank.append(word[0].isspace())
        self.counts.extend(counts)
        return slot

    def _ordinary(self, text: str) -> np.ndarray:
        """Counts at every prefix of a text without special tokens."""
        slots = np.fromiter(map(self.__getitem__, self.matches(text)), np.int64)
        runs, at = [], slots[:0]
        if len(slots):
            at = np.flatnonzero(_view(self.blank)[slots[:-1]] & _view(self.begins_blank)[slots[1:]])
            runs = [self[self.names[slots[i]] + self.names[slots[i + 1]][0]] for i in at.tolist()]
        totals, sizes = _view(self.totals)[slots], _view(self.sizes)[slots]
        base = np.cumsum(totals) - totals
        out = _view(self.counts)[ragged(_view(self.starts)[slots], sizes)] + np.repeat(base, sizes)
        if runs:
            out[np.cumsum(sizes)[at]] = base[at] + _view(self.totals)[runs]
        return out

    def _parts(self, text: str) -> Iterator[str]:
        """The text, cut where a run of white space begins behind PART characters or more."""
        start = 0
        while len(text) - start > PART:
            found = _CUT.search(text, start + PART)
            if not found:
                break
            yield text[start : found.start() + 1]
            start = found.start() + 1
        yield text[start:]

    def along(self, text: str) -> Iterator[np.ndarray]:
        """Counts at every prefix of the text, in parts."""
        base = 0
        sections = self.specials.split(text) if self.specials else [text]
        for i in range(0, len(sections), 2):
            special = sections[i + 1] if i + 1 < len(sections) else ""
            left = len(sections[i])
            at_end = base
            for part in self._parts(sections[i] + special):
                counts = self._ordinary(part) + base
                if not len(counts):
                    continue
                if 0 < left <= len(counts):
                    at_end = int(counts[left - 1])
                left -= len(counts)
                base = int(counts[-1])
                if special and left == -len(special):
                    base = counts[-1] = at_end + 1
                yield counts


@lru_cache(1)
def counter_of(content: str, pattern: str) -> Counter:
    """The counter of a Python worker: it outlives a task."""
    return Counter(content, pattern)


_CUT = re.compile(r"\S(?=\s)")
#: Characters outside long settled blocks: the tables of the pattern engine and of the library differ in age, so the library splits these texts.
_RARE = re.compile("[^\x00-\u0557\u1e00-\u206f\u20a0-\u20bf\u3000-\u30ff\u4e00-\u9fea\uac00-\ud7a3]")


def packed(parts: Iterator[np.ndarray]) -> tuple[list[bytes], int, int]:
    """Chunks of counts, the number of places, and the last count."""
    chunks, waiting, n, last = [], np.zeros(0, np.int64), 0, 0
    for counts in parts:
        waiting = np.concatenate((waiting, counts))
        n += len(counts)
        while len(waiting) >= CHUNK:
            chunks.append(pack(np.array([last], np.int64), np.diff(waiting[:CHUNK], prepend=last).astype(np.int32)))
            last, waiting = int(waiting[CHUNK - 1]), waiting[CHUNK:]
    if len(waiting):
        chunks.append(pack(np.array([last], np.int64), np.diff(waiting, prepend=last).astype(np.int32)))
        last = int(waiting[-1])
    return chunks, n, last


def unpacked(chunk: bytes) -> np.ndarray:
    before, steps = unpack(chunk)
    return before[0] + np.cumsum(steps, dtype=np.int64)


def prefix_counts(docs: DataFrame, vocabulary: Broadcast, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_chars, n_tokens, counts: the packed token counts at every prefix of every text.

    `vocabulary` is the content of a tokenizers file of a byte-level BPE that splits by `pattern`; strings of
    its special tokens count as one token. Null and empty texts have no tokens. Repeated rows each get a
    row; null ids stay null; an empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("_text"))
    names = ["doc_id", "n_bytes", "n_chars", "n_tokens", "counts"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(vocabulary.value, pattern)
        for piece in pieces(batches, "_text", 4 << 20):
            texts = strings(piece.column("_text")).to_pylist()
            told = []
            for text in texts:
                counter.rest()
                told.append(packed(counter.along(text)))
            sizes = pa.array([len(t.encode()) for t in texts], pa.int64())
            columns = [piece.column("doc_id"), sizes, *(pa.array([t[k] for t in told], pa.int64()) for k in (1, 2)), pa.array([t[0] for t in told], pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_chars long, n_tokens long, counts array<binary>")


def _answered(counted: DataFrame, name: str, answer, *inputs: str) -> DataFrame:
    """`counted` with a number from the counts and the other inputs of each row."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [answer(*row) for row in zip(*(batch.column(c) for c in inputs))]
            yield batch.append_column(name, pa.array(values, pa.int64()))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counted.schema.fields)
    return counted.mapInArrow(ask, f"{kinds}, `{name}` long")


def tokens_at(counted: DataFrame, place_col: str, out_col: str = "tokens_at") -> DataFrame:
    """The token count of the first `place_col` characters, from stored counts; null where the text is shorter."""

    def answer(counts, place):
        place = place.as_py()
        if not place:
            return place
        chunk = (place - 1) // CHUNK
        if place < 0 or chunk >= len(counts):
            return None
        held = unpacked(counts[chunk].as_py())
        at = (place - 1) % CHUNK
        return int(held[at]) if at < len(held) else None

    return _answered(counted, out_col, answer, "counts", place_col)


def longest_within(counted: DataFrame, budget: int, out_col: str = "fit_chars") -> DataFrame:
    """Characters of the longest prefix that has `budget` tokens or fewer, from stored counts."""

    def answer(n_chars, n_tokens, counts):
        if n_tokens.as_py() <= budget:
            return n_chars.as_py()
        for chunk in range(len(counts) - 1, -1, -1):
            fits = np.flatnonzero(unpacked(counts[chunk].as_py()) <= budget)
            if len(fits):
                return chunk * CHUNK + int(fits[-1]) + 1
        return 0

    return _answered(counted, out_col, answer, "n_chars", "n_tokens", "counts")


def token_budget(docs: DataFrame, vocabulary: Broadcast, pattern: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars (the longest prefix within the limit) under the rules of `prefix_counts`."""
    told = longest_within(prefix_counts(docs, vocabulary, pattern, id_col, text_col), limit)
    return told.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fit_chars")
