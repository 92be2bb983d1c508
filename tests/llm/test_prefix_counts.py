"""Token counts of prefixes against the library, which encodes each prefix anew."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from candlewright.llm import prefix_counts
from candlewright.llm.prefix_counts import Counter, packed, unpacked

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "the ", "They're", " don't", "  ", "\n", "\n\n", "\t", " ", "é", "ß", "漢字", "🙂", "'", "'re", "'ll ", "<|endoftext|>", "<|end", "|>",
    "123", " 4", "!!", "...", " ", "xxxxx", "ing", "tion", " un", "able", "​", "é", "՘", "\U0001fae9",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def content():
    with open(PATH, encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def counter(content):
    return Counter(content, public_tokenizers.PATTERN)


def brute(library, text):
    return [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(1, len(text) + 1)]


def counts_of(counter, text):
    return np.concatenate([*counter.along(text)] or [np.zeros(0, np.int64)]).tolist()


def test_every_prefix_same_as_library(library, counter):
    rng = random.Random(5)
    for _ in range(400):
        text = "".join(rng.choices(PARTS, k=rng.randrange(0, 14)))
        assert counts_of(counter, text) == brute(library, text), text


def test_long_texts_are_read_in_parts(library, counter, monkeypatch):
    rng = random.Random(6)
    for part, chunk in ((1, 3), (7, 16), (40, 1000)):
        monkeypatch.setattr(prefix_counts, "PART", part)
        monkeypatch.setattr(prefix_counts, "CHUNK", chunk)
        for _ in range(40):
            text = "".join(rng.choices(PARTS, k=rng.randrange(0, 40)))
            chunks, n, last = packed(counter.along(text))
            want = brute(library, text)
            assert np.concatenate([np.zeros(0), *map(unpacked, chunks)]).tolist() == want
            assert (n, last) == (len(text), want[-1] if want else 0)


def test_forgetting_changes_nothing(library, counter, monkeypatch):
    monkeypatch.setattr(prefix_counts, "KNOWN_WORDS", 3)
    for text in ("one two  three four", "They're <|endoftext|> here\n\n "):
        counter.rest()
        assert counts_of(counter, text) == brute(library, text)


def test_answers_from_stored_counts(spark, docs_of, library, content, tmp_path):
    rng = random.Random(7)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(0, 60))) for _ in range(40)] + [None, "", "x" * 3000]
    vocabulary = spark.sparkContext.broadcast(content)
    told = prefix_counts.prefix_counts(docs_of(list(enumerate(texts)) + [(None, "a b"), (None, "a b")]), vocabulary, public_tokenizers.PATTERN)
    told.write.parquet(str(tmp_path / "counts"))
    stored = spark.read.parquet(str(tmp_path / "counts"))
    asked = prefix_counts.longest_within(prefix_counts.tokens_at(stored.withColumn("place", F.col("n_chars") - 2), "place"), 17).collect()
    assert len(asked) == len(texts) + 2 and sum(r["doc_id"] is None for r in asked) == 2
    for row in (r for r in asked if r["doc_id"] is not None):
        text = texts[row["doc_id"]] or ""
        want = [0, *brute(library, text)]
        assert (row["n_bytes"], row["n_chars"], row["n_tokens"]) == (len(text.encode()), len(text), want[-1])
        assert row["tokens_at"] == (want[len(text) - 2] if len(text) >= 2 else None)
        assert row["fit_chars"] == max(i for i, n in enumerate(want) if n <= 17)


def test_query_rows_empty_table_and_other_columns(spark, library, content):
    docs = spark.createDataFrame([("k1", "word " * 2000, 1, "x"), ("k2", None, 2, "y")], "doc_id string, text string, n_tokens int, counts string")
    vocabulary = spark.sparkContext.broadcast(content)
    rows = {r["doc_id"]: r for r in prefix_counts.token_budget(docs, vocabulary, public_tokenizers.PATTERN).collect()}
    assert rows["k1"]["n_tokens"] == len(library.encode("word " * 2000).ids) and rows["k1"]["over_limit"]
    assert len(library.encode(("word " * 2000)[: rows["k1"]["fit_chars"]]).ids) == 1024
    assert (rows["k2"]["n_bytes"], rows["k2"]["n_tokens"], rows["k2"]["over_limit"], rows["k2"]["fit_chars"]) == (0, 0, False, 0)
    assert prefix_counts.token_budget(docs.limit(0), vocabulary, public_tokenizers.PATTERN).count() == 0
