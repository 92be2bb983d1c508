import hashlib
import random
import struct

import public_tokenizers
import pytest
import regex
import tiktoken

from candlewright.llm import byte_bpe as op
from candlewright.llm.queries import BYTE_BPE

PATH = public_tokenizers.path(BYTE_BPE)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=op.ranks_of(open(PATH, "rb").read()), special_tokens={})


def brute(encoding, doc_id, text):
    ids = encoding.encode_ordinary(text or "")
    packed = struct.pack(f"<{len(ids)}I", *ids)
    return doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def rows(rng):
    letters = "aeinrst éüñß'’-#123٣猫한\t\n\r\x0b\x1c\x85  ​\U00012000😀"
    texts = [None, "", " ", "\n\n  x", "we'll they're 'tis", "<|endoftext|>", "word " * 30_000, "x" * 20_000]
    texts += ["".join(rng.choices(letters, k=rng.randrange(300))) for _ in range(150)]
    return [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(5, texts[4])] * 3


@pytest.mark.parametrize("block_bytes", [16 << 20, 200])
def test_same_as_library(spark, docs_of, library, monkeypatch, block_bytes):
    monkeypatch.setattr(op.blocks, "BLOCK_BYTES", block_bytes)
    data = rows(random.Random(3))
    docs = docs_of(data).withColumn("row", op.F.lit(1)).withColumn("ids", op.F.lit("x"))
    found = op.round_trip(docs, op.vocabulary_of(spark, PATH), public_tokenizers.PATTERN)
    assert sorted(map(tuple, found.collect()), key=str) == sorted((brute(library, *r) for r in data), key=str)


def test_decode_joins_token_bytes(spark, library):
    texts = ["héllo  wörld", "", None]
    frame = spark.createDataFrame([(i, None if t is None else struct.pack(f"<{len(library.encode_ordinary(t))}I", *library.encode_ordinary(t))) for i, t in enumerate(texts)], "decoded int, ids binary")
    found = op.decode(frame, op.vocabulary_of(spark, PATH), out_col="bytes").collect()
    assert [r["bytes"] if r["bytes"] is None else r["bytes"].decode() for r in sorted(found)] == texts


def test_encode_gives_ids(spark, docs_of, library):
    found = op.encode(docs_of([(1, "some text"), (2, None)]), op.vocabulary_of(spark, PATH), public_tokenizers.PATTERN, ["doc_id", "lang"]).collect()
    assert {r["row"]["doc_id"]: list(struct.unpack(f"<{r['n_tokens']}I", r["ids"])) for r in found} == {1: library.encode_ordinary("some text"), 2: []}


def test_block_numbers_every_word_once():
    block = op.Block()
    block.add(None, ["a b a", "b c"], regex.compile(public_tokenizers.PATTERN).findall)
    places, words = block.packed(4)
    lengths, front, slots = op.unpack(places)
    names = [w for _, packed in words for w in _names(packed)]
    order = [*front.tolist(), *range(len(names))]
    assert lengths.tolist() == [3, 2] and sorted(names) == [b" a", b" b", b" c", b"a", b"b"]
    assert [names[order[s]] for s in slots] == [b"a", b" b", b" a", b"b", b" c"]


def _names(packed):
    lengths, data = op.unpack(packed)
    out, at = [], 0
    for n in lengths.tolist():
        out.append(data.tobytes()[at : at + n])
        at += n
    return out


def test_empty_table(spark, docs_of):
    assert op.round_trip(docs_of([]), op.vocabulary_of(spark, PATH), public_tokenizers.PATTERN).count() == 0
