"""Corpus pipeline: from raw documents to token ids, as stages that each read what the one before has written.

1. quality: documents that the fertility rules or their base rules reject go.
2. exact_dedup: of equal texts the one with the largest id stays.
3. near_dedup: of each class of texts linked by five-word shingle similarity of 0.8 or more the one with the smallest id stays.
4. mixing: documents repeat, or go, as the capped source targets say.
5. encoding: byte-level ids of every document, with digests of the ids and of the bytes they decode to.

A stage takes any table with the columns of `documents`; further columns are carried along, except by the last.
When a stage begins, the scratch tables of the one before over the same folder go: its result is written by then.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewright.llm import byte_bpe, exact_dedup, fertility, mixing, near_copies
from candlewright.llm.common import discard, gathering, remove, settle, ship, table

BYTE_BPE = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Scratch tables of the stage that ran last, by application and folder.
_left: dict[tuple[str, str], list[str]] = {}


def tidy(stage: Stage) -> Stage:
    """The stage, after removing what the one before has left."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        own = spark.sparkContext.applicationId, sf_dir
        remove(spark, *_left.pop(own, []))
        with gathering() as paths:
            out = stage(spark, docs, sf_dir)
        _left[own] = paths
        return out

    return run_stage


@tidy
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    vocabularies = fertility.Vocabularies.load(spark, public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECES), public_tokenizers.PATTERN)
    return fertility.drop_rejected(docs, vocabularies)


@tidy
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return exact_dedup.drop_copies(docs)


@tidy
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_copies.drop_near_copies(docs)


@tidy
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


@tidy
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    vocabulary = byte_bpe.vocabulary_of(spark, public_tokenizers.path(BYTE_BPE))
    told = byte_bpe.encode_and_decode(docs, vocabulary, public_tokenizers.PATTERN, ["doc_id", "lang", "source"])
    return told.select("row.*", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mixed),
    ("encoding", encoded),
]

#: Tokenisers and 64-bit shingle hashes have no SQL; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`: doc_id, lang, source, n_tokens, ids, ids_sha256, decoded_sha256."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
