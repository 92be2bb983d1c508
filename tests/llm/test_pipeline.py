"""Every stage, and all of them, against brute force on a fixture that holds each case."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from candlewright.llm import fertility
from candlewright.llm.mixing import SEED

from .test_byte_bpe import PATH, brute as encode
from .test_fertility import brute_base, brute_measures
from .test_mixing import brute_targets
from .test_near_copies import brute as brute_near

ROW = ("doc_id", "text", "lang", "source", "n_chars")


def fixture(rng):
    words = "the of and people walking along river stone bridge under morning light with their small dogs while market opens slowly near old station".split()
    rows = []
    for i in range(60):
        rows.append((i, " ".join(rng.choices(words, k=rng.randrange(25, 90))), "en", f"src{i % 4}", i))
    long = rng.choices([f"{a}{b}" for a in words for b in words], k=1500)
    for i in range(5):
        near = list(long)
        near[rng.randrange(1500)] = "changed"
        rows.append((100 + i, " ".join(near), "en", "src1", 0))
    for i in range(3):  # similar at 0.8, too far apart for a fingerprint of 64 bits
        near = list(long[:300])
        near[20 + i * 90] = near[60 + i * 90] = "altered"
        rows.append((110 + i, " ".join(near), "en", "src3", 0))
    rows += [(200, rows[0][1], "en", "src0", 1), (201, rows[0][1], None, None, None), (202, None, "en", "src0", 0), (203, "too short", "en", "src0", 9)]
    rows += [(204, " ".join(f"z{i}#$%x" for i in range(50)), "en", "src2", 9), (None, " ".join(rng.sample(words, 22)), "xx", None, 3)]
    return rows


def quality(rows):
    def kept(r):
        if brute_base(r[1])[5]:
            return False
        n_tokens, chars, byte_share, entropy = brute_measures(r[1])
        band = fertility.LANGUAGE_BANDS.get(r[2], fertility.SCRIPT_BANDS["Latin"])
        floor = min(band.min_entropy, max(2.5, 0.6 * math.log2(n_tokens)))
        return band.min_chars <= chars <= band.max_chars and byte_share <= band.max_bytes and entropy >= floor

    return [r for r in rows if kept(r)]


def exact(rows):
    best = {}
    for r in rows:
        held = best.get(r[1])
        if held is None or (r[0] is not None, r[0] or 0) > (held[0] is not None, held[0] or 0):
            best[r[1]] = r
    return list(best.values())


def near(rows):
    ids = set(brute_near([(i if r[0] is None else -1000 + r[0], r[1]) for i, r in enumerate(rows)]))
    return [r for i, r in enumerate(rows) if (i if r[0] is None else -1000 + r[0]) in ids]


def mixed(rows):
    sources = defaultdict(list)
    for r in rows:
        sources[r[3]].append((hashlib.md5(f"{SEED}:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), len(r[1].split()), r))
    sizes = {s: sum(n for _, n, _ in held) for s, held in sources.items()}
    out = []
    for source, target in brute_targets(sizes).items():
        whole = int(target / sizes[source] + 1e-9)
        rest, before = target - whole * sizes[source], 0
        for _, n, r in sorted(sources[source], key=lambda x: x[:2]):
            out += [r] * (whole + (2 * before + n <= 2 * rest))
            before += n
    return out


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Table folder, and what brute force says after each stage."""
    rows = fixture(random.Random(11))
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    told = [rows]
    for stage in (quality, exact, near, mixed):
        told.append(stage(told[-1]))
    return folder, told


def test_fixture_has_every_case(stages):
    sizes = [len(rows) for rows in stages[1]]
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] and Counter(stages[1][4]).most_common(1)[0][1] > 1


@pytest.mark.parametrize("k", range(4))
def test_stage_same_as_brute_force(spark, stages, k):
    docs = spark.createDataFrame(stages[1][k], "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.STAGES[k][1](spark, docs, stages[0])
    assert found.columns == list(ROW)
    assert Counter(map(tuple, found.collect())) == Counter(stages[1][k + 1])


def test_run_same_as_brute_force(spark, stages):
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=fertility.ranks_of(open(PATH, "rb").read()), special_tokens={})
    found = corpus_pipeline.run(spark, stages[0]).collect()
    want = Counter((*encode(library, r[0], r[1]), r[2], r[3]) for r in stages[1][4])
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["lang"], r["source"]) for r in found) == want
    assert all(hashlib.sha256(r["ids"]).hexdigest() == r["ids_sha256"] and len(r["ids"]) == 4 * r["n_tokens"] for r in found)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "unused").count() == 0
