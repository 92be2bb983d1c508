"""The near_dedup stage against exact similarity of five-word shingles."""

import random
from collections import defaultdict
from itertools import combinations

import corpus_pipeline
from candlewright.llm import near_copies as op

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    """Ids that stay: the smallest of each class of linked texts."""
    sets, parent = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    classes = defaultdict(list)
    for i, r in enumerate(rows):
        classes[root(i)].append(r[0])
    return sorted(min(c) for c in classes.values())


def copy_of(rng, text, changes):
    words = text.split()
    for i in rng.sample(range(len(words)), changes):
        words[i] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def fixture(rng):
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(60):
        base = " ".join(rng.choices(vocabulary, k=rng.randrange(60, 400)))
        texts += [base, *(copy_of(rng, base, rng.randrange(1, max(2, len(base.split()) // 40))) for _ in range(3))]
    chain = [" ".join(rng.choices(vocabulary, k=200))]
    for _ in range(12):  # each near the one before, the ends far apart
        chain.append(copy_of(rng, chain[-1], 3))
    dense = " ".join(rng.choices(vocabulary, k=120))
    texts += [*chain, *(copy_of(rng, dense, 2) for _ in range(80)), "one two", "One two", "", None, " "]
    rng.shuffle(texts)
    return [(i, t, "en", "src0", None) for i, t in enumerate(texts)]


def kept(spark, rows):
    docs = spark.createDataFrame(rows, COLUMNS).repartition(4)
    return sorted(r["doc_id"] for r in corpus_pipeline.near(spark, docs, "unused").collect())


def test_stage_same_as_exact_similarity(spark):
    rows = fixture(random.Random(3))
    want = brute(rows)
    assert len(want) < 120
    assert kept(spark, rows) == want


def test_pairs_beyond_the_heads_are_compared(spark):
    rows = fixture(random.Random(4))
    docs = spark.createDataFrame(rows, COLUMNS).repartition(2)
    assert sorted(r["doc_id"] for r in op.drop_near_copies(docs, stars=0).collect()) == brute(rows)


def passage_rows(rng, n, own, shared):
    """Texts that share a passage and are no near copies, and some near copies among them."""
    passage = " ".join(f"p{i}" for i in range(shared))
    texts = [passage + " " + " ".join(f"q{rng.randrange(10**9)}" for _ in range(own)) for _ in range(n)]
    for i in range(0, n, 40):
        texts[i + 1] = copy_of(rng, texts[i], 2)
    return [(i, t, "en", "src0", None) for i, t in enumerate(texts)]


def test_a_shared_passage_makes_no_pairs(spark, monkeypatch):
    held = []
    found = op.crossing_pairs
    monkeypatch.setattr(op, "crossing_pairs", lambda *a: held.append(found(*a)) or held[-1])
    monkeypatch.setattr(op, "discard", lambda *frames: None)
    for own, shared in ((40, 80), (30, 120)):
        rows = passage_rows(random.Random(own), 400, own, shared)
        docs = spark.createDataFrame(rows, COLUMNS).repartition(4)
        assert sorted(r["doc_id"] for r in op.drop_near_copies(docs, stars=0).collect()) == brute(rows)
        assert held[-1].count() <= 40  # of 79,800 pairs, ten are near copies


def test_dense_group_without_a_centre(spark):
    rng = random.Random(12)
    base = " ".join(f"b{i}" for i in range(150))
    rows = [(i, copy_of(rng, base, rng.choice([1, 2, 2, 3, 4, 6])), "en", "src0", None) for i in range(150)]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    for stars in (0, 1, 3):
        assert sorted(r["doc_id"] for r in op.drop_near_copies(docs, stars=stars).collect()) == brute(rows)


def test_nulls_repeated_rows_long_texts_and_clashing_names(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(None, "a b c d e f", 1, 2), (None, "a b c d e f", 1, 2), (5, "a b c d e f", 3, 4), (3, long, 5, 6), (2, long + " end", 7, 8), (9, None, 0, 0), (8, " \n", 0, 0), (None, "", 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, at long, size long").repartition(3)
    assert sorted(map(tuple, op.drop_near_copies(docs).collect()), key=repr) == sorted([rows[2], rows[4], rows[6]], key=repr)
    strings = docs.selectExpr("cast(doc_id AS string) AS doc_id", "text", "at AS class", "size AS token")
    assert {r["doc_id"] for r in op.drop_near_copies(strings).collect()} == {"5", "2", "8"}
    assert op.drop_near_copies(docs.limit(0)).count() == 0


def test_recall_of_candidates():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    found = total = 0
    for _ in range(1500):
        base = " ".join(rng.choices(vocabulary, k=rng.randrange(60, 400)))
        other = copy_of(rng, base, max(1, len(base.split()) * 21 // 1000))
        if jaccard(shingles(base), shingles(other)) >= 0.8:
            keys = op.band_keys(*op.shingle_sets(op.pa.array([base, other])))
            total += 1
            found += bool((keys[0] == keys[1]).any())
    assert total > 500 and found >= 0.998 * total


def test_the_trie_finds_links_that_share_no_band(spark, monkeypatch):
    """Fingerprints of five-word shingles alone lead to these copies: every band key is a text's own."""
    rng = random.Random(21)
    monkeypatch.setattr(op, "band_keys", lambda hashes, offsets: op.np.random.default_rng().integers(-(1 << 62), 1 << 62, (len(offsets) - 1, op.BANDS)))
    bases = [" ".join(f"t{rng.randrange(10**9)}" for _ in range(600)) for _ in range(5)]
    texts = [t for base in bases for t in (base, base + " end", "start " + base)]
    rows = [(i, t, "en", "src0", None) for i, t in enumerate([*texts, "one two", None, ""])]
    assert kept(spark, rows) == brute(rows) == [0, 3, 6, 9, 12, 15, 16]


def test_a_class_of_the_trie_is_confirmed(spark, monkeypatch):
    """Texts in one class of fingerprints that are not similar both stay."""
    monkeypatch.setattr(op.simhash, "classed", lambda prints: prints.select("fingerprint", op.F.lit(0).cast("long").alias("root")).distinct())
    rows = passage_rows(random.Random(22), 60, 30, 60)
    assert kept(spark, rows) == brute(rows)
