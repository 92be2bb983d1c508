import hashlib
import random
import re
import tracemalloc

import pytest

from candlewright.llm import pii as op

# The base patterns.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            passes = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 8 <= len(digits) <= 15,
            }[kind]()
            if passes:
                out.append((kind, m.start(), m.end()))
    return out


def card(rng, n=16):
    body = "".join(rng.choices("0123456789", k=n - 1))
    return next(body + d for d in "0123456789" if luhn(body + d))


def planted(rng):
    words = ["ein", "wort", "été", "the", "2.0.", 'token = "ab12cd34ef"', "v3.1", "of"]
    kinds = [
        lambda: f"{rng.choice('abcd')}x.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com",
        lambda: ".".join(str(rng.randrange(256)) for _ in range(4)),
        lambda: card(rng),
        lambda: f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}",
    ]
    return " ".join(rng.choice(kinds)() if rng.random() < 0.15 else rng.choice(words) for _ in range(60))


def test_base_same_as_patterns():
    rng = random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choices(["1", "25", "300", ".", "@", "a", "é", "+", " ", "-", "(", ")", "4539578763621486", "x.y", "%"], k=rng.randrange(25)))
        assert sorted(op.base_spans(text)[0]) == sorted(brute(text)), text


def test_long_runs_are_linear():
    for text in ("a" * 300_000 + "@b", "1" * 300_000, "1." * 100_000, "+" * 100_000 + "1", "@" * 100_000, "a@" * 100_000):
        op.base_spans(text)
        list(op.regions(text))


@pytest.fixture(scope="module")
def weights():
    rng = random.Random(6)
    texts = [planted(rng) for _ in range(40)]
    return op.fit([(t, a, b) for t in texts for a, b in op.regions(t)][:400])


def test_held_out_regions(weights):
    rng = random.Random(7)
    right = wrong = missed = 0
    for _ in range(30):
        text = planted(rng)
        good, bad = op.base_spans(text)
        for low, high in op.regions(text):
            if any(s < high and e > low for _, s, e in bad if e - s >= 12):
                continue
            told = set(op.decode(weights, text, low, high))
            want = {s for s in good if low <= s[1] < high}
            right, wrong, missed = right + len(told & want), wrong + len(told - want), missed + len(want - told)
    assert right > 100 and wrong <= 0.02 * right and missed <= 0.02 * right


def test_adds_cards_of_a_list(weights):
    rng = random.Random(8)
    a, b = card(rng), card(rng)
    text = f"pay {a} {b} now"
    base, added = op.find(text, weights)
    assert base == [] and added == [("card", 4, 20), ("card", 21, 37)]
    assert op.find("plain words only", weights) == ([], [])
    assert op.find("version 2.0. and 3.1", weights) == ([], [])


def test_decode_is_the_best_of_all_segmentations(weights):
    text = "a 12.3.4.5 4539578763621486"
    made = op.lattice(text, 2, len(text))

    def paths(j, kind_after):
        if j == 0:
            yield 0.0, None, []
            return
        for i, kind, names in made.ends[j - 1]:
            for score, before, spans in paths(i, kind):
                yield score + op._score(weights, names) + op._joint(weights, before, kind), kind, spans + ([(kind, made.cuts[i], made.cuts[j])] if kind else [])

    assert op.decode(weights, text, 2, len(text)) == max(paths(len(made.ends), None), key=lambda p: p[0])[2]


def whole(weights, made):
    """Best segmentation with every cut held."""
    best = [{None: (0.0, [])}]
    for j, options in enumerate(made.ends, 1):
        here = {}
        for i, kind, names in options:
            for before, (so_far, spans) in best[i].items():
                total = so_far + op._score(weights, names) + op._joint(weights, before, kind)
                if kind not in here or total > here[kind][0]:
                    here[kind] = total, spans + ([(kind, made.cuts[i], made.cuts[j])] if kind else [])
        best.append(here)
    return max(best[-1].values(), key=lambda v: v[0])[1]


@pytest.mark.parametrize("atoms", [1, 2, 7, 256])
def test_decoding_as_a_stream_is_the_same_as_whole(weights, monkeypatch, atoms):
    monkeypatch.setattr(op, "SETTLE_ATOMS", atoms)
    rng = random.Random(atoms)
    for _ in range(4):
        parts = [rng.choice([card(rng), f"{rng.randrange(9999)}", "+49 30 1234567", "10.2.3.4", "a.b@c.de", "x1", "(7)"]) for _ in range(40)]
        text = " ".join(parts)
        assert op.decode(weights, text, 0, len(text)) == whole(weights, op.lattice(text, 0, len(text)))


def test_numbers_on_one_long_line_hold_little_memory(weights):
    rng = random.Random(11)
    text = " ".join(str(rng.randrange(1000, 9999)) for _ in range(6_000))
    tracemalloc.start()
    op.find(text, weights)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10_000_000


def test_many_base_spans_are_walked_once(weights):
    text = "mail a.b@c.de, " * 4000 + "pay 10.0.0.1 +49 30 1234567"
    base, added = op.find(text, weights)
    assert len(base) == 4002 and not any(s < b and e > a for _, s, e in added for _, a, b in base[:50])


def test_sample_sees_rare_kinds(docs_of):
    rng = random.Random(12)
    pan = card(rng)
    rows = [(i, " and ".join(f"in {rng.randrange(1000, 2100)}, then" for _ in range(100))) for i in range(100)] + [(1000, f"pay {pan} now")]
    drawn = op.sample(docs_of(rows))
    assert any(pan in text for text, _, _ in drawn) and len(drawn) <= op.SAMPLE_REGIONS
    assert drawn == op.sample(docs_of(rows[::-1]).repartition(7))
    assert op.sample(docs_of([])) == []


def test_query_on_edge_cases(docs_of):
    rng = random.Random(9)
    rows = [(i, planted(rng)) for i in range(60)] + [(100, None), (None, ""), (101, "x@y.zz"), (101, "x@y.zz"), (102, "1" * 50_000)]
    docs = docs_of(rows).withColumn("spans", op.F.lit(1))
    found = op.personal_data(docs).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    for i, text in rows:
        r, base = by_id[i], sorted(brute(text or ""), key=lambda s: (op.KINDS.index(s[0]), s[1]))
        assert [r[f"n_{k}"] for k in op.KINDS] == [sum(s[0] == k for s in base) for k in op.KINDS]
        assert r["base_sha256"] == hashlib.sha256(op._listed(base).encode()).hexdigest()
        assert set(filter(None, op._listed(base).split(","))) <= set(r["spans"].split(","))
    assert op.personal_data(docs_of([])).count() == 0
