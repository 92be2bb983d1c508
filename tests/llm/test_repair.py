"""Repair of conversations against a search over all edits, and long conversations against short ones."""

import hashlib
import random
import zlib
from functools import cache

import pytest

from candlewright.llm import repair

TURNS = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        out += [(conv, turn, "user" if hit == 4 else role, "" if hit == 1 else text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, turns) of rows (role, text, fault), by looking at every edit."""

    @cache
    def from_here(i, state, inserted):
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        if inserted < 2:
            due = "assistant" if state == "u" else "user"
            ways.append(add(from_here(i, due[0], inserted + 1), 3, "I", f"{due}:"))
        if i < len(rows):
            role, text, fault = rows[i]
            ways.append(add(from_here(i + 1, state, 0), 4, "D", None))
            if fault < 2:
                for new in ("user", "assistant"):
                    if (new == "assistant") == (state == "u"):
                        ways.append(add(from_here(i + 1, new[0], 0), 3 + 3 * fault, "R", f"{new}:{text}"))
                if (state + role[:1] in ("s", "u", "su", "ua", "au")) and role:
                    ways.append(add(from_here(i + 1, role[0], 0), 3 * fault, "K", f"{role}:{text}"))
        return min(ways) if ways else (10**9, "", ())

    def add(way, cost, edit, line):
        return way[0] + cost, edit + way[1], way[2] if line is None else (line, *way[2])

    return from_here(0, "", 0)


def brute(rows, original):
    out = []
    for conv in {r[0] for r in original}:
        own = [r for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).hexdigest()))
        seen, full, illegal = set(), [], 0
        for k, (_, _, role, text) in enumerate(own):
            bare = text.strip(SPACES)
            fault = 2 if not bare else 3 if (role, text) in seen else 0 if bare[-1] in ".!?" else 1
            seen.add((role, text))
            full.append((role, text, fault))
            illegal += k > 0 and own[k - 1][2][:1] + role[:1] not in ("su", "ua", "au")
        turns = {r[1] for r in own if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit, lines = cheapest(tuple(full))
        counts = [sum(f == k for *_, f in full) for k in (2, 3, 1)]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(rng, n=60, most=12):
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(rng.randrange(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "us\ner"])
            text = rng.choice(["Hello there.", "Why?", "no end", "no end \n", None, "", " \t", "Yes! ", "é 漢.", f"t{turn}."])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    return rows


@pytest.mark.parametrize("long, segment", [(8192, 4096), (5, 3), (0, 1), (0, 100)])
def test_same_as_search(spark, long, segment):
    rows = conversations(random.Random(long + segment))
    turns = spark.createDataFrame(rows, TURNS).repartition(3)
    found = repair.audit(turns, repair.damage(turns), long, segment)
    assert found.columns == repair.REPORT
    assert sorted(map(tuple, found.collect()), key=repr) == brute(damaged(rows), rows)


def test_checkpoints_cover_every_length(monkeypatch):
    rng = random.Random(4)
    for n in [*range(0, 30), 100, 101, 1000]:
        rows = bytes(rng.choice([0, 4, 4, 8, 8, 5, 9, 12, 6, 11]) for _ in range(n))
        edits, _ = repair.tight_edits(rows, 0, repair.END, True)
        with monkeypatch.context() as m:
            m.setattr(repair, "isqrt", lambda n: n)
            assert repair.tight_edits(rows, 0, repair.END, True)[0] == edits
        assert sum(e != "I" for e in edits) == n


def test_one_conversation_spreads_over_segments(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"line {i % 700}.") for i in range(3000)]
    turns = spark.createDataFrame(rows, TURNS).repartition(4)
    parts = repair.repair(turns, 1000, 100)
    held = parts.collect()
    assert len(held) == 30 and max(len(r["audit"]) for r in held) <= 102 and not any(r["whole"] for r in held)
    one = repair.report(repair.repair(turns)).collect()
    assert [tuple(r) for r in repair.report(parts).collect()] == [tuple(r) for r in one]
    kept = repair.repaired_turns(parts).orderBy("segment", "at").collect()
    assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in kept).encode()).hexdigest() == one[0]["repaired_sha256"]
    assert one[0]["duplicate"] == 2300


def test_empty_tables_long_texts_and_other_columns(spark):
    turns = spark.createDataFrame([("c", 0, "user", "x" * 500_000 + ".", 5), ("c", 1, "assistant", "y.", 6)], "conv_id string, turn int, role string, text string, fault int")
    (row,) = repair.audit(turns, turns).collect()
    assert (row["audit"], row["cost"], row["gaps"]) == ("KK", 0, 0)
    (row,) = repair.audit(turns, turns.limit(0)).collect()
    assert tuple(row) == ("c", 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.audit(turns.limit(0), repair.damage(turns.limit(0))).count() == 0
