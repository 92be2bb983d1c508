"""Repair of the structure of conversations: the cheapest edits after which roles read `(s?(ua)+)?`.

An edit keeps a row, gives it the role that is due, deletes it, or inserts an empty turn. The state of
the reader is what came last (nothing, system, user, assistant), so the cost of all that follows is a
vector of four numbers. Vectors are computed backwards and stored only at about the square root of the
rows; walking forwards, each block is computed anew from the checkpoint behind it, and of the edits that
keep the cost tight the one with the least letter is taken. That gives the ASCII-least cheapest edits.

Rows of a conversation are a bounded group up to LONG rows. A longer conversation is sorted and numbered
over all tasks and cut into segments. A segment is a table of costs from its entry to its exit state;
these are combined backwards into the vector behind every segment (one small row for each segment), every
segment is walked from all four entry states at once, and the states at its borders then say which of its
four walks holds. Repeated turns are found by the first number of each role and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from candlewright.llm.common import SPACES, numbered, settle

DELETE, INSERT, REROLE, CUT = 4, 3, 3, 3
#: A conversation of more rows is cut into segments of SEGMENT rows.
LONG = 8192
SEGMENT = 4096
#: Rows of output that a task holds.
BATCH = 512

#: States by what came last: nothing, system, user, assistant. An inserted turn, or a row with a new role, leads to DUE.
DUE = (2, 2, 3, 2)
NAMES = (None, "system", "user", "assistant")
LEGAL = {"su", "ua", "au"}
#: State after a kept row by state and by kind of role (s, u, a, other).
KINDS = "sua"
KEPT = ((1, 2, None, None), (None, 2, None, None), (None, None, 3, None), (None, 2, None, None))
#: Faults of a row.
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)
END = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 40

Vector = tuple[int, int, int, int]


def _open(costs: list[int]) -> Vector:
    """Costs with turns inserted first where that is cheaper."""
    for _ in range(2):
        costs = [min(costs[s], costs[DUE[s]] + INSERT) for s in range(4)]
    return tuple(costs)


@lru_cache(1 << 14)
def _behind(row: int, after: Vector) -> Vector:
    kind, fault = divmod(row, 4)
    costs = []
    for s in range(4):
        best = after[s] + DELETE
        if fault < BLANK:
            best = min(best, after[DUE[s]] + REROLE + CUT * fault)
            if KEPT[s][kind] is not None:
                best = min(best, after[KEPT[s][kind]] + CUT * fault)
        costs.append(best)
    return _open(costs)


def before(row: int, after: Vector) -> Vector:
    """Costs before a row (4 * kind + fault) from those after it."""
    base = min(after)
    return tuple(base + c for c in _behind(row, tuple(c - base for c in after)))


def tight_edits(rows: bytes, entry: int, end: Vector, last: bool) -> tuple[str, int]:
    """The ASCII-least cheapest edits from state `entry` over the rows, and the state they lead to.

    `end` has the costs after the rows; `last` says that nothing follows, so that missing turns are
    inserted there. Vectors are kept at every isqrt(n)-th row and for one block at a time.
    """
    n = len(rows)
    gap = max(1, isqrt(n))
    marks = {n: end}
    vector = end
    for i in range(n - 1, -1, -1):
        vector = before(rows[i], vector)
        if i % gap == 0:
            marks[i] = vector
    out, state = [], entry
    for start in range(0, n, gap):
        stop = min(start + gap, n)
        block = [marks[stop]]
        for i in range(stop - 1, start - 1, -1):
            block.append(before(rows[i], block[-1]))
        block.reverse()
        i = start
        while i < stop:
            here, after = block[i - start], block[i - start + 1]
            kind, fault = divmod(rows[i], 4)
            cost = here[state]
            if after[state] + DELETE == cost:
                out.append("D")
            elif here[DUE[state]] + INSERT == cost:
                out.append("I")
                state = DUE[state]
                continue
            elif KEPT[state][kind] is not None and after[KEPT[state][kind]] + CUT * fault == cost:
                out.append("K")
                state = KEPT[state][kind]
            else:
                out.append("R")
                state = DUE[state]
            i += 1
    while last and END[state]:
        out.append("I")
        state = DUE[state]
    return "".join(out), state


def _kind(role: str) -> int:
    return KINDS.find(role[0]) % 4 if role else 3


# -- rows ------------------------------------------------------------------------------------------


def damage(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults planted by crc32(`conv_id:turn`) % 20; nulls count as one space."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    hit = F.crc32(F.encode(key, "UTF-8")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    text = F.when(hit == 1, "").when(hit == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = turns.where(hit != 0).select("conv_id", "turn", F.when(hit == 4, "user").otherwise(role).alias("role"), text.alias("text"), hit.alias("hit"))
    return rows.withColumn("copy", F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("hit", "copy")


def _marked(turns: DataFrame) -> DataFrame:
    """Rows with their own fault and a digest of role and text."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    bare = F.rtrim("text", F.lit(SPACES))
    fault = F.when(F.length(bare) == 0, BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    return rows.select("*", fault.alias("fault"), F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256).alias("digest"))


#: Order of the rows of a conversation, nulls first; rows alike in all of it are copies.
ORDER = ["turn", "role", "digest"]


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows that stand together and agree in their first `keys` columns."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and row[:keys] != held[0][:keys]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _batched(rows: Iterator[tuple], schema: pa.Schema, most: int = BATCH) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _mapped(rows: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]], schema: str) -> DataFrame:
    """mapInArrow with a generator of tuples; `conv` in the schema stands for the type of conv_id."""
    full = StructType.fromDDL(schema.replace("conv,", f"conv_id {rows.schema['conv_id'].dataType.simpleString()},", 1))
    arrow = to_arrow_schema(full)
    return rows.mapInArrow(lambda batches: _batched(make(batches), arrow), full)


_SEGMENT = (
    "conv, segment long, whole boolean, blank long, duplicate long, truncated long, illegal long, turns long, turn_min long, turn_max long, "
    "cost long, audit string, repaired array<struct<edit:string,role:string,text:string>>"
)


def _segment_row(rows: list[tuple], whole: bool, entry: int, edits: str, turn_before: int | None, initial_before: str | None) -> tuple:
    """A row of `repair` from (conv_id, segment, turn, role, text, fault) in order and the edits chosen for them."""
    counts = [0] * 4
    illegal = turns = 0
    known = [r[2] for r in rows if r[2] is not None]
    for _, _, turn, role, _, fault in rows:
        counts[fault] += 1
        illegal += initial_before is not None and initial_before + role[:1] not in LEGAL
        turns += turn is not None and turn != turn_before
        turn_before, initial_before = turn, role[:1]
    repaired, state, cost, at = [], entry, 0, 0
    for edit in edits:
        if edit == "I":
            state = DUE[state]
            repaired.append((edit, NAMES[state], ""))
            cost += INSERT
            continue
        _, _, _, role, text, fault = rows[at]
        at += 1
        if edit == "D":
            cost += DELETE
        else:
            state = KEPT[state][_kind(role)] if edit == "K" else DUE[state]
            cost += CUT * fault + (REROLE if edit == "R" else 0)
            role = NAMES[state] if edit == "R" else role
        repaired.append((edit, role, text))
    structs = [{"edit": e, "role": r, "text": t} for e, r, t in repaired]
    conv, segment = rows[0][:2]
    return conv, segment, whole, counts[BLANK], counts[DUPLICATE], counts[TRUNCATED], illegal, turns, min(known, default=None), max(known, default=None), cost, edits, structs


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for rows in groups(batches, 1):
        seen: set[str] = set()
        full = []
        for conv, turn, role, text, fault, digest in rows:
            if fault < BLANK and digest in seen:
                fault = DUPLICATE
            seen.add(digest)
            full.append((conv, 0, turn, role, text, fault))
        edits, _ = tight_edits(bytes(4 * _kind(r[3]) + r[5] for r in full), 0, END, True)
        yield _segment_row(full, True, 0, edits, None, None)


# -- conversations of many rows --------------------------------------------------------------------


def _crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of each segment its rows, costs from every entry to every exit state, and what its last row is."""
    for rows in groups(batches, 2):
        code = bytes(4 * _kind(r[4]) + r[5] for r in rows)
        columns = []
        for exit_state in range(4):
            vector = tuple(0 if s == exit_state else FAR for s in range(4))
            for row in reversed(code):
                vector = before(row, vector)
            columns.append(vector)
        yield *rows[0][:2], code, [columns[e][s] for s in range(4) for e in range(4)], rows[-1][3], rows[-1][4]


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Costs behind each segment; segments of a conversation come in falling order."""
    conv, vector = object(), END
    for batch in batches:
        for own, segment, costs in zip(*(c.to_pylist() for c in batch.columns)):
            last = own != conv
            conv, vector = own, END if last else vector
            yield own, segment, list(vector), last
            vector = tuple(min(costs[4 * s + e] + vector[e] for e in range(4)) for s in range(4))


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for conv, segment, code, turn, initial, end, last in zip(*(c.to_pylist() for c in batch.columns)):
            found = [tight_edits(code, s, tuple(end), last) for s in range(4)]
            yield conv, segment, [e for e, _ in found], [s for _, s in found], turn, initial


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The walk that holds in each segment; segments of a conversation come in order."""
    conv, state, turn, initial = object(), 0, None, None
    for batch in batches:
        for own, segment, edits, exits, last_turn, last_initial in zip(*(c.to_pylist() for c in batch.columns)):
            if own != conv:
                conv, state, turn, initial = own, 0, None, None
            yield own, segment, state, edits[state], turn, initial
            state, turn, initial = exits[state], last_turn, last_initial


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for rows in groups(batches, 2):
        head, *own = rows  # the row of the choice has no number and comes first
        entry, edits, turn_before, initial_before = head[7:]
        yield _segment_row([(r[0], r[1], *r[3:7]) for r in own], False, entry, edits, turn_before, initial_before)


def _long(rows: DataFrame, segment: int) -> DataFrame:
    placed, _ = numbered(rows.withColumn("read_at", F.monotonically_increasing_id()), "conv_id", *ORDER, "read_at", label="repair-order")
    firsts = placed.where(F.col("fault") < BLANK).groupBy("conv_id", "digest").agg(F.min("row_number").alias("row_number"))
    faults = placed.join(firsts.select("row_number", F.lit(True).alias("first")), "row_number", "left")
    fault = F.when((F.col("fault") < BLANK) & F.col("first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    known = faults.select("conv_id", F.expr(f"row_number div {segment}").alias("segment"), "row_number", "turn", "role", "text", fault.alias("fault"))
    known = settle(known, "repair-rows")
    by_segment = ["conv_id", "segment"]

    narrow = known.select(*by_segment, "row_number", "turn", F.substring("role", 1, 1).alias("initial"), "fault").repartition(*by_segment)
    crossed = _mapped(narrow.sortWithinPartitions(*by_segment, "row_number"), _crossing, "conv, segment long, code binary, costs array<long>, turn long, initial string")
    crossed = settle(crossed, "repair-segments")
    falling = crossed.select(*by_segment, "costs").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("segment"))
    ends = _mapped(falling, _ends, "conv, segment long, end array<long>, last boolean").select(F.col("conv_id").alias("of"), F.col("segment").alias("of_segment"), "end", "last")
    met = crossed.join(ends, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("segment") == F.col("of_segment")))
    walked = _mapped(met.select(*by_segment, "code", "turn", "initial", "end", "last"), _walks, "conv, segment long, edits array<string>, exits array<int>, turn long, initial string")
    rising = walked.repartition("conv_id").sortWithinPartitions(*by_segment)
    chosen = _mapped(rising, _chosen, "conv, segment long, entry int, edits string, turn_before long, initial_before string")
    both = known.unionByName(chosen, allowMissingColumns=True)
    own = ["row_number", "turn", "role", "text", "fault", "entry", "edits", "turn_before", "initial_before"]
    placed = both.select(*by_segment, *own).repartition(*by_segment).sortWithinPartitions(*by_segment, "row_number")
    return _mapped(placed, _applied, _SEGMENT)


# -- results ---------------------------------------------------------------------------------------


def repair(turns: DataFrame, long: int = LONG, segment: int = SEGMENT) -> DataFrame:
    """One row for each conversation, or for each segment of one with more than `long` rows, from conv_id, turn, role, text.

    Columns: conv_id, segment, whole (no other segments), the faults (blank, duplicate, truncated: the
    first that applies to a row), illegal (neighbouring roles), turns (different numbers), turn_min,
    turn_max, cost, audit (a letter for each edit: Delete, Insert, Keep, Rerole) and repaired (edit, role,
    text of each letter; deleted rows too). All but minimum and maximum add up over segments.

    Rows come by turn, nulls first, then role and digest of the text. Null roles and texts count as one
    space; a null conv_id is a conversation. Rows alike in all columns are repeated turns. An empty table
    gives an empty result; other columns are not read.
    """
    rows = _marked(turns)
    many = settle(rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > long).select(F.col("conv_id").alias("of")), "repair-long")
    hot = not many.isEmpty()
    short = rows.join(many, F.col("conv_id").eqNullSafe(F.col("of")), "left_anti") if hot else rows
    solved = _mapped(short.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER), _short, _SEGMENT)
    if not hot:
        return solved
    return solved.unionByName(_long(rows.join(many, F.col("conv_id").eqNullSafe(F.col("of")), "left_semi"), segment))


def repaired_turns(repaired: DataFrame) -> DataFrame:
    """conv_id, segment, at, edit, role, text: the turns that stay, in the order of segment and at."""
    rows = repaired.select("conv_id", "segment", F.posexplode("repaired").alias("at", "turn"))
    return rows.where("turn.edit <> 'D'").select("conv_id", "segment", "at", "turn.*")


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """One row for each conversation from its segments in order; the digest is fed turn by turn."""
    for batch_rows in _by_conversation(batches):
        totals, audit, digest, fresh = [0] * 6, [], hashlib.sha256(), True
        low = high = None
        for row in batch_rows:
            conv = row[0]
            totals = [a + b for a, b in zip(totals, [*row[2:7], row[10]])]
            low = min((x for x in (low, row[8]) if x is not None), default=None)
            high = max((x for x in (high, row[9]) if x is not None), default=None)
            audit.append(row[11])
            for turn in row[12]:
                if turn["edit"] != "D":
                    digest.update(("" if fresh else "\n").encode() + f"{turn['role']}:{turn['text']}".encode())
                    fresh = False
        gaps = 0 if low is None else high - low + 1 - totals[4]
        yield conv, gaps, *totals[:4], totals[5], "".join(audit), digest.hexdigest()


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[tuple]]:
    rows = (row for batch in batches for i in range(batch.num_rows) for row in zip(*(c.to_pylist() for c in batch.slice(i, 1).columns)))
    return (own for _, own in groupby(rows, key=lambda row: row[0]))


REPORT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def report(repaired: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation in `repair`'s rows.

    The digest of a conversation is over all its turns in order, so segments pass through one task, one after the other.
    """
    lines = F.transform(F.filter("repaired", lambda t: t["edit"] != "D"), lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    gaps = F.coalesce(F.col("turn_max") - F.col("turn_min") + 1 - F.col("turns"), F.lit(0)).cast("long")
    digest: Column = F.sha2(F.array_join(lines, "\n").cast("binary"), 256)
    whole = repaired.where("whole").select("conv_id", gaps.alias("gaps"), *REPORT[2:8], digest.alias("repaired_sha256"))
    order = ["conv_id", "segment", "blank", "duplicate", "truncated", "illegal", "turns", "whole", "turn_min", "turn_max", "cost", "audit", "repaired"]
    parts = repaired.where(~F.col("whole")).select(order)
    merged = _mapped(parts.repartition("conv_id").sortWithinPartitions("conv_id", "segment"), _merged, "conv, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
    return whole.unionByName(merged)


def audit(turns: DataFrame, damaged: DataFrame, long: int = LONG, segment: int = SEGMENT) -> DataFrame:
    """`report` of the repaired `damaged` rows for every conv_id of `turns`; those without rows have zeros and nothing in them."""
    told = report(repair(damaged, long, segment)).withColumnRenamed("conv_id", "of")
    ids = turns.select("conv_id").distinct()
    met = ids.join(told, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in REPORT[1:7]]
    return met.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
