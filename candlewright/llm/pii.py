"""Personal data by a semi-Markov conditional random field over whole spans.

Four rules (email, ip, card, phone) give base spans, which always stay. A semi-Markov CRF then reads
every region of words that hold a digit or an at sign, cut into atoms (runs of digits, runs of ASCII
letters, single other characters). A segment is a run of atoms with a type; its score comes from
features of the whole span: checks such as the Luhn sum or octet ranges, digit counts, separators,
the characters beside it and the word before it. Dynamic programming over segments of at most
MAX_ATOMS atoms chooses boundaries and types together. It finds what the rules leave out because a
longer match failed its check, such as the cards of a list with blanks between them.

A region has no length bound. It is decoded as a stream: scores of the last MAX_ATOMS cuts and back pointers are
all that is held, and spans leave as soon as every path goes through them.

The weights are fitted by conditional likelihood to the spans that the rules find in a bounded sample
of regions (SAMPLE_REGIONS at most: a fifth of them for each kind of base span and for none, by hash, so that
rare kinds are seen); regions where a match failed its check are not used.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from candlewright.llm.common import pieces, strings

KINDS = ("email", "ip", "card", "phone")
#: Longest entity in atoms, and the regions that the fit reads at most.
MAX_ATOMS = 16
SAMPLE_REGIONS = 600
#: Longer regions are decoded like any other but not used for the fit.
SAMPLE_CHARS = 300
#: Atoms after which spans that no later atom can change are emitted.
SETTLE_ATOMS = 256
EPOCHS = 12
RATE = 0.5
SHRINK = 1e-3

Span = tuple[str, int, int]

_dotted = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_first = _local | frozenset("(")
_host = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_ip = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_word = re.compile(r"[^\x20\x09-\x0D]+")
_atom = re.compile(r"[0-9]+|[A-Za-z]+|(?s:.)")
_trigger = re.compile(r"[0-9@]")
_group = re.compile(r"[0-9]+")
_digit = frozenset("0123456789")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(d if d < 10 else d - 9 for d in (2 * int(c) for c in digits[-2::-2]))
    return total % 10 == 0


def _octet(part: str) -> bool:
    bare = part.lstrip("0")
    return len(bare) <= 3 and int(bare or 0) <= 255


def _digits(text: str) -> str:
    return "".join([c for c in text if c in _digit])


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 16 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Leftmost non-overlapping matches by kind that pass their check, and those that fail it.

    Every scan is linear in the text: a match of the email or ip rule can only begin where a run of its
    characters begins, so no other start is tried.
    """
    good: list[Span] = []
    bad: list[Span] = []
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _local:
            start -= 1
        host = _host.match(text, at + 1) if start < at else None
        if host:
            good.append(("email", start, host.end()))
            last = host.end()
        at = text.find("@", max(last, at + 1))
    for run in _dotted.finditer(text):
        parts, place = run[0].split("."), run.start()
        for i in range(0, len(parts) - 3, 4):
            end = place + sum(map(len, parts[i : i + 4])) + 3
            (good if all(map(_octet, parts[i : i + 4])) else bad).append(("ip", place, end))
            place = end + 1
    for m in _card.finditer(text):
        (good if _is_card(m[0]) else bad).append(("card", m.start(), m.end()))
    for m in _phone.finditer(text):
        (good if 8 <= len(_digits(m[0])) <= 15 else bad).append(("phone", m.start(), m.end()))
    return good, bad


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Runs of words that hold a digit or an at sign, or that begin with a plus sign, one blank between."""
    start = end = None
    position = 0
    while hit := _trigger.search(text, position):
        left = hit.start()
        while left > position and not text[left - 1] in " \t\n\x0b\x0c\r":
            left -= 1
        right = _word.match(text, hit.start()).end()
        if end is not None and left == end + 1 and text[end] == " ":
            end = right
        else:
            if end is not None:
                yield start, end
            start, end = left, right
        position = right
    if end is not None:
        yield start, end


def _side(text: str, at: int) -> str:
    if not 0 <= at < len(text):
        return "edge"
    c = text[at]
    return "blank" if c.isspace() else "digit" if "0" <= c <= "9" else "letter" if c.isalpha() else "join" if c in "-._@+" else "mark"


_inside_ok = {
    "email": lambda s: "@" in s,
    "ip": lambda s: "." in s and "@" not in s,
    "card": lambda s: s[0].isdigit() and len(s) >= 12,
    "phone": lambda s: len(s) >= 8 and "@" not in s,
}


_checks = {
    "email": lambda span, digits: _email.fullmatch(span) is not None,
    "ip": lambda span, digits: _ip.fullmatch(span) is not None and all(map(_octet, span.split("."))),
    "card": lambda span, digits: _card.fullmatch(span) is not None and _is_card(span),
    "phone": lambda span, digits: _phone.fullmatch(span) is not None and 8 <= digits <= 15,
}


def _before(text: str, start: int) -> tuple[str, str]:
    """Features of where a span begins, whatever its end: they are made once for all candidates from there."""
    before = _word.findall(text[max(0, start - 24) : start])
    return f"left={_side(text, start - 1)}", f"word={before[-1].lower().strip(':.,;()') if before else ''}"


def _features(text: str, start: int, end: int, kinds: list[str], before: tuple[str, str]) -> Iterator[tuple[str, list[str]]]:
    """Features of a whole span under each of some types."""
    span = text[start:end]
    digits = len(_digits(span))
    separators = sorted({c for c in span if not c.isalnum()})
    names = (
        "bias", *before, f"right={_side(text, end)}", f"digits={min(digits, 20)}", f"separators={''.join(separators)[:6]}", f"first={_side(text, start)}",
        f"letters={any(map(str.isalpha, span))}", f"groups={min(len(_group.findall(span)), 6)}",
    )
    for kind in kinds:
        yield kind, [f"{kind}:valid={_checks[kind](span, digits)}", *[f"{kind}:{name}" for name in names]]


@dataclass
class Lattice:
    """Candidate segments of one region: for each end, (start, type or None, features)."""

    cuts: list[int]
    ends: list[list[tuple[int, str | None, list[str]]]] = field(default_factory=list)


def segments(text: str, low: int, high: int) -> Iterator[tuple[int, list[tuple[int, str | None, list[str]]]]]:
    """For each atom its end, and the candidates that end there: (number of the cut they begin at, type or None, features)."""
    recent = deque([(low, _before(text, low))], maxlen=MAX_ATOMS)
    for j, m in enumerate(_atom.finditer(text, low, high), 1):
        end = m.end()
        options: list[tuple[int, str | None, list[str]]] = [(j - 1, None, [])]
        last = text[end - 1]
        if last.isalnum() and last.isascii():
            for i, (start, before) in enumerate(recent, j - len(recent)):
                if text[start] not in _first:
                    continue
                span = text[start:end]
                kinds = [kind for kind in KINDS if _inside_ok[kind](span)] if _trigger.search(span) else []
                if kinds:
                    options += [(i, kind, names) for kind, names in _features(text, start, end, kinds, before)]
        recent.append((end, _before(text, end)))
        yield end, options


def lattice(text: str, low: int, high: int) -> Lattice:
    """All candidates of a region at once, for the fit; its regions have at most SAMPLE_CHARS characters."""
    made = Lattice([low])
    for end, options in segments(text, low, high):
        made.cuts.append(end)
        made.ends.append(options)
    return made


def _score(weights: dict[str, float], names: list[str]) -> float:
    return sum(weights.get(name, 0.0) for name in names)


def _joint(weights: dict[str, float], before: str | None, kind: str | None) -> float:
    return weights.get(f"after:{before}>{kind}", 0.0)


def decode(weights: dict[str, float], text: str, low: int, high: int) -> list[Span]:
    """Best segmentation of a region: boundaries and types together.

    A state is (cut, type of the segment that ends there). Every SETTLE_ATOMS atoms the paths of all states that a
    later segment can follow are walked back until they meet; what lies before that state is final.
    """
    cuts: dict[int, int] = {0: low}
    scores: dict[int, dict[str | None, float]] = {0: {None: 0.0}}
    back: dict[int, dict[str | None, tuple[int, str | None]]] = {}
    spans: list[Span] = []
    settled: tuple[int, str | None] = (0, None)
    j = 0

    def emit(state: tuple[int, str | None]) -> None:
        nonlocal settled
        found, at = [], state
        while at[0] > settled[0]:
            before = back[at[0]][at[1]]
            if at[1] is not None:
                found.append((at[1], cuts[before[0]], cuts[at[0]]))
            at = before
        spans.extend(reversed(found))
        for k in range(settled[0], state[0]):
            del cuts[k]
            back.pop(k, None)
        settled = state

    for j, (end, options) in enumerate(segments(text, low, high), 1):
        cuts[j] = end
        here: dict[str | None, float] = {}
        whence: dict[str | None, tuple[int, str | None]] = {}
        for i, kind, names in options:
            own = _score(weights, names)
            for before, so_far in scores[i].items():
                total = so_far + own + _joint(weights, before, kind)
                if kind not in here or total > here[kind]:
                    here[kind], whence[kind] = total, (i, before)
        scores[j], back[j] = here, whence
        scores.pop(j - MAX_ATOMS, None)
        if j % SETTLE_ATOMS == 0:
            live = {(k, kind) for k, kinds in scores.items() for kind in kinds}
            while len(live) > 1:
                last = max(live, key=lambda state: state[0])
                live.remove(last)
                live.add(back[last[0]][last[1]])
            emit(live.pop())
    if j:
        emit((j, max(scores[j], key=scores[j].get)))
    return spans


def _sum_exp(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def _gradient(weights: dict[str, float], made: Lattice, gold: set[Span]) -> dict[str, float]:
    """Features of the gold segmentation less their expectation under the model."""
    steps = [[(i, kind, names, _score(weights, names)) for i, kind, names in options] for options in made.ends]
    forward: list[dict[str | None, float]] = [{None: 0.0}]
    for options in steps:
        arrived: dict[str | None, list[float]] = {}
        for i, kind, _, own in options:
            arrived.setdefault(kind, []).extend(a + own + _joint(weights, before, kind) for before, a in forward[i].items())
        forward.append({kind: _sum_exp(v) for kind, v in arrived.items()})
    n = len(steps)
    backward: list[dict[str | None, float]] = [{} for _ in range(n + 1)]
    backward[n] = {kind: 0.0 for kind in forward[n]}
    onward: list[list[tuple[int, str | None, float]]] = [[] for _ in range(n + 1)]
    for j, options in enumerate(steps, 1):
        for i, kind, _, own in options:
            onward[i].append((j, kind, own))
    for i in range(n - 1, -1, -1):
        for before in forward[i]:
            backward[i][before] = _sum_exp([own + _joint(weights, before, kind) + backward[j][kind] for j, kind, own in onward[i]])
    whole = backward[0][None]
    change: dict[str, float] = {}

    def add(names: list[str], amount: float) -> None:
        for name in names:
            change[name] = change.get(name, 0.0) + amount

    for j, options in enumerate(steps, 1):
        for i, kind, names, own in options:
            for before, a in forward[i].items():
                p = math.exp(a + own + _joint(weights, before, kind) + backward[j][kind] - whole)
                if p > 1e-9:
                    add([*names, f"after:{before}>{kind}"], -p)
    j, kind, steps_at = 0, None, {}
    for k, low, high in gold:
        steps_at[low] = (k, high)
    while j < n:
        to, next_kind = j + 1, None
        if made.cuts[j] in steps_at:
            next_kind, high = steps_at[made.cuts[j]]
            to = made.cuts.index(high)
        names = next(f for i, k, f in made.ends[to - 1] if i == j and k == next_kind)
        add([*names, f"after:{kind}>{next_kind}"], 1.0)
        j, kind = to, next_kind
    return change


def fit(samples: list[tuple[str, int, int]]) -> dict[str, float]:
    """Weights from (text around a region, low, high), by conditional likelihood with shrinkage."""
    prepared = []
    for text, low, high in samples:
        good, bad = base_spans(text)
        if any(s < high and e > low for _, s, e in bad if e - s >= 12):
            continue
        made = lattice(text, low, high)
        gold = {s for s in good if low <= s[1] and s[2] <= high}
        ordered = sorted(gold, key=lambda s: s[1])
        known = {(made.cuts[i], made.cuts[j], kind) for j, options in enumerate(made.ends, 1) for i, kind, _ in options}
        if any(a[2] > b[1] for a, b in zip(ordered, ordered[1:])) or any((s, e, k) not in known for k, s, e in gold):
            continue
        prepared.append((made, gold))
    weights: dict[str, float] = {}
    for epoch in range(EPOCHS):
        rate = RATE / (1 + epoch / 4)
        for made, gold in prepared:
            for name, value in _gradient(weights, made, gold).items():
                weights[name] = weights.get(name, 0.0) * (1 - rate * SHRINK) + rate * value
    return weights


def find(text: str, weights: dict[str, float]) -> tuple[list[Span], list[Span]]:
    """Base spans, and the spans that the field adds beside them; both in order of kind and place."""
    base, _ = base_spans(text)
    # Base spans of different kinds overlap; their union is walked along with the spans that the field finds.
    taken: list[list[int]] = []
    for s, e in sorted((s, e) for _, s, e in base):
        if taken and s < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], e)
        else:
            taken.append([s, e])
    added, at = [], 0
    for low, high in regions(text):
        for kind, s, e in decode(weights, text, low, high):
            while at < len(taken) and taken[at][1] <= s:
                at += 1
            if at == len(taken) or taken[at][0] >= e:
                added.append((kind, s, e))
    rank = {kind: i for i, kind in enumerate(KINDS)}
    return tuple(sorted(found, key=lambda s: (rank[s[0]], s[1], s[2])) for found in (base, added))


def sample(docs: DataFrame, text_col: str = "text", most: int = SAMPLE_REGIONS) -> list[tuple[str, int, int]]:
    """At most `most` regions with their surroundings, the same ones whatever the partitions.

    Each kind of base span, and regions without one, give the `most` / 5 regions of the smallest hashes.
    """
    share = max(1, most // (len(KINDS) + 1))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            drawn: dict[str, set[tuple]] = {}
            for text in strings(piece.column("text")).to_pylist():
                for low, high in regions(text):
                    if high - low <= SAMPLE_CHARS:
                        start = max(0, low - 30)
                        around = text[start : high + 30]
                        row = (xxhash.xxh64_intdigest(around) >> 1, around, low - start, high - start)
                        good, _ = base_spans(around)
                        for kind in {k for k, s, e in good if row[2] <= s and e <= row[3]} or {"none"}:
                            drawn.setdefault(kind, set()).add(row)
            # The smallest of all are among the smallest of each piece.
            out = [(kind, *row) for kind, rows in drawn.items() for row in heapq.nsmallest(share, rows)]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds)], names=["kind", "mark", "around", "low", "high"])

    with_trigger = docs.select(F.col(text_col).alias("text")).where(F.col("text").rlike("[0-9@]"))
    found = with_trigger.mapInArrow(cut, "kind string, mark long, around string, low int, high int")
    # Copies of a region count once, so that a hot passage cannot be all of the sample.
    by_mark = W.partitionBy("kind").orderBy("mark", "around", "low", "high")
    least = found.distinct().withColumn("place", F.row_number().over(by_mark)).where(F.col("place") <= share)
    rows = least.select("mark", "around", "low", "high").distinct().orderBy("mark", "around", "low", "high").collect()
    return [(r["around"], r["low"], r["high"]) for r in rows]


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind, s, e in spans)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added of every row.

    `spans` lists base and added spans as kind:start:end in code points, by kind and place. Null texts
    count as empty and have no spans. Repeated rows each get a row; an empty table gives an empty
    result; other columns are not read.
    """
    weights = docs.sparkSession.sparkContext.broadcast(fit(sample(docs, text_col)))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans", "n_added"]

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = (*[0] * len(KINDS), hashlib.sha256(b"").hexdigest(), "", 0)
        rank = {kind: i for i, kind in enumerate(KINDS)}
        for piece in pieces(batches, "text"):
            texts = strings(piece.column("text"))
            out = [nothing] * len(texts)
            for i in pc.indices_nonzero(pc.match_substring_regex(texts, "[0-9@]")).to_pylist():
                base, added = find(texts[i].as_py(), weights.value)
                counts = [sum(kind == k for k, _, _ in base) for kind in KINDS]
                together = sorted([*base, *added], key=lambda s: (rank[s[0]], s[1], s[2]))
                out[i] = (*counts, hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(together), len(added))
            kinds = [*[pa.int64()] * len(KINDS), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], names=names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(detect, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added long")
