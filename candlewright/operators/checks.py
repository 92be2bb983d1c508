"""Completeness checks of bars against sessions.

The hot path never explodes a minute grid and never groups raw rows by timestamp alone. A bar in the
phase of its day's grid is a slot number; 64 slots share one long, so a map-side ``bit_or`` turns the
bars of a day into a handful of rows before the first shuffle. Only bars out of phase keep their own
timestamp. Duplicates, gaps and extras then follow from bit counts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from candlewright.functions import times as T, values as V

MAX_LISTED = 10
ISSUE_COLUMNS = [
    "date", "issue_str", "expected_count_int", "bar_count_int", "unique_count_int", "missing_count_int",
    "missing_str", "extra_count_int", "extra_str", "duplicate_count_int",
]

# Core hours of an index session.
CORE_FIRST = "09:31"
CORE_LAST = "15:59"


def _bit(slot: Column) -> Column:
    # shiftleft takes its distance as an expression only through SQL.
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(slot, F.lit(64)).cast("int"))


def _word(slot: Column) -> Column:
    return F.floor(slot / F.lit(64)).cast("int")


def _missing_words(words: Column, bits: str, low: Column, high: Column) -> Column:
    """Per 64 slots of ``low .. high``, in order: the slots whose bit is not set in ``words``, as a mask.

    ``words`` holds a word once. Those of the range are taken as they come, the others are the difference of two
    sets, so the cost is that of the grid and not of a search for each of its words.
    """
    ones = F.lit(-1).cast("bigint")

    def missing(word: Column, own: Column) -> Column:
        start = F.greatest(low - word * 64, F.lit(0)).cast("int")
        end = F.least(high - word * 64, F.lit(63)).cast("int")
        expected = F.call_function("shiftleft", ones, start).bitwiseAND(F.call_function("shiftrightunsigned", ones, F.lit(63) - end))
        return F.struct(word.alias("word"), expected.bitwiseAND(F.bitwise_not(F.coalesce(own, F.lit(0).cast("bigint")))).alias("bits"))

    grid = F.sequence(_word(low), _word(high))
    present = F.filter(words, lambda w: w["word"].between(_word(low), _word(high)))
    absent = F.array_except(grid, F.transform(words, lambda w: w["word"]))
    none = F.lit(0).cast("bigint")
    return F.sort_array(F.concat(F.transform(present, lambda w: missing(w["word"], w[bits])), F.transform(absent, lambda word: missing(word, none))))


def _first_slots(words: Column, bits: str, limit: int) -> Column:
    """The first slots whose bit is set; words beyond the limit are not opened."""
    positions = F.sequence(F.lit(0), F.lit(63))

    def add(found: Column, word: Column) -> Column:
        set_bits = F.filter(positions, lambda b: F.getbit(word[bits], b) == 1)
        slots = F.transform(set_bits, lambda b: word["word"].cast("bigint") * 64 + b)
        enough = (F.size(found) >= limit) | (F.coalesce(word[bits], F.lit(0).cast("bigint")) == 0)
        return F.when(enough, found).otherwise(F.concat(found, slots))

    return F.slice(F.aggregate(words, F.array().cast("array<bigint>"), add), 1, limit)


WORDS = "array<struct<word:int,inside:bigint,outside:bigint>>"

# New York instants of a date lie within 30 hours of its UTC midnight.
DAY_SPAN = 30 * 3600 * T.MICROS_PER_SECOND


def _anchor(step: int) -> Column:
    """Microseconds of slot 0 of a date: its UTC midnight, moved to the phase of the session grid."""
    midnight = T.micros(F.col("date").cast("timestamp"))
    return midnight + F.coalesce(F.pmod(T.micros(F.col("first_bar_ts")) - midnight, F.lit(step)), F.lit(0))


def _slot_rows(bars: DataFrame, calendar: DataFrame, step_seconds: int, counters: Mapping[str, Column]) -> DataFrame:
    """(symbol, date, word, off_ts) -> row count, bits inside and outside the session, summed counters."""
    step = step_seconds * T.MICROS_PER_SECOND
    joined = bars.join(calendar.select("date", "first_bar_ts", "last_bar_ts"), "date", "left")
    offset = T.micros(F.col("ts")) - _anchor(step)
    in_phase = (F.pmod(offset, F.lit(step)) == 0) & offset.between(0, DAY_SPAN)
    slot = F.floor(offset / F.lit(step))
    in_session = F.coalesce(F.col("ts").between(F.col("first_bar_ts"), F.col("last_bar_ts")), F.lit(False))
    keyed = joined.select(
        "symbol",
        "date",
        F.when(in_phase, _word(slot)).alias("word"),
        F.when(~in_phase, F.col("ts")).alias("off_ts"),
        F.when(in_phase & in_session, _bit(slot)).alias("inside"),
        F.when(in_phase & ~in_session, _bit(slot)).alias("outside"),
        *[F.coalesce(flag, F.lit(False)).cast("int").alias(name) for name, flag in counters.items()],
    )
    return keyed.groupBy("symbol", "date", "word", "off_ts").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_or("inside").alias("inside"),
        F.bit_or("outside").alias("outside"),
        *[F.sum(name).alias(name) for name in counters],
    )


def _first_off_phase(rows: DataFrame, limit: int) -> DataFrame:
    """The first out-of-phase timestamps per (symbol, date). The rank limit is applied before the shuffle."""
    # The condition reads aggregates only, so the rows come from the exchange that is already there.
    off_phase = rows.where(F.col("inside").isNull() & F.col("outside").isNull() & (F.col("n") > 0))
    rank = F.row_number().over(W.partitionBy("symbol", "date").orderBy("off_ts"))
    return off_phase.withColumn("rank", rank).where(F.col("rank") <= limit)


def session_summary(
    bars: DataFrame,
    calendar: DataFrame,
    step_seconds: int = 60,
    max_listed: int = MAX_LISTED,
    counters: Mapping[str, Column] | None = None,
    empty: DataFrame | None = None,
) -> DataFrame:
    """One row per (symbol, date) of ``bars`` (``symbol, date, ts``), before sessions are attached.

    ``empty`` adds (symbol, date) pairs that must appear even without bars. ``counters`` are row
    conditions that are counted in the same pass. With ``max_listed`` 0 no extra minutes are listed.
    """
    counters = dict(counters or {})
    rows = _slot_rows(bars, calendar, step_seconds, counters)
    no_ts = F.lit(None).cast("timestamp")
    zero = F.lit(0).cast("bigint")
    parts = rows.select(
        "symbol", "date", "word", "off_ts", "n", "inside", "outside", no_ts.alias("listed_ts"), F.lit(0).alias("asked"), *counters
    )
    if max_listed > 0:
        listed = _first_off_phase(rows, max_listed).select(
            "symbol", "date", F.col("off_ts").alias("listed_ts"), zero.alias("n"), F.lit(0).alias("asked"), *[zero.alias(c) for c in counters]
        )
        parts = parts.unionByName(listed, allowMissingColumns=True)
    if empty is not None:
        parts = parts.unionByName(
            empty.select("symbol", "date", zero.alias("n"), F.lit(1).alias("asked"), *[zero.alias(c) for c in counters]),
            allowMissingColumns=True,
        )
    bits = lambda name: F.coalesce(F.sum(F.bit_count(name)), F.lit(0)).cast("bigint")
    # At most one entry per 64 slots of a day reaches the list.
    entry = F.when(F.col("word").isNotNull(), F.struct("word", "inside", "outside"))
    return parts.groupBy("symbol", "date").agg(
        F.sum("n").alias("bar_count_int"),
        bits("inside").alias("on_grid_count"),
        (bits("outside") + F.count("off_ts")).alias("extra_count_int"),
        F.sort_array(F.collect_list(entry)).alias("words"),
        F.sort_array(F.collect_list("listed_ts")).alias("off_ts"),
        (F.max("asked") == 1).alias("asked"),
        *[F.sum(name).alias(name) for name in counters],
    )


def _with_session(summary: DataFrame, calendar: DataFrame, step_seconds: int, max_listed: int) -> DataFrame:
    """Attach expected counts and render the missing and extra minutes."""
    step = step_seconds * T.MICROS_PER_SECOND
    grid = calendar.select("date", "first_bar_ts", "bar_count_int").withColumnRenamed("bar_count_int", "expected")
    joined = summary.join(grid, "date", "left").withColumn("anchor", _anchor(step))
    expected = F.coalesce("expected", F.lit(0)).cast("bigint")
    missing = expected - F.col("on_grid_count")
    label = lambda slot: F.timestamp_micros(F.col("anchor") + slot * F.lit(step))
    if max_listed > 0:
        first_slot = F.floor((T.micros(F.col("first_bar_ts")) - F.col("anchor")) / F.lit(step))
        missing_words = _missing_words(F.col("words"), "inside", first_slot, first_slot + expected - 1)
        gaps = _first_slots(missing_words, "bits", max_listed)
        extras = F.transform(_first_slots(F.col("words"), "outside", max_listed), label)
        first_extras = F.slice(F.sort_array(F.concat(extras, "off_ts")), 1, max_listed)
        clock = lambda stamps: F.transform(stamps, T.clock_text if step_seconds % 60 == 0 else T.second_text)
        listed = lambda stamps, total: F.when(total > 0, V.listed(clock(stamps), total, max_listed)).otherwise(F.lit(""))
        missing_text = listed(F.transform(gaps, label), missing)
        extra_text = listed(first_extras, F.col("extra_count_int"))
    else:
        missing_text = extra_text = F.lit("")
    return (
        joined.withColumn("expected_count_int", expected)
        .withColumn("missing_count_int", missing)
        .withColumn("unique_count_int", F.col("on_grid_count") + F.col("extra_count_int"))
        .withColumn("duplicate_count_int", F.col("bar_count_int") - F.col("unique_count_int"))
        .withColumn("missing_str", missing_text)
        .withColumn("extra_str", extra_text)
        .withColumn("is_session", F.col("first_bar_ts").isNotNull())
    )


def dated(bars: DataFrame) -> DataFrame:
    """Add the New York date of every bar."""
    return bars.select("symbol", "ts", T.wall_date(F.col("ts")).alias("date"))


def issue_report(
    bars: DataFrame,
    calendar: DataFrame,
    last_date: str,
    start_date: str | None = None,
    series: DataFrame | None = None,
    step_seconds: int = 60,
    max_listed: int = MAX_LISTED,
    symbols: DataFrame | None = None,
) -> DataFrame:
    """Problem dates of every series: missing sessions, missing / extra minutes, duplicates, no session.

    ``bars`` needs ``symbol, ts``; ``calendar`` holds closed sessions only. Coverage starts at the
    first date found, at ``start_date`` for every symbol, or at ``series.start_date`` for the listed
    symbols (others start at their first date); earlier bars are ignored. ``last_date`` is the last date
    that could have a session. With a start date ``symbols`` may name the series where ``bars`` holds the
    recent ones only.
    """
    starts = None
    if series is not None:
        starts = series.select("symbol", F.col("start_date").cast("date").alias("date"))
    elif start_date is not None:
        # A symbol whose bars all lie before the start is still expected; this reads one column.
        starts = (bars if symbols is None else symbols).select("symbol").distinct().withColumn("date", F.lit(start_date).cast("date"))
        bars = bars.where(F.col("ts") >= T.instant_literal(f"{start_date} 00:00:00"))
    summary = session_summary(dated(bars), calendar, step_seconds, max_listed, empty=starts)

    # From here on there is one short row per (symbol, date).
    by_symbol = W.partitionBy("symbol")
    by_date = by_symbol.orderBy("date")
    if starts is not None:
        start = F.min(F.when(F.col("asked"), F.col("date"))).over(by_symbol)
        summary = summary.withColumn("start", start).where(F.col("start").isNull() | (F.col("date") >= F.col("start")))
    # Every present date also answers for the days up to the next present one.
    after = F.coalesce(F.date_sub(F.lead("date").over(by_date), 1), F.lit(last_date).cast("date"))
    covered = summary.withColumn("gap_end", F.greatest(after, F.col("date")))
    spread = covered.withColumn("day", F.explode(F.sequence("date", "gap_end")))
    own = F.col("day") == F.col("date")
    zero = F.lit(0).cast("bigint")
    every = spread.select(
        "symbol",
        F.col("day").alias("date"),
        *[F.when(own, F.col(c)).otherwise(zero).alias(c) for c in ("bar_count_int", "on_grid_count", "extra_count_int")],
        F.when(own, F.col("words")).otherwise(F.array().cast(WORDS)).alias("words"),
        F.when(own, F.col("off_ts")).otherwise(F.array().cast("array<timestamp>")).alias("off_ts"),
    )
    checked = _with_session(every, calendar, step_seconds, max_listed)
    has_bars = F.col("bar_count_int") > 0
    label = F.concat_ws(
        ",",
        F.when(~F.col("is_session"), F.lit("no_session")),
        F.when(F.col("is_session") & ~has_bars, F.lit("missing_session")),
        F.when((F.col("missing_count_int") > 0) & has_bars, F.lit("missing_minutes")),
        F.when((F.col("extra_count_int") > 0) & F.col("is_session"), F.lit("extra_minutes")),
        F.when(F.col("duplicate_count_int") > 0, F.lit("duplicate_rows")),
    )
    problem = (F.col("missing_count_int") > 0) | (F.col("extra_count_int") > 0) | (F.col("duplicate_count_int") > 0)
    return checked.where(problem).withColumn("issue_str", label).select("symbol", *ISSUE_COLUMNS)


def issue_dates(issues: DataFrame, limit: int = 30) -> DataFrame:
    """Per issue kind: how many dates, and the first ones. The lists hold calendar dates, not bars."""
    kinds = issues.select("date", F.explode(F.split("issue_str", ",")).alias("issue")).distinct()
    first = F.slice(F.sort_array(F.collect_list("date")), 1, limit)
    return kinds.groupBy("issue").agg(
        F.count(F.lit(1)).alias("date_count"), F.array_join(F.transform(first, lambda d: d.cast("string")), " ").alias("first_dates")
    )


def session_check(
    bars: DataFrame,
    calendar: DataFrame,
    requested: DataFrame | None = None,
    step_seconds: int = 60,
    max_listed: int = MAX_LISTED,
    counters: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Status of every (symbol, date): empty, partial, complete, or no_session.

    ``bars`` carries the ``date`` its rows were filed under, so bars of another day count as extra.
    Extras and duplicates do not make a session incomplete. With ``max_listed`` 0 only counts are
    reported.
    """
    counters = dict(counters or {})
    summary = session_summary(bars, calendar, step_seconds, max_listed, counters, requested)
    checked = _with_session(summary, calendar, step_seconds, max_listed)
    status = (
        F.when(~F.col("is_session"), F.lit("no_session"))
        .when(F.col("bar_count_int") == 0, F.lit("empty"))
        .when(F.col("missing_count_int") == 0, F.lit("complete"))
        .otherwise(F.lit("partial"))
    )
    return checked.withColumn("status_str", status).select(
        "symbol", "date", "status_str", "expected_count_int", "bar_count_int", "missing_count_int", "extra_count_int",
        "duplicate_count_int", "missing_str", "extra_str", *counters,
    )


def in_session(bars: DataFrame, calendar: DataFrame) -> DataFrame:
    """Bars inside the session of their New York date (equi-join on the date plus a range test)."""
    dates = bars if "date" in bars.columns else bars.withColumn("date", T.wall_date(F.col("ts")))
    span = calendar.select("date", "first_bar_ts", "last_bar_ts")
    return (
        dates.join(span, "date")
        .where(F.col("ts").between(F.col("first_bar_ts"), F.col("last_bar_ts")))
        .drop("first_bar_ts", "last_bar_ts")
    )


def core_hours_check(
    bars: DataFrame,
    requested: DataFrame | None = None,
    core_first: str = CORE_FIRST,
    core_last: str = CORE_LAST,
    step_seconds: int = 60,
    max_listed: int = MAX_LISTED,
    counters: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Missing minutes between the first and last bar, inside the core hours only.

    ``bars``: ``symbol, date, ts`` where ``date`` is the session asked for; bars of another New York
    date are extra. The expected minutes start at the later of the first bar and the core start, in
    that bar's own phase, and stop at the earlier of the last bar and the core end.
    """
    counters = dict(counters or {})
    step = step_seconds * T.MICROS_PER_SECOND
    day = F.date_format("date", "yyyy-MM-dd")
    core_start = T.from_wall(F.concat(day, F.lit(f" {core_first}:00")))
    core_end = T.from_wall(F.concat(day, F.lit(f" {core_last}:00")))
    own = T.wall_date(F.col("ts")) == F.col("date")
    offset = T.micros(F.col("ts")) - T.micros(core_start)
    slot = F.floor(offset / F.lit(step))
    keyed = bars.select(
        "symbol", "date", own.alias("own"),
        F.when(own, F.pmod(offset, F.lit(step))).alias("phase"),
        F.when(own, _word(slot)).alias("word"),
        F.when(own, _bit(slot)).alias("bit"),
        F.when(own, F.col("ts")).alias("ts"),
        *[F.coalesce(flag, F.lit(False)).cast("int").alias(name) for name, flag in counters.items()],
    )
    words = keyed.groupBy("symbol", "date", "own", "phase", "word").agg(
        F.count(F.lit(1)).alias("n"), F.bit_or("bit").alias("bits"), F.min("ts").alias("low"), F.max("ts").alias("high"),
        *[F.sum(name).alias(name) for name in counters],
    )
    pair = F.when(F.col("bits").isNotNull(), F.struct("word", "bits"))
    phases = words.groupBy("symbol", "date", "own", "phase").agg(
        F.sum("n").alias("n"), F.sum(F.bit_count("bits")).alias("unique_bars"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.sort_array(F.collect_list(pair)).alias("pairs"),
        *[F.sum(name).alias(name) for name in counters],
    )
    if requested is not None:
        zero = F.lit(0).cast("bigint")
        phases = phases.unionByName(
            requested.select("symbol", "date", F.lit(True).alias("own"), zero.alias("n"), *[zero.alias(c) for c in counters]),
            allowMissingColumns=True,
        )
    merged = phases.groupBy("symbol", "date").agg(
        F.coalesce(F.sum(F.when(F.col("own"), F.col("n"))), F.lit(0)).alias("day_rows"),
        F.coalesce(F.sum("unique_bars"), F.lit(0)).cast("bigint").alias("bar_count_int"),
        F.coalesce(F.sum(F.when(~F.col("own"), F.col("n"))), F.lit(0)).alias("extra_count_int"),
        F.min("low").alias("first_ts"),
        F.max("high").alias("last_ts"),
        F.max(F.when(F.col("phase") == 0, F.col("pairs"))).alias("core_pairs"),
        F.min_by("pairs", "low").alias("first_pairs"),
        *[F.sum(name).alias(name) for name in counters],
    )
    late_start = F.col("first_ts") > core_start
    low_ts = F.greatest(F.col("first_ts"), core_start)
    high_ts = F.least(F.col("last_ts"), core_end)
    pairs = F.coalesce(
        F.when(late_start, F.col("first_pairs")).otherwise(F.col("core_pairs")),
        F.array().cast("array<struct<word:int,bits:bigint>>"),
    )
    low_slot = F.floor((T.micros(low_ts) - T.micros(core_start)) / F.lit(step))
    span = F.floor((T.micros(high_ts) - T.micros(low_ts)) / F.lit(step))
    anchored = merged.withColumn("low_ts", low_ts).withColumn("low_slot", low_slot).withColumn("span", span).withColumn("words", pairs)
    has_span = F.coalesce(F.col("span") >= 0, F.lit(False))
    gap_words = F.when(has_span, _missing_words(F.col("words"), "bits", F.col("low_slot"), F.col("low_slot") + F.col("span")))
    total = F.aggregate("gap_words", F.lit(0).cast("bigint"), lambda count, w: count + F.bit_count(w["bits"]))
    result = anchored.withColumn("gap_words", gap_words).withColumn("missing_count_int", F.coalesce(total, F.lit(0)))
    texts = F.transform(
        _first_slots(F.col("gap_words"), "bits", max_listed),
        lambda slot: T.clock_text(T.plus_micros(F.col("low_ts"), (slot - F.col("low_slot")) * F.lit(step))),
    )
    status = (
        F.when(F.col("bar_count_int") == 0, F.lit("empty"))
        .when(F.col("missing_count_int") > 0, F.lit("partial"))
        .otherwise(F.lit("complete"))
    )
    extra = F.col("extra_count_int")
    return result.select(
        "symbol",
        "date",
        status.alias("status_str"),
        "bar_count_int",
        F.when(has_span, F.col("span") + 1).otherwise(F.lit(0)).cast("bigint").alias("expected_count_int"),
        "missing_count_int",
        "extra_count_int",
        (F.col("day_rows") - F.col("bar_count_int")).alias("duplicate_count_int"),
        F.coalesce(T.clock_text(F.col("first_ts")), F.lit("")).alias("first_bar_str"),
        F.coalesce(T.clock_text(F.col("last_ts")), F.lit("")).alias("last_bar_str"),
        F.when(F.col("missing_count_int") > 0, V.listed_plain(texts, F.col("missing_count_int"), max_listed)).otherwise(F.lit("")).alias("missing_str"),
        F.when(extra > 0, F.concat(extra.cast("string"), F.lit(" bar(s) of another date"))).otherwise(F.lit("")).alias("extra_str"),
        *counters,
    )


def daily_chunk_check(received: DataFrame, wanted: DataFrame, calendar: DataFrame, max_listed: int = MAX_LISTED) -> DataFrame:
    """Daily bars of a request chunk against the dates it had to bring.

    ``received``: ``symbol, label, date`` (one row per bar); ``wanted``: ``symbol, label, date``.
    """
    marks = received.select("symbol", "label", "date", F.lit(1).alias("got"), F.lit(0).alias("want")).unionByName(
        wanted.select("symbol", "label", "date", F.lit(0).alias("got"), F.lit(1).alias("want"))
    )
    by_date = marks.groupBy("symbol", "label", "date").agg(F.sum("got").alias("n"), F.max("want").alias("want"))
    by_date = by_date.join(calendar.select("date", F.lit(True).alias("open")), "date", "left")
    wanted_day = F.when(F.col("want") == 1, F.col("date"))
    # One entry per calendar date of the chunk: the lists are bounded by its day span.
    off_days = F.collect_list(F.when((F.col("n") > 0) & F.col("open").isNull(), F.col("date")))
    missing_days = F.collect_list(F.when((F.col("want") == 1) & (F.col("n") == 0), F.col("date")))
    chunk = by_date.groupBy("symbol", "label").agg(
        F.count(F.when((F.col("want") == 1) & (F.col("n") > 0), F.lit(1))).alias("bar_count_int"),
        F.sum("want").alias("expected_count_int"),
        (F.sum("n") - F.count(F.when(F.col("n") > 0, F.lit(1)))).alias("duplicate_count_int"),
        F.min(wanted_day).alias("low"),
        F.max(wanted_day).alias("high"),
        F.min(F.when(F.col("n") > 0, wanted_day)).alias("first_kept"),
        F.max(F.when(F.col("n") > 0, wanted_day)).alias("last_kept"),
        F.sort_array(missing_days).alias("missing"),
        F.sort_array(off_days).alias("off_days"),
    )
    extra = F.filter("off_days", lambda d: d.between(F.col("low"), F.col("high")))
    chunk = chunk.withColumn("extra", F.coalesce(extra, F.array().cast("array<date>")))
    text = lambda name: F.transform(F.slice(name, 1, max_listed), lambda d: d.cast("string"))
    missing_count, extra_count = F.size("missing").cast("bigint"), F.size("extra").cast("bigint")
    status = (
        F.when(F.col("bar_count_int") == 0, F.lit("empty"))
        .when(missing_count > 0, F.lit("partial"))
        .otherwise(F.lit("complete"))
    )
    return chunk.select(
        "symbol", "label", status.alias("status_str"), "bar_count_int", "expected_count_int",
        missing_count.alias("missing_count_int"), extra_count.alias("extra_count_int"), "duplicate_count_int",
        F.coalesce(F.col("first_kept").cast("string"), F.lit("")).alias("first_bar_str"),
        F.coalesce(F.col("last_kept").cast("string"), F.lit("")).alias("last_bar_str"),
        V.listed_plain(text("missing"), missing_count, max_listed).alias("missing_str"),
        V.listed_plain(text("extra"), extra_count, max_listed).alias("extra_str"),
    )


def bar_summary(bars: DataFrame, by: list[str], order: str, intraday: bool = True) -> DataFrame:
    """Count, first / last label, gaps, volume class and first candle per group.

    ``order`` is the arrival order, used when two bars share the first label. Bars of one label are
    reduced first, so the second step sees one row per label.
    """
    prices = ["open", "high", "low", "close"]
    labels = bars.groupBy(*by, "ts").agg(
        F.count(F.lit(1)).alias("n"), F.max("volume").alias("volume"), *[F.min_by(p, order).alias(p) for p in prices]
    )
    total = labels.groupBy(*by).agg(
        F.sum("n").alias("bars"),
        F.count(F.lit(1)).alias("labels"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.max("volume").alias("volume"),
        *[F.min_by(p, "ts").alias(p) for p in prices],
    )
    minutes = F.floor((T.micros(F.col("last_ts")) - T.micros(F.col("first_ts"))) / F.lit(60 * T.MICROS_PER_SECOND)) + 1
    daily = F.lit(not intraday)
    return total.select(
        *by,
        "bars",
        T.label_text(F.col("first_ts"), daily).alias("first_bar"),
        T.label_text(F.col("last_ts"), daily).alias("last_bar"),
        (minutes - F.col("labels") if intraday else F.lit(None).cast("bigint")).alias("missing_minutes"),
        V.volume_class(F.col("volume")).alias("volume_info"),
        F.concat_ws("/", *[F.col(p).cast("string") for p in prices]).alias("first_bar_ohlc"),
    )


def broken_candles() -> Column:
    return V.broken_candle(F.col("open"), F.col("high"), F.col("low"), F.col("close"))


def candle_issues(bars: DataFrame, by: list[str]) -> DataFrame:
    """Rows and broken candles per group; one pass, map-side combined."""
    return bars.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count_int"), F.count_if(broken_candles()).alias("price_issue_count_int")
    )


def session_text(bars: DataFrame, calendar: DataFrame, order: str) -> DataFrame:
    """Text rows of session files: session minutes only, first row per minute, New York ISO text."""
    on_grid = in_session(bars, calendar.select("date", "first_bar_ts", "last_bar_ts"))
    minute = 60 * T.MICROS_PER_SECOND
    # The session grid starts on a whole minute of the New York clock.
    kept = on_grid.where(F.pmod(T.micros(F.col("ts")), F.lit(minute)) == 0)
    values = ["open", "high", "low", "close", "volume"]
    first = kept.groupBy("symbol", "date", "ts").agg(*[F.min_by(v, order).alias(v) for v in values])
    return first.select("symbol", *text_columns())


def day_text(bars: DataFrame, order: str) -> DataFrame:
    """Text rows of index days: bars of the day they were asked for, first row per label, no session limit."""
    own = bars.where(T.wall_date(F.col("ts")) == F.col("date"))
    values = ["open", "high", "low", "close", "volume"]
    first = own.groupBy("symbol", "date", "ts").agg(*[F.min_by(v, order).alias(v) for v in values])
    return first.select("symbol", *text_columns())


def text_columns() -> list[Column]:
    """Typed bar -> the eight text cells of a bar file."""
    return [
        T.offset_text(F.col("ts")).alias("timestamp"),
        *[V.plain_text(F.col(p)).alias(p) for p in ("open", "high", "low", "close")],
        V.volume_text(F.col("volume")).alias("volume"),
        F.lit("").alias("created_ts"),
        F.date_format("date", "yyyy-MM-dd").alias("date"),
    ]
