"""Numbers held as text, volumes, candle rules, and the wording of errors and outcomes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# From here up a volume is the "unset" marker 2**127 - 1 of the data service.
UNSET_VOLUME_WHEN_WRITING = float(2**126)
UNSET_VOLUME_WHEN_CLASSIFYING = 1e15

#: Decimal numbers, with or without an exponent, and the words for infinity.
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?\s*$|^\s*[+-]?inf(inity)?\s*$"

# Message codes and texts of the historical data service.
INFO_CODES = (2100, 2199)
HISTORY_ERROR_CODE = 162
PACING_TEXT = "pacing violation"
NO_DATA_TEXT = "returned no data"
PERMISSION_CODES = [354, 10089, 10090, 10167, 10168]
PERMISSION_TEXTS = ["no market data permissions", "not subscribed", "market data is not subscribed"]
UNKNOWN_CONTRACT_CODE = 200

# The diagnosis wording that reports and verdicts compare.
DATA_RETURNED = "data returned"
NOTHING_RETURNED = "completed with nothing returned"
PERMISSION_MISSING = "market data permission missing"
NO_DATA_FOR_WINDOW = "no data for this window (before the history starts, or not offered for this data type)"
PACING_LATER = "pacing violation (run the probe again later)"
NO_ANSWER = "no answer before the timeout"
CONTRACT_NOT_FOUND = "contract not found (symbol, security type or exchange)"
OTHER_ERROR = "IBKR error (see error_text)"

# How often a request may be repeated.
MAX_PACING_REQUEUES = 10
MAX_ATTEMPTS = 3
SOFT_FAILURES = ["partial", "empty", "no_data", "error", "timeout"]


def number(text: Column) -> Column:
    """Text -> DOUBLE; anything that is not a number (NaN and type suffixes included) -> null."""
    value = text.try_cast("double")
    return F.when(text.rlike(NUMBER) & ~F.isnan(value), value)


def plain_text(value: Column) -> Column:
    """The shortest digits that read back as the value, never with an exponent."""
    text = value.cast("string")
    sign, whole, fraction, power = (F.regexp_extract(text, r"^(-?)(\d+)\.?(\d*)E(-?\d+)$", k) for k in (1, 2, 3, 4))
    power = power.try_cast("int")
    digits = F.concat(whole, F.when(fraction == "0", F.lit("")).otherwise(fraction))
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    short = F.length(digits) - 1 <= power
    large = F.when(short, F.concat(sign, F.rpad(digits, power + 1, "0"), F.lit(".0"))).otherwise(
        F.concat(sign, F.substring(digits, F.lit(1), power + 1), F.lit("."), F.substring(digits, power + 2, F.length(digits)))
    )
    return F.when(~text.contains("E"), text).when(power < 0, small).otherwise(large)


def number_text(value: Column) -> Column:
    """Whole numbers without a fraction (up to 38 digits), the others as they are."""
    whole = (value == F.floor(value)) & (F.abs(value) < F.lit(1e38))
    return F.when(whole, value.try_cast("decimal(38,0)").cast("string")).otherwise(plain_text(value))


def volume_text(volume: Column) -> Column:
    """The unset marker is written as an empty cell; zero and negative volumes stay."""
    value = volume.cast("double")
    return F.when(value >= UNSET_VOLUME_WHEN_WRITING, F.lit("")).otherwise(number_text(value))


def volume_class(largest: Column) -> Column:
    return (
        F.when(largest >= UNSET_VOLUME_WHEN_CLASSIFYING, F.lit("unset"))
        .when(largest <= 0, F.lit("zero_or_negative"))
        .when(largest.isNotNull(), F.lit("present"))
    )


def broken_candle(open_: Column, high: Column, low: Column, close: Column) -> Column:
    """True for a price that is not a positive finite number, or a high / low inside the body."""
    prices = [open_, high, low, close]
    bad = F.lit(False)
    for price in prices:
        bad = bad | price.isNull() | F.isnan(price) | (price <= 0) | (F.abs(price) == F.lit(float("inf")))
    shape = (high < F.greatest(open_, close, low)) | (low > F.least(open_, close, high))
    return F.coalesce(bad | shape, F.lit(True))


def error_class(code: Column, text: Column) -> Column:
    lowered = F.lower(text)
    history = code == HISTORY_ERROR_CODE
    return (
        F.when(code.between(*INFO_CODES), F.lit("info"))
        .when(history & lowered.contains(PACING_TEXT), F.lit("pacing"))
        .when(history & lowered.contains(NO_DATA_TEXT), F.lit("no_data"))
        .otherwise(F.lit("error"))
    )


def diagnosis(status: Column, code: Column, text: Column, returned: Column) -> Column:
    lowered = F.lower(F.coalesce(text, F.lit("")))
    no_permission = F.coalesce(code.isin(PERMISSION_CODES), F.lit(False))
    for phrase in PERMISSION_TEXTS:
        no_permission = no_permission | lowered.contains(phrase)
    return (
        F.when((status == "complete") & (returned > 0), F.lit(DATA_RETURNED))
        .when(status == "complete", F.lit(NOTHING_RETURNED))
        .when(no_permission, F.lit(PERMISSION_MISSING))
        .when(status == "no_data", F.lit(NO_DATA_FOR_WINDOW))
        .when(status == "pacing", F.lit(PACING_LATER))
        .when(status == "timeout", F.lit(NO_ANSWER))
        .when(code == UNKNOWN_CONTRACT_CODE, F.lit(CONTRACT_NOT_FOUND))
        .otherwise(F.lit(OTHER_ERROR))
    )


def wants_retry(status: Column, attempt: Column, requeues: Column) -> Column:
    return ((status == "pacing") & (requeues < MAX_PACING_REQUEUES)) | (
        status.isin(SOFT_FAILURES) & (attempt < MAX_ATTEMPTS)
    )


def wants_save(status: Column, attempt: Column, requeues: Column) -> Column:
    return (status == "complete") | ((status == "partial") & ~wants_retry(status, attempt, requeues))


def hide_latest(test_name: Column, text: Column) -> Column:
    """Prices of the latest bars must not appear in a report."""
    return F.when(test_name.endswith("_latest"), F.lit("")).otherwise(text)


def listed(items: Column, total: Column, limit: int) -> Column:
    """``09:30, 09:31 (+5 more)`` from the first items and the full count."""
    more = F.when(total > limit, F.concat(F.lit(" (+"), (total - limit).cast("string"), F.lit(" more)"))).otherwise(F.lit(""))
    return F.concat(F.array_join(F.slice(items, 1, limit), ", "), more)


def listed_plain(items: Column, total: Column, limit: int) -> Column:
    """``2026-09-10 2026-09-11 ...`` from the first items and the full count."""
    more = F.when(total > limit, F.lit(" ...")).otherwise(F.lit(""))
    return F.concat(F.array_join(F.slice(items, 1, limit), " "), more)
