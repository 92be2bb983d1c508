"""Keyed merges of text bars. In a merge the existing row wins; in the live stream the newest does.

All of them are aggregates over the bar key, so any number of copies of one key is reduced on the map
side instead of meeting in one window partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from candlewright.functions import values as V

KEY = ["symbol", "ts"]
VALUE_COLUMNS = ["open", "high", "low", "close", "volume"]


def stack_sources(sources: list[DataFrame], keys: list[str] = KEY, order: str | None = None) -> DataFrame:
    """Union of the sources in order of precedence, with the union of their columns.

    Columns a source lacks become empty text. ``source_rank`` and ``row_pos`` give the precedence; without
    ``order`` rows of one source stand as Spark's scan of it does, so name a column where that matters.
    """
    names: list[str] = []
    for source in sources:
        names += [c for c in source.columns if c not in names and c not in keys and c != order]
    ranked = []
    for rank, source in enumerate(sources):
        position = F.col(order) if order else F.monotonically_increasing_id()
        filled = [
            (F.coalesce(F.col(c).cast("string"), F.lit("")) if c in source.columns else F.lit("")).alias(c) for c in names
        ]
        ranked.append(source.select(*keys, F.lit(rank).alias("source_rank"), position.cast("decimal(38,0)").alias("row_pos"), *filled))
    stacked = ranked[0]
    for other in ranked[1:]:
        stacked = stacked.unionByName(other)
    return stacked


def _differs(value: Column) -> Column:
    """More than one value in a group, where null counts as a value."""
    return F.coalesce(F.min(value) != F.max(value), F.lit(False)) | (
        (F.count(value) > 0) & (F.count(value) < F.count(F.lit(1)))
    )


def merged_rows(stacked: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """One row per key: the winning cells, the number of copies and whether their numbers differ."""
    cells = [c for c in stacked.columns if c not in (*keys, "source_rank", "row_pos")]
    conflict = F.lit(False)
    for name in VALUE_COLUMNS:
        if name in cells:
            conflict = conflict | _differs(V.number(F.col(name)))
    winner = F.min(F.struct("source_rank", "row_pos", *cells))
    grouped = stacked.groupBy(*keys).agg(winner.alias("winner"), F.count(F.lit(1)).alias("copies"), conflict.alias("conflict"))
    return grouped.select(*keys, *[F.col("winner")[c].alias(c) for c in ("source_rank", *cells)], "copies", "conflict")


def merge_existing_wins(sources: list[DataFrame], keys: list[str] = KEY, order: str | None = None) -> DataFrame:
    """The merged table: first source first, then the order of the others."""
    return merged_rows(stack_sources(sources, keys, order), keys).drop("source_rank", "copies", "conflict")


def conflict_flags(stacked: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Copies and conflict per key without carrying the text cells; fixed-width buffers only."""
    conflict = F.lit(False)
    for name in VALUE_COLUMNS:
        if name in stacked.columns:
            conflict = conflict | _differs(V.number(F.col(name)))
    return stacked.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"), conflict.alias("conflict"))


def merge_conflicts(stacked: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Keys whose copies hold different prices or volumes, compared as numbers."""
    return conflict_flags(stacked, keys).where("conflict").select(*keys, "copies")


def first_conflicts(stacked: DataFrame, keys: list[str] = KEY, limit: int = 10) -> DataFrame:
    """The earliest conflicting keys; sort and limit become one top-k per task."""
    return merge_conflicts(stacked, keys).orderBy("ts", *keys).limit(limit)


def merge_stats(stacked: DataFrame, keys: list[str] = KEY, by: list[str] | None = None) -> DataFrame:
    """Rows in and out, duplicates and conflicting keys."""
    by = by or []
    grouped = conflict_flags(stacked, keys).groupBy(*by)
    return grouped.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("input_row_count"),
        F.count(F.lit(1)).alias("output_row_count"),
        (F.coalesce(F.sum("copies"), F.lit(0)) - F.count(F.lit(1))).alias("duplicate_row_count"),
        F.count_if("conflict").alias("conflict_minute_count"),
    )


def merge_verify(inputs: DataFrame, output: DataFrame, keys: list[str] = KEY, by: list[str] | None = None) -> DataFrame:
    """Lost, foreign and repeated keys of a written merge result, and the verdict; one row per ``by``."""
    marks = inputs.select(*keys, F.lit(1).alias("given"), F.lit(0).alias("kept")).unionByName(
        output.select(*keys, F.lit(0).alias("given"), F.lit(1).alias("kept"))
    )
    per_key = marks.groupBy(*keys).agg(F.sum("given").alias("given"), F.sum("kept").alias("kept"))
    return per_key.groupBy(*(by or [])).agg(
        F.count_if((F.col("given") > 0) & (F.col("kept") == 0)).alias("lost_key_count"),
        F.count_if((F.col("given") == 0) & (F.col("kept") > 0)).alias("foreign_key_count"),
        F.count_if(F.col("kept") > 1).alias("repeated_key_count"),
    ).withColumn("verified", F.col("lost_key_count") + F.col("foreign_key_count") + F.col("repeated_key_count") == 0)


def merge_audit(stacked: DataFrame, output: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Counts of ``merge_stats`` and verdict of ``merge_verify`` per ``by``, in one pass over both sides."""
    values = [c for c in VALUE_COLUMNS if c in stacked.columns]
    marks = stacked.select(*keys, F.lit(1).alias("given"), F.lit(0).alias("kept"), *[V.number(F.col(c)).alias(c) for c in values]).unionByName(
        output.select(*keys, F.lit(0).alias("given"), F.lit(1).alias("kept")), allowMissingColumns=True
    )
    # The written row adds no value of its own, so blanks are counted against the given rows.
    differs = F.lit(False)
    for name in values:
        known = F.count(F.col(name))
        differs = differs | F.coalesce(F.min(name) != F.max(name), F.lit(False)) | ((known > 0) & (known < F.sum("given")))
    per_key = marks.groupBy(*keys).agg(F.sum("given").alias("given"), F.sum("kept").alias("kept"), differs.alias("conflict"))
    return per_key.groupBy(*by).agg(
        F.sum("given").alias("input_row_count"),
        F.count_if(F.col("given") > 0).alias("output_row_count"),
        (F.sum("given") - F.count_if(F.col("given") > 0)).alias("duplicate_row_count"),
        F.count_if("conflict").alias("conflict_minute_count"),
        (F.count_if((F.col("given") == 0) | (F.col("kept") != 1)) == 0).alias("verified"),
    )


def kv_upsert(old: DataFrame, new: DataFrame, key: str = "key", value: str = "value", order: str | None = None) -> DataFrame:
    """Top-level keys of two documents; the new value wins and is not merged deeper.

    Each side may repeat a key: its last value (by ``order``) counts, as in a JSON object.
    """
    def side(frame: DataFrame, rank: int) -> DataFrame:
        position = F.col(order) if order else F.monotonically_increasing_id()
        return frame.select(key, value, F.lit(rank).alias("rank"), position.alias("pos"))

    both = side(old, 0).unionByName(side(new, 1))
    return both.groupBy(key).agg(F.max_by(value, F.struct("rank", "pos")).alias(value))


def snapshot_guard(old: DataFrame, new: DataFrame, by: list[str]) -> DataFrame:
    """What to do with each partition of a new snapshot: write, skip, overwrite or error.

    Rows are compared as text, as multisets: equal -> skip, fewer rows -> error, else overwrite.
    Partitions that only the old snapshot has are left alone.
    """
    columns = new.columns
    as_text = lambda frame: [F.col(c).cast("string").alias(c) for c in columns]
    marks = old.select(*as_text(old), F.lit(1).alias("old"), F.lit(0).alias("new")).unionByName(
        new.select(*as_text(new), F.lit(0).alias("old"), F.lit(1).alias("new"))
    )
    rows = marks.groupBy(*columns).agg(F.sum("old").alias("old"), F.sum("new").alias("new"))
    parts = rows.groupBy(*by).agg(
        F.sum("old").alias("old_rows"), F.sum("new").alias("new_rows"), F.count_if(F.col("old") != F.col("new")).alias("differing")
    )
    action = (
        F.when(F.col("old_rows") == 0, F.lit("write"))
        .when(F.col("differing") == 0, F.lit("skip"))
        .when(F.col("new_rows") < F.col("old_rows"), F.lit("error"))
        .otherwise(F.lit("overwrite"))
    )
    return parts.where(F.col("new_rows") > 0).select(*by, "old_rows", "new_rows", action.alias("action"))


def frames_equal(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row telling whether two tables hold the same rows as text."""
    columns = left.columns
    as_text = lambda frame, sign: frame.select(*[F.col(c).cast("string").alias(c) for c in columns], F.lit(sign).alias("sign"))
    counts = as_text(left, 1).unionByName(as_text(right, -1)).groupBy(*columns).agg(F.sum("sign").alias("balance"))
    return counts.agg((F.count_if(F.col("balance") != 0) == 0).alias("equal"))


def row_count_delta(before: DataFrame, after: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Row counts of two loads and their difference."""
    by = by or []
    marks = before.select(*by, F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        after.select(*by, F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    return marks.groupBy(*by).agg(
        F.coalesce(F.sum("b"), F.lit(0)).alias("before_count"),
        F.coalesce(F.sum("a"), F.lit(0)).alias("after_count"),
        (F.coalesce(F.sum("a"), F.lit(0)) - F.coalesce(F.sum("b"), F.lit(0))).alias("row_count_diff"),
    )
