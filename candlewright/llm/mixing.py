"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Shares are proportional to weights. Sources whose share exceeds their words times `epochs` are clamped
there and their excess goes to the others by weight, until no share exceeds its cap. A source then
repeats each document as often as whole epochs fit, and the rest of its target comes from a seeded
selection: documents in the order of a hash are taken until the rest is reached to half a document.

The order is cut in two steps: sums of hash bins find the bin where the cut falls, and only rows of the
same source and bin are ordered against each other. A source with a third of all rows so spreads over
all bins and no window sees more than its share of one bin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from candlewright.llm.common import numbered, settle, word_count

WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = 7
#: Leading hex digits of the hash that make a bin.
BIN_DIGITS = 3
#: Cuts of so many sources are sent to every task; more are joined by a shuffle.
SENT_SOURCES = 10_000


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size, target, whole, rest: from rows of source and size, one row for each source.

    Sources are ranked by code point, null last; the driver sees three sums for each round of filling.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked, _ = numbered(by_source, F.col("source").asc_nulls_last(), label="mix-sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("row_number") % len(weights) + 1).cast("int"))
    sources = settle(ranked.select("source", "source_size", weight.cast("long").alias("weight")), "mix-weights")
    cap = F.col("source_size") * epochs
    clamped, level = -1, 0.0
    while True:
        full = cap <= F.col("weight") * F.lit(level) if clamped >= 0 else F.lit(False)
        at = sources.agg(
            F.count_if(full).alias("clamped"),
            F.sum("source_size").alias("total"),
            F.sum(F.when(full, cap)).alias("held"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
        ).first()
        if at["clamped"] == clamped or not at["open"]:
            break
        clamped, level = at["clamped"], (at["total"] - (at["held"] or 0)) / at["open"]
    full = cap <= F.col("weight") * F.lit(level)
    target = F.when(full, cap.cast("double")).otherwise(F.col("weight") * F.lit(level))
    whole = F.when(F.col("source_size") == 0, 0).when(full, epochs).otherwise(F.floor(target / F.col("source_size"))).cast("long")
    planned = sources.select("source", "source_size", target.alias("target"), whole.alias("whole"))
    return planned.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))


def repetitions(sized: DataFrame, planned: DataFrame, *carry: str) -> DataFrame:
    """`carry`, size, source_size, target and times (how often the mix repeats the row).

    `sized` has source, size and mark: the hash that orders the rows of a source.
    """
    binned = sized.withColumn("bin", F.substring("mark", 1, BIN_DIGITS))
    bins = binned.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    plan = planned.withColumnRenamed("source", "of")
    bins = bins.join(plan, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    earlier = W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    bins = bins.withColumn("base", F.coalesce(F.sum("bin_size").over(earlier), F.lit(0)))
    bins = bins.select(F.col("source").alias("of"), F.col("bin").alias("of_bin"), "base", "source_size", "target", "whole", "rest")
    rows = binned.join(bins, F.col("source").eqNullSafe(F.col("of")) & (F.col("bin") == F.col("of_bin")))
    before = W.partitionBy("source", "bin").orderBy("mark", "size").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("size").over(before), F.lit(0))
    picked = 2 * start + F.col("size") <= 2 * F.col("rest")
    times = F.col("whole") + F.when(picked, 1).otherwise(0)
    return rows.select(*carry, "size", "source_size", "target", times.alias("times"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> list:
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    return [F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), mark.alias("mark")]


def mix_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row.

    Null texts have no words and take none; null sources form a source of their own, ranked last. Rows
    that agree in id and size may stand for each other. A source without words has target 0. An empty
    table gives an empty result; other columns are not read.
    """
    sized = settle(docs.select(F.col(id_col).alias("doc_id"), *_sized(docs, id_col, text_col, source_col, seed)), "mix-sizes")
    told = repetitions(sized, targets(sized), "doc_id")
    return told.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def cuts(sized: DataFrame, planned: DataFrame) -> DataFrame:
    """of, whole, last: one row for each source; `last` has mark and size of the last row that its rest takes, null if none.

    Rows are taken in the order of mark and size as long as half of the next one still fits, so one mark
    for each source tells them all. Only the rows of the bin of the cut are ordered.
    """
    took = repetitions(sized, planned, "source", "mark").join(
        planned.select(F.col("source").alias("of"), "whole"), F.col("source").eqNullSafe(F.col("of"))
    ).where(F.col("times") > F.col("whole"))
    last = took.groupBy("source").agg(F.max(F.struct("mark", "size")).alias("last")).withColumnRenamed("source", "took")
    plan = planned.select(F.col("source").alias("of"), "whole")
    return plan.join(last, F.col("of").eqNullSafe(F.col("took")), "left").select("of", "whole", "last")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """The rows of `docs`, each as often as the mix repeats it; same rules as `mix_words`.

    Rows without words come as often as whole epochs of their source do. Only ids, sizes and sources move
    to find the cuts; the rows themselves stay where they are read, unless there are too many sources to
    send their cuts to every task.
    """
    own = _sized(docs, id_col, text_col, source_col, seed)
    sized = settle(docs.select(*own), "mix-sizes")
    told = settle(cuts(sized, settle(targets(sized), "mix-targets")), "mix-cuts")
    if told.count() <= SENT_SOURCES:
        told = F.broadcast(told)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *own)
    rows = rows.join(told, F.col("source").eqNullSafe(F.col("of")))
    picked = F.coalesce(F.struct("mark", "size") <= F.col("last"), F.lit(False)) & (F.col("size") > 0)
    times = F.col("whole") + F.when(picked, 1).otherwise(0)
    rows = rows.withColumn("again", F.explode(F.array_repeat(F.lit(0), times.cast("int"))))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
