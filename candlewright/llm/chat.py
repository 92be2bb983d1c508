"""Chat formatting in budgeted windows, in DataFrame operations only.

Prefix sums of the tokens of turns cut a conversation into turn-aligned windows: a window takes the
turns whose prefix falls into one cell of half the room, and a turn of more than half the room is a
window of its own, so the new turns of a window fit the room (one longer turn excepted). Every later
window repeats the system turn and as many earlier turns as fit the history budget. A system turn of
more than half of what history leaves is no longer repeated: it is in its own first window only, so
what is repeated never outgrows the budget. Only assistant texts that are new in a window are under
its loss mask, so each is a target once.

A conversation may hold a third of all rows. Turns are put in order by a range shuffle and written, so a
conversation spans as many parts as its share; prefix sums are made inside each (conversation, part) and
lifted by the sums of the parts before. From then on rows meet by cell of the prefix, with the turns that
a cell needs as history copied from the one before. (Turns of one number and role whose texts begin alike
stay in one part.) Only `read_back` gathers a conversation.

A window is a text of marked turns. Inside roles and texts a backslash is doubled and `<|` becomes
`<\\|`, so no mark can occur there, and reading back undoes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from candlewright.llm.common import settle, word_count

BUDGET = 512
HISTORY = 128
#: Tokens that the marks of a turn count for.
MARK_TOKENS = 4
TARGET = "assistant"
SYSTEM = "system"
#: First characters of a text by which turns of one number and role are dealt to parts.
DEAL_CHARS = 32
#: Budgets of tokens in a group that collects history, and parts that the windows of a conversation meet its system turn in.
GROUP_BUDGETS = 8
SYSTEM_PARTS = 16
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _role(text: Column) -> Column:
    """Roles end at a line feed, so theirs are written in another way."""
    return F.replace(F.replace(escape(text), F.lit("\n"), F.lit("<\\n")), F.lit("\r"), F.lit("<\\r"))


def _plain_role(text: Column) -> Column:
    return unescape(F.regexp_replace(F.regexp_replace(text, r"(?<!\\)((?:\\\\)*)<\\n", "$1\n"), r"(?<!\\)((?:\\\\)*)<\\r", "$1\r"))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, formatted, n_repeated, loss: from conv_id, turn, role, text.

    `window` grows along a conversation, with gaps. `n_repeated` turns at the beginning were in an earlier
    window; `loss` lists the (start, length) of targets in characters. Turns are ordered by number, null
    first, then role and text; null roles and texts count as empty; a null conv_id is a conversation like
    any other. Repeated rows are turns like any other; an empty table gives an empty result; other columns
    are not read.
    """
    # As a field of a struct, a null conversation is equal to itself.
    rows = turns.select(
        F.struct("conv_id").alias("conv"), F.col("turn").alias("number"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = rows.repartitionByRange("conv", "number", "role", F.substring("text", 1, DEAL_CHARS))
    parts = settle(ordered.select("*", (word_count(F.col("text")) + MARK_TOKENS).alias("tokens"), F.spark_partition_id().alias("part")), "chat-parts")
    placed = W.partitionBy("conv", "part").orderBy("number", "role", "text")
    here = parts.select(
        "*", F.row_number().over(placed).alias("at_here"),
        F.coalesce(F.sum("tokens").over(placed.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("prefix_here"),
    )
    lead = F.max(F.when(F.col("at_here") == 1, F.struct("role", "tokens")))
    sums = here.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("turns"), F.sum("tokens").alias("all_tokens"), lead.alias("lead"))
    by_part = W.partitionBy("conv").orderBy("part")
    before = by_part.rowsBetween(W.unboundedPreceding, -1)
    first = F.first("lead").over(by_part.rowsBetween(W.unboundedPreceding, W.currentRow))
    lifts = sums.select(
        "conv", "part", F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("turns_before"),
        F.coalesce(F.sum("all_tokens").over(before), F.lit(0)).alias("tokens_before"), first.alias("lead"),
    )
    retained = (F.col("lead.role") == SYSTEM) & (2 * F.col("lead.tokens") <= budget - history)
    half = F.floor(F.greatest(F.lit(2), budget - history - F.when(retained, F.col("lead.tokens")).otherwise(0)) / 2)
    lifted = here.join(lifts, ["conv", "part"]).select(
        "conv", "role", "text", "tokens", (F.col("at_here") + F.col("turns_before")).alias("at"),
        (F.col("prefix_here") + F.col("tokens_before")).alias("prefix"), retained.alias("retained"), half.alias("half"),
    )
    # A turn of more than half the room reaches beyond its cell, so it is the last of the cell and a window of its own.
    window = 2 * F.floor(F.col("prefix") / F.col("half")) + (F.col("tokens") > F.col("half")).cast("long")
    lifted = lifted.withColumn("window", window)
    # History of a group's first turns lies at most `history` tokens before it: those turns come along as guests.
    group_tokens = GROUP_BUDGETS * max(budget, history)
    own_group, reached = F.floor(F.col("prefix") / group_tokens), F.floor((F.col("prefix") + history) / group_tokens)
    groups = lifted.select("*", own_group.alias("home"), F.explode(F.sequence(own_group, reached)).alias("group"))
    along = W.partitionBy("conv", "group").orderBy("prefix")
    own = F.struct("at", "role", "text")
    # Turns of one conversation have different prefixes, so a range of prefixes is a budget of tokens.
    past = F.collect_list(F.when(~(F.col("retained") & (F.col("at") == 1)), own)).over(along.rangeBetween(-history, -1))
    opens = F.coalesce(F.lag("window").over(along) != F.col("window"), F.lit(True))
    rows = groups.select("*", opens.alias("opens"), past.alias("past")).where(F.col("group") == F.col("home"))
    packed = rows.groupBy("conv", "window").agg(
        F.sort_array(F.collect_list(own)).alias("new"),
        F.min_by(F.when(F.col("opens"), F.col("past")), F.when(F.col("opens"), F.col("at"))).alias("past"),
        (F.bool_or("retained") & (F.min("at") > 1)).alias("later"),
    )
    system = lifted.where(F.col("retained") & (F.col("at") == 1)).select(
        "conv", F.array(F.struct(F.lit(0).cast("long").alias("at"), "role", "text")).alias("again"), F.explode(F.sequence(F.lit(0), F.lit(SYSTEM_PARTS - 1))).alias("salt"))
    salted = packed.withColumn("salt", F.when(F.col("later"), F.pmod(F.hash("window"), F.lit(SYSTEM_PARTS))).otherwise(-1))
    nothing = F.array().cast("array<struct<at:bigint,role:string,text:string>>")
    packed = salted.join(system, ["conv", "salt"], "left").select(
        "conv.conv_id", "window", "new", F.concat(F.coalesce("again", nothing), "past").alias("repeated"),
    )
    marked = packed.select(
        "conv_id", "window", F.size("repeated").cast("long").alias("n_repeated"),
        F.transform(F.concat("repeated", "new"), lambda t: F.struct(
            F.concat(F.lit(OPEN), _role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"), (t["role"] == TARGET).alias("target"))).alias("parts"),
    )
    # A window is bounded, so a fold over its turns is too.
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("chars"), F.array().cast("array<struct<start:int,length:int>>").alias("loss"))

    def step(state: Column, part: Column) -> Column:
        begin = state["chars"] + F.length(part["head"])
        target = part["target"] & (state["at"] >= F.col("n_repeated"))
        span = F.array(F.struct((begin + 1).alias("start"), F.length(part["body"]).alias("length")))
        return F.struct(
            (state["at"] + 1).alias("at"),
            (begin + F.length(part["body"]) + len(CLOSE)).alias("chars"),
            F.when(target, F.concat(state["loss"], span)).otherwise(state["loss"]).alias("loss"),
        )

    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    return marked.select("conv_id", "window", text.alias("formatted"), "n_repeated", F.aggregate("parts", start, step)["loss"].alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars: from `windows`, by its text alone.

    The digests of a conversation are made over all its windows in order, so they meet in one row.
    """
    turn = r"(?s)<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n"
    roles, texts = (F.regexp_extract_all("formatted", F.lit(turn), F.lit(i)) for i in (1, 2))
    new = F.col("n_repeated").cast("int")
    read = formatted.select(
        "conv_id", "window", F.length("formatted").alias("chars"),
        F.filter(F.zip_with(roles, texts, lambda r, t: F.struct(r.alias("role"), t.alias("text"))), lambda t, i: i >= new).alias("turns"),
        F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"], s["length"]))).alias("targets"),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(_plain_role(t["role"]), F.lit("\n"), unescape(t["text"]), F.lit("\n"))), "")
    parts = read.select("conv_id", "window", "chars", F.size("turns").alias("n"), told.alias("told"), F.array_join("targets", "").alias("aim"))
    ordered = F.sort_array(F.collect_list(F.struct("window", "told", "aim")))
    whole = parts.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), ordered.alias("all"))
    aim = F.array_join("all.aim", "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join("all.told", "").cast("binary"), 256).alias("turns_sha256"),
        F.length(aim).cast("long").alias("loss_chars"), F.sha2(aim.cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )
