"""Chat windows under a token budget, with a loss mask; DataFrame functions only.

Prefix sums of turn tokens choose the spans. They cut a conversation into blocks of BLOCK times
what a span may hold; in a block, the next span starts with the first turn whose prefix sum no
longer fits, found by one pass over the block's numbers. A block's turns are bounded in tokens, so
no task walks a whole conversation. A window holds the conversation's first system turn, then
history (turns of the span before, within `history` tokens and what the budget leaves), then the
span. Repeated turns are masked: each assistant text is a target once, in its own span.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 2048
HISTORY = 256
CHARS_PER_TOKEN = 4
#: Tokens that the template adds to a turn.
TURN_TOKENS = 4
#: Spans that a block of turns may fill; each block starts a span.
BLOCK = 16
#: The template. A turn is OPEN role > text CLOSE; these start with the one character that escaping removes.
OPEN, CLOSE = "<turn ", "</turn>\n"
#: Escapes, in the order of escaping; undone in reverse. A backslash is always followed by a letter.
ESCAPES = (("\\", "\\s"), ("<", "\\l"), (">", "\\g"))


def escape(text: Column) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ESCAPES, text)


def unescape(text: Column) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[1]), F.lit(e[0])), reversed(ESCAPES), text)


def spans_of(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """Turns with pos, tokens before, span, start (set on a span's first turn), the next span's
    start and the opening system text. Ties of turn are ordered by role and text, null first."""
    conv = Window.partitionBy("conv_id")
    order = conv.orderBy("turn", "role", "text")
    placed = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    tokens = F.ceil(F.char_length("text") / CHARS_PER_TOKEN) + TURN_TOKENS
    placed = placed.withColumns({"tokens": tokens, "pos": F.row_number().over(order)})
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    system = (F.col("pos") == 1) & (F.col("role") == "system")
    placed = placed.withColumns({
        "before": F.sum("tokens").over(upto) - F.col("tokens"), "system": system,
        "system_text": F.first(F.when(system, F.col("text"))).over(upto),
        "kept": F.first(F.when(system, F.col("tokens")).otherwise(0)).over(upto)})
    stride = F.greatest(F.lit(1), F.lit(budget - history) - F.col("kept"))
    placed = placed.withColumn("stride", stride).withColumn("block", F.floor(F.col("before") / (F.col("stride") * BLOCK)))
    blocks = placed.groupBy("conv_id", "block").agg(
        F.array_sort(F.collect_list(F.struct("pos", "before", "tokens", "system", "role", "text"))).alias("t"),
        F.first("kept").alias("kept"), F.first("stride").alias("stride"), F.first("system_text").alias("system_text"))

    def step(a: Column, x: Column) -> Column:
        new = a["at"].isNull() | (x["before"] + x["tokens"] - a["at"] > F.col("stride"))
        return F.struct(
            F.when(new, x["before"]).otherwise(a["at"]).alias("at"),
            F.when(new, F.concat(a["out"], F.array(x["before"]))).otherwise(a["out"]).alias("out"))

    none = F.struct(F.lit(None).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out"))
    last = F.element_at("t", -1)
    blocks = blocks.withColumns({
        "starts": F.aggregate("t", none, step, lambda a: a["out"]), "ends": last["before"] + last["tokens"]})
    placed = blocks.select("conv_id", "kept", "system_text", "starts", "ends", F.explode("t").alias("x")).select("*", "x.*")
    # the span's first turn lies at starts[k - 1], that of the block's next span at starts[k]
    k = F.size(F.filter("starts", lambda s: s <= F.col("before")))
    placed = placed.withColumns({"first": F.get("starts", k - 1), "end": F.coalesce(F.get("starts", k), "ends")}).drop("x", "starts", "ends")
    new = F.col("first") == F.col("before")
    order = conv.orderBy("pos")
    placed = placed.withColumn("span", F.sum(new.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    placed = placed.withColumn("start", F.when(new, F.struct("before", "span", (F.col("end") - F.col("first")).alias("tokens"))))
    back = conv.orderBy(F.col("pos").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("next", F.last("start", ignorenulls=True).over(back))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, repeated, text, spans: a row per window.

    turns: conv_id, turn, role, text; a null role or text is empty, a null conv_id is a
    conversation of its own, a null turn comes first, equal rows are turns each. `repeated` counts
    the turns at the front of a window that stand in an earlier one too. spans holds begin and
    length (code points) of the target texts, escaped as they stand. A window goes beyond the
    budget by its last turn at most. Texts are shuffled once, by conversation; a task sorts the
    turns of a conversation (on disk if need be) and gathers those of one window. No turns give
    no windows.
    """
    placed = spans_of(turns, budget, history)
    # history: turns of the span before that lie within `history` tokens of the next span's start, and fit
    room = F.least(F.lit(history), F.lit(budget) - F.col("kept") - F.col("next.tokens"))
    near = (F.col("next.before") - F.col("before") <= room) & ~F.col("system")
    opens = F.col("start").isNotNull() & (F.col("span") > 0) & F.col("system_text").isNotNull()

    def copy(window: Column, again: bool, pos: Column, role: Column, text: Column) -> Column:
        return F.struct(window.alias("window"), F.lit(again).alias("again"), pos.alias("pos"), role.alias("role"), text.alias("text"))

    copies = F.array(
        copy(F.col("span"), False, F.col("pos"), F.col("role"), F.col("text")),
        F.when(near, copy(F.col("next.span"), True, F.col("pos"), F.col("role"), F.col("text"))),
        F.when(opens, copy(F.col("span"), True, F.lit(1), F.lit("system"), F.col("system_text"))))
    every = placed.select("conv_id", F.explode(F.array_compact(copies)).alias("x")).select("conv_id", "x.*")
    piece = F.struct(
        "pos", F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(">")).alias("head"), escape(F.col("text")).alias("body"),
        "again", ((F.col("role") == "assistant") & ~F.col("again")).alias("target"))
    packed = every.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    text = F.array_join(F.transform("p", lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), "")
    # one pass over the turns of a window gives the places of its targets
    none = F.array().cast("array<struct<begin: int, length: int>>")

    def step(a: Column, x: Column) -> Column:
        begin, length = a["at"] + F.char_length(x["head"]), F.char_length(x["body"])
        more = F.concat(a["out"], F.array(F.struct(begin.alias("begin"), length.alias("length"))))
        return F.struct((begin + length + len(CLOSE)).alias("at"), F.when(x["target"], more).otherwise(a["out"]).alias("out"))

    mask = F.aggregate("p", F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda a: a["out"])
    return packed.select(
        "conv_id", "window", F.size(F.filter("p", lambda x: x["again"])).alias("repeated"), text.alias("text"), mask.alias("spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, window, turns (role and text), target (what is under the mask, unescaped), chars:
    from a window's text, count of repeated turns and mask alone. Repeated turns are left out."""
    parts = F.filter(F.split("text", CLOSE), lambda x: F.startswith(x, F.lit(OPEN)))

    def turn(x: Column) -> Column:
        at = F.instr(x, ">")
        role = F.substr(x, F.lit(len(OPEN) + 1), at - (len(OPEN) + 1))
        return F.struct(unescape(role).alias("role"), unescape(F.substr(x, at + 1)).alias("text"))

    own = F.slice(F.transform(parts, turn), F.col("repeated") + 1, F.greatest(F.lit(0), F.size(parts) - F.col("repeated")))
    target = F.array_join(F.transform("spans", lambda s: F.substr("text", s["begin"] + 1, s["length"])), "")
    return formatted.select(
        "conv_id", "window", own.alias("turns"), unescape(target).alias("target"), F.char_length("text").alias("chars"))


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars. A digest is
    of one value, so this puts a conversation's texts together; `windows` does not."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = read_back(formatted).withColumn("told", told)
    whole = read.groupBy("conv_id").agg(
        F.sum(F.size("turns")).cast("bigint").alias("n_turns"), F.sum("chars").cast("bigint").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("window", "told", "target"))).alias("w"))
    loss = F.array_join(F.col("w.target"), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join(F.col("w.told"), "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars")
