"""Chat formatting in budgeted windows, in DataFrame expressions only.

Every turn is written as ``<|role|>text</s>``. Inside roles and texts the characters backslash, <, > and [ become
two-character escapes, so no control string can arise from a text and reading back restores it exactly.

Prefix sums of turn tokens choose the windows. A conversation's body (all turns but a leading system turn) is measured
along its tokens and ruled into strides of ``budget - history - system`` tokens: a turn belongs to the stride in which it
begins, and one that reaches into the next stride stands in a window of its own. So every window keeps to the budget
except around a single turn that is longer than a stride, which is kept whole and marked ``oversize``. A window
repeats the leading system turn and those of the turns before it that begin within ``history`` tokens. The mask covers
the text of each assistant turn where it is new; repeated targets are outside the mask.

Prefix sums run within blocks of ``TURNS`` turn numbers and then over block totals, so a very long conversation is spread over
tasks. A window is bounded by its budget, history rows are found by an equality join on stretches of ``history`` tokens.

Defined cases: null roles and texts are empty; equal turn numbers are ordered by role, then text; null turn numbers come
first; rows with a null conversation id form one conversation; a conversation of only a system turn is one window;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURNS = 256
OVERHEAD = 4
TOKEN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\r]"
END = "</s>"
#: The backslash comes first when escaping and last when reading back.
ESCAPES = [("\\", "\\s"), ("<", "\\l"), (">", "\\g"), ("[", "\\b")]


def escaped(text: Column) -> Column:
    for plain, mark in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescaped(text: Column) -> Column:
    for plain, mark in reversed(ESCAPES):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def rough_tokens(text: Column) -> Column:
    """Words and single other characters, with a fixed share for the marks of the turn."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("long") + OVERHEAD


def _measured(conversations: DataFrame, tokens: Callable[[Column], Column]) -> DataFrame:
    """Each turn with its place in the conversation, its tokens and the tokens before it."""
    blank = F.lit("")
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
    )
    turns = turns.withColumns({"tokens": tokens(F.col("text")), "block": F.floor(F.col("turn") / TURNS)})
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    turns = turns.withColumns({"place": F.count("*").over(inside), "upto": F.sum("tokens").over(inside)})
    totals = turns.groupBy("conv_id", "block").agg(F.count("*").alias("n"), F.sum("tokens").alias("sum"))
    before = Window.partitionBy("id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("conv_id").alias("id"), F.col("block").alias("at"), "n", "sum")
    totals = totals.select(
        "id", "at", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"), F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("sum")
    )
    same = F.col("conv_id").eqNullSafe(F.col("id")) & F.col("block").eqNullSafe(F.col("at"))
    return turns.join(totals, same).select(
        "conv_id",
        "role",
        "text",
        "tokens",
        (F.col("place") + F.col("n")).alias("place"),
        (F.col("upto") - F.col("tokens") + F.col("sum")).alias("start"),
    )


def windows(
    conversations: DataFrame,
    budget: int = 4096,
    history: int = 512,
    tokens: Callable[[Column], Column] = rough_tokens,
) -> DataFrame:
    """One row per window: conv_id, stride, alone (its place in the conversation), formatted, n_turns, n_repeated (leading
    turns that an earlier window holds), mask (start and length in characters of each target), n_tokens, oversize."""
    if history < 1 or budget <= history:
        raise ValueError("budget must be above history, and history 1 or more")
    turns = _measured(conversations, tokens)
    lead = (F.col("place") == 1) & (F.col("role") == "system")
    system = turns.filter(lead).select(
        F.col("conv_id").alias("id"), F.col("tokens").alias("system_tokens"), F.col("text").alias("system_text")
    )
    turns = turns.join(system, F.col("conv_id").eqNullSafe(F.col("id")), "left").drop("id")
    given = F.coalesce("system_tokens", F.lit(0))
    stride = F.greatest(F.lit(budget - history) - given, F.lit(1))
    body = turns.withColumns({"lead": lead, "start": F.when(lead, 0).otherwise(F.col("start") - given), "length": stride})
    body = body.withColumn("stride", F.floor(F.col("start") / F.col("length")))
    crossing = ~F.col("lead") & (F.col("start") + F.col("tokens") > (F.col("stride") + 1) * F.col("length"))
    body = body.withColumn("alone", crossing.cast("int"))

    key = ["conv_id", "stride", "alone"]
    turn = lambda repeated, place, role, text, n: F.struct(
        place.cast("long").alias("place"), F.lit(repeated).alias("repeated"), role.alias("role"), text.alias("text"), n.alias("tokens")
    )
    new = body.select(*key, turn(False, F.col("place"), F.col("role"), F.col("text"), F.col("tokens")).alias("turn"))
    begun = (
        body.filter(~F.col("lead"))
        .groupBy(*key)
        .agg(F.min("start").alias("begins"), F.first("system_text").alias("system_text"), F.first("system_tokens").alias("system_tokens"))
    )
    leading = begun.filter("system_tokens is not null and not (stride = 0 and alone = 0)").select(
        *key, turn(True, F.lit(1), F.lit("system"), F.col("system_text"), F.col("system_tokens")).alias("turn")
    )
    stretch = F.floor(F.col("start") / history)
    past = body.filter(~F.col("lead")).select(
        F.col("conv_id").alias("id"), "place", "role", "text", "tokens", "start", F.explode(F.array(stretch, stretch + 1)).alias("at")
    )
    near = F.col("conv_id").eqNullSafe(F.col("id")) & (F.floor(F.col("begins") / history) == F.col("at"))
    near &= (F.col("start") < F.col("begins")) & (F.col("begins") - F.col("start") <= history)
    repeated = begun.join(past, near).select(*key, turn(True, F.col("place"), F.col("role"), F.col("text"), F.col("tokens")).alias("turn"))

    held = new.union(leading).union(repeated).groupBy(*key).agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    written = held.withColumn(
        "turns",
        F.transform(
            "turns",
            lambda t: t.withField("head", F.concat(F.lit("<|"), escaped(t["role"]), F.lit("|>"))).withField("text", escaped(t["text"])),
        ),
    )
    empty = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("mask"))

    def step(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(t["head"])
        target = F.array(F.struct(start.alias("start"), F.length(t["text"]).alias("length")))
        masked = F.when((t["role"] == "assistant") & ~t["repeated"], F.concat(state["mask"], target)).otherwise(state["mask"])
        return F.struct((start + F.length(t["text"]) + len(END)).alias("at"), masked.alias("mask"))

    total = F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["tokens"])
    return written.select(
        *key,
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["text"], F.lit(END))), "").alias("formatted"),
        F.size("turns").alias("n_turns"),
        F.size(F.filter("turns", lambda t: t["repeated"])).alias("n_repeated"),
        F.aggregate("turns", empty, step, lambda s: s["mask"]).alias("mask"),
        total.alias("n_tokens"),
        (total > budget).alias("oversize"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``windows`` with ``turns``, the new turns parsed from the formatted text (role, text), and ``targets``, the texts
    under the mask."""
    parts = F.split("formatted", END)

    def parsed(part: Column) -> Column:
        end = F.instr(part, "|>")
        role = F.substr(part, F.lit(3), end - 3)
        return F.struct(unescaped(role).alias("role"), unescaped(F.substr(part, end + 2)).alias("text"))

    fresh = F.slice(parts, F.col("n_repeated") + 1, F.col("n_turns") - F.col("n_repeated"))
    under = lambda m: unescaped(F.substr(F.col("formatted"), m["start"] + 1, m["length"]))
    return formatted.withColumns({"turns": F.transform(fresh, parsed), "targets": F.transform("mask", under)})


def report(formatted: DataFrame) -> DataFrame:
    """Per conversation, from what ``read_back`` finds: turns, targets and their digests."""
    read = read_back(formatted)
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    window = F.struct(
        "stride", "alone", F.array_join(said, "").alias("said"), F.array_join("targets", "").alias("learned")
    )
    grouped = read.groupBy("conv_id").agg(
        F.sum(F.size("turns")).alias("n_turns"),
        F.array_sort(F.collect_list(window)).alias("windows"),
        F.sum(F.length("formatted").cast("long")).alias("formatted_chars"),
    )
    said = F.array_join(F.transform("windows", lambda w: w["said"]), "")
    learned = F.array_join(F.transform("windows", lambda w: w["learned"]), "")
    return grouped.select(
        "conv_id",
        "n_turns",
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
    )
