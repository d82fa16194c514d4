"""Repair of conversation structure: the cheapest edits that make the roles of a conversation well-formed.

Well-formed is ``(s?(ua)+)?``: nothing, or user and assistant in turns after at most one system turn. A turn is kept for 0,
given the role user or assistant for 2, or deleted for 3; a user or assistant turn without text is inserted for 2. A blank turn
and a repeated one (its role and text stood earlier in the conversation) must go; a truncated turn (its last visible character
ends no sentence) that stays adds 1.

All that decides the edits of a conversation is its signature, one symbol per turn: role and fault. The cost-to-go of a turn
depends on the signature from there to the end only, so equal ends are one node of a suffix-sharing automaton. The distinct
signatures of all conversations are sorted by their reversed text over the cluster; neighbours then share their longest ends, and a
task that walks them keeps just the nodes of the current path. Each node gets, for each of the four grammar states, the cost to go
and the first edit of the best audit, once for all conversations (a path that two partitions share, once in each). From one
state every edit leads to one state, so the least audit among equal costs is that of the least first letter, and no audits are
compared.

A long conversation is never one group: turns are sorted by range over the cluster, signatures are put together from the pieces of
partitions, and edits go back to the turns by row number. Only the signature and the audit, a character per turn, are in one
row.

Defined cases: null roles and texts are one space; null turn numbers come first; turns of one number are ordered by role, by the first 64
characters of the text and by its digest; equal rows of one number are repeats; rows with a null conversation id are one conversation; any
role counts by its first character; other columns are ignored; an empty table has no conversations.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepmill.sources.storage import materialize

KEEP, REROLE, DELETE, INSERT = "KRDI"
#: Costs of the edits, and of leaving a truncated turn in.
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED = 1
#: Grammar states: before anything, after system, after user, after assistant.
BEGIN, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
NEXT = [{"s": AFTER_SYSTEM, "u": AFTER_USER}, {"u": AFTER_USER}, {"a": AFTER_ASSISTANT}, {"u": AFTER_USER}]
ENDS = (BEGIN, AFTER_ASSISTANT)
#: The one role among user and assistant that may follow each state.
FOLLOWS = "uuau"
ROLES = {"u": "user", "a": "assistant"}
#: A turn's code: its role (system, user, assistant, other) in each of four blocks (whole, blank, duplicate, truncated).
CODES, INITIALS, SYMBOLS = "ABCDEFGHIJKLMNOP", "suax" * 4, "suaxddddddddSUAX"
WHITE = r"[\x20\x09-\x0D]"
ROW_BITS = 33
BATCH = 1 << 14


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _turns(conversations: DataFrame) -> DataFrame:
    """Every turn with its code, stored in the order of its conversation: ``row`` numbers run without gaps within the part
    of a conversation that a partition holds."""
    space = F.lit(" ")
    whole = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )
    counted = whole.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    counted = counted.withColumn("digest", F.sha2("text", 256))
    number = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
    first = counted.groupBy("conv_id", "role", "digest").agg(F.min(number).alias("first"), F.count("*").alias("times"))
    first = first.filter("times > 1").select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"
    )
    marked = counted.join(first, _same("conv_id", "c") & _same("role", "r") & _same("digest", "d"), "left")
    again = F.coalesce(number > F.col("first"), F.lit(False))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    rows = marked.select("conv_id", "turn", "role", "text", "digest", again.alias("again"), copies)

    seen = F.regexp_replace("text", WHITE, "")
    fault = F.when(seen == "", 1).when(F.col("again") | (F.col("copy") > 1), 2).when(F.substring(seen, -1, 1).rlike("[^.!?]"), 3)
    start = F.substring("role", 1, 1)
    role = F.when(start == "s", 0).when(start == "u", 1).when(start == "a", 2).otherwise(3)
    rows = rows.withColumn("code", F.substring(F.lit(CODES), 4 * F.coalesce(fault, F.lit(0)) + role + 1, F.lit(1)))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", F.substring("text", 1, 64), "digest", "copy"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.select("conv_id", "turn", "role", "text", "code", F.monotonically_increasing_id().alias("row"))
    return materialize(placed, "turns")


def _listed(items: str) -> Column:
    return F.array_sort(F.collect_list(items))


def _signatures(turns: DataFrame) -> DataFrame:
    """Per conversation: its counts, its symbols, and the first row and size of its part in each partition."""
    pieces = turns.groupBy("conv_id", F.shiftright("row", ROW_BITS).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("row", "code"))).alias("held"), F.min("row").alias("row")
    )
    piece = F.struct("row", F.array_join(F.transform("held", lambda x: x["code"]), "").alias("codes")).alias("piece")
    joined = pieces.select("conv_id", piece).groupBy("conv_id").agg(_listed("piece").alias("pieces"))
    codes = F.array_join(F.transform("pieces", lambda p: p["codes"]), "")
    parts = F.transform("pieces", lambda p: F.struct(p["row"].alias("row"), F.length(p["codes"]).cast("long").alias("n")))
    joined = joined.select("conv_id", codes.alias("codes"), parts.alias("parts"))
    of_fault = lambda f: F.regexp_count("codes", F.lit(f"[{CODES[4 * f : 4 * f + 4]}]")).cast("long")
    pairs = F.regexp_count(F.translate("codes", CODES, INITIALS), F.lit("(?=su|ua|au)"))
    joined = joined.select(
        "conv_id",
        "parts",
        F.translate("codes", CODES, SYMBOLS).alias("symbols"),
        *(of_fault(f).alias(name) for f, name in enumerate(("blank", "duplicate", "truncated"), 1)),
        (F.length("codes") - 1 - pairs).cast("long").alias("illegal"),
    )
    numbers = turns.groupBy("conv_id", "turn").agg(F.lit(1)).groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps")
    )
    numbers = numbers.select(F.col("conv_id").alias("c"), F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"))
    return joined.join(numbers, _same("conv_id", "c")).drop("c")


@dataclass(frozen=True)
class Node:
    """A node of the automaton: what the turns from here to the end cost from each state, above ``base``, and the first
    edit of the best audit from each (empty at the end)."""

    base: int
    costs: tuple[int, ...]
    edits: str


def _with_inserts(options: list[list[tuple[int, str]]]) -> tuple[int, tuple[int, ...], str]:
    """(least cost, costs above it, edits) when turns may be inserted before the given options."""
    best = [min(o, default=(1 << 60, DELETE)) for o in options]
    for _ in range(len(best)):  # inserting costs something, so no state is passed twice
        best = [min(best[s], (COST[INSERT] + best[NEXT[s][FOLLOWS[s]]][0], INSERT)) for s in range(4)]
    base = min(cost for cost, _ in best)
    return base, tuple(cost - base for cost, _ in best), "".join(edit or " " for _, edit in best)


END = Node(*_with_inserts([[(0, "")] if s in ENDS else [] for s in range(4)]))


@functools.cache
def _before(symbol: str, costs: tuple[int, ...]) -> tuple[int, tuple[int, ...], str]:
    """The node of a turn ahead of one with these costs. Costs stay within a few units, so there are few distinct cases."""
    stays, role = TRUNCATED if symbol.isupper() else 0, symbol.lower()
    options = [[(COST[DELETE] + costs[s], DELETE)] for s in range(4)]
    if role != "d":
        for s in range(4):
            options[s].append((COST[REROLE] + stays + costs[NEXT[s][FOLLOWS[s]]], REROLE))
            if role in NEXT[s]:
                options[s].append((COST[KEEP] + stays + costs[NEXT[s][role]], KEEP))
    return _with_inserts(options)


def _audit(symbols: str, path: list[Node]) -> str:
    """The edits along a path, whose last node is that of the first turn."""
    out, state, at = [], BEGIN, len(path) - 1
    while (edit := path[at].edits[state]) != " ":
        out.append(edit)
        if edit in (INSERT, REROLE):
            state = NEXT[state][FOLLOWS[state]]
        elif edit == KEEP:
            state = NEXT[state][symbols[len(path) - 1 - at].lower()]
        at -= edit != INSERT
    return "".join(out)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(symbols, cost, audit) of signatures that come in the order of their reversed text."""
    path, held = [END], ""
    for batch in batches:
        out = []
        for symbols in batch.column(0).to_pylist():
            turned = symbols[::-1]
            common = 0
            for a, b in zip(held, turned):  # noqa: B905
                if a != b:
                    break
                common += 1
            del path[common + 1 :]
            for symbol in turned[common:]:
                more, costs, edits = _before(symbol, path[-1].costs)
                path.append(Node(path[-1].base + more, costs, edits))
            held = turned
            out.append((symbols, path[-1].base + path[-1].costs[BEGIN], _audit(symbols, path)))
        schema = pa.schema([("symbols", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in out], schema)


def _planned(signatures: DataFrame) -> DataFrame:
    """(symbols, cost, audit) of every distinct signature."""
    distinct = signatures.select("symbols").distinct().withColumn("turned", F.reverse("symbols"))
    ranged = distinct.repartitionByRange(F.substring("turned", 1, 256)).sortWithinPartitions("turned")
    return ranged.select("symbols").mapInArrow(_walk, "symbols string, cost long, audit string")


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, step, edit, role): the edits of each conversation at its rows, in order; an inserted turn stands at the row that
    follows it, or after the last one."""
    schema = pa.schema([("row", pa.int64()), ("step", pa.int32()), ("edit", pa.string()), ("role", pa.string())])
    out: list[tuple] = []
    for batch in batches:
        for symbols, audit, parts in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            rows = (p["row"] + i for p in parts for i in range(p["n"]))
            row, last, state, at, step = next(rows), None, BEGIN, 0, 0
            for edit in audit:
                moved = edit in (INSERT, REROLE)
                role = FOLLOWS[state] if moved else symbols[at].lower() if edit == KEEP else None
                out.append((row if row is not None else last, step, edit, ROLES[role] if moved else None))
                state = NEXT[state][role] if role else state
                step += 1
                if edit != INSERT:
                    last, at, row = row, at + 1, next(rows, None)
                    step = 0 if row is not None else step
                if len(out) >= BATCH:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in out], schema)
                    out = []
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in out], schema)
            out = []


@dataclass
class Repaired:
    """``conversations``: conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of each conversation.
    ``turns``: conv_id, row, step (the order within a conversation), edit, role and text of every edit, deleted turns included."""

    conversations: DataFrame
    turns: DataFrame


def repair(conversations: DataFrame) -> Repaired:
    """The cheapest edits of each conversation (conv_id, turn, role, text), and its turns after them."""
    turns = _turns(conversations)
    signatures = materialize(_signatures(turns), "signatures")
    planned = _planned(signatures).withColumnRenamed("symbols", "of")
    planned = materialize(signatures.join(planned, F.col("symbols") == F.col("of")).drop("of"), "planned")
    edits = planned.select("symbols", "audit", "parts").mapInArrow(_edits, "at long, step int, edit string, new_role string")
    inserted = F.col("edit") == INSERT
    applied = edits.join(turns, F.col("at") == F.col("row")).select(
        "conv_id",
        "row",
        "step",
        "edit",
        F.coalesce("new_role", "role").alias("role"),
        F.when(inserted, "").otherwise(F.col("text")).alias("text"),
    )
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return Repaired(planned.select("conv_id", *counts, "audit"), applied)


def report(conversations: DataFrame, repaired: Repaired) -> DataFrame:
    """Per conversation of ``conversations``, what ``repaired`` has of it and a digest of the turns that are left. Turns are put
    together by the partition they were sorted to, then by conversation; the digest needs the latter in one row."""
    line = F.struct("row", "step", F.concat("role", F.lit(":"), "text").alias("line"))
    kept = repaired.turns.filter(F.col("edit") != DELETE)
    pieces = kept.groupBy("conv_id", F.shiftright("row", ROW_BITS).alias("part")).agg(F.array_sort(F.collect_list(line)).alias("held"))
    piece = F.struct("part", F.array_join(F.transform("held", lambda x: x["line"]), "\n").alias("said"))
    said = pieces.select("conv_id", piece.alias("piece")).groupBy("conv_id").agg(_listed("piece").alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda p: p["said"]), "\n")
    said = said.select(F.col("conv_id").alias("said_id"), F.sha2(text, 256).alias("said"))
    found = repaired.conversations.withColumnRenamed("conv_id", "found_id")
    every = conversations.select("conv_id").distinct().join(found, _same("conv_id", "found_id"), "left")
    every = every.join(said, _same("conv_id", "said_id"), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("said", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults that the checksum of ``conv_id:turn`` decides: of 20 remainders, 0 drops the turn, 1
    empties its text, 2 takes out its ends of sentences, 3 repeats it, 4 makes it the user's. Nulls are one space, but stay null as
    id or number."""
    space = F.lit(" ")
    written = lambda c: F.coalesce(F.col(c).cast("string"), space)
    case = F.pmod(F.crc32(F.concat(written("conv_id"), F.lit(":"), written("turn"))), F.lit(20))
    text = F.when(case == 1, "").when(case == 2, F.regexp_replace(written("text"), "[.!?]", "")).otherwise(written("text"))
    turns = conversations.filter(case != 0).select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(case == 4, "user").otherwise(written("role")).alias("role"),
        text.alias("text"),
        F.when(case == 3, 2).otherwise(1).alias("times"),
    )
    return turns.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), "times")).alias("n")).drop("n")
