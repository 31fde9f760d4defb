"""Cheapest repair of damaged conversations.

1. Rows are damaged by a checksum of ``conv_id:turn``, put in order of turn, and
   each is given its first fault.
2. Every edit of a row has one whole number as weight: high digits are its cost,
   then comes one slot of fixed width per row for the audit letters of that row
   (up to two inserts before it, then its own edit), padded with zeros at the
   end. A slot always ends in the row's own letter, so no slot is the beginning
   of another, and comparing padded slots is comparing the audits. Weights add
   up along a path, and the smallest sum over the graph of (row, state) is the
   cheapest repair with the least audit. The audit is read back from its digits.
3. A conversation of any length is cut into segments of ``SEGMENT`` rows. Each
   gives the smallest weight from every state to every state. Over segments the
   same sum of whole numbers decides, with the rank of a segment's audit among
   its sixteen as its digit; then each segment writes its part of the repair.

States: nothing yet; after system; after user; after assistant. The first and
the last may end. Letters determine roles, so the audit determines the text.

Rows are dealt out by ranges of (conversation, turn), so no task holds a whole
long conversation; only its small segment weights meet, and the final digest
reads the repaired text in order, batch by batch, as a digest has to.

Defined results: null role or text is one space; a null turn sorts first and is
one space in the checksum's key, as is a null conv_id, whose rows are one
conversation (the largest bigint counts as null); rows of one turn are in order
of role, then of the text's hash; repeated rows are rows of their own; a role
counts by its first character, and one that is neither s, u nor a cannot be
kept; empty input gives no row; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby, islice
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikepath.llm.common import pick, slices, stored

SEGMENT = 4096
LAST = (1 << 63) - 1

# Costs of the edits.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Faults of a row.
NONE, GONE, CUT_OFF = 0, 1, 2
#: Bits of a letter; letters are numbered in ASCII order from 1, so that 0 is padding.
BITS = 3
LETTERS = "DIKR"
SLOT = 3
START, SYSTEM, USER, ASSISTANT = range(4)
_NAMES = {USER: "user", ASSISTANT: "assistant"}
#: The state after a role's initial, from each state that allows it.
_AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: What inserts must follow at the end, from each state.
_ENDING = {START: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}
SPACE = " \t\n\x0b\x0c\r"


def _next(state: int) -> int:
    """The state after a user or an assistant turn, whichever may come."""
    return ASSISTANT if state == USER else USER


def _code(letters: str) -> int:
    """A slot's digits: its letters from the left, zeros at the end."""
    out = 0
    for k in range(SLOT):
        out = (out << BITS) | (LETTERS.index(letters[k]) + 1 if k < len(letters) else 0)
    return out


def _edits(initial: str, fault: int) -> list[list[tuple[int, int, int]]]:
    """From each state the edits of one row, as (next state, cost, slot)."""
    out: list[list[tuple[int, int, int]]] = []
    for state in range(4):
        best: dict[int, tuple[int, int]] = {}
        at, before = state, ""
        for _ in range(SLOT):
            own = [(at, DELETE, "D")]
            if fault != GONE:
                more = TRUNCATED if fault == CUT_OFF else 0
                own.append((_next(at), REROLE + more, "R"))
                if at in _AFTER.get(initial, {}):
                    own.append((_AFTER[initial][at], KEEP + more, "K"))
            for to, cost, letter in own:
                found = (INSERT * len(before) + cost, _code(before + letter))
                best[to] = min(best.get(to, found), found)
            at, before = _next(at), before + "I"
        out.append([(to, cost, code) for to, (cost, code) in best.items()])
    return out


_ROWS = {(i, f): _edits(i, f) for i in ("s", "u", "a", "") for f in (NONE, GONE, CUT_OFF)}


def _kind(role: str, fault: int) -> list[list[tuple[int, int, int]]]:
    return _ROWS[role[:1] if role[:1] in _AFTER else "", fault]


def paths(rows: list[list[list[tuple[int, int, int]]]], width: int, start: int) -> list[int | None]:
    """The smallest weight from a state to every state; a row's digits have ``width`` bits."""
    high = width * len(rows)
    weights: list[int | None] = [None] * 4
    weights[start] = 0
    for k, edits in enumerate(rows, 1):
        new: list[int | None] = [None] * 4
        low = high - width * k
        for state, weight in enumerate(weights):
            if weight is not None:
                for to, cost, digits in edits[state]:
                    total = weight + (cost << high) + (digits << low)
                    if new[to] is None or total < new[to]:
                        new[to] = total
        weights = new
    return weights


def _digits(weight: int, n: int, width: int) -> list[int]:
    """The n low digits of a weight, most significant first."""
    low = weight & ((1 << (width * n)) - 1)
    data = low.to_bytes(-(-width * n // 8), "big")
    bits = bin(int.from_bytes(data, "big"))[2:].zfill(width * n)
    return [int(bits[k * width : (k + 1) * width], 2) for k in range(n)]


def _letters(slot: int) -> str:
    parts = [(slot >> (BITS * (SLOT - 1 - k))) & ((1 << BITS) - 1) for k in range(SLOT)]
    return "".join(LETTERS[x - 1] for x in parts if x)


def slots(roles: list[str], faults: list[int], start: int, end: int) -> list[str]:
    """The letters of every row on the cheapest path between two states."""
    n = len(roles)
    weight = paths([_kind(r, f) for r, f in zip(roles, faults, strict=True)], BITS * SLOT, start)[end]
    return [_letters(x) for x in _digits(weight, n, BITS * SLOT)]


def segment(roles: list[str], faults: list[int]) -> tuple[list[int | None], list[int | None]]:
    """Costs from every state to every state, and the ranks of the audits among them."""
    n = len(roles)
    rows = [_kind(r, f) for r, f in zip(roles, faults, strict=True)]
    high = BITS * SLOT * n
    weights = [w for state in range(4) for w in paths(rows, BITS * SLOT, state)]
    low = [None if w is None else w & ((1 << high) - 1) for w in weights]
    order = {x: k for k, x in enumerate(sorted({x for x in low if x is not None}))}
    return [None if w is None else w >> high for w in weights], [None if x is None else order[x] for x in low]


def through(segments: list[tuple[list[int | None], list[int | None]]]) -> tuple[int, list[tuple[int, int]]]:
    """The whole cost of the cheapest repair, and the states that it enters and leaves each segment in."""
    graph = [
        [[(to, costs[4 * s + to], ranks[4 * s + to]) for to in range(4) if costs[4 * s + to] is not None] for s in range(4)] for costs, ranks in segments
    ]
    width, n = 4, len(graph)
    weights = paths(graph, width, START)
    total, end = min((w + ((INSERT * _ENDING[s]) << (width * n)), s) for s, w in enumerate(weights) if w is not None)
    at, out = START, []
    for edits, rank in zip(graph, _digits(weights[end], n, width), strict=True):
        to = next(t for t, _, r in edits[at] if r == rank)
        out.append((at, to))
        at = to
    return total >> (width * n), out


def repaired(roles: list[str], texts: list[str], faults: list[int], start: int, end: int, last: bool) -> tuple[str, list[str]]:
    """A segment's part of the audit and its repaired rows; the last one's ends with the inserts that must follow."""
    audit, lines, at = [], [], start
    found = slots(roles, faults, start, end) + (["I" * _ENDING[end]] if last else [])
    for k, letters in enumerate(found):
        for letter in letters:
            if letter == "I":
                at = _next(at)
                lines.append(f"{_NAMES[at]}:")
            elif letter == "R":
                at = _next(at)
                lines.append(f"{_NAMES[at]}:{texts[k]}")
            elif letter == "K":
                at = _AFTER[roles[k][:1]][at]
                lines.append(f"{roles[k]}:{texts[k]}")
        audit.append(letters)
    return "".join(audit), lines


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
    for batch in slices(batches):
        yield from batch.to_pylist()


def _batched(rows: Iterator[dict[str, Any]], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    held: list[dict[str, Any]] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_SEGMENTS = pa.schema(
    [(c, pa.int64()) for c in ("at", "part", "seg", "illegal")]
    + [("first", pa.string()), ("last", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("faults", pa.list_(pa.int32()))]
    + [("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int64()))]
)
_CHOSEN = pa.schema([(c, pa.int64()) for c in ("at", "part", "seg", "enter", "leave", "cost", "illegal", "ends")])
_PIECES = pa.schema([("at", pa.int64()), ("part", pa.int64()), ("seg", pa.int64()), ("audit", pa.string()), ("lines", pa.list_(pa.string()))])
_REPAIRS = pa.schema([("at", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
_LEGAL = {"su", "ua", "au"}


def _segments(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows in order to segments; copies of a row stand side by side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def copies() -> Iterator[tuple[int, str, str, int]]:
            for row in _records(batches):
                for k in range(row["copies"]):
                    yield row["at"], row["role"], row["text"], GONE if k else row["fault"]

        def built() -> Iterator[dict[str, Any]]:
            seg = 0
            for at, rows in groupby(copies(), key=lambda r: r[0]):
                while own := list(islice(rows, size)):
                    roles, faults = [r[1] for r in own], [r[3] for r in own]
                    initials = [r[:1] for r in roles]
                    costs, ranks = segment(roles, faults)
                    yield {
                        "at": at, "part": part, "seg": seg, "illegal": sum(x + y not in _LEGAL for x, y in zip(initials, initials[1:])),
                        "first": initials[0], "last": initials[-1], "roles": roles, "texts": [r[2] for r in own], "faults": faults, "costs": costs, "ranks": ranks,
                    }
                    seg += 1

        return _batched(built(), _SEGMENTS)

    return run


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def built() -> Iterator[dict[str, Any]]:
        for at, rows in groupby(_records(batches), key=lambda r: r["at"]):
            own = list(rows)
            cost, states = through([(r["costs"], r["ranks"]) for r in own])
            illegal = sum(r["illegal"] for r in own) + sum(x["last"] + y["first"] not in _LEGAL for x, y in zip(own, own[1:]))
            for k, (row, (enter, leave)) in enumerate(zip(own, states, strict=True)):
                yield {"at": at, "part": row["part"], "seg": row["seg"], "enter": enter, "leave": leave, "cost": cost, "illegal": illegal, "ends": int(k == len(own) - 1)}

    return _batched(built(), _CHOSEN)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def built() -> Iterator[dict[str, Any]]:
        for r in _records(batches):
            audit, lines = repaired(r["roles"], r["texts"], r["faults"], r["enter"], r["leave"], bool(r["ends"]))
            yield {"at": r["at"], "part": r["part"], "seg": r["seg"], "audit": audit, "lines": lines}

    return _batched(built(), _PIECES)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def built() -> Iterator[dict[str, Any]]:
        for at, rows in groupby(_records(batches), key=lambda r: r["at"]):
            audit, digest, any_line = [], hashlib.sha256(), False
            for r in rows:
                audit.append(r["audit"])
                for line in r["lines"]:
                    digest.update((b"\n" if any_line else b"") + line.encode("utf-8", "surrogatepass"))
                    any_line = True
            yield {"at": at, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

    return _batched(built(), _REPAIRS)


def damaged(conversations: DataFrame) -> DataFrame:
    """(at, turn, role, text, copies, place): the rows after damage; equal rows of one turn are counted, not repeated."""
    rows = pick(conversations, {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"})
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = rows.select(F.coalesce("conv_id", F.lit(LAST)).alias("at"), "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("harm"))
    rows = rows.groupBy("at", "turn", "role", "text", "harm").agg(F.count("*").alias("n")).where("harm <> 0")
    return rows.select(
        "at",
        "turn",
        F.when(F.col("harm") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, F.lit("")).when(F.col("harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("harm") == 3, F.col("n") * 2).otherwise(F.col("n")).alias("copies"),
        # Its place in the conversation.
        F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"), "role", F.sha2("text", 256).alias("hash")).alias("place"),
    )


def faulty(rows: DataFrame) -> DataFrame:
    """Damaged rows with ``fault``, and how many of their copies count as blank, duplicate and truncated."""
    rows = rows.withColumn("digest", F.sha2(F.concat(F.sha2("role", 256), F.col("text")), 256))
    # Stored, so that the join has exchanges of its own.
    repeated = stored(rows.groupBy("at", "digest").agg(F.min("place").alias("earliest"), F.count("*").alias("n")).where("n > 1").drop("n"), "repair-repeated")
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    blank = F.length(bare) == 0
    seen = F.coalesce(F.col("earliest") < F.col("place"), F.lit(False))
    cut_off = ~F.substring(bare, -1, 1).isin(".", "!", "?")
    first = F.when(blank, "blank").when(seen, "duplicate").when(cut_off, "truncated")
    rows = rows.join(repeated, ["at", "digest"], "left").withColumn("first_fault", first)
    return rows.select(
        "at", "turn", "role", "text", "copies", "place",
        F.when(F.col("first_fault").isin("blank", "duplicate"), GONE).when(F.col("first_fault") == "truncated", CUT_OFF).otherwise(NONE).alias("fault"),
        F.when(F.col("first_fault") == "blank", F.col("copies")).otherwise(0).alias("blank"),
        F.when(F.col("first_fault") == "blank", 0).when(F.col("first_fault") == "duplicate", F.col("copies")).otherwise(F.col("copies") - 1).alias("duplicate"),
        (F.col("first_fault") == "truncated").cast("bigint").alias("truncated"),
    )


def repair(conversations: DataFrame) -> DataFrame:
    """Per conversation its counts of faults, the cost and audit of its cheapest repair, and the repaired text's digest."""
    marked = stored(faulty(damaged(conversations)), "repair-rows")
    counts = marked.groupBy("at").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("blank", "duplicate")],
        F.sum("truncated").alias("truncated"),
    )
    ordered = marked.select("at", "place", "role", "text", "copies", "fault").repartitionByRange("at", "place").sortWithinPartitions("at", "place")
    segments = stored(ordered.drop("place").mapInArrow(_segments(SEGMENT), _sql(_SEGMENTS)), "repair-segments")
    light = segments.select("at", "part", "seg", "illegal", "first", "last", "costs", "ranks")
    chosen = stored(_in_order(light).mapInArrow(_chosen, _sql(_CHOSEN)), "repair-chosen")
    asked = segments.select("at", "part", "seg", "roles", "texts", "faults").join(chosen.select("at", "part", "seg", "enter", "leave", "ends"), ["at", "part", "seg"])
    pieces = asked.mapInArrow(_pieces, _sql(_PIECES))
    texts = _in_order(pieces).mapInArrow(_digested, _sql(_REPAIRS))
    costs = chosen.where("ends = 1").select("at", "illegal", "cost")
    every = pick(conversations, {"conv_id": "bigint"}).select(F.coalesce("conv_id", F.lit(LAST)).alias("at")).distinct()
    out = every.join(counts, "at", "left").join(costs, "at", "left").join(texts, "at", "left")
    return out.select(
        F.when(F.col("at") < LAST, F.col("at")).alias("conv_id"),
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _in_order(segments: DataFrame) -> DataFrame:
    return segments.repartition("at").sortWithinPartitions("at", "part", "seg")


def _sql(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "bigint", pa.string(): "string", pa.list_(pa.string()): "array<string>", pa.list_(pa.int32()): "array<int>", pa.list_(pa.int64()): "array<bigint>"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)
