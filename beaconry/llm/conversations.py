"""Repair of conversations: which rows to keep, rename, delete or add so that the speakers alternate, at least cost.

Hirschberg's divide and conquer over a machine of four states. A cost vector goes forward from the start of a stretch
of rows and another backward from its end; where they meet, the crossing state of least cost is taken, of several the
one whose edits read first in ASCII order, and both halves go on by themselves. The forward vector carries, beside
the costs, the order of its states' best edits, so the choice needs no text of edits. Long conversations are cut into
blocks: a block is one unit with a cost and an order for each pair of states, units combine like rows, and the same
search gives each block its first and last state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from beaconry.llm.store import materialise

# White space, the marks that end a sentence, costs, legal neighbours.
STRIPPED = " \t\n\x0b\x0c\r"
ENDS = ".!?"
RENAMED, DELETED, INSERTED, CUT = 1, 2, 5, 5
LEGAL = ("su", "ua", "au")
# States: nothing yet, after a system row, after a user row, after an assistant row.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
SPOKEN = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
NEVER = 1 << 50
# Rows and bytes of text that a block holds at most (one row may be larger).
BLOCK_ROWS, BLOCK_BYTES = 4096, 4 << 20


class Unit(NamedTuple):
    """Costs from each state to each, and for each first state the order of the edits that lead to the others."""

    costs: tuple[int, ...]
    order: tuple[int, ...]


# What may stand before a row of a conversation that is cut to pieces: at most two inserted rows help.
_INSERTS = [[(state, "", 0)] for state in range(4)]
for _found in _INSERTS:
    for _ in range(2):
        _at, _edits, _cost = _found[-1]
        _found.append((SPOKEN[_at], _edits + "I", _cost + INSERTED))


@lru_cache(maxsize=None)
def row_edits(code: str) -> dict[tuple[int, int], tuple[int, str]]:
    """Cost and edits of the best way from a state to another over one row.

    ``code``: the role's initial, ``-`` for one that can't stay, upper case or ``_`` for truncated text, ``x`` for a
    row that must go.
    """
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start in range(4):
        for at, edits, cost in _INSERTS[start]:
            ways = [(at, cost + DELETED, edits + "D")]
            if code != "x":
                extra = CUT if code.isupper() or code == "_" else 0
                ways.append((SPOKEN[at], cost + RENAMED + extra, edits + "R"))
                if code.lower() in KEPT[at]:
                    ways.append((KEPT[at][code.lower()], cost + extra, edits + "K"))
            for end, total, done in ways:
                best[start, end] = min(best.get((start, end), (total, done)), (total, done))
    return best


@lru_cache(maxsize=None)
def row_unit(code: str) -> Unit:
    best = row_edits(code)
    costs, order = [], []
    for start in range(4):
        told = sorted((best[start, end][1], end) for end in range(4) if (start, end) in best)
        place = {end: i for i, (_, end) in enumerate(told)}
        costs += [best.get((start, end), (NEVER, ""))[0] for end in range(4)]
        order += [place.get(end, 9) for end in range(4)]
    return Unit(tuple(costs), tuple(order))


@lru_cache(maxsize=1 << 16)
def _ahead(costs: tuple[int, ...], order: tuple[int, ...], unit: Unit) -> tuple[int, tuple[int, ...], tuple[int, ...]]:
    """The forward vector after one more unit, its least cost apart so that few vectors ever occur."""
    found = {}
    for end in range(4):
        ways = [
            (costs[s] + unit.costs[4 * s + end], order[s], unit.order[4 * s + end])
            for s in range(4) if costs[s] < NEVER and unit.costs[4 * s + end] < NEVER
        ]
        if ways:
            found[end] = min(ways)
    least = min(way[0] for way in found.values())
    place = {end: i for i, end in enumerate(sorted(found, key=lambda end: found[end][1:]))}
    return (
        least, tuple(found[end][0] - least if end in found else NEVER for end in range(4)),
        tuple(place.get(end, 9) for end in range(4)),
    )


@lru_cache(maxsize=1 << 16)
def _back(costs: tuple[int, ...], unit: Unit) -> tuple[int, tuple[int, ...]]:
    """The backward vector before one more unit."""
    ways = [min(unit.costs[4 * s + end] + costs[end] for end in range(4)) for s in range(4)]
    least = min(ways)
    return least, tuple(w - least if w < NEVER else NEVER for w in ways)


def _only(state: int) -> tuple[int, ...]:
    return tuple(0 if s == state else NEVER for s in range(4))


def forward(units: Iterable[Unit], start: int) -> tuple[int, tuple[int, ...], tuple[int, ...]]:
    total, costs, order = 0, _only(start), (0,) * 4
    for unit in units:
        least, costs, order = _ahead(costs, order, unit)
        total += least
    return total, costs, order


def backward(units: Sequence[Unit], end: int) -> tuple[int, ...]:
    costs = _only(end)
    for unit in reversed(units):
        _, costs = _back(costs, unit)
    return costs


def combined(units: Sequence[Unit]) -> Unit:
    """The unit that several adjacent units are together."""
    costs, order = [], []
    for start in range(4):
        total, vector, places = forward(units, start)
        costs += [total + c if c < NEVER else NEVER for c in vector]
        order += places
    return Unit(tuple(costs), tuple(order))


# What completes a conversation: its last speaker is the assistant, or it is empty.
_CLOSING = {EMPTY: (0, ""), SYSTEM: (2 * INSERTED, "II"), USER: (INSERTED, "I"), ASSISTANT: (0, "")}


def last_state(units: Sequence[Unit], start: int = EMPTY) -> int:
    """The state behind the last unit, before the rows that complete the conversation."""
    _, costs, order = forward(units, start)
    return min(range(4), key=lambda s: (costs[s] + _CLOSING[s][0], order[s]))


def states_after(units: Sequence[Unit], start: int, end: int) -> list[int]:
    """The state behind each unit on the best way from ``start`` to ``end``."""
    if len(units) < 2:
        return [end] * len(units)
    left, right = units[: len(units) // 2], units[len(units) // 2 :]
    _, ahead, order = forward(left, start)
    behind = backward(right, end)
    middle = min(range(4), key=lambda s: (ahead[s] + behind[s], order[s]))
    return states_after(left, start, middle) + states_after(right, middle, end)


def mend(codes: str, roles: Sequence[str], texts: Sequence[str], start: int, end: int, last: bool) -> tuple[str, int, list[str], list[str]]:
    """Edits, cost, roles and texts of a stretch of rows between two states, with its completion where it is the last."""
    edits, cost, said, told, at = [], 0, [], [], start

    def speak(text: str) -> None:
        nonlocal at
        at = SPOKEN[at]
        said.append(NAMES[at])
        told.append(text)

    units = [row_unit(c) for c in codes]
    for code, role, text, then in zip(codes, roles, texts, states_after(units, start, end), strict=True):
        price, done = row_edits(code)[at, then]
        cost += price
        edits.append(done)
        for edit in done:
            if edit == "I":
                speak("")
            elif edit == "R":
                speak(text)
            elif edit == "K":
                said.append(role)
                told.append(text)
        at = then
    if last:
        price, done = _CLOSING[at]
        cost += price
        edits.append(done)
        for _ in done:
            speak("")
    return "".join(edits), cost, said, told


def _code(role: str, cut: bool) -> str:
    first = role[:1] if role[:1] in ("s", "u", "a") else "-"
    return (first.upper() if first != "-" else "_") if cut else first


def _blocks_schema(conv: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("conv_id", conv),
        *T.StructType.fromDDL(
            "part int, run int, block int, alone boolean, roles array<string>, texts array<string>, codes string, blank bigint, illegal bigint, "
            "first_role string, last_role string, first_turn bigint, last_turn bigint, turns bigint, firsts array<struct<pos:int,h1:bigint,h2:bigint>>"
        ).fields,
    ])


class _Block:
    """Rows of one conversation that follow each other."""

    def __init__(self, conv, run: int, number: int):
        self.conv, self.run, self.number = conv, run, number
        self.roles, self.texts, self.codes, self.firsts = [], [], [], []
        self.blank = self.illegal = self.turns = self.bytes = 0
        self.first_turn = self.last_turn = None
        self.seen: set[tuple[str, str]] = set()

    def add(self, turn, role: str, text: str, blank: bool, cut: bool, h1: int, h2: int) -> None:
        if self.roles and self.roles[-1][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        code = "x"
        if blank:
            self.blank += 1
        elif (role, text) not in self.seen:
            self.seen.add((role, text))
            self.firsts.append({"pos": len(self.roles), "h1": h1, "h2": h2})
            code = _code(role, cut)
        if turn is not None:
            self.turns += turn != self.last_turn
            self.last_turn = turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
        self.roles.append(role)
        self.texts.append(text)
        self.codes.append(code)
        self.bytes += len(text)

    def row(self, part: int, alone: bool) -> dict:
        return {
            "conv_id": self.conv, "part": part, "run": self.run, "block": self.number, "alone": alone, "roles": self.roles,
            "texts": self.texts, "codes": "".join(self.codes), "blank": self.blank, "illegal": self.illegal,
            "first_role": self.roles[0][:1], "last_role": self.roles[-1][:1], "first_turn": self.first_turn,
            "last_turn": self.last_turn, "turns": self.turns, "firsts": None if alone else self.firsts,
        }


def _written(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of a few thousand rows of conversations at most."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 1 + len(row.get("texts") or ()) + sum(map(len, row.get("texts") or ())) // 1024
        if size >= BLOCK_ROWS:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _cutter(schema: T.StructType, most_rows: int, most_bytes: int) -> Callable:
    """Sorted rows to blocks. A block is alone if its conversation surely has no rows in another block or partition."""

    def blocks(batches: Iterable[pa.RecordBatch], part: int) -> Iterator[dict]:
        block, first, number = None, True, 0
        for batch in batches:
            for conv, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block and (conv != block.conv or len(block.roles) >= most_rows or block.bytes + len(row[2]) > most_bytes):
                    same = conv == block.conv
                    yield block.row(part, not (first or same or block.run != block.number))
                    first = first and same
                    number += 1
                    block = _Block(conv, block.run if same else number, number)
                if block is None:
                    block = _Block(conv, 0, 0)
                block.add(*row)
        if block:
            yield block.row(part, False)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _written(blocks(batches, TaskContext.get().partitionId()), _arrow(schema))

    return cut


def _mapped(df: DataFrame, work: Callable[[dict], Iterable[dict]], schema: T.StructType) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _written((out for batch in batches for row in batch.to_pylist() for out in work(row)), _arrow(schema))

    return df.mapInArrow(run, schema)


def _summarise(row: dict) -> Iterable[dict]:
    codes = list(row["codes"])
    for pos in row["later"] or ():
        codes[pos] = "x"
    unit = combined([row_unit(c) for c in codes])
    kept = {k: row[k] for k in ("conv_id", "part", "run", "block")}
    return [kept | {"final": "".join(codes), "costs": list(unit.costs), "order": list(unit.order)}]


def _units(items: list[dict]) -> list[Unit]:
    return [Unit(tuple(i["costs"]), tuple(i["order"])) for i in items]


def _fold(row: dict) -> Iterable[dict]:
    unit = combined(_units(row["items"]))
    return [{k: row[k] for k in ("conv_id", "part", "run")} | {"costs": list(unit.costs), "order": list(unit.order)}]


def _assign(row: dict) -> Iterable[dict]:
    """First and last state of each item between those of the row; a row without states is a whole conversation."""
    units = _units(row["items"])
    start = row.get("enters") or EMPTY
    end = last_state(units, start) if row.get("leaves") is None else row["leaves"]
    final = row.get("last", True)
    after = states_after(units, start, end)
    for i, (item, enters, leaves) in enumerate(zip(row["items"], [start, *after], after)):
        place = {k: item[k] for k in ("part", "run", "block") if k in item}
        yield place | {"enters": enters, "leaves": leaves, "last": final and i == len(units) - 1}


def _list(*columns: str) -> Column:
    return F.sort_array(F.collect_list(F.struct(*columns))).alias("items")


def plan_repair(conversations: DataFrame, most_rows: int = BLOCK_ROWS, most_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of conversations (conv_id, turn, role, text) in blocks, each with its first and last state.

    Rows follow each other by turn (null first), rows of one turn by role and then by the md5 of their text. A null
    role or text is one space; rows without conv_id are one conversation. Other columns are not looked at. No rows
    give no blocks.

    A sort by range puts neighbours together and parts a conversation of any length, equal rows included, among many
    tasks. Only blocks that may share their conversation with another block are ever joined or grouped, as hashes or
    as 32 numbers a block: at most a partition's blocks, and then at most one row a partition, meet in one row.
    """
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    slim = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    bare = F.btrim("text", F.lit(STRIPPED))
    rows = slim.withColumns({
        "blank": bare == "", "cut": ~F.substring(bare, -1, 1).isin(*ENDS), "h1": F.xxhash64("role", "text"),
        "h2": F.xxhash64(F.lit("second"), "text", "role"), "digest": F.md5("text"), "at": F.monotonically_increasing_id(),
    })
    order = ["conv_id", "turn", "role", "digest", "at"]
    schema = _blocks_schema(conversations.schema["conv_id"].dataType)
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("digest", "at")
    blocks = materialise(placed.mapInArrow(_cutter(schema, most_rows, most_bytes), schema), "conversation-blocks")

    conv, field = T.StructField("conv_id", schema["conv_id"].dataType), T.StructType.fromDDL
    shared = blocks.where(~F.col("alone"))
    key = Window.partitionBy("conv_id", "h1", "h2").orderBy("part", "block")
    seen = shared.select("conv_id", "part", "block", F.explode("firsts").alias("f")).select("conv_id", "part", "block", "f.*")
    later = seen.withColumn("_nth", F.row_number().over(key)).where("_nth > 1").groupBy("part", "block").agg(F.collect_list("pos").alias("later"))
    coded = shared.select("conv_id", "part", "run", "block", "codes").join(later, ["part", "block"], "left")
    numbers = "costs array<bigint>, order array<int>"
    units = materialise(
        _mapped(coded, _summarise, T.StructType([conv, *field(f"part int, run int, block int, final string, {numbers}").fields])), "conversation-units"
    )
    runs = units.groupBy("conv_id", "part", "run").agg(_list("block", "costs", "order"))
    states = "enters int, leaves int, last boolean"
    whole = _mapped(runs, _fold, T.StructType([conv, *field(f"part int, run int, {numbers}").fields]))
    tops = _mapped(whole.groupBy("conv_id").agg(_list("part", "run", "costs", "order")), _assign, field(f"part int, run int, {states}"))
    inner = runs.withColumn("items", F.transform("items", lambda i: F.struct("part", i["block"].alias("block"), i["costs"].alias("costs"), i["order"].alias("order"))))
    ends = _mapped(inner.join(tops, ["part", "run"]), _assign, field(f"part int, block int, {states}"))
    found = ends.join(units.select("part", "block", "final"), ["part", "block"])
    names = [c for c in blocks.columns if c != "firsts"]
    closed = blocks.where("alone").select(*names, F.col("codes").alias("final"), F.lit(EMPTY).alias("enters"), F.lit(None).cast("int").alias("leaves"), F.lit(True).alias("last"))
    return closed.unionByName(shared.select(*names).join(found, ["part", "block"]))


def _repair(row: dict) -> Iterable[dict]:
    codes, leaves = row["final"], row["leaves"]
    if leaves is None:
        leaves = last_state([row_unit(c) for c in codes])
    audit, cost, roles, texts = mend(codes, row["roles"], row["texts"], row["enters"], leaves, row["last"])
    cut = sum(c.isupper() or c == "_" for c in codes)
    kept = ("conv_id", "part", "block", "alone", "blank", "illegal", "first_role", "last_role", "first_turn", "last_turn", "turns")
    return [{k: row[k] for k in kept} | {
        "duplicate": codes.count("x") - row["blank"], "truncated": cut, "audit": audit, "cost": cost, "roles": roles, "texts": texts,
    }]


def repair(blocks: DataFrame) -> DataFrame:
    """The blocks of :func:`plan_repair` after repair: edits (audit), cost, the roles and texts that stay, faults by kind."""
    schema = T.StructType([
        blocks.schema["conv_id"],
        *T.StructType.fromDDL(
            "part int, block int, alone boolean, blank bigint, illegal bigint, first_role string, last_role string, first_turn bigint, "
            "last_turn bigint, turns bigint, duplicate bigint, truncated bigint, audit string, cost bigint, roles array<string>, texts array<string>"
        ).fields,
    ])
    return _mapped(blocks, _repair, schema)


def messages(repaired: DataFrame) -> DataFrame:
    """One row per message that stays or is added: conv_id, its place (part, block, pos), role, text."""
    both = F.arrays_zip("roles", "texts")
    rows = repaired.select("conv_id", "part", "block", F.posexplode(both).alias("pos", "m"))
    return rows.select("conv_id", "part", "block", "pos", F.col("m.roles").alias("role"), F.col("m.texts").alias("text"))


def _lines(row: dict) -> bytes:
    return "\n".join([f"{r}:{t}" for r, t in zip(row["roles"], row["texts"], strict=True)]).encode("utf-8", "replace")


def _digested(row: dict) -> Iterable[dict]:
    return [{k: v for k, v in row.items() if k not in ("roles", "texts")} | {"repaired_sha256": hashlib.sha256(_lines(row)).hexdigest()}]


def _stream_digests(schema: pa.Schema) -> Callable:
    """sha256 of conversations whose blocks follow each other; a digest takes its bytes in order, one block at a time."""

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        conv, state, begun, some = None, hashlib.sha256(), False, False
        for batch in batches:
            for row in batch.to_pylist():
                if some and row["conv_id"] != conv:
                    yield {"conv_id": conv, "repaired_sha256": state.hexdigest()}
                    state, begun = hashlib.sha256(), False
                conv, some = row["conv_id"], True
                if row["roles"]:
                    state.update((b"\n" if begun else b"") + _lines(row))
                    begun = True
        if some:
            yield {"conv_id": conv, "repaired_sha256": state.hexdigest()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _written(digests(batches), schema)

    return run


def report(blocks: DataFrame) -> DataFrame:
    """One row per conversation of the blocks of :func:`plan_repair`.

    conv_id; gaps (turn numbers missing between the first and the last), blank, duplicate, truncated (rows by first
    fault), illegal (neighbours that may not follow each other), cost, audit (the edits), repaired_sha256 (of the
    repaired ``role:text`` lines). A digest has to take its bytes in order, so the blocks of one long conversation
    stream through one task, sorted, one block at a time; nothing else of it meets there.
    """
    conv = blocks.schema["conv_id"]
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps")
    alone = repair(blocks.where("alone"))
    digested = T.StructType([*[f for f in alone.schema.fields if f.name not in ("roles", "texts")], T.StructField("repaired_sha256", T.StringType())])
    closed = _mapped(alone, _digested, digested).withColumn("gaps", gaps).select(*names)

    shared = materialise(repair(blocks.where(~F.col("alone"))), "conversations-repaired")
    before = Window.partitionBy("conv_id").orderBy("part", "block")
    joint = F.lag("last_role").over(before)
    joined = shared.drop("roles", "texts").withColumns({
        "illegal": F.col("illegal") + F.when(joint.isNotNull() & ~F.concat(joint, "first_role").isin(*LEGAL), 1).otherwise(0),
        "turns": F.col("turns") - F.when(F.lag("last_turn").over(before) == F.col("first_turn"), 1).otherwise(0),
    })
    sums = joined.groupBy("conv_id").agg(
        F.min("first_turn").alias("first_turn"), F.max("last_turn").alias("last_turn"), F.sum("turns").alias("turns"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "block", "audit"))), lambda b: b["audit"]), "").alias("audit"),
    )
    digest = T.StructType([conv, T.StructField("repaired_sha256", T.StringType())])
    bodies = shared.select("conv_id", "part", "block", "roles", "texts").repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    digests = bodies.mapInArrow(_stream_digests(_arrow(digest)), digest).withColumnRenamed("conv_id", "_conv")
    both = sums.join(digests, F.col("conv_id").eqNullSafe(F.col("_conv")))
    return closed.unionByName(both.withColumn("gaps", gaps).select(*names))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in, by crc32 of ``conv_id:turn`` modulo 20 (nulls: one space).

    0 drops the row, 1 empties its text, 2 removes the marks that end sentences, 3 repeats it, 4 makes it the user's.
    """
    blank = F.lit(" ")
    named = conversations.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        (F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)).cast("binary")) % 20).alias("fault"),
    ).where("fault <> 0")
    faulty = named.withColumns({
        "text": F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")),
        "role": F.when(F.col("fault") == 4, "user").otherwise(F.col("role")),
    })
    times = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return faulty.withColumn("copy", F.explode(times)).select("conv_id", "turn", "role", "text")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """The report of :func:`report` on damaged rows, with a row for each conversation, also where no row is left."""
    told = report(plan_repair(damage(conversations))).withColumnRenamed("conv_id", "_conv")
    every = conversations.select("conv_id").distinct()
    joined = every.join(told, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    zeros = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return joined.withColumns(zeros | {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))})
