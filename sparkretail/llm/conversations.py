"""Cheapest repair of the turn order of conversations, by the method of Four Russians.

A conversation is right if its roles read: nothing, or an optional system turn and then
user and assistant in turn. What reading it so far leaves is one of four states, so the
cost of repairing the rest is a vector of four numbers. Less their minimum, only a few
dozen such vectors exist. A table therefore holds, for each vector and each block of
``BLOCK`` turns, the vector before the block and what it adds. Conversations are read from
their end, a block a lookup. To trace the edits, each block is expanded backward from the
vector at its end, and at each turn the first edit in the order of their letters is taken
that keeps the cost; so ties are broken exactly.

Rows are range-partitioned by conversation and turn. A conversation that lies in one
partition is repaired there. One that spans several is repaired in pieces: each piece is
read once for the costs between all pairs of states, these are put together, and each
piece is then traced on its own. So a conversation with a third of all rows is spread over
a third of the tasks.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sparkretail.llm.common import durable

BLOCK = 4  # turns in a block of the table
BATCH = 4_096  # rows handed on at once
FLUSH = 16 << 20  # or this many letters
REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
BEYOND = 1 << 30

# States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: The state after the one user or assistant turn that may follow, and its role.
FOLLOWING = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
#: Cheapest ends: the conversation may stop at the start or after an assistant.
AT_END = (0, 2 * INSERT, INSERT, 0)
ENDINGS = ("", "II", "I", "")

# Symbols: 0 must go; else 1 + 2 x (initial s, u, a or other) + whether it is unfinished.
SYMBOLS = 9
GONE = re.compile(r"[^\x20\x09-\x0D]")
FAULTS = ("blank", "duplicate", "truncated")


def after_keeping(state: int, initial: int) -> int | None:
    """The state after a kept turn with initial s, u, a or other; None if it may not stand."""
    if initial == 0:
        return SYSTEM if state == START else None
    return FOLLOWING[state] if initial < 3 and FOLLOWING[state] == initial + 1 else None


def step(after: tuple[int, ...], symbol: int) -> tuple[list[int], list[tuple[str, int, int]]]:
    """Costs before a turn from those after it, and per state the first cheapest edits up
    to and with the turn: letters, cost, next state."""
    late = UNFINISHED if symbol and (symbol - 1) % 2 else 0

    def options(state: int) -> list[tuple[str, int, int]]:
        found = [("D", DELETE, state)]
        if symbol:
            kept = after_keeping(state, (symbol - 1) // 2)
            found += [("K", late, kept)] if kept is not None else []
            found += [("R", REROLE + late, FOLLOWING[state])]
        return found

    before = [min(cost + after[to] for _, cost, to in options(q)) for q in STATES]
    for _ in STATES:  # insertions before the turn, as many in a row as pay
        before = [min(before[q], INSERT + before[FOLLOWING[q]]) for q in STATES]
    before = [min(b, BEYOND) for b in before]

    def first(state: int) -> tuple[str, int, int]:
        letters, spent = "", 0
        while True:
            fits = [o for o in options(state) if o[1] + after[o[2]] == before[state]]
            if INSERT + before[FOLLOWING[state]] == before[state]:
                fits.append(("I", INSERT, FOLLOWING[state]))
            letter, cost, to = min(fits)
            letters, spent, state = letters + letter, spent + cost, to
            if letter != "I":
                return letters, spent, state

    return before, [first(q) if before[q] < BEYOND else ("", 0, q) for q in STATES]


class Tables:
    """Vectors by number, one-turn steps and block transitions between their numbers."""

    def __init__(self):
        self.vectors: list[tuple[int, ...]] = []
        self.number: dict[tuple[int, ...], int] = {}
        self.end = self._add(AT_END)[0]
        #: One state at the end of a piece and no other.
        self.at = [self._add([0 if p == q else BEYOND for p in STATES])[0] for q in STATES]
        self.steps: list[list[tuple[int, int, list]]] = []
        while len(self.steps) < len(self.vectors):
            vector, row = self.vectors[len(self.steps)], []
            for symbol in range(SYMBOLS):
                before, edits = step(vector, symbol)
                row.append((*self._add(before), edits))
            self.steps.append(row)
        #: blocks[vector][code]: the code reads the turns as digits, the first one leading.
        blocks = [[(v, 0)] for v in range(len(self.vectors))]
        for _ in range(BLOCK):
            blocks = [
                [(self.steps[w][s][0], add + self.steps[w][s][1]) for s in range(SYMBOLS) for w, add in row]
                for row in blocks
            ]
        self.blocks = blocks

    def _add(self, vector) -> tuple[int, int]:
        """The number of a vector less its minimum, and the minimum."""
        low = min(vector)
        key = tuple(BEYOND if v >= BEYOND else v - low for v in vector)
        if key not in self.number:
            self.number[key] = len(self.vectors)
            self.vectors.append(key)
        return self.number[key], low

    def borders(self, symbols: bytes, last: int) -> tuple[list[int], int]:
        """Vector numbers at the ends of the blocks, from the end of the symbols on, and
        the sum of what was subtracted. The first block may be shorter."""
        at, total, found = len(symbols), 0, [last]
        while at >= BLOCK:
            code = 0
            for s in symbols[at - BLOCK : at]:
                code = code * SYMBOLS + s
            last, add = self.blocks[last][code]
            found.append(last)
            total += add
            at -= BLOCK
        for s in reversed(symbols[:at]):
            last, add, _ = self.steps[last][s]
            total += add
        if at:
            found.append(last)
        return found, total

    def costs(self, symbols: bytes, last: int) -> list[int]:
        """Cost of the symbols from each state, given the vector at their end."""
        found, total = self.borders(symbols, last)
        return [min(BEYOND, v + total) for v in self.vectors[found[-1]]]

    def trace(self, symbols: bytes, state: int, last: int) -> Iterator[tuple[str, int, int]]:
        """Per turn the letters of its edits, their cost and the state after it."""
        found, _ = self.borders(symbols, last)
        first = len(symbols) % BLOCK
        stops = range(first or BLOCK, len(symbols) + 1, BLOCK)
        for stop, border in zip(stops, reversed(found[:-1]), strict=True):
            begin, vector, edits = max(0, stop - BLOCK), border, []
            for s in reversed(symbols[begin:stop]):
                vector, _, choice = self.steps[vector][s]
                edits.append(choice)
            for choice in reversed(edits):
                letters, cost, state = choice[state]
                yield letters, cost, state


@cache
def tables() -> Tables:
    return Tables()


def judge(role: str, text: str, seen: bool) -> tuple[int, str | None]:
    """Symbol and first fault of a turn; ``seen``: an earlier one has its role and text."""
    last = GONE.search(text[::-1])
    if last is None:
        return 0, FAULTS[0]
    if seen:
        return 0, FAULTS[1]
    late = last[0] not in ".!?"
    return 1 + 2 * ("sua".find(role[:1]) % 4 if role else 3) + late, FAULTS[2] if late else None


def _edit_rows(turns: list[tuple], symbols: bytes, faults: list, state: int, last: int, tail: bool) -> Iterator[tuple]:
    """(turn, edit, fault, cost, was, role, text) of turns (turn, role, text). ``tail``: what
    is missing at the end follows."""
    for (turn, role, text), fault, (letters, cost, to) in zip(
        turns, faults, tables().trace(symbols, state, last), strict=True
    ):
        for _ in letters[:-1]:
            state = FOLLOWING[state]
            yield None, "I", None, INSERT, None, ROLE_OF[state], ""
        letter = letters[-1]
        new = None if letter == "D" else role if letter == "K" else ROLE_OF[to]
        yield turn, letter, fault, cost - INSERT * (len(letters) - 1), role, new, None if letter == "D" else text
        state = to
    for _ in ENDINGS[state] if tail else "":
        state = FOLLOWING[state]
        yield None, "I", None, INSERT, None, ROLE_OF[state], ""


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= BATCH or size >= FLUSH:
            yield _batch(held, schema)
            held, size = [], 0
    yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _matched(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """A join on columns of equal names in which a null equals a null; the columns of
    ``right`` that are not among them follow those of ``left``."""
    right = right.withColumnsRenamed({n: f"_right_{n}" for n in names})
    on = [left[n].eqNullSafe(right[f"_right_{n}"]) for n in names]
    return left.join(right, on, how).drop(*(f"_right_{n}" for n in names))


def _types(df: DataFrame, names: str, extra: str = "") -> tuple[str, pa.Schema]:
    """A schema of some columns of ``df`` and others, for Spark and for Arrow."""
    ddl = ", ".join([f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names.split()] + [extra] * bool(extra))
    return ddl, to_arrow_schema(StructType.fromDDL(ddl))


EDITS = "edit string, fault string, cost long, was string, role string, text string"


def _edits(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edits of the conversations that lie in one partition, in order there, and of those
    that span several."""
    keys = ["conv_id", "turn", "role", F.sha2("text", 256)]
    rows = rows.select(
        "conv_id", "turn", *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text"))
    ).withColumn("_row", F.monotonically_increasing_id())
    # Equal rows stand for one another, so their number may decide between partitions.
    ordered = durable(
        rows.repartitionByRange(*keys, "_row").sortWithinPartitions(*keys, "_row").select(
            "conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"),
            "turn", "role", "text",
        )
    )
    # A partition shares conversations with others only at its two ends: two rows each.
    ends = ordered.groupBy("part").agg(F.min(F.struct("conv_id")).alias("a"), F.max(F.struct("conv_id")).alias("b"))
    parts: dict = {}
    for r in ends.collect():
        for conv in {r["a"]["conv_id"], r["b"]["conv_id"]}:
            parts.setdefault(conv, set()).add(r["part"])
    spanning = {conv for conv, found in parts.items() if len(found) > 1}
    ddl, schema = _types(ordered, "conv_id part place turn", EDITS)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edits() -> Iterator[tuple]:
            for conv, run in itertools.groupby(_stream(batches), key=lambda r: r[0]):
                if conv in spanning:
                    continue
                part, turns, seen, symbols, faults = 0, [], set(), bytearray(), []
                for _, part, _, turn, role, text in run:
                    symbol, fault = judge(role, text, (role, text) in seen)
                    seen.add((role, text))
                    turns.append((turn, role, text))
                    symbols.append(symbol)
                    faults.append(fault)
                for i, edit in enumerate(_edit_rows(turns, bytes(symbols), faults, START, tables().end, True)):
                    yield conv, part, i, *edit

        return _batched(edits(), schema)

    return ordered.mapInArrow(whole, ddl), _spanning_edits(ordered, spanning, ddl, schema)


def _spanning_edits(ordered: DataFrame, spanning: set, ddl: str, schema: pa.Schema) -> DataFrame:
    """Edits of conversations that lie in several partitions, piece by piece.

    What the driver holds are 16 numbers for each end of a partition.
    """
    spark = ordered.sparkSession
    kind = ordered.schema["conv_id"].dataType.simpleString()
    chosen = spark.createDataFrame([(c,) for c in spanning], f"conv_id {kind}")
    border = _matched(ordered, F.broadcast(chosen), ["conv_id"], "left_semi")
    digest = F.sha2("text", 256).alias("digest")
    texts = border.select("conv_id", "part", "role", digest).distinct()
    first = texts.groupBy("conv_id", "role", "digest").agg(F.min("part").alias("first"))
    seen = _matched(texts, first, ["conv_id", "role", "digest"], "inner").where("first < part")
    # New names: both sides of the cogroup come from the same rows.
    seen = seen.selectExpr("conv_id AS seen_id", "part AS seen_part", "role AS seen_role", "digest AS seen_digest")

    def piece(left: pa.Table, right: pa.Table) -> tuple[list[tuple], bytes, list]:
        earlier = set(zip(right["seen_role"].to_pylist(), right["seen_digest"].to_pylist(), strict=True))
        left = left.sort_by("place")
        turns = list(zip(*(left[c].to_pylist() for c in ("turn", "role", "text")), strict=True))
        symbols, faults = bytearray(), []
        for _, role, text in turns:
            key = (role, hashlib.sha256(text.encode()).hexdigest())
            symbol, fault = judge(role, text, key in earlier)
            earlier.add(key)
            symbols.append(symbol)
            faults.append(fault)
        return turns, bytes(symbols), faults

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return pa.table({"conv_id": pa.array([], schema.field("conv_id").type), "part": pa.array([], pa.int32()), "symbols": pa.array([], pa.binary())})
        _, symbols, _ = piece(left, right)
        return pa.table({"conv_id": left["conv_id"][:1], "part": left["part"][:1], "symbols": pa.array([symbols], pa.binary())})

    groups = border.groupBy("conv_id", "part").cogroup(seen.groupBy("seen_id", "seen_part"))
    pieces = durable(groups.applyInArrow(read, f"conv_id {kind}, part int, symbols binary"))

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[v for q in STATES for v in tables().costs(s, tables().at[q])] for s in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.list_(pa.int64()))], names=["conv_id", "part", "m"])

    by_conv: dict = {}
    for r in pieces.mapInArrow(matrices, f"conv_id {kind}, part int, m array<bigint>").collect():
        by_conv.setdefault(r["conv_id"], []).append((r["part"], r["m"]))
    after: dict = {}
    for conv, found in by_conv.items():
        vector = list(AT_END)
        for part, m in sorted(found, reverse=True):
            low = min(vector)
            after[conv, part] = [v - low if v < BEYOND else v for v in vector]
            vector = [min(m[4 * to + q] + vector[to] for to in STATES) for q in STATES]

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for conv, part, symbols in _stream([batch]):
                last = tables().number[tuple(after[conv, part])]
                ends = []
                for state in STATES:
                    for _, _, state in tables().trace(symbols, state, last):  # noqa: B020
                        pass
                    ends.append(state)
                found.append(ends)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.list_(pa.int64()))], names=["conv_id", "part", "m"])

    leads: dict = {}
    for r in pieces.mapInArrow(exits, f"conv_id {kind}, part int, m array<bigint>").collect():
        leads.setdefault(r["conv_id"], []).append((r["part"], r["m"]))
    entry, final = {}, {}
    for conv, found in leads.items():
        state = START
        for part, m in sorted(found):
            entry[conv, part], final[conv] = state, part
            state = m[state]

    def trace(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return schema.empty_table()
        conv, part = left["conv_id"][0].as_py(), left["part"][0].as_py()
        turns, symbols, faults = piece(left, right)
        last = tables().number[tuple(after[conv, part])]
        found = [
            (conv, part, i, *edit)
            for i, edit in enumerate(_edit_rows(turns, symbols, faults, entry[conv, part], last, part == final[conv]))
        ]
        return pa.Table.from_batches([_batch(found, schema)])

    return groups.applyInArrow(trace, ddl)


def repair(rows: DataFrame) -> DataFrame:
    """The cheapest edits of every conversation of ``rows(conv_id, turn, role, text)``, one
    row per edit: conv_id, part, place, turn, edit (K, R, D or I), fault (blank, duplicate
    or truncated), cost, was (role before), role and text (after; null where deleted).

    Within a conversation edits follow each other by part and place. Turns stand by ``turn``, nulls first, then role, then the SHA-256
    of the text, so ties have one order; equal rows are duplicates of the first. Null roles
    and texts count as one space, a null ``conv_id`` is a conversation of its own. Very long
    texts are only searched for their last character. Other columns are ignored; an empty
    table gives an empty result. ``rows`` should come from files or a written table: rows
    that are equal in all columns are told apart by their place in it.
    """
    one, many = _edits(rows)
    return one.unionByName(many)


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _reports(schema: pa.Schema):
    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for conv, run in itertools.groupby(_stream(batches), key=lambda r: r[0]):
                count = dict.fromkeys(FAULTS, 0)
                low = high = previous = before = None
                distinct = illegal = total = 0
                audit, repaired, any_ = [], hashlib.sha256(), False
                for _, _, _, turn, edit, fault, cost, was, role, text in run:
                    audit.append(edit)
                    total += cost
                    if edit != "D":
                        repaired.update(f"{'\n' * any_}{role}:{text}".encode())
                        any_ = True
                    if edit == "I":
                        continue
                    if fault:
                        count[fault] += 1
                    if before is not None and before[:1] + was[:1] not in ("su", "ua", "au"):
                        illegal += 1
                    before = was
                    if turn is not None:
                        distinct += turn != previous
                        low, high, previous = turn if low is None else low, turn, turn
                gaps = 0 if low is None else high - low + 1 - distinct
                yield conv, gaps, *count.values(), illegal, total, "".join(audit), repaired.hexdigest()

        return _batched(found(), schema)

    return report


def report(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows``: gaps in its turn numbers, faults, illegal
    neighbours, cost and letters of its edits, and the SHA-256 of its repaired form,
    ``role:text`` joined by line feeds.

    A digest is made of the whole text in order. Where a conversation spans partitions its
    edits are therefore streamed through one task, in order and without being held there.
    """
    one, many = _edits(rows)
    ddl, schema = _types(one, "conv_id", REPORT)
    many = many.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    return one.mapInArrow(_reports(schema), ddl).unionByName(many.mapInArrow(_reports(schema), ddl))


def damage(rows: DataFrame) -> DataFrame:
    """Every twentieth turn or so, chosen by a checksum of its id and number, is dropped,
    emptied, stripped of its full stops, repeated or given to the user."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key) % 20
    text = F.coalesce("text", F.lit(" "))
    changed = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" ")))
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where(kind != 0).select(
        "conv_id", "turn", role.alias("role"), changed.alias("text"), F.explode(copies).alias("copy")
    )


def damaged_report(rows: DataFrame) -> DataFrame:
    """``report`` of the damaged rows, with a row for every conversation there was."""
    found = report(damage(rows))
    left = rows.select("conv_id").distinct()
    empty = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    names = [c for c in found.columns if c != "conv_id"]
    return _matched(left, found, ["conv_id"], "left").select(
        "conv_id", *(F.coalesce(c, empty.get(c, F.lit(0).cast("long"))).alias(c) for c in names)
    )
