"""Repair of the role structure of conversations at least cost, by Hirschberg's divide and conquer.

A repaired conversation has the role initials ``(s?(ua)+)?``. What has been read so far is in one of four states, so a
row is a table of least costs between states, and so is any run of rows. Long conversations are cut into blocks that
different tasks hold; the same recursion runs over the blocks' tables and then over the rows inside each block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.storage import cut

#: Nothing read yet, after system, after user, after assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NEVER = 1 << 40

#: What an inserted or reroled message becomes in each state, and the state after it.
TURN = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAME = {USER: "user", ASSISTANT: "assistant"}
#: Cost and edits that end a conversation in each state.
END = (0, 2 * INSERT, INSERT, 0)
TAIL = ("", "II", "I", "")
LEGAL = {"su", "ua", "au"}


def _edits(code: int) -> list[dict[int, tuple[int, str]]]:
    """From each state to each state: least cost of one row with insertions before it, and its least edits.

    Codes: 0 is a row that has to go; 1 to 4 are rows of system, user, assistant and other roles; 5 to 8 the same,
    truncated.
    """
    kept = (code - 1) % 4 + 1 if code else None
    made: list[dict[int, tuple[int, str]]] = []
    for first in range(4):
        best: dict[int, tuple[int, str]] = {}

        def offer(to: int, cost: int, edits: str) -> None:
            best[to] = min(best.get(to, (NEVER, "")), (cost, edits))

        at = first
        for inserted in range(3):
            base, head, more = inserted * INSERT, "I" * inserted, TRUNCATED if code > 4 else 0
            offer(at, base + DELETE, head + "D")
            if kept:
                offer(TURN[at], base + REROLE + more, head + "R")
                fits = at == EMPTY if kept == SYSTEM else kept == TURN[at]
                if fits:
                    offer(kept, base + KEEP + more, head + "K")
            at = TURN[at]
        made.append(best)
    return made


#: A move goes from a state to another: (state, cost, rank). Among the moves from one state, ranks order the edits.
Move = tuple[int, int, int]
Moves = list[list[Move]]


def _ranked(edits: list[dict[int, tuple[int, str]]]) -> Moves:
    """No edits are the beginning of others here, since each ends with the row's own letter: ranks settle all ties."""
    moves = []
    for best in edits:
        order = sorted(best, key=lambda to: best[to][1])
        moves.append([(to, best[to][0], order.index(to)) for to in sorted(best)])
    return moves


EDITS = [_edits(code) for code in range(9)]
ROW_MOVES = [_ranked(edits) for edits in EDITS]


def _at(state: int) -> list[int]:
    return [0 if s == state else NEVER for s in range(4)]


def forward(runs: Sequence[Moves], start: int) -> tuple[list[int], list[int]]:
    """Least cost of each state after ``runs``, and the order of the states by their least edits."""
    cost, rank = _at(start), [0, 0, 0, 0]
    for moves in runs:
        best = [(NEVER, 0, 0)] * 4
        for s in range(4):
            if cost[s] < NEVER:
                for to, more, order in moves[s]:
                    best[to] = min(best[to], (cost[s] + more, rank[s], order))
        cost = [b[0] for b in best]
        places = sorted(range(4), key=lambda s: best[s][1:])
        rank = [places.index(s) for s in range(4)]
    return cost, rank


def backward(runs: Sequence[Moves], end: Sequence[int]) -> list[int]:
    """Least cost from each state through ``runs`` to the end."""
    cost = list(end)
    for moves in reversed(runs):
        cost = [min((more + cost[to] for to, more, _ in moves[s]), default=NEVER) for s in range(4)]
    return cost


def crossings(runs: Sequence[Moves], start: int, end: Sequence[int]) -> list[int]:
    """The states between ``runs`` on the cheapest way; of several ways the one whose edits are least as text.

    Costs from the front and from the back meet in the middle. Of the states with the least sum the one reached by the
    least edits is crossed: edits up to one row are never the beginning of others, so what follows cannot change their
    order. Both halves go on alone; only vectors of four are kept for each half.
    """
    states = [start] * (len(runs) + 1)
    left = [(0, len(runs), start, list(end))] if runs else []
    while left:
        low, high, at, goal = left.pop()
        middle = (low + high + 1) // 2
        cost, rank = forward(runs[low:middle], at)
        rest = backward(runs[middle:high], goal)
        states[middle] = cross = min(range(4), key=lambda s: (cost[s] + rest[s], rank[s]))
        if middle - low > 1:
            left.append((low, middle, at, _at(cross)))
        if high > middle:
            left.append((middle, high, cross, goal))
    return states


def block_moves(codes: bytes) -> Moves:
    """A run of rows as one table of moves."""
    runs = [ROW_MOVES[c] for c in codes]
    made = []
    for start in range(4):
        cost, rank = forward(runs, start)
        made.append([(s, cost[s], rank[s]) for s in range(4) if cost[s] < NEVER])
    return made


def _solve(codes: bytes, start: int, end: tuple[int, ...]) -> tuple[list[int], str, int]:
    states = crossings([ROW_MOVES[c] for c in codes], start, end)
    edits = [EDITS[c][a][b] for c, a, b in zip(codes, states, states[1:])]
    return states, "".join(e for _, e in edits), sum(c for c, _ in edits) + end[states[-1]]


_kept_solve = lru_cache(1 << 16)(_solve)


def solve(codes: bytes, start: int, end: tuple[int, ...]) -> tuple[list[int], str, int]:
    """States, edits and cost of a run of rows. Answers for short runs are kept."""
    return (_kept_solve if len(codes) <= 16 else _solve)(codes, start, end)


def lines(codes: bytes, states: Sequence[int], roles: Sequence[str], texts: Sequence[str]) -> list[str]:
    """``role:text`` of what the edits leave and insert. Roles and texts are those of the rows that need not go."""
    out, messages = [], iter(zip(roles, texts))
    for code, at, to in zip(codes, states, states[1:]):
        role, text = next(messages) if code else ("", "")
        for edit in EDITS[code][at][to][1]:
            if edit == "I":
                at = TURN[at]
                out.append(f"{NAME[at]}:")
            elif edit == "R":
                out.append(f"{NAME[TURN[at]]}:{text}")
            elif edit == "K":
                out.append(f"{role}:{text}")
    return out


def tail_lines(state: int) -> list[str]:
    out = []
    for _ in TAIL[state]:
        state = TURN[state]
        out.append(f"{NAME[state]}:")
    return out


class _Block:
    """Consecutive rows of one conversation, and what is counted of them."""

    def __init__(self, rows: int, size: int) -> None:
        self.limits = rows, size
        self.codes = bytearray()
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.bytes = self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.turns: list[int | None] = [None, None]
        self.initials: list[str | None] = [None, None]

    def full(self) -> bool:
        return len(self.codes) >= self.limits[0] or self.bytes >= self.limits[1]

    def add(self, turn: int | None, role: str, text: str, n: int, fault: int) -> None:
        """``n`` equal rows; ``fault`` is that of the first: 0 none, 1 blank, 2 duplicate, 3 truncated."""
        first = role[:1]
        kind = {"s": 1, "u": 2, "a": 3}.get(first, 4)
        self.codes += bytes([0 if fault in (1, 2) else kind + (4 if fault == 3 else 0)]) + bytes(n - 1)
        if fault in (0, 3):
            self.roles.append(role)
            self.texts.append(text)
            self.bytes += len(role) + len(text)
        if fault == 1:
            self.blank += n
        else:
            self.duplicate += n - (fault != 2)
            self.truncated += fault == 3
        if self.initials[0] is None:
            self.initials[0] = first
        else:
            self.illegal += self.initials[1] + first not in LEGAL
        self.illegal += (n - 1) * (first + first not in LEGAL)
        self.initials[1] = first
        if turn is not None:
            self.distinct += turn != self.turns[1]
            self.turns = [turn if self.turns[0] is None else self.turns[0], turn]


def _gaps(low: int | None, high: int | None, distinct: int) -> int:
    return min(2**63 - 1, high - low + 1 - distinct) if distinct else 0


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_BLOCK = (
    "part int, block int, whole boolean, blank bigint, duplicate bigint, truncated bigint, illegal bigint, gaps bigint,"
    " cost bigint, audit string, repaired_sha256 string, codes binary, roles array<string>, texts array<string>,"
    " low bigint, high bigint, distinct bigint, first string, last string, moves array<bigint>"
)


def _flat(moves: Moves) -> list[int]:
    out = [NEVER] * 32
    for at, row in enumerate(moves):
        for to, cost, rank in row:
            out[at * 8 + to * 2 : at * 8 + to * 2 + 2] = cost, rank
    return out


def _unflat(flat: Sequence[int]) -> Moves:
    return [[(to, flat[at * 8 + to * 2], flat[at * 8 + to * 2 + 1]) for to in range(4) if flat[at * 8 + to * 2] < NEVER] for at in range(4)]


def _row(conv, part: int, number: int, block: _Block, whole: bool) -> dict:
    row = {
        "conv": conv,
        "part": part,
        "block": number,
        "whole": whole,
        "blank": block.blank,
        "duplicate": block.duplicate,
        "truncated": block.truncated,
        "illegal": block.illegal,
    }
    codes = bytes(block.codes)
    if whole:
        states, audit, cost = solve(codes, EMPTY, END)
        text = "\n".join(lines(codes, states, block.roles, block.texts) + tail_lines(states[-1]))
        row["gaps"] = _gaps(*block.turns, block.distinct)
        row["cost"], row["audit"] = cost, audit + TAIL[states[-1]]
        row["repaired_sha256"] = hashlib.sha256(text.encode()).hexdigest()
        return row
    row |= {"codes": codes, "roles": block.roles, "texts": block.texts, "moves": _flat(block_moves(codes))}
    row |= {"low": block.turns[0], "high": block.turns[1], "distinct": block.distinct}
    return row | {"first": block.initials[0], "last": block.initials[1]}


def _blocks(schema: pa.Schema, block_rows: int, block_bytes: int):
    """Sorted rows of a partition to conversations that lie whole within it, and to blocks of all others.

    The first and last conversation of a partition may go on in its neighbours, and one that fills a block may be long.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        out: list[dict] = []
        conv, block, edge = None, None, True

        def put(whole: bool) -> None:
            nonlocal number
            out.append(_row(conv, part, number, block, whole))
            number += 1

        for batch in batches:
            for key, turn, role, text, n, fault in zip(*[batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "n", "fault")]):
                if block is None or key != conv:
                    if block is not None:
                        put(not edge)
                        edge = False
                    conv, block = key, _Block(block_rows, block_bytes)
                elif block.full():
                    put(False)
                    block, edge = _Block(block_rows, block_bytes), True
                while n > 0:
                    some = min(n, block_rows)
                    block.add(turn, role, text, some, fault)
                    n, fault = n - some, 1 if fault == 1 else 2
                    if n:
                        put(False)
                        block, edge = _Block(block_rows, block_bytes), True
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out.clear()
        if block is not None:
            put(False)
        yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _chain(schema: pa.Schema):
    """The states between a conversation's blocks, and its counts on the first of them."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["block"]))
        runs = [_unflat(r["moves"]) for r in rows]
        states = crossings(runs, EMPTY, END)
        cost = END[states[-1]]
        for moves, at, to in zip(runs, states, states[1:]):
            cost += next(c for t, c, _ in moves[at] if t == to)
        total = {c: sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated", "illegal")} | {"cost": cost}
        low = high = last = None
        distinct = 0
        for r in rows:
            if r["distinct"]:
                distinct += r["distinct"] - (high == r["low"])
                low, high = r["low"] if low is None else low, r["high"]
            if r["first"] is not None:
                total["illegal"] += last is not None and last + r["first"] not in LEGAL
                last = r["last"]
        total["gaps"] = _gaps(low, high, distinct)
        out = [{"part": r["part"], "block": r["block"], "start": a, "goal": b} for r, a, b in zip(rows, states, states[1:])]
        out[0] |= total
        return pa.Table.from_pylist(out, schema)

    return run


def _pieces(schema: pa.Schema):
    """The edits of each block between its two states, and what they leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                states, edits, _ = solve(row["codes"], row["start"], tuple(_at(row["goal"])))
                text = "\n".join(lines(row["codes"], states, row["roles"], row["texts"])) or None
                out.append({k: row[k] for k in ("conv", "part", "block", "goal", *COUNTS)} | {"edits": edits, "text": text})
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _joined(schema: pa.Schema):
    """Blocks in order to one row for each conversation. Texts go through the digest and are not kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, first, last, edits, digest, empty = None, None, EMPTY, [], None, True

        def feed(text: str) -> None:
            nonlocal empty
            digest.update(text.encode() if empty else b"\n" + text.encode())
            empty = False

        def done() -> pa.RecordBatch:
            for line in tail_lines(last):
                feed(line)
            row = {"conv": conv, "audit": "".join(edits) + TAIL[last], "repaired_sha256": digest.hexdigest()}
            return pa.RecordBatch.from_pylist([row | {c: first[c] for c in COUNTS}], schema)

        for batch in batches:
            for row in batch.to_pylist():
                if first is None or row["conv"] != conv:
                    if first is not None:
                        yield done()
                    conv, first, edits, digest, empty = row["conv"], row, [], hashlib.sha256(), True
                edits.append(row["edits"])
                last = row["goal"]
                if row["text"] is not None:
                    feed(row["text"])
        if first is not None:
            yield done()

    return run


def _types(kind: T.DataType, ddl: str) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([T.StructField("conv", kind), *T._parse_datatype_string(ddl).fields])
    return schema, to_arrow_schema(schema)


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations with planted faults, by the crc32 of ``conv:turn`` modulo 20, and ``copies`` of each row.

    0 drops a row (no copies), 1 empties its text, 2 removes ``.``, ``!`` and ``?`` from it, 3 repeats it, 4 gives it
    the role user. A null in any column counts as one space.
    """
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    said = F.coalesce(text, F.lit(" "))
    return rows.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(role, F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(said, ".!?", "")).otherwise(said).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def repair(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    copies: Column | None = None,
    block_rows: int = 1024,
    block_bytes: int = 1 << 16,
) -> DataFrame:
    """One row per conversation: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    Rows are taken by ``turn``, nulls first, then by role and text. A null role or text is one space, and a null
    conversation is one like any other. ``copies`` tells how often a row occurs; one that occurs never still names its
    conversation. Conversations without rows have zeros, an empty audit and the digest of the empty text. Equal rows
    are one row with a count before the first shuffle. Other columns are not read; without rows the result is empty.

    Edits, by initial: Keep 0, Rerole to user or assistant 3, Delete 4 (blank and repeated rows have to go), Insert
    3; a truncated row that stays costs 3 more. ``audit`` holds the cheapest edits, the least of them as text. ``gaps``
    that no long can hold are the largest long.

    Conversations are sorted by range, so one with a third of all rows lies on as many tasks as a third of the data,
    in blocks of ``block_rows`` rows or ``block_bytes`` of text (a longer text has a block of its own). What meets in one task is a table of 32 numbers per block of it, and its text in order for the digest, which is
    read through and not kept.
    """
    white = " \t\n\x0b\x0c\r"
    n = F.lit(1) if copies is None else copies
    said = [F.when(n > 0, F.coalesce(c, F.lit(" "))) for c in (role, text)]
    named = rows.select(
        F.col(conv).alias("conv"),
        F.when(n > 0, F.col(turn).cast("bigint")).alias("turn"),
        said[0].alias("role"),
        said[1].alias("text"),
        n.cast("bigint").alias("n"),
    )
    trimmed = F.rtrim("text", F.lit(white))
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    single = cut(
        named.groupBy("conv", "turn", "role", "text")
        .agg(F.sum("n").alias("n"))
        .withColumns({"blank": trimmed == "", "open": ~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), "digest": digest})
    )
    said_again = single.where("n > 0 and not blank").groupBy(F.col("conv").alias("_conv"), F.col("digest").alias("_digest"))
    said_again = said_again.agg(
        F.count("*").alias("_times"), F.max(F.col("turn").isNull()).alias("_untimed"), F.min("turn").alias("_turn")
    )
    said_again = cut(said_again.where("_times > 1"))
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest"))
    late = F.when(F.col("_untimed"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("_turn"))
    fault = F.when(F.col("blank"), 1).when(late, 2).when(F.col("open"), 3).otherwise(0)
    order = ["conv", "turn", "role", "text"]
    faults = cut(single.join(said_again, same, "left").select(*order, "n", fault.alias("fault")))

    kind = faults.schema["conv"].dataType
    schema, arrow = _types(kind, _BLOCK)
    sorted_rows = faults.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = cut(sorted_rows.mapInArrow(_blocks(arrow, block_rows, block_bytes), schema))
    shown = ["conv", *COUNTS, "audit", "repaired_sha256"]

    longs = ", ".join(f"{c} bigint" for c in COUNTS)
    schema, arrow = _types(kind, f"part int, block int, start int, goal int, {longs}")
    narrow = ("part", "block", "blank", "duplicate", "truncated", "illegal", "low", "high", "distinct", "first", "last", "moves")
    open_blocks = blocks.where("not whole")
    ways = open_blocks.select("conv", *narrow).groupBy("conv").applyInArrow(_chain(arrow), schema).drop("conv")
    held = open_blocks.select("conv", "part", "block", "codes", "roles", "texts").join(ways, ["part", "block"])
    schema, arrow = _types(kind, f"part int, block int, goal int, {longs}, edits string, text string")
    pieces = held.mapInArrow(_pieces(arrow), schema)
    schema, arrow = _types(kind, f"{longs}, audit string, repaired_sha256 string")
    in_order = pieces.repartition("conv").sortWithinPartitions("conv", "part", "block")
    joined = in_order.mapInArrow(_joined(arrow), schema)
    return blocks.where("whole").select(*shown).unionByName(joined.select(*shown)).withColumnRenamed("conv", conv)
