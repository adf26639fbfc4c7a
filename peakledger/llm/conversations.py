"""Repair of conversation structure: the cheapest edits that give role initials (s?(ua)+)?, by Hirschberg's divide and conquer.

A conversation is a walk through four states (before anything, after s, after u, after a). Costs to reach the states from the front and
costs to go from the back are vectors of four numbers; where they meet in the middle, the crossing with the least sum is taken, among
equals the one whose audit so far is ASCII-least, and both halves are solved alike, so no table of all rows is ever held.

Rows are range-partitioned by conversation and turn. A conversation inside one partition is solved there. One that crosses partitions,
or is longer than a piece, is solved piece by piece: each piece becomes a 4 x 4 table of costs (with the order of its audits), tables
are multiplied over groups of neighbouring partitions, level by level, and the crossings chosen on top are handed down to the pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.shipping import by_value
from .common import checkpoint, stored

SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: Rows and bytes of text of one piece of a conversation.
PIECE_ROWS = 1 << 16
PIECE_BYTES = 8 << 20
#: Neighbouring partitions whose tables are multiplied in one group.
FAN = 64

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 60
#: The role that an inserted or renamed row takes in each state, as the state it leads to.
FOLLOWS = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: Inserts that end a conversation from each state, and their costs.
TAIL = ("", "II", "I", "")
TAIL_COST = tuple(INSERT * len(x) for x in TAIL)
#: Row codes: 0 must go; 1 + 4 * truncated + number of the initial.
INITIALS = "sua"
CODES = 9

Vector = tuple[tuple[int, ...], tuple[int, ...]]  # costs less their least, and the order of the audits


def _moves(code: int) -> list[list[tuple[int, str]]]:
    """[state before][state after] -> (cost, letters): inserts, then one letter for the row; cheapest, then ASCII-least."""
    out = [[(FAR, "")] * 4 for _ in range(4)]
    for before in range(4):
        state, cost, letters = before, 0, ""
        for _ in range(4):
            ways = [("D", DELETE, state)]
            if code:
                extra, initial = TRUNCATED * ((code - 1) // 4), "sua?"[(code - 1) % 4]
                if state in KEPT.get(initial, {}):
                    ways.append(("K", KEEP + extra, KEPT[initial][state]))
                ways.append(("R", REROLE + extra, FOLLOWS[state]))
            for letter, price, after in ways:
                out[before][after] = min(out[before][after], (cost + price, letters + letter))
            state, cost, letters = FOLLOWS[state], cost + INSERT, letters + "I"
    return out


MOVES = [_moves(code) for code in range(CODES)]


class Walker:
    """Vectors moved by rows; a move is worked out once for each pair of relative costs and code, as those are few."""

    def __init__(self) -> None:
        self.ahead: dict[tuple, tuple[int, Vector]] = {}
        self.back: dict[tuple, tuple[int, tuple[int, ...]]] = {}

    @staticmethod
    def _lifted(costs: list[int]) -> tuple[int, tuple[int, ...]]:
        least = min(costs)
        return least, tuple(FAR if c >= FAR // 2 else c - least for c in costs)

    @staticmethod
    def _raised(costs: tuple[int, ...], by: int) -> list[int]:
        return [FAR if c >= FAR // 2 else c + by for c in costs]

    def _step(self, at: Vector, code: int) -> tuple[int, Vector]:
        costs, order = at
        picked = []
        for after in range(4):
            picked.append(min((costs[q] + MOVES[code][q][after][0], order[q], MOVES[code][q][after][1]) for q in range(4)))
        by_audit = sorted(range(4), key=lambda q: (True, (q,)) if picked[q][0] >= FAR // 2 else (False, picked[q][1:]))
        least, relative = self._lifted([p[0] for p in picked])
        return least, (relative, tuple(by_audit.index(q) for q in range(4)))

    def forward(self, codes: bytes, begin: int, end: int, entry: int) -> tuple[list[int], tuple[int, ...]]:
        """Costs of reaching the states from `entry` after rows begin..end, and the order of the ASCII-least audits that do."""
        total, at = 0, (tuple(0 if q == entry else FAR for q in range(4)), (0, 1, 2, 3))
        known = self.ahead
        for code in codes[begin:end]:
            key = (at, code)
            if key not in known:
                known[key] = self._step(at, code)
            more, at = known[key]
            total += more
        return self._raised(at[0], total), at[1]

    def backward(self, codes: bytes, begin: int, end: int, tail: tuple[int, ...]) -> list[int]:
        """Costs of going from each state through rows begin..end and then paying `tail` for the state reached."""
        total, at = self._lifted(list(tail))
        known = self.back
        for code in reversed(codes[begin:end]):
            key = (at, code)
            if key not in known:
                known[key] = self._lifted([min(MOVES[code][q][r][0] + at[r] for r in range(4)) for q in range(4)])
            more, at = known[key]
            total += more
        return self._raised(at, total)

    def audit(self, codes: bytes, entry: int, leave: int) -> str:
        """The ASCII-least of the cheapest audits that lead from state to state."""
        out: list[str] = []
        todo = [(0, len(codes), entry, leave)]
        while todo:
            begin, end, before, after = todo.pop()
            if end - begin == 1:
                out.append(MOVES[codes[begin]][before][after][1])
            elif end > begin:
                mid = (begin + end) // 2
                front, order = self.forward(codes, begin, mid, before)
                rest = self.backward(codes, mid, end, tuple(0 if q == after else FAR for q in range(4)))
                cross = min(range(4), key=lambda q: (front[q] + rest[q], order[q]))
                todo += [(mid, end, cross, after), (begin, mid, before, cross)]
        return "".join(out)

    def table(self, codes: bytes) -> list[int]:
        """16 costs and 16 ranks: what the rows do from each state to each."""
        rows = [self.forward(codes, 0, len(codes), q) for q in range(4)]
        return [c for costs, _ in rows for c in costs] + [r for _, order in rows for r in order]


def _cost(table: list[int], q: int, r: int) -> int:
    return int(table[4 * q + r])


def _rank(table: list[int], q: int, r: int) -> int:
    return int(table[16 + 4 * q + r])


def leave_by(front: list[int], order: tuple[int, ...] | list[int]) -> int:
    """The state to end in, trailing inserts included."""
    return min(range(4), key=lambda q: (front[q] + TAIL_COST[q], order[q]))


def product(first: list[int], second: list[int]) -> list[int]:
    """The table of two neighbouring stretches."""
    costs, ranks = [], []
    for q in range(4):
        picked = [min((min(_cost(first, q, m) + _cost(second, m, r), FAR), _rank(first, q, m), _rank(second, m, r)) for m in range(4)) for r in range(4)]
        by_audit = sorted(range(4), key=lambda r: (True, (r,)) if picked[r][0] >= FAR else (False, picked[r][1:]))
        costs += [p[0] for p in picked]
        ranks += [by_audit.index(r) for r in range(4)]
    return costs + ranks


def crossings(tables: list[list[int]], entry: int, leave: int) -> list[int]:
    """The states between neighbouring stretches (one less than tables) on the audit-least of the cheapest ways."""
    rest = [[0 if q == leave else FAR for q in range(4)]]
    for table in reversed(tables[1:]):
        rest.append([min(min(_cost(table, q, r) + rest[-1][r], FAR) for r in range(4)) for q in range(4)])
    out, at = [], entry
    for table, back in zip(tables, reversed(rest[1:])):  # what was chosen before a stretch is one state, so ranks from there decide
        at = min(range(4), key=lambda q: (min(_cost(table, at, q) + back[q], FAR), _rank(table, at, q)))
        out.append(at)
    return out


def repaired(audit: str, rows: Iterator[tuple[str, str]], entry: int = START) -> tuple[list[str], int]:
    """The lines role:text of the rows after the edits, and the state after them."""
    lines, state = [], entry
    for letter in audit:
        if letter == "I":
            state = FOLLOWS[state]
            lines.append(f"{NAMES[state]}:")
            continue
        role, text = next(rows)
        if letter == "K":
            state = KEPT[role[:1]][state]
            lines.append(f"{role}:{text}")
        elif letter == "R":
            state = FOLLOWS[state]
            lines.append(f"{NAMES[state]}:{text}")
    return lines, state


class Piece:
    """Neighbouring rows of one conversation and what is counted of them."""

    def __init__(self) -> None:
        self.codes, self.roles, self.texts, self.size = bytearray(), [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.turn = self.first_turn = None
        self.head = self.last = None

    def add(self, turn: int | None, role: str, text: str, first: bool) -> None:
        initial = role[:1]
        body = text.rstrip(SPACES)
        if not body:
            self.blank += 1
            code = 0
        elif not first:
            self.duplicate += 1
            code = 0
        else:
            cut = body[-1] not in ENDS
            self.truncated += cut
            code = 1 + 4 * cut + (INITIALS.index(initial) if initial and initial in INITIALS else 3)
        if self.last is None:
            self.head, self.first_turn = initial, turn
        elif self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        if turn is not None:
            if turn != self.turn:
                self.turns += 1
            self.least = turn if self.least is None else min(turn, self.least)
            self.most = turn if self.most is None else max(turn, self.most)
        self.turn = turn
        self.codes.append(code)
        self.roles.append(role)
        self.texts.append(text if code else "")
        self.size += len(text) if code else 0

    def stats(self) -> dict:
        return {"least": self.least, "most": self.most, "turns": self.turns, "first_turn": self.first_turn, "last_turn": self.turn, "blank": self.blank,
                "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "head": self.head, "last": self.last}


STATS = ("least long, most long, turns long, first_turn long, last_turn long, blank long, duplicate long, truncated long, illegal long, "
         "head string, last string")
COUNTED = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _digest(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, times): the rows after the damage that crc32 of `conv_id:turn` deals; equal rows are one with a count.

    Null roles, texts, and null ids and turns inside the key, are one space.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    dealt = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                        (F.crc32(key.cast("binary")) % 20).alias("dealt")).where("dealt <> 0")
    text = F.when(F.col("dealt") == 1, F.lit("")).when(F.col("dealt") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("dealt") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("dealt") == 3, 2).otherwise(1)
    out = dealt.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("times"))
    return out.groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times"))


def ordered(rows: DataFrame) -> DataFrame:
    """Damaged rows with `first` (no earlier row of the conversation has this role and text), in order of conversation, turn (nulls
    first), role and text over the partitions. A long conversation is spread over several of them."""
    same = F.xxhash64("conv_id", "role", "text")
    turn = F.struct(F.col("turn").isNotNull().alias("named"), F.coalesce("turn", F.lit(0)).alias("turn"))
    again = rows.groupBy(same.alias("same")).agg(F.min(turn).alias("begin"), F.count("*").alias("n")).where("n > 1").drop("n")
    marked = rows.withColumns({"key": same, "at": turn}).join(again, F.col("key") == F.col("same"), "left")
    marked = marked.select("conv_id", "turn", "role", "text", "times", (F.col("begin").isNull() | (F.col("begin") == F.col("at"))).alias("first"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = marked.withColumn("start", F.substring("text", 1, 32)).repartitionByRange(parts, "conv_id", "turn", "role", "start").drop("start")
    return checkpoint(dealt.sortWithinPartitions("conv_id", "turn", "role", "text"))


def _by_piece(piece_rows: int, piece_bytes: int, kind: str):
    """One row per piece: solved if it is a whole conversation for sure, else its table and its rows."""
    target = to_arrow_schema(StructType.fromDDL(_piece_schema(kind)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker, part = Walker(), TaskContext.get().partitionId()
        now: Piece | None = None
        conv, number, whole, held, size = None, 0, False, [], 0

        def finish(last: bool, cut: bool) -> None:
            nonlocal number, size
            row = {"conv_id": conv, "part": part, "number": number, **now.stats(), "whole": whole and not cut and not last}
            if row["whole"]:
                front, order = walker.forward(bytes(now.codes), 0, len(now.codes), START)
                leave = leave_by(front, order)
                audit = walker.audit(bytes(now.codes), START, leave) + TAIL[leave]
                row |= {"audit": audit, "cost": front[leave] + TAIL_COST[leave], "digest": _digest(repaired(audit, zip(now.roles, now.texts))[0])}
            else:
                row |= {"codes": bytes(now.codes), "cells": walker.table(bytes(now.codes)), "roles": now.roles, "texts": now.texts}
                size += now.size
            number += 1
            held.append(row)

        def flush() -> pa.RecordBatch:
            nonlocal size
            out = pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in held], f.type) for f in target], schema=target)
            held.clear()
            size = 0
            return out

        begun = False
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "times", "first")]
            for key, turn, role, text, times, first in zip(*columns):
                if now is None or key != conv:
                    if now is not None:
                        finish(False, False)
                    now, conv, whole, begun = Piece(), key, begun, True
                for k in range(times):
                    if len(now.codes) >= piece_rows or now.size >= piece_bytes:
                        finish(False, True)
                        now, whole = Piece(), False
                        if size > piece_bytes:
                            yield flush()
                    now.add(turn, role, text, first and not k)
                if len(held) >= 1024:
                    yield flush()
        if now is not None:
            finish(True, False)
        if held:
            yield flush()
    return run


def _piece_schema(kind: str) -> str:
    return f"conv_id {kind}, part int, number int, whole boolean, {STATS}, cost long, audit string, digest string, codes binary, cells array<long>, roles array<string>, texts array<string>"


def _multiplied(frame):
    import pandas as pd

    frame = frame.sort_values(["part", "number"])
    table = None
    for x in frame["cells"]:
        table = list(x) if table is None else product(table, list(x))
    first = frame.iloc[0]
    return pd.DataFrame({"conv": [first["conv"]], "part": [first["above"]], "number": [0], "cells": [table]})


def _handed_down(frame):
    frame = frame.sort_values(["part", "number"])
    tables = [list(x) for x in frame["cells"]]
    entry, leave = int(frame["entry"].iloc[0]), int(frame["leave"].iloc[0])
    states = [entry, *crossings(tables, entry, leave), leave]
    frame = frame.assign(entry=states[:-1], leave=states[1:])
    return frame[["conv", "part", "number", "entry", "leave"]]


def _ends(cells: DataFrame, parts: int) -> DataFrame:
    """(conv, part, number, cells) of the pieces of split conversations -> (conv, part, number, entry, leave)."""
    levels = [cells]
    while parts > 1 or len(levels) == 1:
        up = levels[-1].withColumn("above", F.floor(F.col("part") / FAN).cast("int"))
        levels.append(up.groupBy("conv", "above").applyInPandas(_multiplied, "conv string, part int, number int, cells array<long>"))
        parts = -(-parts // FAN)
    top = levels.pop()

    @F.udf("int")
    def leave(table):
        return leave_by(table[:4], table[16:20])

    known = top.select("conv", "part", "number", F.lit(START).alias("entry"), leave("cells").alias("leave"))
    while levels:
        below = levels.pop().withColumn("above", F.floor(F.col("part") / FAN).cast("int"))
        parent = known.select("conv", F.col("part").alias("above"), "entry", "leave")
        known = below.join(parent, ["conv", "above"]).groupBy("conv", "above").applyInPandas(_handed_down, "conv string, part int, number int, entry int, leave int")
    return known


def _solved():
    """Pieces with entry and leave -> their audits and repaired lines."""
    target = to_arrow_schema(StructType.fromDDL(SOLVED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker = Walker()
        for batch in batches:
            for row in batch.to_pylist():
                audit = walker.audit(row["codes"], row["entry"], row["leave"])
                lines, _ = repaired(audit, zip(row["roles"], row["texts"]), row["entry"])
                out = row | {"audit": audit, "lines": "\n".join(lines).encode("utf-8", "surrogatepass"), "filled": bool(lines),
                             "cost": row["cells"][4 * row["entry"] + row["leave"]]}
                yield pa.RecordBatch.from_arrays([pa.array([out[f.name]], f.type) for f in target], schema=target)
    return run


SOLVED = f"conv string, part int, number int, {STATS}, cost long, audit string, lines binary, filled boolean, leave int"


def _joined():
    """Solved pieces in order -> one row per conversation. Texts are only hashed as they pass."""
    target = to_arrow_schema(StructType.fromDDL(RESULT))

    def finished(conv: str, now: dict) -> pa.RecordBatch:
        tail, state = TAIL[now["leave"]], now["leave"]
        for _ in tail:
            state = FOLLOWS[state]
            now["sha"].update((b"\n" if now["filled"] else b"") + f"{NAMES[state]}:".encode())
            now["filled"] = True
        out = now | {"conv": conv, "audit": "".join(now["audit"]) + tail, "cost": now["cost"] + TAIL_COST[now["leave"]], "digest": now["sha"].hexdigest(),
                     "gaps": 0 if now["least"] is None else now["most"] - now["least"] + 1 - now["turns"]}
        return pa.RecordBatch.from_arrays([pa.array([out[f.name]], f.type) for f in target], schema=target)

    def extend(now: dict, row: dict) -> None:
        now["illegal"] += now["last"] + row["head"] not in ("su", "ua", "au")
        now["turns"] -= row["first_turn"] is not None and row["first_turn"] == now["last_turn"]
        for name in ("blank", "duplicate", "truncated", "illegal", "cost", "turns"):
            now[name] += row[name]
        for name, pick in (("least", min), ("most", max)):
            now[name] = pick((x for x in (now[name], row[name]) if x is not None), default=None)
        if row["filled"]:
            now["sha"].update((b"\n" if now["filled"] else b"") + row["lines"])
        now |= {"last": row["last"], "last_turn": row["last_turn"], "leave": row["leave"], "filled": now["filled"] or row["filled"]}
        now["audit"].append(row["audit"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, now = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if now is not None and row["conv"] == conv:
                    extend(now, row)
                    continue
                if now is not None:
                    yield finished(conv, now)
                conv, now = row["conv"], row | {"sha": hashlib.sha256(row["lines"]), "audit": [row["audit"]]}
        if now is not None:
            yield finished(conv, now)
    return run


RESULT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, digest string"


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row per conversation of `rows` (conv_id, turn, role, text): gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256, of the rows after damage().

    Rows of one turn are taken by role, then text; repeated rows follow each other. Null ids are one conversation. A conversation that
    loses all rows has zeros, an empty audit and the hash of nothing. An empty table gives an empty one; other columns are not read.
    Only the final hash of a split conversation passes through one task, a piece at a time, as SHA-256 has no other way.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    lined = ordered(damaged(rows.select("conv_id", "turn", "role", "text")))
    pieces = stored(lined.mapInArrow(_by_piece(piece_rows, piece_bytes, kind), _piece_schema(kind)), "conversations")
    conv = F.concat(F.when(F.col("conv_id").isNull(), "-").otherwise("+"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    split = pieces.where("not whole").withColumn("conv", conv)
    ends = _ends(split.select("conv", "part", "number", "cells"), (pieces.agg(F.max("part").alias("last")).first()["last"] or 0) + 1)
    solved = split.join(ends, ["conv", "part", "number"]).mapInArrow(_solved(), SOLVED)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined = solved.repartition(parts, "conv").sortWithinPartitions("conv", "part", "number").mapInArrow(_joined(), RESULT)
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0))
    whole = pieces.where("whole").select(conv.alias("conv"), gaps.alias("gaps"), *COUNTED[1:], "audit", "digest")
    found = whole.unionByName(joined)
    asked = rows.select("conv_id").distinct().withColumn("asked", conv)
    zero, empty = F.lit(0).cast("long"), F.lit(hashlib.sha256(b"").hexdigest())
    return asked.join(found, F.col("asked") == F.col("conv"), "left").select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in COUNTED], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", empty).alias("repaired_sha256"))


by_value(__name__)
