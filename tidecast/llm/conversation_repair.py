"""Operator 13: repair of conversations by weighted interval parsing.

A conversation is legal if the initials of its roles spell ``(s?(ua)+)?``.
With the automaton's states START, SYSTEM, USER, ANSWER the repair grammar in
Chomsky normal form has a symbol N[p,q] for the spans that lead from p to q:

    N[p,q] -> N[p,r] N[r,q]          two neighbouring spans
    N[p,q] -> row                    Keep, Rerole or Delete a row
    N[p,q] -> empty                  insertions alone (the closure)

A cell holds, for each symbol over one span, the least (cost, audit). Because
N[p,q] means the same for every split of a span, all splits give the same
cell, and spans of 1, 2, 4, ... rows fill the table bottom-up in linear time.
Rows travel without texts, range-partitioned by conversation and turn, so a
conversation of any length is parsed in many tasks, one cell each, and the
cells of its parts are combined. Texts meet the audit once, for the digest.

Least audits combine: of two different audits of one symbol, span and cost,
neither is a prefix of the other (it would miss insertions, which cost), so
what follows doesn't change their order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import BLANKS, keyed_lookup, store

BLANK, DUPLICATE, TRUNCATED, SOUND = "blank", "duplicate", "truncated", "sound"
START, SYSTEM, USER, ANSWER = range(4)
ARCS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ANSWER, (ANSWER, "u"): USER}
ENDS = (START, ANSWER)
NAMES = {"u": "user", "a": "assistant"}
RECAST, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
LEGAL = ("su", "ua", "au")

Cell = dict[tuple[int, int], tuple[int, str]]


# -- grammar -----------------------------------------------------------------

def _put(cell: Cell, at: tuple[int, int], entry: tuple[int, str]) -> None:
    if at not in cell or entry < cell[at]:
        cell[at] = entry


def combine(left: Cell, right: Cell) -> Cell:
    """Cell of two neighbouring spans."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in range(4):
            if more := right.get((r, q)):
                _put(out, (p, q), (cost + more[0], audit + more[1]))
    return out


def _closure() -> Cell:
    """Cell of the empty span: every way by insertions."""
    out: Cell = {(p, p): (0, "") for p in range(4)}
    for _ in range(3):  # the longest way without a loop
        for (p, r), (cost, audit) in list(out.items()):
            for (state, role), q in ARCS.items():
                if state == r and role in NAMES:
                    _put(out, (p, q), (cost + INSERT, audit + "I"))
    return out


CLOSURE = _closure()


@lru_cache(maxsize=4096)
def _row_cell(initial: str, fault: str, copies: int) -> Cell:
    """Cell of one row and of the copies that follow it (duplicates, deleted)."""
    own: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if fault in (TRUNCATED, SOUND):
        extra = CUT_OFF if fault == TRUNCATED else 0
        for (p, role), q in ARCS.items():
            if role == initial:
                _put(own, (p, q), (extra, "K"))
            if role in NAMES:
                _put(own, (p, q), (extra + RECAST, "R"))
    if copies > 1:
        own = combine(own, {(p, p): (DELETE * (copies - 1), "D" * (copies - 1)) for p in range(4)})
    return combine(combine(CLOSURE, own), CLOSURE)


@lru_cache(maxsize=65536)
def _short_span(rows: tuple) -> Cell:
    """Cell of a span of up to 8 rows; equal spans are parsed once."""
    if len(rows) == 1:
        return _row_cell(*rows[0])
    half = len(rows) // 2
    return combine(_short_span(rows[:half]), _short_span(rows[half:]))


def bottom_up(cells: list[Cell]) -> Cell:
    """Cell of all spans together, neighbours first."""
    while len(cells) > 1:
        pairs = [combine(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[2 * len(pairs):]
    return cells[0] if cells else CLOSURE


def parse(rows: Sequence[tuple[str, str, int]]) -> Cell:
    """Cell of rows (role initial, fault, copies)."""
    return bottom_up([_short_span(tuple(rows[i:i + 8])) for i in range(0, len(rows), 8)])


def best(cell: Cell) -> tuple[int, str]:
    return min(cell[START, q] for q in ENDS if (START, q) in cell)


# -- rows --------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) after the contract's damage; a null
    role, text or key part counts as one space. Dropped rows stay with 0 copies."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    h = F.crc32(F.concat(parts[0], F.lit(":"), parts[1]).cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.when(h == 4, "user").otherwise(role).alias("role"),
        F.when(h == 1, "").when(h == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(h == 0, 0).when(h == 3, 2).otherwise(1).alias("copies"))


def _last_character(text: Column) -> Column:
    """The last character that is no blank, '' if there is none."""
    return F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1))


def _outlines(rows: DataFrame) -> DataFrame:
    """Rows without texts, equal ones as one with its copies: (conv_id, turn,
    role, digest, copies, fault, later); ``later``: role and text are seen in
    an earlier turn of the conversation."""
    last = _last_character(F.col("text"))
    fault = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    there = F.col("copies") > 0
    same = ["conv_id", "role", "digest"]
    # One row of a conversation that lost all its rows is enough to keep its id.
    light = rows.select("conv_id", F.when(there, F.col("turn")).alias("turn"), F.when(there, F.col("role")).otherwise("").alias("role"),
                        F.when(there, F.unhex(F.sha2("text", 256))).otherwise(F.lit(b"")).alias("digest"), F.when(there, fault).alias("fault"), "copies")
    light = store(light.groupBy("conv_id", "turn", "role", "digest").agg(F.sum("copies").alias("copies"), F.min("fault").alias("fault")), "outlines")
    again = (light.where(F.col("copies") > 0).groupBy(*same)
             .agg(F.count("*").alias("turns"), F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first")).where(F.col("turns") > 1))
    found = keyed_lookup(light, again, same, "turns")
    here = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    return found.select(*light.columns, F.coalesce(here > F.col("first"), F.lit(False)).alias("later"))


class _Part:
    """The rows of one conversation in one range, in order."""

    def __init__(self, conv_id):
        self.conv_id, self.rows, self.turns, self.low, self.high = conv_id, [], 0, None, None
        self.count = dict.fromkeys((BLANK, DUPLICATE, TRUNCATED, SOUND), 0)
        self.illegal, self.first, self.last = 0, None, None

    def add(self, turn, role, fault, later, copies):
        if not copies:
            return
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        if fault != BLANK and later:
            fault = DUPLICATE
        self.count[fault] += 1
        self.count[BLANK if fault == BLANK else DUPLICATE] += copies - 1
        initial = role[:1]
        if self.last is not None:
            self.illegal += self.last + initial not in LEGAL
        self.illegal += copies - 1  # a role never follows itself
        self.first, self.last = initial if self.first is None else self.first, initial
        self.rows.append((initial, fault, copies))

    def row(self, part):
        cell = parse(self.rows)
        return (self.conv_id, part, self.low, self.high, self.turns, self.count[BLANK], self.count[DUPLICATE], self.count[TRUNCATED], self.illegal,
                self.first, self.last, [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in cell.items()])


_PARTS = ("part int, low bigint, high bigint, turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          "first string, last string, cell array<struct<p:int,q:int,cost:bigint,audit:string>>")
_FOUND = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _arrow(id_type: str, rest: str) -> tuple[str, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    ddl = f"conv_id {id_type}, {rest}"
    return ddl, to_arrow_schema(StructType.fromDDL(ddl))


def parsed(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of
    the conversations of damaged ``rows``."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    part_ddl, part_schema = _arrow(id_type, _PARTS)
    found_ddl, found_schema = _arrow(id_type, _FOUND)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        me, part, out = TaskContext.get().partitionId(), None, []
        for batch in batches:
            for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if part is None or conv_id != part.conv_id:
                    if part:
                        out.append(part.row(me))
                    part = _Part(conv_id)
                    if len(out) >= 1000:
                        yield _batch(out, part_schema)
                        out = []
                part.add(*row)
        if part:
            yield _batch([*out, part.row(me)], part_schema)

    def whole(parts: list[dict]) -> tuple:
        seen = [p for p in parts if p["first"] is not None]
        dated = [p for p in seen if p["low"] is not None]
        gaps = 0
        if dated:
            turns = sum(p["turns"] for p in dated) - sum(a["high"] == b["low"] for a, b in zip(dated, dated[1:]))
            gaps = dated[-1]["high"] - dated[0]["low"] + 1 - turns
        counts = [sum(p[c] for p in seen) for c in (BLANK, DUPLICATE, TRUNCATED, "illegal")]
        counts[3] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(seen, seen[1:]))
        return (gaps, *counts, *best(bottom_up([{(e["p"], e["q"]): (e["cost"], e["audit"]) for e in p["cell"]} for p in seen])))

    def join_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = [], []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["conv_id"] != held[0]["conv_id"]:
                    out.append((held[0]["conv_id"], *whole(held)))
                    held = []
                    if len(out) >= 1000:
                        yield _batch(out, found_schema)
                        out = []
                held.append(row)
        if held:
            yield _batch([*out, (held[0]["conv_id"], *whole(held))], found_schema)

    order = ["conv_id", "turn", "role", "digest"]
    lines = _outlines(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    parts = lines.select("conv_id", "turn", "role", "fault", "later", "copies").mapInArrow(cells, part_ddl)
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(join_cells, found_ddl)


def repair(rows: DataFrame) -> DataFrame:
    """One row for each conversation of damaged ``rows``: its faults, the
    cheapest repair and the digest of the repaired conversation.

    Rows go by turn (null first), then role and text digest; repeated rows are
    duplicates. A row whose role is empty can't be kept, only recast or
    deleted. A null conv_id is a conversation like any other. Other columns
    are ignored; no rows give no rows. The digest runs over a conversation's
    text in order, which only one task can do: it streams the sorted rows and
    holds the audit and one batch."""
    found = store(parsed(rows), "parsed")
    id_type = rows.schema["conv_id"].dataType.simpleString()
    ddl, schema = _arrow(id_type, _FOUND + ", repaired_sha256 string")
    names = found.columns
    texts = rows.where(F.col("copies") > 0).withColumns({"kind": F.lit(1), "digest": F.unhex(F.sha2("text", 256))})
    both = found.withColumn("kind", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    order = ["conv_id", "kind", "turn", "role", "digest"]
    both = both.repartition("conv_id").sortWithinPartitions(*order).select("kind", *names, "role", "text", "copies")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, repaired = [], None
        for batch in batches:
            for kind, *fields, role, text, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    if repaired:
                        done.append((*repaired.found, repaired.hexdigest()))
                        if len(done) >= 1000:
                            yield _batch(done, schema)
                            done = []
                    repaired = _Repaired(fields)
                else:
                    for _ in range(copies):
                        repaired.add(role, text)
        if repaired:
            yield _batch([*done, (*repaired.found, repaired.hexdigest())], schema)

    return both.mapInArrow(digest, ddl)


class _Repaired:
    """Follows an audit over the rows of a conversation and hashes what it leaves."""

    def __init__(self, found):
        self.found, self.audit = found, found[-1]
        self.at, self.state, self.sha, self.empty = 0, START, hashlib.sha256(), True

    def write(self, initial: str, role: str, text: str) -> None:
        self.state = ARCS[self.state, initial]
        self.sha.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty = False

    def owed(self) -> str:
        """The one role that may follow by insertion or a new role."""
        return "a" if self.state == USER else "u"

    def insertions(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.write(self.owed(), NAMES[self.owed()], "")
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self.insertions()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.write(role[:1], role, text)
        elif edit == "R":
            self.write(self.owed(), NAMES[self.owed()], text)

    def hexdigest(self) -> str:
        self.insertions()
        return self.sha.hexdigest()
