"""Repair of conversation structure by weighted interval parsing.

Every row of a conversation is kept (K, cost 0), given the role user or assistant (R, 1) or deleted (D, 2), and rows user or assistant without
text are inserted anywhere (I, 5), so that the initials of the roles read ``(s?(ua)+)?`` at the least cost; of equally cheap repairs the one
whose letters (the audit) come first in ASCII order is taken.  Blank and duplicate rows must go, and a truncated row that stays costs 5 more.

The grammar is in Chomsky normal form.  Its nonterminals are pairs of states of the automaton of ``(s?(ua)+)?``: [p q] derives the stretches
that, after repair, take it from p to q.  Rules: [p q] -> [p r] [r q] for all r; [p q] -> one row, by its edits; and insertions, as the
closure of [p q] -> inserted row, on both sides of every row.  The cell of a span holds the least (cost, audit) for each [p q].  Cells are
combined bottom-up by span length: spans of 1, 2, 4, ... rows, then what is left of these.  A span's cell does not depend on where it is split,
since the rules join any two states through every third one, so one split is enough where other grammars need all (a test compares them).
That makes the work linear in the rows, and lets a conversation of any length be parsed in several tasks.

Rows are ordered by range partitioning on (conv_id, turn, role, text), so that even one conversation with a third of all rows is dealt to
many tasks; each gives one cell per conversation it holds, and only conversations on a border are joined afterwards.  First occurrences for
the duplicate test are least turns per (conversation, role, text hash), combined before the shuffle.  Rows of one turn that differ come by
role, then by the first characters of the text, then by its hash.

A null turn comes first; a null conv_id is a conversation of its own; a null role or text counts as one space.  Repeated rows are rows of their
own (the later ones are duplicates).  Conversations without rows have an empty repair.  An empty table gives an empty result; further columns
are left out.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shelfmark.llm.common import delete, written

# States: start, after s, after u, after a.  An ending in the first or last is a whole conversation.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
STATES, ENDS = range(4), (0, 3)
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}

Cell = dict[tuple[int, int], tuple[int, str]]


def join(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans: [p q] -> [p r] [r q]."""
    out: Cell = {}
    for (p, r), (c1, a1) in left.items():
        for q in STATES:
            other = right.get((r, q))
            if other is not None:
                found = (c1 + other[0], a1 + other[1])
                if (p, q) not in out or found < out[p, q]:
                    out[p, q] = found
    return out


def _least(*cells: Cell) -> Cell:
    out: Cell = {}
    for cell in cells:
        for k, v in cell.items():
            if k not in out or v < out[k]:
                out[k] = v
    return out


def _insertions() -> Cell:
    """The empty span: no insertion, or as many as the states allow without coming back to one."""
    cell: Cell = {(p, p): (0, "") for p in STATES}
    once: Cell = {(p, q): (INSERT, "I") for (p, x), q in STEP.items() if x in ROLES}
    while (wider := _least(cell, join(cell, once))) != cell:
        cell = wider
    return cell


EMPTY = _insertions()


@lru_cache(1 << 10)
def leaf(kind: str) -> Cell:
    """One row: its role's initial, then its fault ('x' must go, 't' truncated, '-' none)."""
    initial, fault = kind[:-1], kind[-1]
    cells: list[Cell] = [{(p, p): (DELETE, "D") for p in STATES}]
    if fault != "x":
        cut = CUT if fault == "t" else 0
        cells.append({(p, q): (KEEP + cut, "K") for (p, x), q in STEP.items() if x == initial})
        cells.append({(p, q): (REROLE + cut, "R") for (p, x), q in STEP.items() if x in ROLES})
    return join(join(EMPTY, _least(*cells)), EMPTY)


@lru_cache(1 << 14)
def _short(kinds: tuple[str, ...]) -> Cell:
    """Spans of up to eight rows recur, so their cells are kept."""
    if len(kinds) == 1:
        return leaf(kinds[0])
    half = 1 << (len(kinds) - 1).bit_length() - 1
    return join(_short(kinds[:half]), _short(kinds[half:]))


class Chart:
    """Cells of a growing span: those of lengths 8, 16, 32, ... are combined as soon as two neighbours have one length."""

    def __init__(self):
        self.recent: list[str] = []
        self.spans: list[tuple[int, Cell]] = []

    def add(self, kind: str) -> None:
        self.recent.append(kind)
        if len(self.recent) == 8:
            self.spans.append((8, _short(tuple(self.recent))))
            self.recent = []
            while len(self.spans) > 1 and self.spans[-1][0] == self.spans[-2][0]:
                (n, right), (_, left) = self.spans.pop(), self.spans.pop()
                self.spans.append((2 * n, join(left, right)))

    def cell(self) -> Cell:
        cells = [c for _, c in self.spans] + ([_short(tuple(self.recent))] if self.recent else [])
        if not cells:
            return EMPTY
        out = cells[-1]
        for c in reversed(cells[:-1]):
            out = join(c, out)
        return out


def cheapest(cell: Cell) -> tuple[int, str]:
    return min(cell[0, q] for q in ENDS)


# ---- rows and their faults ----------------------------------------------------------------------

ROW_ORDER = ["conv_id", "has_turn", "turn", "role", "start", "sha"]


def _rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text), and what orders and marks a row."""
    text, role = F.coalesce(F.col("text"), F.lit(" ")), F.coalesce(F.col("role"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return rows.withColumns({"has_turn": F.col("turn").isNotNull(), "start": F.substring("text", 1, 32), "sha": F.sha2("text", 256)})


def _faults(rows: DataFrame) -> DataFrame:
    """Rows in narrow form: order, role's initial, and whether blank, truncated or seen on an earlier turn."""
    held = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\f\r"))
    narrow = rows.select(*ROW_ORDER, F.substring("role", 1, 1).alias("initial"), (held == "").alias("blank"),
                         (~F.substring(held, -1, 1).isin(".", "!", "?")).alias("cut"))
    at = F.struct("has_turn", "turn")
    first = narrow.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("sha").alias("h")).agg(F.min(at).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("sha") == F.col("h"))
    return narrow.join(first, same).select(*narrow.columns, (at > F.col("first")).alias("later"))


# ---- parsing ------------------------------------------------------------------------------------

_SPAN = ("part int, place int, conv_id long, border boolean, cell string, n long, blank long, duplicate long, truncated long, illegal long, head string, "
         "tail string, low long, high long, turns long, first_turn long, last_turn long")
_LEGAL = frozenset(["su", "ua", "au"])


def _kind(initial: str, blank: bool, again: bool, cut: bool) -> str:
    return initial + ("x" if blank or again else "t" if cut else "-")


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Per conversation of this task's stretch of the ordered rows: its cell and counts.  Equal rows are never parted by the ranges, so a
    repetition always follows the row it repeats."""
    from pyspark import TaskContext

    part, place, s, chart, last = TaskContext.get().partitionId(), 0, None, Chart(), None
    fields = ("conv_id", "turn", "role", "sha", "initial", "blank", "cut", "later")
    packed = lambda: json.dumps([[p, q, c, a] for (p, q), (c, a) in chart.cell().items()])
    for batch in batches:
        for conv, turn, role, sha, initial, blank, cut, later in zip(*[batch.column(c).to_pylist() for c in fields]):
            if s is None or s["conv_id"] != conv:
                if s is not None:
                    yield s | {"cell": packed()}
                chart, last = Chart(), None
                s = {"part": part, "place": place, "conv_id": conv, "border": place == 0, "n": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0,
                     "head": initial, "tail": None, "low": None, "high": None, "turns": 0, "first_turn": turn, "last_turn": None}
                place += 1
            again = later or (turn, role, sha) == last
            s["n"] += 1
            s["blank"] += blank
            s["duplicate"] += again and not blank
            s["truncated"] += cut and not again and not blank
            s["illegal"] += s["tail"] is not None and s["tail"] + initial not in _LEGAL
            if turn is not None:
                s["low"] = turn if s["low"] is None else s["low"]
                s["turns"] += turn != s["last_turn"]
                s["high"] = turn
            s["tail"], s["last_turn"], last = initial, turn, (turn, role, sha)
            chart.add(_kind(initial, blank, again, cut))
    if s is not None:
        yield s | {"cell": packed(), "border": True}


def _as_arrow(rows: Iterator[dict], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, size)):
        yield pa.RecordBatch.from_pylist(some, schema=schema)


def _schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _cell(text: str) -> Cell:
    return {(p, q): (c, a) for p, q, c, a in json.loads(text)}


_AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _audit(s: dict, cell: Cell) -> dict:
    cost, audit = cheapest(cell)
    gaps = 0 if s["low"] is None else int(s["high"]) - int(s["low"]) + 1 - int(s["turns"])
    return {"conv_id": s["conv_id"], "gaps": gaps, **{k: int(s[k]) for k in ("blank", "duplicate", "truncated", "illegal")}, "cost": cost, "audit": audit}


def _joined(spans: list[dict]) -> dict:
    """Stretches of one conversation, in order."""
    spans = sorted(spans, key=lambda s: (s["part"], s["place"]))
    total, cell = dict(spans[0]), _cell(spans[0]["cell"])
    for s in spans[1:]:
        total["illegal"] += s["illegal"] + (total["tail"] + s["head"] not in _LEGAL)
        if s["low"] is not None:
            total["turns"] += s["turns"] - (total["last_turn"] is not None and s["first_turn"] == total["last_turn"])
            total["low"] = s["low"] if total["low"] is None else total["low"]
            total["high"] = s["high"]
        for k in ("blank", "duplicate", "truncated", "n"):
            total[k] += s[k]
        total["tail"], total["last_turn"] = s["tail"], s["last_turn"]
        cell = join(cell, _cell(s["cell"]))
    return _audit(total, cell)


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation that has rows: gaps in its turns, faults by kind, neighbours that must not follow each other, and the cheapest repair."""
    span_schema, audit_schema = _schema(_SPAN), _schema(_AUDIT)
    ordered = _faults(rows).repartitionByRange(*ROW_ORDER).sortWithinPartitions(*ROW_ORDER)
    spans = written(ordered.mapInArrow(lambda b: _as_arrow(_spans(b), span_schema), _SPAN), "conversation-spans")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pylist([_audit(s, _cell(s["cell"])) for s in b.to_pylist()], schema=audit_schema)

    def bordering(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([_joined(table.to_pylist())], schema=audit_schema)

    inner = spans.filter("NOT border").mapInArrow(whole, _AUDIT)
    outer = spans.filter("border").groupBy("conv_id").applyInArrow(bordering, _AUDIT)  # two stretches a task at most
    out = written(inner.unionByName(outer), "conversation-audits")
    delete(spans)
    return out


# ---- applying the repair ------------------------------------------------------------------------

_REPAIRED = "conv_id long, place long, edit string, role string, text string"


def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, audit row or None, edit, role, text) in order, from an audit row followed by the rows it is for."""
    conv, audit, at, state = None, "", 0, 0

    def inserted():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state = 3 if state == 2 else 2
            at += 1
            yield conv, None, "I", ROLES["a" if state == 3 else "u"], ""

    for batch in batches:
        for r in batch.to_pylist():
            if r["kind"] == 0:
                yield from inserted()
                conv, audit, at, state = r["conv_id"], r["audit"] or "", 0, 0
                yield conv, r, None, None, None
                continue
            yield from inserted()
            edit, role = audit[at], r["role"]
            at += 1
            if edit == "R":
                state = 3 if state == 2 else 2
                role = ROLES["a" if state == 3 else "u"]
            elif edit == "K":
                state = STEP[state, role[:1]]
            yield conv, None, edit, role, r["text"]
    yield from inserted()


def _with_audits(rows: DataFrame, found: DataFrame, also: DataFrame | None = None) -> DataFrame:
    """Audit rows and rows in order, all of a conversation in one task, which reads them as a stream."""
    every = found if also is None else also.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().join(
        found.withColumnRenamed("conv_id", "id"), F.col("conv_id").eqNullSafe(F.col("id")), "left").drop("id")
    both = every.withColumn("kind", F.lit(0)).unionByName(rows.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ROW_ORDER[1:])


def repaired(conversations: DataFrame) -> DataFrame:
    """The rows of each repaired conversation, numbered from 0, with the edit that each owes its place to (K, R or I)."""
    schema = _schema(_REPAIRED)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        place = 0
        for conv, head, edit, role, text in edits(batches):
            if head is not None:
                place = 0
            elif edit != "D":
                yield {"conv_id": conv, "place": place, "edit": edit, "role": role, "text": text}
                place += 1

    rows = _rows(conversations)
    return _with_audits(rows, audits(rows)).mapInArrow(lambda b: _as_arrow(kept(b), schema), _REPAIRED)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def digest(conversations: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """Per conversation (of `every` table, if given) the counts, the audit and the hash of the repaired ``role:text`` lines.  A hash is taken in
    one go, so a conversation's repaired text passes through one task, as a stream."""
    ddl = _AUDIT + ", repaired_sha256 string"
    schema = _schema(ddl)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        head, sha, lines = None, hashlib.sha256(), 0
        done = lambda: {"conv_id": head["conv_id"], **{k: head[k] or 0 for k in COUNTS}, "audit": head["audit"] or "", "repaired_sha256": sha.hexdigest()}
        for _, new, edit, role, text in edits(batches):
            if new is not None:
                if head is not None:
                    yield done()
                head, sha, lines = new, hashlib.sha256(), 0
            elif edit != "D":
                sha.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                lines += 1
        if head is not None:
            yield done()

    rows = _rows(conversations)
    return _with_audits(rows, audits(rows), every).mapInArrow(lambda b: _as_arrow(hashed(b), schema), ddl)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in, as the row's number decides: one row in twenty each is dropped, emptied, loses its sentence ends, is
    repeated, or becomes the user's."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how: Column = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), how.alias("how")).filter("how <> 0")
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("how") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(times).alias("copy")).drop("copy")
