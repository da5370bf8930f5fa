"""Conversation structure repair by weighted CYK interval parsing.

A good conversation's roles are an optional system row and then user and
assistant in turn: `(s?(ua)+)?`. Each row is a terminal that can be kept, given
another role or deleted, and rows can be inserted, all at a cost. The grammar
is in Chomsky normal form: its nonterminals say with which role a span of rows
begins and ends once it is repaired (or that nothing is left of it), its binary
rules say which of them may follow one another. A cell holds for each
nonterminal the least (cost, audit) of a span, the audit being the initials of
the edits in order; rows' own cells are closed under insertion on both sides,
so that all larger ones are. Cells are filled bottom-up by the length of spans.

Up to BLOCK rows every split of a span is tried. As every part of a repaired
span is itself a span of some nonterminal, one split finds the same cell, so
longer conversations are parsed as blocks whose cells are combined pairwise,
again by the length of spans, in time linear in the rows.

Rows are dealt by ranges of (conversation, turn), so that a very long
conversation is many tasks' work: each parses its stretch, and one row for each
stretch is combined afterwards.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partnerlens.llm.common import BATCH_BYTES, forget, small_batches, sole_memory, values, written

#: Rows of a span of which all splits are tried.
BLOCK = 16
#: What edits cost, by their initials; a truncated row that stays costs TRUNCATED more.
COST = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED = 5
#: Nonterminals: first and last role of what is left of a span; "" if nothing is, "s" for a system row alone.
SPANS = ["", "s", "uu", "ua", "au", "aa", "su", "sa"]
FOLLOWS = {"su", "ua", "au"}
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}

BLANK = r"^[\x20\x09-\x0D]*\z"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"

Cell = tuple  # for each of SPANS the least (cost, audit), or None


def _joined(x: str, y: str) -> str | None:
    """The span of x followed by y, None if they may not meet."""
    if not x or not y:
        return x or y
    return x[0] + y[-1] if x[-1] + y[0] in FOLLOWS else None


RULES = [(i, k, SPANS.index(z)) for i, x in enumerate(SPANS) for k, y in enumerate(SPANS) if (z := _joined(x, y)) is not None]


def combine(left: Cell, right: Cell, found: Cell | None = None) -> Cell:
    """The least (cost, audit) of two neighbouring spans, by the binary rules; found is another split's cell."""
    out = list(found) if found else [None] * len(SPANS)
    for i, k, z in RULES:
        a, b = left[i], right[k]
        if a and b:
            cost = a[0] + b[0]
            if out[z] is None or cost < out[z][0]:
                out[z] = cost, a[1] + b[1]
            elif cost == out[z][0]:
                out[z] = min(out[z], (cost, a[1] + b[1]))
    return tuple(out)


def _cell(**found: tuple) -> Cell:
    return tuple(found.get(s or "none") for s in SPANS)


#: Inserted rows alone; no cheapest repair inserts three in a row.
INSERTED = _cell(none=(0, ""), uu=(COST["I"], "I"), aa=(COST["I"], "I"), ua=(2 * COST["I"], "II"), au=(2 * COST["I"], "II"))


def leaf(symbol: str) -> Cell:
    """The cell of one row, closed under insertion: s, u, a or x for its role, upper case if truncated, d if it must go."""
    found = {"none": (COST["D"], "D")}
    if symbol != "d":
        more = TRUNCATED if symbol.isupper() else 0
        found |= {"uu": (COST["R"] + more, "R"), "aa": (COST["R"] + more, "R")}
        kept = {"s": "s", "u": "uu", "a": "aa"}.get(symbol.lower())
        if kept:
            found[kept] = COST["K"] + more, "K"
    return combine(combine(INSERTED, _cell(**found)), INSERTED)


_cells: dict[str, Cell] = {}


def chart(symbols: str) -> Cell:
    """The cell of a span of at most BLOCK rows, from all splits of all its spans; cells of equal spans are remembered."""
    found = _cells.get(symbols)
    if found:
        return found
    forget(_cells, 50_000)
    for size in range(1, len(symbols) + 1):
        for at in range(len(symbols) - size + 1):
            span = symbols[at : at + size]
            if span not in _cells:
                _cells[span] = leaf(span) if size == 1 else reduce(
                    lambda best, k: combine(_cells[span[:k]], _cells[span[k:]], best), range(1, size), None)
    return _cells[symbols]


class Stretch:
    """What a task knows of one conversation after some of its rows."""

    def __init__(self, conv):
        self.conv, self.blank, self.duplicate, self.truncated, self.illegal, self.turns = conv, 0, 0, 0, 0, 0
        self.low = self.high = self.first = self.last = None
        self.symbols, self.done = "", []  # rows not parsed yet; (blocks, cell) of those before, ever fewer blocks

    def add(self, turn, initial, symbol):
        self.blank, self.duplicate = self.blank + (symbol == "b"), self.duplicate + (symbol == "d")
        self.truncated += symbol.isupper()
        self.illegal += self.last is not None and self.last + initial not in FOLLOWS
        self.first, self.last = initial if self.first is None else self.first, initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.symbols += "d" if symbol == "b" else symbol
        if len(self.symbols) == BLOCK:
            self.parse()

    def parse(self):
        n, cell = 1, chart(self.symbols)
        while self.done and self.done[-1][0] == n:
            n, cell = 2 * n, combine(self.done.pop()[1], cell)
        self.done.append((n, cell))
        self.symbols = ""

    def cell(self) -> Cell:
        if self.symbols:
            self.parse()
        return reduce(lambda right, left: combine(left[1], right), reversed(self.done[:-1]), self.done[-1][1])

    def row(self, part, is_open):
        cell = self.cell()
        return (self.conv, part, is_open, self.blank, self.duplicate, self.truncated, self.illegal, self.turns, self.low, self.high, self.first, self.last,
                [c and c[0] for c in cell], [c and c[1] for c in cell])


_STRETCH = [("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("turns", pa.int64()), ("low", pa.int64()),
            ("high", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))]
_STRETCH_SQL = ("part int, open boolean, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, first string, last string, "
                "costs array<long>, audits array<string>")


def _final(cell: Cell) -> tuple:
    """The cheapest repair that the grammar's start symbol allows."""
    return min(c for s, c in zip(SPANS, cell) if c and s in ("", "ua", "sa"))


def _messages(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, turn, role and text, nulls in the last two as one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))


def audits(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each conversation: conv, gaps, blank, duplicate, truncated, illegal, cost and audit.

    Rows stand by turn (nulls first), then role and text. A row's first fault
    counts: blank (nothing but blanks), duplicate (role and text seen earlier
    in the conversation), truncated (its last other character is not one of
    `.!?`). gaps are turns that lack between the first and the last; illegal
    are neighbours whose role initials are not su, ua or au. Blank and
    duplicate rows have to be deleted. audit is the cheapest repair's edits by
    initials (Keep, Rerole, Delete, Insert), of equally cheap ones the least in
    ASCII order. A null role or text is one space; a role that begins with
    none of s, u and a cannot be kept; a null conversation is one as well.
    Other columns play no part; no rows give no rows.
    """
    known = _messages(rows, conv_col, turn_col, role_col, text_col)
    key = [F.col("conv").cast("string"), F.col("conv").isNull(), "role", "text"]
    known = known.withColumns({"p": F.xxhash64(*key), "q": F.xxhash64(F.lit(1), *key)})

    # Where each repeated message stands first. Repeats in one turn are neighbours in the order below.
    rank = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("at"))
    first = known.groupBy("p", "q").agg(F.min(rank).alias("early"), F.count("*").alias("n")).filter("n > 1").drop("n")
    known = known.join(first, ["p", "q"], "left")

    initial = F.substring("role", 1, 1)
    symbol = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    symbol = F.when(F.col("text").rlike(BLANK), "b").when(F.col("early") < rank, "d").when(F.col("text").rlike(ENDED), symbol).otherwise(F.upper(symbol))
    # Long texts are no range keys; where roles are short, ranges by these keys are ranges of the order.
    near = F.when(F.char_length("role") < 64, F.substring("text", 1, 64)).otherwise("")
    ordered = known.repartitionByRange("conv", "turn", F.substring("role", 1, 64), near).sortWithinPartitions("conv", "turn", "role", "text")
    ordered = ordered.select("conv", "turn", initial.alias("initial"), symbol.alias("symbol"), "p", "q")
    conv = rows.schema[conv_col].dataType.simpleString()
    small_batches(rows.sparkSession)

    def walk(batches):
        sole_memory("conversation", _cells)
        part, now, is_first, before, done = TaskContext.get().partitionId(), None, True, None, []

        def out(schema):
            columns = list(zip(*done)) or [[]] * (3 + len(_STRETCH))
            types = [schema.field("conv").type, pa.int32(), pa.bool_(), *(t for _, t in _STRETCH)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["conv", "part", "open", *(n for n, _ in _STRETCH)])

        for batch in batches:
            for conv, turn, initial, symbol, *print_ in zip(*(values(batch, c) for c in batch.schema.names)):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.row(part, is_first))
                        is_first = False
                    now, before = Stretch(conv), None
                again = before == (turn, print_)
                now.add(turn, initial, "d" if again and symbol != "b" else symbol)
                before = turn, print_
            if len(done) >= 1000:
                yield out(batch.schema)
                done.clear()
        if now is not None:
            done.append(now.row(part, True))
            yield out(batch.schema)

    stretches, _ = written(ordered.mapInArrow(walk, f"conv {conv}, {_STRETCH_SQL}"), "stretches")

    def finish(batches):
        for batch in batches:
            out = []
            for conv, parts in zip(values(batch, "conv"), values(batch, "parts")):
                whole, high, last, cell = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0), None, None, None
                low = next((p["low"] for p in parts if p["low"] is not None), None)
                for p in parts:
                    for n in whole:
                        whole[n] += p[n]
                    whole["turns"] -= high is not None and p["low"] == high
                    whole["illegal"] += last is not None and last + p["first"] not in FOLLOWS
                    high, last = high if p["high"] is None else p["high"], p["last"]
                    own = tuple(c if c is None else (c, a) for c, a in zip(p["costs"], p["audits"]))
                    cell = combine(cell, own) if cell else own
                gaps = 0 if low is None else high - low + 1 - whole["turns"]
                out.append((conv, gaps, whole["blank"], whole["duplicate"], whole["truncated"], whole["illegal"], *_final(cell)))
            columns = list(zip(*out)) or [[]] * 8
            types = [batch.schema.field("conv").type, *[pa.int64()] * 6, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             names=["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

    # Only a task's first and last conversation can have rows elsewhere.
    named = F.struct("part", *(n for n, _ in _STRETCH))
    whole = stretches.filter("not open").select("conv", F.array(named).alias("parts"))
    cut = stretches.filter("open").groupBy("conv").agg(F.sort_array(F.collect_list(named)).alias("parts"))
    return whole.union(cut).mapInArrow(finish, f"conv {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def repaired(rows: DataFrame, found: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired conversations: conv, place (from 0), role, text and edit (K, R or I), by what audits() found in rows.

    A conversation's rows are in one task and in order (it is one sequence), but
    the task holds its audit and a batch of rows only.
    """
    conv = rows.schema[conv_col].dataType.simpleString()
    messages = _messages(rows, conv_col, turn_col, role_col, text_col).select("conv", F.lit(1).alias("kind"), "turn", "role", "text")
    edits = found.select("conv", F.lit(0), F.lit(None).cast("long"), F.lit(None).cast("string"), "audit")
    ordered = messages.union(edits).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "text").select("conv", "kind", "role", "text")
    small_batches(rows.sparkSession)

    def apply(batches):
        audit, at, place, last, held, out = "", 0, 0, "", 0, []

        def put(conv, role, text, edit):
            nonlocal place, last, held
            out.append((conv, place, role, text, edit))
            place, last, held = place + 1, role[:1], held + len(text)

        def inserts(conv):
            nonlocal at
            while audit[at : at + 1] == "I":
                put(conv, NAMES[NEXT[last]], "", "I")
                at += 1

        def batch_of(schema):
            types = [schema.field("conv").type, pa.int64(), pa.string(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 5, types)], names=["conv", "place", "role", "text", "edit"])

        now, schema = None, None
        for batch in batches:
            schema = batch.schema
            for conv, kind, role, text in zip(*(values(batch, c) for c in schema.names)):
                if kind == 0:
                    inserts(now)
                    now, audit, at, place, last = conv, text, 0, 0, ""
                    continue
                inserts(conv)
                edit, at = audit[at], at + 1
                if edit != "D":
                    put(conv, role if edit == "K" else NAMES[NEXT[last]], text, edit)
                if held >= BATCH_BYTES or len(out) >= 10_000:
                    yield batch_of(schema)
                    out.clear()
                    held = 0
        if schema is not None:
            inserts(now)
            yield batch_of(schema)

    return ordered.mapInArrow(apply, f"conv {conv}, place long, role string, text string, edit string")


def digests(messages: DataFrame) -> DataFrame:
    """conv and sha256 (lowercase hex) of its `role:text` lines joined by newlines, for the rows of repaired() as they come."""
    conv = messages.schema["conv"].dataType.simpleString()

    def run(batches):
        now, state, schema = None, None, None
        for batch in batches:
            schema, out = batch.schema, []
            for conv, place, role, text in zip(*(values(batch, c) for c in ("conv", "place", "role", "text"))):
                if place == 0:
                    if state:
                        out.append((now, state.hexdigest()))
                    now, state = conv, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], schema.field("conv").type), pa.array([o[1] for o in out], pa.string())], names=["conv", "sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([now], schema.field("conv").type), pa.array([state.hexdigest()])], names=["conv", "sha256"])

    return messages.mapInArrow(run, f"conv {conv}, sha256 string")


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """rows with faults by the crc32 of `conv:turn` modulo 20: 0 drops a row, 1 empties its text, 2 removes its `.!?`, 3 repeats it, 4 makes it a user's.

    Nulls count as one space, in role, text and the hashed ids. Only the four columns are returned.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space(conv_col), F.lit(":"), space(turn_col)).cast("binary")) % 20
    made = rows.select(conv_col, turn_col, space(role_col).alias(role_col), space(text_col).alias(text_col), kind.alias("_kind")).filter("_kind <> 0")
    k: Column = F.col("_kind")
    text = F.when(k == 1, "").when(k == 2, F.regexp_replace(text_col, "[.!?]", "")).otherwise(F.col(text_col))
    made = made.withColumns({role_col: F.when(k == 4, "user").otherwise(F.col(role_col)), text_col: text})
    return made.withColumn("_kind", F.explode(F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_kind")
