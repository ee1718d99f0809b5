"""Conversation structure repair with Four-Russians block tables.

A conversation should read ``(s?(ua)+)?`` in role initials: an optional system turn, then user
and assistant in turn. Each row is kept (cost 0), given the role user or assistant (2), or
deleted (3); empty user or assistant turns may be inserted anywhere (2). Blank rows and
duplicates must go; a truncated row that stays costs 1 more. The audit is the string of edit
initials (D, I, K, R); of the cheapest edits the one whose audit comes first in ASCII is taken.

Four states (nothing yet, after s, after u, after a) and nine symbols (must go, or one of the
initials s, u, a, other, cut off or not) make the alignment a product of cost vectors.

* ``Tables`` holds, for every normalised cost vector (least entry 0) that can occur, the vector
  after each block of ``BLOCK`` symbols and what it adds. Any state can take over another
  state's way at 7 more at the most, so entries above that are dropped without losing a cheapest
  way, nor one of equal cost: the vectors are few. Blocks are processed by lookup.
* The trace goes through the blocks backward, expanding each one: from the cost to go after it,
  for each state the ASCII-least of the cheapest edits, the state after them and the cost to go
  before it. Expansions are remembered by block and normalised vector.

Rows are sorted in ranges of (conversation, turn, role, text), so a conversation of any size
lies over as many tasks as it fills; each cuts it into segments of bounded size and computes the
four cost vectors that a segment makes of the four states. Only those small vectors meet in one
group for each conversation of several segments, which gives every segment the cost to go behind
it and, after all segments are expanded in parallel, the state before it. Repeated rows are
counted before the sort. The digest alone reads a conversation in one task, one segment after
the other, as SHA-256 has to.

Nulls: in role and text read as one space; null turns come first; a null conversation id is an
id of its own. Rows of one turn are ordered by role, then by the SHA-256 of id, role and text. Repeated
rows stand side by side, so all but one are duplicates. A conversation without rows gets zeros,
an empty audit and the empty string's hash; an empty table gives an empty result. Texts may be
of any length. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import sys
import types
from collections.abc import Iterator
from functools import reduce
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankfold.llm.common import WHITE_SPACE, ship_by_value, written

ship_by_value(__name__)

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1  # costs
EMPTY, SYSTEM, USER, ASSISTANT = STATES = range(4)
TURN = (USER, USER, ASSISTANT, USER)       # the state after a user or assistant turn
LEGAL = {"su", "ua", "au"}                 # neighbouring initials
SPOKEN = {USER: "user", ASSISTANT: "assistant"}
OPEN = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
MUST_GO, SYMBOLS = 0, 9
INITIALS = "sua?"                          # ? for every other initial
DEAD = 99
APART = 7                                  # no state is worth keeping that costs so much more than another
TO_END = (0, 4, 2, 0)                      # least cost from a state to a legal end
BLOCK = 4
SEGMENT_ROWS = 4096
SEGMENT_CHARACTERS = 1 << 18


def symbol(initial: str, cut_off: bool) -> int:
    return 1 + 2 * (INITIALS.index(initial) if initial in INITIALS[:3] and initial else 3) + cut_off


def moves(sym: int) -> list[tuple[str, int, tuple]]:
    """(edit, cost, state after it for each state or None) of a row, in ASCII order."""
    out = [("D", DELETE, STATES)]
    if sym != MUST_GO:
        initial, extra = INITIALS[(sym - 1) // 2], CUT_OFF * ((sym - 1) % 2)
        out.append(("K", KEEP + extra, tuple(OPEN.get(initial, {}).get(q) for q in STATES)))
        out.append(("R", REROLE + extra, TURN))
    return out


MOVES = [moves(s) for s in range(SYMBOLS)]


def with_inserts(costs: list[int]) -> list[int]:
    """Costs of the states when turns may be inserted here."""
    c = list(costs)
    for _ in range(2):
        for q in STATES:
            c[TURN[q]] = min(c[TURN[q]], c[q] + INSERT)
    return c


def normal(costs: list[int]) -> tuple[tuple[int, ...], int]:
    least = min(costs)
    return tuple(c - least if c - least <= APART else DEAD for c in costs), least


def step(costs: tuple[int, ...], sym: int) -> list[int]:
    """Costs of the states after a row."""
    out = [DEAD] * 4
    for _, cost, after in MOVES[sym]:
        for q, to in enumerate(after):
            if to is not None:
                out[to] = min(out[to], costs[q] + cost)
    return with_inserts(out)


class Tables:
    """Normalised cost vectors and their transitions by symbol and by block of symbols."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        starts = [normal(with_inserts([0 if q == s else DEAD for q in STATES])) for s in STATES]
        self.vectors: list[tuple[int, ...]] = []
        number: dict[tuple[int, ...], int] = {}

        def known(vector):
            if vector not in number:
                number[vector] = len(self.vectors)
                self.vectors.append(vector)
            return number[vector]

        self.start = [known(v) for v, _ in starts]
        steps, at = [], 0
        while at < len(self.vectors):
            steps.append([normal(step(self.vectors[at], s)) for s in range(SYMBOLS)])
            for v, _ in steps[-1]:
                known(v)
            at += 1
        to = np.array([[number[v] for v, _ in row] for row in steps])
        add = np.array([[a for _, a in row] for row in steps])
        whole, gain = to, add
        for _ in range(block - 1):  # one symbol more: look up the vector so far
            gain = (gain[:, :, None] + add[whole]).reshape(len(to), -1)
            whole = to[whole].reshape(len(to), -1)
        # plain lists: single numbers are read one after the other
        self.symbol_to, self.symbol_add, self.to, self.add = to.tolist(), add.tolist(), whole.tolist(), gain.tolist()
        self.place = SYMBOLS ** np.arange(block - 1, -1, -1)
        self.expanded: dict[tuple[bytes, tuple], tuple] = {}

    def forward(self, symbols: bytes, state: int = EMPTY) -> list[int]:
        """Costs of the four states after ``symbols``, beginning in ``state``; block by block."""
        s, n = np.frombuffer(symbols, np.uint8), len(symbols) // self.block
        v, total = self.start[state], 0
        for code in (s[:n * self.block].reshape(n, self.block) @ self.place).tolist():
            total += self.add[v][code]
            v = self.to[v][code]
        for code in symbols[n * self.block:]:
            total += self.symbol_add[v][code]
            v = self.symbol_to[v][code]
        return [total + c if c < DEAD else -1 for c in self.vectors[v]]

    def expand(self, symbols: bytes, to_go: tuple[int, ...]) -> tuple:
        """One block and the normalised cost to go after it: for each state the ASCII-least of the
        cheapest edits, the state after them; and the cost to go before the block, normalised."""
        key = symbols, to_go
        if key not in self.expanded:
            if len(self.expanded) > 200_000:
                self.expanded.clear()
            costs = [to_go]
            for s in reversed(symbols):
                row = [min(cost + costs[-1][to] for _, cost, after in MOVES[s] if (to := after[q]) is not None) for q in STATES]
                for _ in range(2):
                    row = [min(row[q], INSERT + row[TURN[q]]) for q in STATES]
                costs.append(row)
            edits, ends = [], []
            for q in STATES:
                done, i = "", len(symbols)
                while i:
                    left = costs[i][q]
                    ways = [(e, i - 1, to) for e, cost, after in MOVES[symbols[len(symbols) - i]]
                            if (to := after[q]) is not None and cost + costs[i - 1][to] == left]
                    if INSERT + costs[i][TURN[q]] == left:
                        ways.append(("I", i, TURN[q]))
                    e, i, q = min(ways)
                    done += e
                edits.append(done)
                ends.append(q)
            least = min(costs[-1])
            self.expanded[key] = tuple(edits), tuple(ends), tuple(c - least for c in costs[-1])
        return self.expanded[key]

    def backward(self, symbols: bytes, to_go: tuple[int, ...]) -> list[tuple]:
        """The expansions of all blocks, first block first. ``to_go`` is the cost to go after them."""
        out = []
        n = len(symbols) // self.block * self.block
        cuts = [*range(0, n, self.block), *range(n, len(symbols))]
        for a in reversed(cuts):
            out.append(self.expand(symbols[a:a + (self.block if a < n else 1)], to_go))
            to_go = out[-1][2]
        return out[::-1]


def trace(blocks: list[tuple], state: int) -> tuple[str, int]:
    """Edits through expanded blocks from ``state``, and the state after them."""
    parts = []
    for edits, ends, _ in blocks:
        parts.append(edits[state])
        state = ends[state]
    return "".join(parts), state


def ending(state: int) -> str:
    return "I" * (TO_END[state] // INSERT)


def apply(audit: str, symbols: bytes, roles: list[str], texts: list[str], state: int) -> tuple[list[str], list[str], int]:
    """Roles and texts after the edits, and their cost; ``roles`` and ``texts`` are those of the
    rows that need not go."""
    said, spoken, cost, row, kept = [], [], 0, 0, 0
    for e in audit:
        sym = MUST_GO if e == "I" else symbols[row]
        if e == "I":
            said.append(SPOKEN[TURN[state]])
            spoken.append("")
            state, cost = TURN[state], cost + INSERT
            continue
        if e == "D":
            cost += DELETE
        else:
            said.append(roles[kept] if e == "K" else SPOKEN[TURN[state]])
            spoken.append(texts[kept])
            cost += CUT_OFF * ((sym - 1) % 2) + (KEEP if e == "K" else REROLE)
            state = OPEN[INITIALS[(sym - 1) // 2]][state] if e == "K" else TURN[state]
        row, kept = row + 1, kept + (sym != MUST_GO)
    return said, spoken, cost


class Rows:
    """Result rows gathered to Arrow batches of up to ``n`` rows or ``characters`` of text."""

    def __init__(self, names: list[str], kinds: list[pa.DataType], n: int = 1000, characters: int = 1 << 24):
        self.names, self.kinds, self.n, self.characters = names, kinds, n, characters
        self.columns, self.size = [[] for _ in names], 0

    def add(self, *values, size: int = 0) -> Iterator[pa.RecordBatch]:
        for c, v in zip(self.columns, values):
            c.append(v)
        self.size += size
        if len(self.columns[0]) >= self.n or self.size >= self.characters:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.columns[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(self.columns, self.kinds)], names=self.names)
            self.columns, self.size = [[] for _ in self.names], 0


def task_tables() -> Tables:
    """The worker process's tables; they outlive the task in a module of their own."""
    state = sys.modules.setdefault("rankfold_repair_state", types.ModuleType("rankfold_repair_state")).__dict__
    if "tables" not in state:
        state["tables"] = Tables()
    return state["tables"]


# ------------------------------------------------------------------ rows and their faults

def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def _blank(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE)) == ""


def _cut_off(text: Column) -> Column:
    return ~F.substring(F.rtrim(text, F.lit(WHITE_SPACE)), -1, 1).isin(".", "!", "?")


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: ``rows`` (nulls in role and text: one space) with faults
    by the crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties the text, 2 takes its
    ``.!?`` out, 3 repeats it, 4 makes it the user's."""
    fault = F.crc32(F.concat(_text(F.col("conv_id")), F.lit(":"), _text(F.col("turn"))).cast("binary")) % 20
    f, text = F.col("fault"), F.col("text")
    return (rows.select("conv_id", "turn", _text(F.col("role")).alias("role"), _text(F.col("text")).alias("text"), fault.alias("fault"))
            .filter(f != 0)
            .select("conv_id", "turn", F.when(f == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(f == 1, "").when(f == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                    F.when(f == 3, 2).otherwise(1).cast("long").alias("copies")))


def faults(rows: DataFrame) -> DataFrame:
    """The different rows of ``rows`` (conv_id, turn, role, text, copies) with their number of
    copies, ``mark``, and flags blank, repeated (role and text stand in an earlier turn) and cut_off."""
    mark = F.sha2(F.concat(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")), F.lit(":"),
                           F.length("role"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)
    # the first turn of each text needs no text: one more pass over the rows, not a table of them
    first = (rows.groupBy(mark.alias("first_mark"), "turn").agg(F.lit(1).alias("one")).groupBy("first_mark")
             .agg(F.max(F.col("turn").isNull()).alias("any_null"), F.min("turn").alias("least_turn"), F.count(F.lit(1)).alias("turns"))
             .filter(F.col("turns") > 1).drop("turns"))
    different = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn("mark", mark)
    later = F.col("turn").isNotNull() & (F.col("any_null") | (F.col("least_turn") < F.col("turn")))
    return (different.join(first, F.col("mark") == F.col("first_mark"), "left")
            .select("conv_id", "turn", "role", "text", "copies", "mark", _blank(F.col("text")).alias("blank"),
                    F.coalesce(later, F.lit(False)).alias("repeated"), _cut_off(F.col("text")).alias("cut_off")))


def symbol_of(blank: Column, repeated: Column, role: Column, cut_off: Column) -> Column:
    initial = F.substring(role, 1, 1)
    base = F.when(initial == "s", symbol("s", False)).when(initial == "u", symbol("u", False)).when(
        initial == "a", symbol("a", False)).otherwise(symbol("?", False))
    return F.when(blank | repeated, MUST_GO).otherwise(base + cut_off.cast("int")).cast("int")


# ------------------------------------------------------------------ segments

PLACE = "conv_id", "part", "segment"


def segments(marked: DataFrame) -> DataFrame:
    """Sorted runs of each conversation's rows: symbols of all rows, roles and texts of those that
    need not go, the cost vectors of the four states (-1: dropped), pairs of neighbours in an
    illegal order, first and last initial."""
    kind = marked.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, part, number = task_tables(), TaskContext.get().partitionId(), 0
        held, symbols, roles, texts, illegal, ends, size, out = None, bytearray(), [], [], 0, ["", ""], 0, None

        def cut() -> Iterator[pa.RecordBatch]:
            nonlocal number, symbols, roles, texts, illegal, size
            done = bytes(symbols)
            costs = [c for q in STATES for c in tables.forward(done, q)]
            yield from out.add(held, part, number, done, roles, texts, costs, illegal, *ends, size=size)
            number += 1
            symbols, roles, texts, illegal, size = bytearray(), [], [], 0, 0

        for b in batches:
            out = out or Rows(names, [b.column("conv_id").type, pa.int32(), pa.int64(), pa.binary(), strings, strings, pa.list_(pa.int64()),
                                      pa.int64(), pa.string(), pa.string()])
            for conv_id, role, text, copies, sym in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text", "copies", "sym"))):
                if symbols and (conv_id != held or size >= SEGMENT_CHARACTERS):
                    yield from cut()
                while copies:
                    if len(symbols) >= SEGMENT_ROWS:
                        yield from cut()
                    if not symbols:
                        held, ends = conv_id, [role[:1], role[:1]]
                    else:
                        illegal += ends[1] + role[:1] not in LEGAL
                    ends[1] = role[:1]
                    if sym != MUST_GO:
                        roles.append(role)
                        texts.append(text)
                        size += len(text)
                    # further copies are duplicates
                    more = min(copies - 1, SEGMENT_ROWS - 1 - len(symbols))
                    symbols += bytes([sym]) + bytes(more)
                    illegal += more
                    copies, sym = copies - 1 - more, MUST_GO
        if symbols:
            yield from cut()
        if out:
            yield from out.rest()

    shape = (f"conv_id {kind}, part int, segment long, symbols binary, roles array<string>, texts array<string>, costs array<long>, "
             "illegal long, first string, last string")
    names, strings = [c.split()[0] for c in shape.split(", ")], pa.list_(pa.string())
    order = ["conv_id", "turn", "role", "mark"]
    ready = marked.select(*order, "text", "copies", symbol_of(*map(F.col, ("blank", "repeated", "role", "cut_off"))).alias("sym"))
    dealt = ready.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("conv_id", "role", "text", "copies", "sym").mapInArrow(run, shape)


def costs_behind(several: DataFrame) -> DataFrame:
    """The cost to go after each segment, from the cost vectors of its conversation's segments."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["part", "segment"])
        to_go, out = TO_END, []
        for costs in reversed(group["costs"].tolist()):
            out.append(list(to_go))
            rows = [min(c + to_go[x] for x, c in enumerate(costs[4 * q:4 * q + 4]) if c >= 0) for q in STATES]
            to_go = tuple(c - min(rows) for c in rows)
        return pd.DataFrame({"part": group["part"], "segment": group["segment"], "to_go": out[::-1]})

    return several.select(*PLACE, "costs").groupBy("conv_id").applyInPandas(run, "part int, segment long, to_go array<long>")


def states_before(ended: DataFrame) -> DataFrame:
    """The state before each segment and whether it is the last, from where its four states end."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["part", "segment"])
        state, out = EMPTY, []
        for ends in group["ends"].tolist():
            out.append(state)
            state = int(ends[state])
        return pd.DataFrame({"part": group["part"], "segment": group["segment"], "state": out, "final": [False] * (len(group) - 1) + [True]})

    return ended.groupBy("conv_id").applyInPandas(run, "part int, segment long, state int, final boolean")


def repaired(marked: DataFrame) -> DataFrame:
    """The segments with their edits done: conv_id, part, segment, audit, cost, roles and texts
    after the repair, and for the pairs between segments illegal, first and last initial."""
    kind = marked.schema["conv_id"].dataType.simpleString()
    cut = written(segments(marked), "repair-segments")
    many = cut.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select(F.col("conv_id").alias("of"))
    several = cut.join(many, F.col("conv_id").eqNullSafe(F.col("of")), "left_semi")
    behind = written(costs_behind(several), "repair-behind")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = task_tables()
        for b in batches:
            ends = []
            for symbols, to_go in zip(b.column("symbols").to_pylist(), b.column("to_go").to_pylist()):
                blocks = tables.backward(symbols, tuple(to_go))
                ends.append([trace(blocks, q)[1] for q in STATES])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in PLACE), pa.array(ends, pa.list_(pa.int64()))], names=[*PLACE, "ends"])

    ended = several.select(*PLACE, "symbols").join(behind, ["part", "segment"]).select(*PLACE, "symbols", "to_go").mapInArrow(
        expand, f"conv_id {kind}, part int, segment long, ends array<long>")
    known = written(states_before(ended).join(behind, ["part", "segment"]), "repair-states")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = task_tables()
        for b in batches:
            audits, costs, roles, texts = [], [], [], []
            columns = (b.column(c).to_pylist() for c in ("symbols", "roles", "texts", "to_go", "state", "final"))
            for symbols, role, text, to_go, state, final in zip(*columns):
                audit, last = trace(tables.backward(symbols, TO_END if to_go is None else tuple(to_go)), state or EMPTY)
                audit += ending(last) if final is not False else ""
                said, spoken, cost = apply(audit, symbols, role, text, state or EMPTY)
                for c, v in zip((audits, costs, roles, texts), (audit, cost, said, spoken)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in (*PLACE, "illegal", "first", "last")), pa.array(audits, pa.string()), pa.array(costs, pa.int64()),
                 pa.array(roles, pa.list_(pa.string())), pa.array(texts, pa.list_(pa.string()))],
                names=[*PLACE, "illegal", "first", "last", "audit", "cost", "roles", "texts"])

    return cut.drop("costs").join(known, ["part", "segment"], "left").select(
        *PLACE, "illegal", "first", "last", "symbols", "roles", "texts", "to_go", "state", "final").mapInArrow(
        finish, f"conv_id {kind}, part int, segment long, illegal long, first string, last string, audit string, cost long, "
                "roles array<string>, texts array<string>")


def turns(done: DataFrame) -> DataFrame:
    """The repaired conversations, one row a turn: conv_id, (part, segment, turn) in order, role, text."""
    both = F.posexplode(F.arrays_zip("roles", "texts")).alias("turn", "t")
    return done.select(*PLACE, both).select(*PLACE, "turn", F.col("t.roles").alias("role"), F.col("t.texts").alias("text"))


class Digest:
    """What the segments of one conversation, in order, add up to."""

    def __init__(self, conv_id):
        self.conv_id, self.illegal, self.cost, self.audits, self.sha, self.last, self.lines = conv_id, 0, 0, [], hashlib.sha256(), None, 0

    def add(self, illegal: int, first: str, last: str, audit: str, cost: int, roles: list[str], texts: list[str]) -> None:
        self.illegal += illegal + (self.last is not None and self.last + first not in LEGAL)
        self.last, self.cost = last, self.cost + cost
        self.audits.append(audit)
        for line in zip(roles, texts):
            self.sha.update((("\n" if self.lines else "") + ":".join(line)).encode())
            self.lines += 1

    def row(self) -> tuple:
        return self.conv_id, self.illegal, self.cost, "".join(self.audits), self.sha.hexdigest()


def digests(done: DataFrame) -> DataFrame:
    """Per conversation illegal, cost, audit and the SHA-256 of its lines ``role:text``, one segment
    after the other."""
    kind = done.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = None, None
        for b in batches:
            out = out or Rows(names, [b.column("conv_id").type, pa.int64(), pa.int64(), pa.string(), pa.string()])
            columns = (b.column(c) for c in ("conv_id", "illegal", "first", "last", "audit", "cost", "roles", "texts"))
            for values in zip(*columns):
                conv_id, illegal, first, last, audit, cost, roles, texts = (v.as_py() for v in values)
                if held is None or conv_id != held.conv_id:
                    if held is not None:
                        yield from out.add(*held.row())
                    held = Digest(conv_id)
                held.add(illegal, first, last, audit, cost, roles, texts)
        if held is not None:
            yield from out.add(*held.row())
            yield from out.rest()

    shape = f"conv_id {kind}, illegal long, cost long, audit string, repaired_sha256 string"
    return done.repartition("conv_id").sortWithinPartitions(*PLACE).mapInArrow(run, shape)


def repair(rows: DataFrame, damage=damaged) -> DataFrame:
    """Every conversation of ``rows`` after ``damage``: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256."""
    marked = written(faults(damage(rows)), "repair-marked")
    n, blank, again, cut = F.col("copies"), F.col("blank"), F.col("repeated"), F.col("cut_off")
    counts = marked.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        F.sum(F.when(blank, n).otherwise(0)).alias("blank"),
        F.sum(F.when(blank, 0).otherwise(n - 1 + again.cast("int"))).cast("long").alias("duplicate"),
        F.sum((~blank & ~again & cut).cast("long")).alias("truncated"))
    found = [counts, digests(repaired(marked))]
    all_ids = rows.select("conv_id").distinct()
    def by_id(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed("conv_id", "right_id")
        return left.join(right, F.col("conv_id").eqNullSafe(F.col("right_id")), "left").drop("right_id")
    out = reduce(by_id, found, all_ids)
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def _oracle() -> str:
    """The repair by recursion over the rows of a conversation, last row first. Each state holds
    the least (cost, audit, lines) to the end: costs first, then the audit in ASCII order."""
    def way(cost, edit, line, after):
        lines = f"{after}.t" if line is None else f"list_prepend({line}, {after}.t)"
        return f"{{'c': {after}.c + {cost}, 'a': '{edit}' || {after}.a, 't': {lines}}}"

    dead = "{'c': 1000000000, 'a': '', 't': []::VARCHAR[]}"
    row, after = {}, {"e": "h.e", "s": "h.s", "u": "h.u", "a": "h.a"}
    nexts = {"e": ("u", "user"), "s": ("u", "user"), "u": ("a", "assistant"), "a": ("u", "user")}
    opens = {"e": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    for q in "esua":
        to, said = nexts[q]
        kept = "".join(f" WHEN r.initial = '{i}' THEN {way('r.cut', 'K', 'r.role || chr(58) || r.text', after[x])}" for i, x in opens[q].items())
        kept = f"CASE WHEN r.go THEN {dead}{kept} ELSE {dead} END"
        said_ = f"'{said}' || chr(58) || r.text"
        roled = f"CASE WHEN r.go THEN {dead} ELSE {way('r.cut + 2', 'R', said_, after[to])} END"
        row[q] = f"list_min([{way(3, 'D', None, after[q])}, {kept}, {roled}])"
    once = {q: f"list_min([b.{q}, {way(2, 'I', repr(nexts[q][1] + ':'), 'b.' + nexts[q][0])}])" for q in "esua"}
    twice = {q: f"list_min([b.{q}, {way(2, 'I', repr(nexts[q][1] + ':'), 'o.' + nexts[q][0])}])" for q in "esua"}
    end = ("{'c': 0, 'a': '', 't': []::VARCHAR[]} AS e, {'c': 4, 'a': 'II', 't': ['user:', 'assistant:']} AS s, "
           "{'c': 2, 'a': 'I', 't': ['assistant:']} AS u, {'c': 0, 'a': '', 't': []::VARCHAR[]} AS a")
    crc = ("xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(k, ''), "
           "lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) "
           "WHEN crc % 2 = 1 THEN xor(crc >> 1, 3988292384::BIGINT) ELSE crc >> 1 END), 4294967295::BIGINT)")
    return rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || chr(58) || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hit AS (SELECT *, {crc} % 20 AS f FROM keyed),
broken AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN f = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hit WHERE f <> 0),
numbered AS (
  SELECT *, row_number() OVER w AS n, substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER w AS before,
         regexp_replace(text, '[ 	-
]+$', '') AS body
  FROM broken WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
              sha256(coalesce('=' || CAST(conv_id AS VARCHAR), '') || ':' || length(role) || ':' || role || text), copy)),
marked AS (
  SELECT *, body = '' AS blank, body <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again
  FROM numbered),
r AS (
  SELECT *, blank OR again AS go, CAST(NOT blank AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS INTEGER) AS cut FROM marked),
h AS (
  SELECT conv_id, max(n) AS n, {end} FROM r GROUP BY conv_id
  UNION ALL
  SELECT conv_id, n, {', '.join(f'{twice[q]} AS {q}' for q in 'esua')} FROM (
    SELECT conv_id, n, b, {{{', '.join(f"'{q}': {once[q]}" for q in 'esua')}}} AS o FROM (
      SELECT h.conv_id, h.n - 1 AS n, {{{', '.join(f"'{q}': {row[q]}" for q in 'esua')}}} AS b
      FROM h JOIN r ON h.conv_id IS NOT DISTINCT FROM r.conv_id AND h.n = r.n))),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (again) AS duplicate, sum(cut) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(h.e.c, 0) AS BIGINT) AS cost, coalesce(h.e.a, '') AS audit,
       sha256(coalesce(array_to_string(h.e.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted k ON c.conv_id IS NOT DISTINCT FROM k.conv_id
LEFT JOIN h ON c.conv_id IS NOT DISTINCT FROM h.conv_id AND h.n = 0"""


ORACLE_SQL = _oracle()
