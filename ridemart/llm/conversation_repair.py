"""Conversation structure repair by the auction algorithm for shortest paths.

A conversation's rows in order, and the states of the role grammar
``(s?(ua)+)?``, span a lattice: an arc keeps, reroles or deletes the next row
or inserts an empty message, at an integer cost.  The cheapest repair is a
shortest path.  It is found by an auction (Bertsekas, 1991): every node has a
price, the path from the origin is extended to the neighbour with the best
arc cost plus price as long as the last node's price equals that, and
otherwise the last node's price is raised to it and the path contracts by one
node.  When the path reaches the end, prices are an optimal dual solution: the
arcs of every shortest path are tight (price equals cost plus next price), so
the tight arcs that lead to the end are exactly the cheapest repairs, and the
one with the least string of edits is traced along them.

Long conversations are cut into blocks of rows.  Blocks are solved from the
last to the first; the prices at a block's entry, converged for each state, are
the end costs of the block before, so no path runs back over more than a
block and the work grows with the number of rows.  A conversation is one row
of the result (its edits, its repaired messages), so it is the unit of work: a
task reads its sorted rows as a stream and holds one conversation at a time.

Edits: ``K`` keeps a row (0), ``R`` gives it the role user or assistant (3),
``D`` deletes it (4; the only edit of blank and duplicate rows), ``I`` inserts
an empty message (3); a truncated row that is not deleted adds 3.

Edge cases: a null role or text is one space; a null turn comes first; rows
with equal turns are taken by role, then text; repeated rows are duplicates of
the first; rows with a null conversation id are one conversation; a role whose
first letter is not s, u or a cannot be kept; a conversation without rows (see
``alive``) has zeros, no edits and no messages; an empty table gives an empty
result; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPACE = " \t\n\v\f\r"
BLANK, DUPLICATE, TRUNCATED, SOUND = "blank", "duplicate", "truncated", ""
_LEGAL = {"su", "ua", "au"}

REPAIRED_SCHEMA = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
                   "messages array<struct<role:string,text:string>>")

#: States of the grammar: nothing yet, after s, after u, after a; the next state by a role's initial.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_ENDS = (0, 3)
_NAMES = {"u": "user", "a": "assistant"}


@dataclass(frozen=True)
class RepairConfig:
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3
    block: int = 16


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, alive): rows dropped, blanked, cut short, repeated or reroled by a checksum of their place."""
    def printed(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(printed("conv_id"), F.lit(":"), printed("turn"))) % 20
    rows = conversations.select("conv_id", "turn", printed("role").alias("role"), printed("text").alias("text"), fate.alias("fate"))
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("fate") != 0).alias("alive"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")


def faults(rows: list[tuple[str, str]]) -> list[str]:
    """First fault of each (role, text) of a conversation."""
    out, seen = [], set()
    for role, text in rows:
        trimmed = text.strip(_SPACE)
        if not trimmed:
            out.append(BLANK)
        elif (role, text) in seen:
            out.append(DUPLICATE)
        else:
            out.append(SOUND if trimmed[-1] in ".!?" else TRUNCATED)
        seen.add((role, text))
    return out


def row_arcs(initial: str, fault: str, cfg: RepairConfig) -> list[list[tuple[str, int, int]]]:
    """Per state the arcs over one row: (edit, cost, next state)."""
    out = []
    for state in range(4):
        arcs = [("D", cfg.delete, state)]
        if fault in (SOUND, TRUNCATED):
            more = cfg.truncated if fault == TRUNCATED else 0
            if initial in _NEXT[state]:
                arcs.append(("K", more, _NEXT[state][initial]))
            arcs += [("R", cfg.rerole + more, to) for role, to in _NEXT[state].items() if role in _NAMES]
        out.append(arcs)
    return out


class Block:
    """The lattice of a run of rows: layers of four states, and an end reached from the last layer at given costs."""

    def __init__(self, rows: list[list[list[tuple[str, int, int]]]], end_costs: list[int | None], cfg: RepairConfig):
        n = len(rows)
        self.end = 4 * (n + 1)
        self.arcs: list[list[tuple[str, int, int]]] = []
        for i, row in enumerate(rows):
            for state in range(4):
                inserts = [("I", cfg.insert, 4 * i + to) for role, to in _NEXT[state].items() if role in _NAMES]
                self.arcs.append(inserts + [(edit, cost, 4 * (i + 1) + to) for edit, cost, to in row[state]])
        self.arcs += [[("", cost, self.end)] if cost is not None else [] for cost in end_costs]
        self.price = [0] * (self.end + 1)

    def auction(self, origin: int) -> int:
        """Raise prices until a path from ``origin`` reaches the end; its converged price is the distance."""
        arcs, price = self.arcs, self.price
        path = [origin]
        while path[-1] != self.end:
            last = path[-1]
            best, to = min(((cost + price[j], j) for _, cost, j in arcs[last]), default=(_NO_WAY, -1))
            if price[last] < best:
                price[last] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        return price[origin]

    def trace(self, origin: int) -> tuple[str, int]:
        """The least string of edits among all shortest paths, and the state in which it ends."""
        leads = [False] * (self.end + 1)
        leads[self.end] = True
        tight: list[list[tuple[str, int]]] = [[] for _ in self.arcs]
        into: list[list[int]] = [[] for _ in range(self.end + 1)]
        for i, arcs in enumerate(self.arcs):
            for edit, cost, j in arcs:
                if self.price[i] == cost + self.price[j]:
                    tight[i].append((edit, j))
                    into[j].append(i)
        stack = [self.end]
        while stack:
            for i in into[stack.pop()]:
                if not leads[i]:
                    leads[i] = True
                    stack.append(i)
        edits, node = [], origin
        while True:
            edit, to = min((edit, j) for edit, j in tight[node] if leads[j])
            if to == self.end:
                return "".join(edits), node % 4
            edits.append(edit)
            node = to


_NO_WAY = 1 << 60


def cheapest(initials: list[str], found: list[str], cfg: RepairConfig = RepairConfig()) -> tuple[int, str]:
    """(cost, edits) of the cheapest repair, the least string among equals."""
    rows = [row_arcs(a, f, cfg) for a, f in zip(initials, found)]
    # A row that only a finished grammar passes closes the lattice; inserts before it complete a turn.
    rows.append([[("", 0, s)] if s in _ENDS else [] for s in range(4)])
    cuts = list(range(0, len(rows), cfg.block))
    ends: list[int | None] = [0 if s in _ENDS else None for s in range(4)]
    blocks = []
    for at in reversed(cuts):
        block = Block(rows[at:at + cfg.block], ends, cfg)
        ends = [block.auction(s) for s in range(4 if at else 1)]
        if at:
            # Only differences matter to the block before; small ones keep its auction short.
            base = min(ends)
            blocks.append((block, base))
            ends = [e - base for e in ends]
        else:
            blocks.append((block, ends[0]))
    cost = sum(base for _, base in blocks)
    edits, state = [], 0
    for block, _ in reversed(blocks):
        part, state = block.trace(state)
        edits.append(part)
    return cost, "".join(edits)


def apply_edits(rows: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The repaired (role, text) messages; the grammar's state tells the role of an ``R`` or ``I``."""
    out, state = [], 0
    left = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(left)
        if edit == "D":
            continue
        if edit in "IR":
            role = next(name for initial, name in _NAMES.items() if initial in _NEXT[state])
        out.append((role, text))
        state = _NEXT[state][role[:1]]
    return out


def repaired(conv_id, turns: list[int | None], rows: list[tuple[str, str]], cfg: RepairConfig) -> tuple:
    """One result row of a conversation's rows in order."""
    known = {t for t in turns if t is not None}
    found = faults(rows)
    initials = [role[:1] for role, _ in rows]
    cost, audit = cheapest(initials, found, cfg)
    return (conv_id, max(known) - min(known) + 1 - len(known) if known else 0, *[found.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)],
            sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])), cost, audit,
            [{"role": r, "text": t} for r, t in apply_edits(rows, audit)])


_ARROW = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()),
                    ("messages", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])


def repair(rows: DataFrame, cfg: RepairConfig = RepairConfig(), out_rows: int = 1024) -> DataFrame:
    """The cheapest repair of every conversation: faults counted, cost, edits and repaired messages.

    ``rows`` has conv_id, turn, role and text; rows whose optional ``alive`` is
    false count for nothing but make their conversation known.
    """
    alive = F.col("alive") if "alive" in rows.columns else F.lit(True)
    taken = rows.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], alive.alias("alive"))
    # UTF-8 sorts by code point, so Spark's order of roles and texts is that of any other engine.
    taken = taken.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        turns: list[int | None] = []
        held: list[tuple[str, str]] = []
        current, begun = None, False

        def flushed() -> pa.RecordBatch:
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)

        for b in batches:
            for conv, turn, role, text, live in zip(*[c.to_pylist() for c in b.columns]):
                if begun and conv != current:
                    out.append(repaired(current, turns, held, cfg))
                    turns, held = [], []
                    if len(out) >= out_rows:
                        yield flushed()
                        out.clear()
                current, begun = conv, True
                if live:
                    turns.append(turn)
                    held.append((role, text))
        if begun:
            out.append(repaired(current, turns, held, cfg))
            yield flushed()

    return taken.mapInArrow(run, REPAIRED_SCHEMA)


def repair_report(repairs: DataFrame) -> DataFrame:
    """The repairs with a digest of their messages (``role:text``, one a line)."""
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"]))
    return repairs.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                          F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))
