"""Conversations repaired at the least cost to a legal order of turns, and rendered.

Legal: an optional system turn, then user and assistant in turn, ending with the assistant.
Method: dynamic programming over the automaton of the last role (none, system, user, assistant).
Each turn keeps its role or is relabelled, and then joins the turn before it if that has the same
role, or follows it, with as many empty turns inserted as the automaton needs. Costs: a merge 1, a
relabel 2, an inserted empty turn 3. Merges may be of relabelled turns. Nothing is ever dropped.

A conversation is cut into blocks of ``BLOCK`` turns by position. A block is reduced to a table of
16 costs, from each last role to each; these tables, one row for each block, give the role at every
block's ends, and then each block finds its own turns' roles. So a conversation of any length costs
a task no more than a block of its turns or the tables of its blocks. Ties: a block's ends take the
earliest role in the automaton's order; within a block a turn keeps its role if it can, else takes
the earliest, from the front.

Defined results: turns are ordered by ``turn`` (null first), then by role and text; equal rows are
turns of their own. A null text is empty; a role is compared without case and outer white space,
and any but the three counts as a role to relabel. A null conv_id is a conversation of its own, to which
the smallest long, -2**63, counts too. A block of very long turns lies whole in one task.
Other columns are not read. One row for each block: its part of the rendered conversation, which
in order make up the whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.tables import NO_ID
from tallyroll.operators.numbering import number_rows

ROLES = ("system", "user", "assistant")
MERGE, RELABEL, INSERT = 1, 2, 3
BLOCK = 1000
# Turns, and bytes of their texts, that a task's function sees at once, about; one block at least.
CELL_TURNS, CELL_BYTES = 20_000, 16 << 20
NEVER = 1 << 40
# Last role: 0 none, 1 system, 2 user, 3 assistant. Which roles may follow each.
FOLLOWS = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
COSTS = "conv long, block long, costs array<long>"
TURNS = "conv_id long, block long, n_turns long, n_merged long, n_relabelled long, n_inserted long, cost long, rendered string, rendered_sha256 string"


def _ways() -> dict[tuple[int, int], list[int]]:
    """From last role to role: the empty turns to insert on the shortest legal way."""
    out = {}
    for start in FOLLOWS:
        front, seen = [(start, [])], set()
        while front:
            node, way = front.pop(0)
            for role in FOLLOWS[node]:
                if (start, role) not in out:
                    out[start, role] = way
                if role not in seen:
                    seen.add(role)
                    front.append((role, [*way, role]))
    return out


WAYS = _ways()
# Cost of a turn with a given role after each last role, and of the end.
STEP = np.array([[NEVER] + [min(MERGE if s == r else NEVER, INSERT * len(WAYS[s, r]) if (s, r) in WAYS else NEVER) for r in (1, 2, 3)] for s in range(4)])
END = np.array([0, *(0 if s == 3 else INSERT * (len(WAYS[s, 3]) + 1) for s in (1, 2, 3))])


def role_number(role: str | None) -> int:
    name = (role or "").strip().lower()
    return ROLES.index(name) + 1 if name in ROLES else 0


def turn_costs(role: int) -> np.ndarray:
    """From each last role to each, by one turn."""
    return np.minimum(STEP + np.array([NEVER, *(0 if r == role else RELABEL for r in (1, 2, 3))]), NEVER)


TURN = np.stack([turn_costs(r) for r in range(4)])
PLAIN = TURN.tolist()


def meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Costs of one stretch after another."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), NEVER)


def block_costs(roles: list[int]) -> np.ndarray:
    """From each last role to each, by a block of turns."""
    out = np.where(np.eye(4, dtype=bool), 0, NEVER)
    for role in roles:
        out = meet(out, TURN[role])
    return out


def repaired(roles: list[int], start: int, stop: int) -> list[int]:
    """The role of each turn on the cheapest way from the last role ``start`` to ``stop``."""
    to_go = [[0 if r == stop else NEVER for r in range(4)]]
    for role in reversed(roles):
        rest = to_go[-1]
        to_go.append([min(c + r for c, r in zip(row, rest, strict=True)) for row in PLAIN[role]])
    out, at = [], start
    for role, rest in zip(roles, reversed(to_go[:-1]), strict=True):
        total = [c + r for c, r in zip(PLAIN[role][at], rest, strict=True)]
        best = min(total)
        at = role if role and total[role] == best else total.index(best)
        out.append(at)
    return out


def render(texts: list[str], roles: list[int], chosen: list[int], start: int, last: bool) -> tuple[str, int, int, int]:
    """A block's part of the text; merged, relabelled and inserted turns."""
    parts, merged, inserted, at = [], 0, 0, start

    def open_turn(role: int) -> None:
        parts.append(("" if at == 0 else "\n<|end|>\n") + f"<|{ROLES[role - 1]}|>\n")

    for text, role in zip(texts, chosen, strict=True):
        if role == at:
            parts.append("\n")
            merged += 1
        else:
            for empty in WAYS[at, role]:
                open_turn(empty)
                at, inserted = empty, inserted + 1
            open_turn(role)
            at = role
        parts.append(text)
    if last:
        while at not in (0, 3):
            at = WAYS[at, 3][0] if WAYS[at, 3] else 3
            parts.append(f"\n<|end|>\n<|{ROLES[at - 1]}|>\n")
            inserted += 1
        parts.append("\n<|end|>\n" if at else "")
    return "".join(parts), merged, sum(a != b for a, b in zip(roles, chosen, strict=True)), inserted


def _sorted(table: pa.Table, *by: str) -> tuple[pa.Table, np.ndarray]:
    """Rows in order, and where each group of equal values in all but the last column begins, with the end."""
    keys = [table.column(c).to_numpy() for c in by]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order) + 1, bool)
    new[[0, -1]] = True
    for key in keys[:-1]:
        new[1:-1] |= key[order[1:]] != key[order[:-1]]
    return table.take(pa.array(order)), np.flatnonzero(new) if len(order) else np.zeros(1, np.int64)


def chat_format(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``conv_id, block, n_turns, n_merged, n_relabelled, n_inserted, cost, rendered, rendered_sha256``."""
    read = conversations.select(
        F.coalesce(F.col(f"`{conv_col}`").cast("long"), F.lit(NO_ID)).alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    numbered = number_rows(read, ["conv"], [F.col(c) for c in ("turn", "role", "text")]).withColumn("block", F.floor((F.col("row_no") - 1) / block).cast("long"))
    # Many short conversations go through a task's function together. Blocks are bounded, so cells of them are.
    least = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    size = numbered.agg(F.count("*").alias("turns"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    n = max(least, -(-size.turns // CELL_TURNS), -(-size.bytes // CELL_BYTES))
    numbered = numbered.withColumn("cell", F.pmod(F.xxhash64("conv", "block"), F.lit(n)).cast("int"))

    def costs(table: pa.Table) -> pa.Table:
        table, edges = _sorted(table, "conv", "block", "row_no")
        roles = [role_number(r) for r in table.column("role").to_pylist()]
        found = [block_costs(roles[a:b]).ravel().tolist() for a, b in zip(edges, edges[1:], strict=False)]
        firsts = table.select(["conv", "block"]).take(pa.array(edges[:-1]))
        return firsts.append_column("costs", pa.array(found, pa.list_(pa.int64())))

    def ends(table: pa.Table) -> pa.Table:
        """Last role before and after each block, conversation by conversation."""
        table, edges = _sorted(table, "conv", "block")
        tables = np.array(table.column("costs").to_pylist(), np.int64).reshape(-1, 4, 4)
        starts, stops, lasts = [], [], []
        for a, b in zip(edges, edges[1:], strict=False):
            to_go = [END]
            for one in tables[a:b][::-1]:
                to_go.append((one + to_go[-1][None, :]).min(axis=1))
            at = 0
            for one, rest in zip(tables[a:b], to_go[-2::-1], strict=True):
                new = int(np.argmin(one[at] + rest))
                starts.append(at)
                stops.append(new)
                at = new
            lasts += [False] * int(b - a - 1) + [True]
        columns = [table.column("conv"), table.column("block"), pa.array(starts, pa.int32()), pa.array(stops, pa.int32()), pa.array(lasts, pa.bool_())]
        return pa.table(columns, names=["conv", "block", "start", "stop", "last"])

    def write(table: pa.Table, around: pa.Table) -> pa.Table:
        table, edges = _sorted(table, "conv", "block", "row_no")
        known = dict(zip(zip(around.column("conv").to_pylist(), around.column("block").to_pylist(), strict=True), zip(*(around.column(c).to_pylist() for c in ("start", "stop", "last")), strict=True), strict=True))
        convs, numbers, texts = (table.column(c).to_pylist() for c in ("conv", "block", "text"))
        roles = [role_number(r) for r in table.column("role").to_pylist()]
        rows = []
        for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
            start, stop, last = known[convs[a], numbers[a]]
            own = roles[a:b]
            text, merged, relabelled, inserted = render(texts[a:b], own, repaired(own, start, stop), start, last)
            conv = None if convs[a] == NO_ID else convs[a]
            rows.append((conv, numbers[a], b - a, merged, relabelled, inserted, MERGE * merged + RELABEL * relabelled + INSERT * inserted, text, hashlib.sha256(text.encode()).hexdigest()))
        names = [part.split()[0] for part in TURNS.split(", ")]
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        return pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)

    tables = numbered.select("cell", "conv", "block", "row_no", "role").groupBy("cell").applyInArrow(costs, COSTS)
    of_conversation = F.pmod(F.xxhash64("conv"), F.lit(n)).cast("int")
    around = tables.withColumn("cell", of_conversation).groupBy("cell").applyInArrow(ends, "conv long, block long, start int, stop int, last boolean")
    around = around.withColumn("cell", F.pmod(F.xxhash64("conv", "block"), F.lit(n)).cast("int"))
    return numbered.groupBy("cell").cogroup(around.groupBy("cell")).applyInArrow(write, TURNS)
