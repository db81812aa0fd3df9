"""A Merkle manifest of a table: a tree for each group, a tree over the groups' roots, a proof for each row.

H is the lowercase hex SHA-256 of its inputs put together; digests go in as hex text. A leaf is H of a
row's fields, each ``-`` if null, else its number of UTF-8 bytes, ``:`` and the value. In a group leaves
stand in order; while there is more than one node, every ``FANOUT`` consecutive ones (the last run may be
shorter, even one) become their H. What remains is the group's root; the roots, in the order of the
groups, become one root in the same way.

Butterfly exchange: the leaves of a group are dealt to aligned chunks of ``CHUNK`` leaves, a power of the
fan-out. A chunk computes its own subtree. Then chunks swap subtree roots round by round: in round r
the chunk numbers are taken as digits to the base ``SWAP``; the ``SWAP`` chunks that differ in digit r only
meet, each with the root of its own subtree of ``SWAP**r`` chunks, and each computes the
nodes above, all of them the same. So every chunk gets the siblings on its own way up and at last the
group's root, without a pass from the root down, and what meets is ``SWAP`` rows at most. At the end of a
group a subtree may have fewer chunks than the others: its chunks then also stand in for the missing ones, so
that all partners meet one of them. The rows of a round are at most twice the chunks. The tree
over the groups' roots is made by the same function, so any number of groups will do.

Positions come from ``number_rows``, so a group of any size is spread over the cluster; chunks are of
one size, whatever the group. Texts are hashed where they are read and never shuffled.

Defined results: a row for each input row, repeated rows too, each a leaf of its own. Leaves of a
group are ordered by id (null first), then by digest; groups by name in UTF-8 bytes, null first. A null or empty field differs
(``-`` and ``0:``). A very long text is hashed whole in the JVM. Other columns are not read. No rows: no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.operators.joins import lookup_join
from tallyroll.operators.numbering import number_rows
from tallyroll.session import settle

FANOUT = 2
# Leaves of a chunk and chunks that swap roots in a round: powers of the fan-out.
CHUNK = 1024
SWAP = 16
# Leaves or swapped rows that a task's function sees at once, about.
CELL_ROWS = 8192
STEP = "struct<before:string,after:string>"
STATE = f"grp string, chunk long, leaves long, root string, above array<{STEP}>"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts), 256)


def leaf(*values: Column) -> Column:
    return digest(*map(field, values))


def fold(start: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(steps, start, lambda node, step: digest(step["before"], node, step["after"]))


def proof_digest(steps: Column) -> Column:
    """H of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(n: int, fanout: int) -> int:
    """Levels above ``n`` nodes."""
    up = 0
    while n > 1:
        n, up = -(-n // fanout), up + 1
    return up


def climb(nodes: list[str], levels: int, fanout: int) -> tuple[list[tuple[list[str], list[str]]], str]:
    """For each of ``levels`` levels what stands before and after each node in its run; and the node they all lead to."""
    out = []
    for _ in range(levels):
        before, after, up = [], [], []
        for a in range(0, len(nodes), fanout):
            run = nodes[a : a + fanout]
            before += ["".join(run[:i]) for i in range(len(run))]
            after += ["".join(run[i + 1 :]) for i in range(len(run))]
            up.append(h("".join(run)))
        out.append((before, after))
        nodes = up
    return out, nodes[0]


def _log(n: int, base: int) -> int:
    """Exact logarithm of a power."""
    found = height(n, base)
    if base**found != n:
        raise ValueError(f"{n} is no power of {base}")
    return found


def _steps(before: Sequence, after: Sequence, lengths: Sequence[int]) -> pa.Array:
    """Lists of steps from flat sequences."""
    flat = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], names=["before", "after"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), flat)


def _runs(table: pa.Table, *by: str) -> tuple[pa.Table, np.ndarray]:
    """Rows sorted by ``by``, and the edges of the runs that agree in all but the last of these columns."""
    table = table.sort_by([(c, "ascending") for c in by])
    new = np.zeros(table.num_rows + 1, bool)
    new[[0, -1]] = True
    for c in by[:-1]:
        codes = table.column(c).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        new[1:-1] |= codes[1:] != codes[:-1]
    return table, np.flatnonzero(new)


def _cell(n: int, *of: str) -> Column:
    return F.pmod(F.xxhash64(*of), F.lit(n)).cast("int")


def _chunked(leaves: DataFrame, chunk: int) -> tuple[DataFrame, DataFrame, int, int]:
    """Leaves with their chunk and cell; leaves of each group; cells; leaves of the largest group."""
    sizes = leaves.groupBy("grp").agg((F.max("pos") + 1).alias("size"))
    # One row.
    total, largest = sizes.agg(F.sum("size"), F.max("size")).first()
    cells = max(int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(total or 0) // CELL_ROWS))
    placed = leaves.withColumn("chunk", F.expr(f"pos div {chunk}"))
    return placed.withColumn("cell", _cell(cells, "grp", "chunk")), sizes, cells, largest or 0


def _levels(number: int, n: int, fanout: int, chunk: int) -> int:
    """Levels inside a chunk of ``n`` leaves. A group of a single chunk ends there."""
    return height(n, fanout) if number == 0 and n < chunk else _log(chunk, fanout)


def subtrees(leaves: DataFrame, fanout: int = FANOUT, chunk: int = CHUNK, swap: int = SWAP) -> DataFrame:
    """``grp, chunk, leaves, root, above`` of each chunk of ``leaves`` (grp string, pos long from 0, leaf string, not null):
    its group's root and the siblings on the way from the chunk's own root to that one."""
    in_swap = _log(swap, fanout)
    chunked, sizes, _, largest = _chunked(leaves.select("grp", "pos", "leaf"), chunk)

    def roots(table: pa.Table) -> pa.Table:
        table, edges = _runs(table, "grp", "chunk", "pos")
        nodes, numbers = table.column("leaf").to_pylist(), table.column("chunk").to_pylist()
        found = [climb(nodes[a:b], _levels(numbers[a], b - a, fanout, chunk), fanout)[1] for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False)]
        firsts = table.select(["grp", "chunk"]).take(pa.array(edges[:-1]))
        return firsts.append_column("leaves", pa.array(np.diff(edges), pa.int64())).append_column("root", pa.array(found, pa.string())).append_column("above", _steps([], [], [0] * len(found)))

    state = settle(chunked.groupBy("cell").applyInArrow(roots, STATE), "merkle-chunks")
    state = lookup_join(state, sizes.select("grp", F.expr(f"(size + {chunk - 1}) div {chunk}").alias("chunks")), ["grp"], ["chunk"])
    least = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for r in range(height(-(-largest // chunk), swap)):
        state = _round(state, swap**r, swap, in_swap, fanout, least)
    return settle(state.drop("chunks"), "merkle-state")


def with_steps(leaves: DataFrame, above: DataFrame, fanout: int = FANOUT, chunk: int = CHUNK) -> DataFrame:
    """``leaves`` with ``root`` and all ``steps`` to it; ``above`` has ``grp, chunk, root, above`` and may have more strings."""
    chunked, _, cells, _ = _chunked(leaves, chunk)
    kept, more = leaves.columns, [c for c in above.columns if c not in ("grp", "chunk", "leaves", "above")]

    def own(table: pa.Table, uppers: pa.Table) -> pa.Table:
        table, edges = _runs(table, "grp", "chunk", "pos")
        groups, numbers, nodes = (table.column(c).to_pylist() for c in ("grp", "chunk", "leaf"))
        place = {key: i for i, key in enumerate(zip(uppers.column("grp").to_pylist(), uppers.column("chunk").to_pylist(), strict=True))}
        over, before, after, lengths, of = uppers.column("above").to_pylist(), [], [], [], []
        for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
            up, at = climb(nodes[a:b], _levels(numbers[a], b - a, fanout, chunk), fanout)[0], place[groups[a], numbers[a]]
            lefts, rights = [step["before"] for step in over[at]], [step["after"] for step in over[at]]
            for i in range(b - a):
                for left, right in up:
                    before.append(left[i])
                    after.append(right[i])
                    i //= fanout
                before += lefts
                after += rights
            lengths += [len(up) + len(lefts)] * (b - a)
            of += [at] * (b - a)
        columns = [table.column(c) for c in kept] + [uppers.column(c).take(pa.array(of, pa.int64())) for c in more]
        return pa.table([*columns, _steps(before, after, lengths)], names=[*kept, *more, "steps"])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in leaves.schema), *(f"{c} string" for c in more), f"steps array<{STEP}>"])
    uppers = above.withColumn("cell", _cell(cells, "grp", "chunk"))
    return chunked.groupBy("cell").cogroup(uppers.groupBy("cell")).applyInArrow(own, schema)


def _round(state: DataFrame, width: int, swap: int, in_swap: int, fanout: int, least: int) -> DataFrame:
    """One round: ``width`` chunks make up a subtree so far, ``swap`` subtrees the next one."""
    digit, offset = F.expr(f"(chunk div {width}) % {swap}"), F.expr(f"chunk % {width}")
    # Members of the own subtree; a short one stands in for those it lacks, unless it has no partner.
    members = F.least(F.lit(width), F.col("chunks") - (F.col("chunk") - offset))
    served = F.when((members < width) & (digit > 0), F.sequence(offset, F.lit(width - 1).cast("long"), members)).otherwise(F.array(offset))
    sent = state.select("*", digit.alias("digit"), offset.alias("offset"), F.expr(f"chunk div {width * swap}").alias("meet"), F.explode(served).alias("at"))
    own = F.col("at") == F.col("offset")
    sent = sent.withColumn("above", F.when(own, F.col("above"))).withColumn("chunk", F.when(own, F.col("chunk"))).drop("offset")
    cells = F.greatest(F.lit(least), F.expr(f"chunks div {CELL_ROWS}"))
    sent = sent.withColumn("cell", F.pmod(F.xxhash64("grp", "meet", "at"), cells))

    def meet(table: pa.Table) -> pa.Table:
        table, edges = _runs(table, "grp", "meet", "at", "digit")
        roots, own, above = table.column("root").to_pylist(), table.column("chunk").to_pylist(), table.column("above").to_pylist()
        chunks, meets = table.column("chunks").to_pylist(), table.column("meet").to_pylist()
        rows, news, before, after, lengths = [], [], [], [], []
        for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
            alone = meets[a] == 0 and chunks[a] <= width * swap
            up, top = climb(roots[a:b], height(b - a, fanout) if alone else in_swap, fanout)
            for i in range(a, b):
                if own[i] is None:
                    continue
                rows.append(i)
                news.append(top)
                old, at = above[i], i - a
                before += [step["before"] for step in old]
                after += [step["after"] for step in old]
                for left, right in up:
                    before.append(left[at])
                    after.append(right[at])
                    at //= fanout
                lengths.append(len(old) + len(up))
        kept = table.select(["grp", "chunk", "leaves"]).take(pa.array(rows, pa.int64()))
        columns = [*kept.columns, pa.array(news, pa.string()), _steps(before, after, lengths), table.column("chunks").take(pa.array(rows, pa.int64()))]
        return pa.table(columns, names=["grp", "chunk", "leaves", "root", "above", "chunks"])

    return sent.groupBy("cell").applyInArrow(meet, f"{STATE}, chunks long")


def manifest(leaves: DataFrame, fanout: int = FANOUT, chunk: int = CHUNK, swap: int = SWAP) -> DataFrame:
    """``leaves`` (id, grp, leaf and other columns) with ``subroot``, ``root`` and ``steps``, the siblings from each leaf to the root."""
    # A null group sorts before all others and still equals itself in joins.
    named = leaves.withColumn("grp", F.coalesce(F.concat(F.lit("="), F.col("grp")), F.lit("")))
    numbered = number_rows(named, ["grp"], [F.col("id").asc_nulls_first(), F.col("leaf")]).withColumn("pos", F.col("row_no") - 1).drop("row_no")
    chunks = subtrees(numbered, fanout, chunk, swap)
    # The groups' roots are the leaves of one more tree.
    tops = number_rows(chunks.where("chunk = 0").select(F.lit("").alias("all"), "grp", F.col("root").alias("leaf")), ["all"], [F.col("grp")])
    tops = settle(tops.select(F.lit("").alias("grp"), (F.col("row_no") - 1).alias("pos"), "leaf", F.col("grp").alias("name")), "merkle-tops")
    upper = with_steps(tops, subtrees(tops, fanout, chunk, swap).drop("leaves"), fanout, chunk)
    upper = settle(upper.select(F.col("name").alias("grp"), F.col("leaf").alias("subroot"), F.col("root").alias("top"), F.col("steps").alias("over")), "merkle-upper")
    above = lookup_join(chunks.select("grp", "chunk", "above"), upper, ["grp"], ["chunk"])
    above = above.select("grp", "chunk", "subroot", F.col("top").alias("root"), F.concat("above", "over").alias("above"))
    found = with_steps(numbered, above, fanout, chunk)
    return found.withColumn("grp", F.when(F.col("grp") != "", F.substring("grp", 2, 1 << 30))).drop("pos")


def document_leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``doc_id, id, grp, leaf, tampered_leaf``: leaves of documents, and of those that ``tampered`` picks with one more in n_chars."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    # Beyond the largest long too.
    more = [(c.cast("decimal(20,0)") + F.lit(1).cast("decimal(1,0)")).cast("decimal(20,0)") if i == 3 else c for i, c in enumerate(fields)]
    other = F.lit(None).cast("string") if tampered is None else F.when(tampered, leaf(*more))
    return docs.select("doc_id", F.col("doc_id").alias("id"), F.col("lang").cast("string").alias("grp"), leaf(*fields).alias("leaf"), other.alias("tampered_leaf"))


def merkle_digests(docs: DataFrame, every: int = 7, **sizes: int) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``; n_chars is tampered with where ``every`` divides the crc32 of the id."""
    picked = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0, F.lit(False)) & F.col("n_chars").isNotNull()
    found = manifest(document_leaves(docs, picked), **sizes)
    folded = fold(F.coalesce("tampered_leaf", "leaf"), F.col("steps"))
    out = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
