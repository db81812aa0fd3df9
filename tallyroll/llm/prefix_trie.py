"""The trie of all prefixes that conversations share.

A node of depth d is a distinct sequence of the first d turns (role and text) of some conversation; the root
has none. Conversations that start with it are its members.

Method: a turn is an id, 128 bits of the SHA-256 of role and text; a conversation is the row of its ids.
Rows are range-partitioned in the order of these rows, so a shard is a run of the sorted trie. A
shard puts its ids into padded matrices, ``COLUMNS`` turns wide, with only the rows that are
that long, and sorts by ``lexsort``; masks of the columns in which a row differs from the one before, OR-accumulated
from left to right, give how many turns the two share, and hence where nodes start at every
depth; ``reduceat`` over the starts sums up each depth, from the deepest up. A node that is no prefix of the
shard's first or last row has all its members here and is done. The others, one path on either side, are the
shard's boundary: their partial sums go on as two rows of the same form, which are sharded, ``PATHS`` to a
shard, and put together by the same function until one shard is left, so the boundaries of
any number of shards need neither the driver nor one task. Nodes whose parent lies on a boundary get their
parent's conv_id from the finished boundary nodes at the end (a join that cuts hot parents).

Conversations that are equal in all turns are cut among shards by id. The ids of the members that end at a boundary node
reach its hash piece by piece in sorted order, by a sorted stream of bounded batches. (SHA-256 has to see
its input in order, so the pieces of one node are one task's; they are the bare ids as text.)

What bounds memory: a shard has ``SHARD`` turns, about; a conversation lies whole in one row of 20 bytes a
turn, so the longest one bounds a task from below. Texts are hashed where they are read and not shuffled.

Defined results: turns are ordered by ``turn`` (null first), equal ones by their id; equal rows are turns of
their own. A null role or text is empty. A row with a null conv_id belongs to no conversation. Other
columns are not read. An empty table has no conversation and so no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.operators.joins import lookup_join
from tallyroll.session import settle

ID_BYTES = 16
# Turns of a shard, about; turns that one matrix is wide; boundary paths of a shard; ids in a piece of text.
SHARD = 200_000
COLUMNS = 32
PATHS = 256
PIECE = 1000
# The prefix that a conversation is rebuilt with comes from the first conversation of its hundred.
FAMILY, SHARED = 100, 6
NONE = np.iinfo(np.int64).max
NOTHING = hashlib.sha256(b"").hexdigest()

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
KEYS = "key binary, parent_key binary"
PATH = "seq binary, lens array<int>, counts array<long>, smallest array<long>, kids array<long>, leaves array<long>, saved array<long>"
OUT = f"kind int, {NODE}, {KEYS}, {PATH}, first long, piece string"
_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
SCHEMA = pa.schema([(part.split()[0], _ARROW[part.split()[1]]) for part in OUT.split(", ")])
SUMS = ("counts", "smallest", "kids", "leaves", "saved")


def turn_id(role: Column, text: Column) -> Column:
    """Hex of the id; the length keeps role and text apart."""
    return F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * ID_BYTES)


def conversations_of(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, turns``: the turns of each conversation in order, as structs of ``id`` and ``len`` (code points)."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    read = turns.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"), F.struct(F.col(f"`{turn_col}`").cast("long").alias("turn"), turn_id(role, text).alias("id"), F.length(text).alias("len")).alias("t")
    ).where(F.col("conv").isNotNull())
    found = read.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return found.select("conv", F.transform("t", lambda t: F.struct(t["id"].alias("id"), t["len"].alias("len"))).alias("turns"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Conversations whose first h turns are those of the first conversation of their family; h = crc32(conv) % 6."""
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED).cast("int")
    named = convs.withColumn("h", h).withColumn("base", F.col("conv") - F.col("conv") % FAMILY)
    # At most five turns of one conversation in a hundred.
    bases = convs.where(F.col("conv") % FAMILY == 0).select(F.col("conv").alias("base"), F.slice("turns", 1, SHARED - 1).alias("lent"))
    joined = named.join(bases, "base", "left")
    lent = F.slice(F.coalesce("lent", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    return joined.select("conv", F.concat(lent, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


class Shard:
    """Rows of ids with sums at each of their depths, sorted, and the turns that each shares with the one before."""

    def __init__(self, table: pa.Table) -> None:
        self.n = table.num_rows
        sequences = table.column("seq").combine_chunks()
        if isinstance(sequences, pa.ChunkedArray):
            sequences = pa.concat_arrays(sequences.chunks)
        self.length = np.array([len(s) // ID_BYTES for s in sequences.to_pylist()], np.int64)
        self.ids = np.frombuffer(b"".join(sequences.to_pylist()), ">u8").astype(np.uint64).reshape(-1, 2)
        self.at = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.lens = _flat(table.column("lens"))
        self.conv = table.column("conv").to_numpy() if "conv" in table.column_names else None
        # A row has one value more than turns: depth 0.
        self.sums = None if self.conv is not None else {c: _flat(table.column(c)) for c in SUMS}
        self._sort()

    def _block(self, rows: np.ndarray, start: int) -> np.ndarray:
        """Ids of turns ``start`` and on of each row, padded with zeros."""
        width = int(min(COLUMNS, self.length[rows].max() - start))
        cols = start + np.arange(width)
        there = cols[None, :] < self.length[rows][:, None]
        out = np.zeros((len(rows), width, 2), np.uint64)
        out[there] = self.ids[(self.at[rows][:, None] + cols[None, :])[there]]
        return out

    def _sort(self) -> None:
        order, group = np.arange(self.n), np.zeros(self.n, np.int64)
        last = self.conv if self.conv is not None else np.arange(self.n)
        for start in range(0, int(self.length.max(initial=0)) or 1, COLUMNS):
            # Rows that go on stand last in the group that they share all turns so far with.
            slots = np.flatnonzero(self.length[order] > start) if start else np.arange(self.n)
            rows, of = order[slots], group[slots]
            block = self._block(rows, start) if self.length[rows].max(initial=0) > start else np.zeros((len(rows), 0, 2), np.uint64)
            keys = [last[rows], self.length[rows]]
            for c in range(block.shape[1] - 1, -1, -1):
                keys += [block[:, c, 1], block[:, c, 0]]
            sort = np.lexsort([*keys, of])
            order[slots], block = rows[sort], block[sort]
            new = np.ones(len(rows), bool)
            new[1:] = (block[1:] != block[:-1]).any(axis=(1, 2)) | (of[sort][1:] != of[sort][:-1])
            group[slots] = of[sort] * 0 + np.cumsum(new)
        self.order = order
        self.length, self.at = self.length[order], self.at[order]
        self.wide = self.at + order  # where the sums of a row begin
        if self.conv is not None:
            self.conv = self.conv[order]
        shared = np.zeros(self.n, np.int64)
        pairs = np.arange(1, self.n)
        start = 0
        while len(pairs):
            both = np.minimum(self.length[pairs], self.length[pairs - 1])
            pairs, both = pairs[both > start], both[both > start]
            if not len(pairs):
                break
            here, before = self._block(pairs, start), self._block(pairs - 1, start)
            width = min(here.shape[1], before.shape[1])
            changed = (here[:, :width] != before[:, :width]).any(axis=2) | (start + np.arange(width)[None, :] >= both[:, None])
            changed = np.logical_or.accumulate(changed, axis=1)
            shared[pairs] += (~changed).sum(axis=1)
            pairs = pairs[~changed[:, -1]]
            start += width
        self.shared = shared

    def sequence(self, row: int) -> bytes:
        a = self.at[row]
        return self.ids[a : a + self.length[row]].astype(">u8").tobytes()

    def prefix_keys(self, row: int) -> list[bytes]:
        """A key for each depth of a row."""
        running, text, out = hashlib.sha256(), self.sequence(row), []
        for d in range(int(self.length[row]) + 1):
            running.update(text[(d - 1) * ID_BYTES : d * ID_BYTES] if d else b"")
            out.append(running.copy().digest()[:ID_BYTES])
        return out


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    chunks = [c.flatten() for c in column.chunks]
    return np.concatenate([c.to_numpy(zero_copy_only=False) for c in chunks]).astype(np.int64) if chunks else np.zeros(0, np.int64)


def trie(shard: Shard, whole: bool) -> Iterator[pa.Table]:
    """Nodes that are done, paths of the boundary and the pieces of text that go with them.

    ``whole``: there is no other shard, so all nodes are done.
    """
    n, first_level = shard.n, shard.conv is not None
    ends = _ends(shard) if first_level else {}
    sides = [0, n - 1]
    keys = [shard.prefix_keys(r) for r in sides]
    paths = [{c: np.zeros(int(shard.length[r]) + 1, np.int64) for c in SUMS} for r in sides]
    paths[1]["smallest"][:] = NONE
    second_from = int(shard.length[n - 1]) + 1  # depths of the last row from here on are its own
    below = None  # nodes of the next depth: start rows, done, leaves, saved
    columns: dict[str, list] = {c: [] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "key", "parent_key")}
    waiting = None  # done nodes of the next depth, whose parents are this depth's
    for d in range(int(shard.length.max()), -1, -1):
        rows = np.flatnonzero(shard.length >= d)
        # A row starts a node if it shares fewer turns with the row before.
        new = shard.shared[rows] < d
        new[0] = True
        starts = np.flatnonzero(new)
        heads = rows[starts]
        if first_level:
            counts, smallest = np.diff(np.append(starts, len(rows))), np.minimum.reduceat(shard.conv[rows], starts)
            kids, leaves, saved = (np.zeros(len(starts), np.int64) for _ in range(3))
        else:
            here = shard.wide[rows] + d
            counts, kids, leaves, saved = (np.add.reduceat(shard.sums[c][here], starts) for c in ("counts", "kids", "leaves", "saved"))
            smallest = np.minimum.reduceat(shard.sums["smallest"][here], starts)
        counts = counts.astype(np.int64)
        done = np.ones(len(starts), bool)
        if not whole:
            done[0] &= heads[0] != 0
            done[-1] &= rows[-1] != n - 1
        if below is not None:
            child_heads, child_done, child_leaves, child_saved = below
            parent = np.searchsorted(heads, child_heads, "right") - 1
            up = child_done
            np.add.at(kids, parent[up], 1)
            np.add.at(leaves, parent[up], child_leaves[up])
            np.add.at(saved, parent[up], child_saved[up])
            if waiting is not None:
                known = done[parent[up]]
                columns["parent_conv_id"].append(pa.array(smallest[parent[up]], pa.int64(), mask=~known))
                side = np.where(parent[up] == 0, 0, 1) if heads[0] == 0 else np.ones(len(known), int)
                columns["parent_key"].append(pa.array([None if k else keys[s][d] for k, s in zip(known.tolist(), side.tolist(), strict=True)], pa.binary()))
        own = shard.lens[shard.at[heads] + d - 1] if d else np.zeros(len(heads), np.int64)
        childless = done & (kids == 0)
        all_leaves = np.where(childless, 1, leaves)
        all_saved = saved + np.where(done, (counts - 1) * own, 0)
        mine = [(0, 0)] * int(heads[0] == 0 and not done[0])
        if not whole and rows[-1] == n - 1 and not (mine and len(starts) == 1):
            mine.append((1, len(starts) - 1))
            second_from = d
        for side, i in mine:
            for c, values in zip(SUMS, (counts, smallest, kids, leaves, saved), strict=True):
                paths[side][c][d] = values[i]
        out = np.flatnonzero(done)
        waiting = out if len(out) else None
        if len(out):
            for c, values in (("conv_id", smallest), ("n_convs", counts), ("n_children", kids), ("n_leaves", all_leaves), ("saved_tokens", all_saved)):
                columns[c].append(pa.array(values[out], pa.int64()))
            columns["depth"].append(pa.array(np.full(len(out), d), pa.int64()))
            ended = shard.length[heads[out]] == d
            texts = [ends[r] if e and first_level else NOTHING for r, e in zip(heads[out].tolist(), ended.tolist(), strict=True)]
            columns["ends_sha256"].append(pa.array(texts if first_level else [None] * len(out), pa.string()))
            own_keys = [None] * len(out) if first_level else [hashlib.sha256(shard.sequence(int(r))[: d * ID_BYTES]).digest()[:ID_BYTES] for r in heads[out]]
            columns["key"].append(pa.array(own_keys, pa.binary()))
            if d == 0:
                columns["parent_conv_id"].append(pa.nulls(len(out), pa.int64()))
                columns["parent_key"].append(pa.nulls(len(out), pa.binary()))
        below = (heads, done, all_leaves, all_saved)
    if columns["conv_id"]:
        yield _table(0, {c: pa.chunked_array(v) for c, v in columns.items()})
    if whole:
        return
    kept = [0] + [1] * int(second_from <= shard.length[n - 1])
    yield _table(1, {
        "seq": pa.array([shard.sequence(sides[s]) for s in kept], pa.binary()),
        "lens": pa.array([shard.lens[shard.at[sides[s]] : shard.at[sides[s]] + shard.length[sides[s]]] for s in kept], pa.list_(pa.int32())),
        **{c: pa.array([paths[s][c] for s in kept], pa.list_(pa.int64())) for c in SUMS},
    })
    if first_level:
        yield from _pieces(shard, keys)


def _ends(shard: Shard) -> dict[int, str]:
    """For the first of each run of equal rows: the hash of the run's ids."""
    new = np.ones(shard.n, bool)
    new[1:] = (shard.shared[1:] != shard.length[1:]) | (shard.length[1:] != shard.length[:-1])
    edges = np.append(np.flatnonzero(new), shard.n).tolist()
    ids = shard.conv.tolist()
    return {a: hashlib.sha256(",".join(map(str, ids[a:b])).encode()).hexdigest() for a, b in zip(edges, edges[1:], strict=False)}


def _pieces(shard: Shard, keys: list[list[bytes]]) -> Iterator[pa.Table]:
    """Ids of the rows that end on the boundary, in order, as pieces of text."""
    first, last = 0, shard.n - 1
    shares = np.minimum.accumulate(np.append(shard.length[:1], shard.shared[1:]))  # turns shared with the first row
    back = np.minimum.accumulate(np.append(shard.shared[1:], shard.length[-1:])[::-1])[::-1]  # with the last row
    found: dict[bytes, list[int]] = {}
    for row in np.flatnonzero((shares == shard.length) | (back == shard.length)).tolist():
        side = first if shares[row] == shard.length[row] else last
        found.setdefault(keys[0 if side == first else 1][int(shard.length[row])], []).append(int(shard.conv[row]))
    for key, ids in found.items():
        cuts = range(0, len(ids), PIECE)
        yield _table(2, {"key": pa.array([key] * len(cuts), pa.binary()), "first": pa.array([ids[a] for a in cuts], pa.int64()), "piece": pa.array([",".join(map(str, ids[a : a + PIECE])) for a in cuts], pa.string())})


def _table(kind: int, columns: dict) -> pa.Table:
    n = len(next(iter(columns.values())))
    columns = {"kind": pa.array(np.full(n, kind), pa.int32()), **columns}
    return pa.table([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in SCHEMA], schema=SCHEMA)


def _shards(whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [b for b in batches if b.num_rows]
        if table:
            for part in trie(Shard(pa.Table.from_batches(table)), whole):
                yield from part.to_batches(max_chunksize=10_000)

    return run


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces come sorted by node and id; one hash is open at a time."""
    at, running = None, None
    for batch in batches:
        done = []
        for key, piece in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist(), strict=True):
            if key != at:
                if running:
                    done.append((at, running.hexdigest()))
                at, running = key, hashlib.sha256(piece.encode())
            else:
                running.update(b"," + piece.encode())
        yield pa.record_batch([pa.array([k for k, _ in done], pa.binary()), pa.array([x for _, x in done], pa.string())], names=["key", "hash"])
    if running:
        yield pa.record_batch([pa.array([at], pa.binary()), pa.array([running.hexdigest()], pa.string())], names=["key", "hash"])


def prefix_trie(convs: DataFrame, shard: int = SHARD, paths: int = PATHS) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of each node.

    ``convs`` has ``conv`` (unique) and ``turns`` (structs of hex ``id`` and ``len``).
    """
    spark = convs.sparkSession
    seq = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    rows = settle(convs.select("conv", seq.alias("seq"), F.transform("turns", lambda t: t["len"]).alias("lens")), "trie-rows")
    # One row.
    size = rows.agg(F.sum(F.size("lens") + 1)).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // shard))
    # A conversation's id parts rows that are equal, of which there may be any number.
    sharded = rows.repartitionByRange(n, "seq", "conv")
    found = settle(sharded.mapInArrow(_shards(False), OUT), "trie-shards")
    nodes, path_rows = found.where("kind = 0"), found.where("kind = 1").select(*[part.split()[0] for part in PATH.split(", ")])
    boundary, left = [], path_rows.count()
    while left:
        # Every shard leaves two paths at most, so few rounds are needed; the last one takes the rest.
        whole = left <= paths
        merged = path_rows.coalesce(1) if whole else path_rows.repartitionByRange(-(-left // paths), "seq")
        step = settle(merged.mapInArrow(_shards(whole), OUT), "trie-paths")
        boundary.append(step.where("kind = 0"))
        path_rows = step.where("kind = 1").select(*path_rows.columns)
        before, left = left, path_rows.count()
        if left > before // 2:
            paths *= 4
    if not boundary:
        return nodes.select(*[part.split()[0] for part in NODE.split(", ")])
    kept = boundary[0]
    for more in boundary[1:]:
        kept = kept.unionByName(more)
    pieces = found.where("kind = 2").select("key", "first", "piece")
    hashed = pieces.repartition("key").sortWithinPartitions("key", "first").select("key", "piece").mapInArrow(_hash_pieces, "key binary, hash string")
    kept = kept.drop("ends_sha256").join(hashed, "key", "left").withColumn("ends_sha256", F.coalesce("hash", F.lit(NOTHING))).drop("hash")
    kept = settle(kept.select(*[part.split()[0] for part in f"{NODE}, {KEYS}".split(", ")]), "trie-boundary")
    every = nodes.select(*kept.columns).unionByName(kept)
    named = kept.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    open_ends = every.where(F.col("parent_key").isNotNull())
    joined = lookup_join(open_ends, named, ["parent_key"], ["conv_id", "depth"]).withColumn("parent_conv_id", F.col("_parent")).drop("_parent")
    columns = [part.split()[0] for part in NODE.split(", ")]
    return every.where(F.col("parent_key").isNull()).select(*columns).unionByName(joined.select(*columns))


def conversation_trie(turns: DataFrame, **sizes: int) -> DataFrame:
    """The trie of the rebuilt conversations of a table of turns."""
    return prefix_trie(rebuilt(conversations_of(turns)), **sizes)
