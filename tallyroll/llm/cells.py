"""Asking the whole corpus about hashes, without a shuffle row for each of them.

Documents are dealt to cells by a hash of their key; a cell is a bounded share of the text. A
cell reduces its hashes to distinct ones (that is the aggregation before the shuffle: however
often a hash occurs, a cell sends it once) and sends one packed row to each bucket, a bounded
share of the hash values. A bucket answers every cell's hashes in their order, and the cell,
met again with the answers, goes on. Both directions are grouped Spark shuffles; the texts
themselves are shuffled once, since every later step has the same exchange of them.

No key can fill a task: a hot hash has at most one entry a cell in its bucket, and copies of a
document lie in different cells. A document is never split between cells, so the largest one
bounds a cell from below.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL_BYTES = 16 << 20
BLOCK = "bucket int, cell int, data binary"
ANSWER = "cell int, bucket int, step int, data binary"
_BLOCK = pa.schema([("bucket", pa.int32()), ("cell", pa.int32()), ("data", pa.binary())])
_ANSWER = pa.schema([("cell", pa.int32()), ("bucket", pa.int32()), ("step", pa.int32()), ("data", pa.binary())])


def dealt(docs: DataFrame, cell_bytes: int = CELL_BYTES) -> tuple[DataFrame, int]:
    """What ``keyed`` gives (``id, h, text`` and more) with its ``cell``, and the number of cells (and of buckets).

    The number follows the size of the texts, which one aggregate finds.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    n = max(1, least, math.ceil(total / cell_bytes))
    return docs.select(F.pmod(F.xxhash64("id", "h"), F.lit(n)).cast("int").alias("cell"), *docs.columns), n


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one value: their sizes in bytes, then their bytes."""
    raw = [np.ascontiguousarray(a).tobytes() for a in arrays]
    return np.array([len(r) for r in raw], np.int64).tobytes() + b"".join(raw)


def unpack(data: bytes, *kinds) -> list[np.ndarray]:
    sizes = np.frombuffer(data, np.int64, len(kinds))
    at, out = 8 * len(kinds), []
    for size, kind in zip(sizes.tolist(), kinds, strict=True):
        out.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def bucket_edges(hashes: np.ndarray, n: int) -> np.ndarray:
    """Where each of the n buckets begins in sorted hashes, and the end. A bucket is a range of hash values."""
    limits = np.array([(b << 64) // n for b in range(1, n)], dtype=np.uint64)
    return np.concatenate(([0], np.searchsorted(hashes, limits), [len(hashes)]))


def blocks(cell: int, hashes: np.ndarray, n: int, *more: np.ndarray) -> pa.Table:
    """A cell's sorted hashes, and arrays that go with them, as one row for each bucket."""
    edges = bucket_edges(hashes, n)
    filled = np.flatnonzero(np.diff(edges))
    data = [pack(*(a[edges[b] : edges[b + 1]] for a in (hashes, *more))) for b in filled]
    return pa.table([pa.array(filled, pa.int32()), pa.array(np.full(len(filled), cell), pa.int32()), pa.array(data, pa.binary())], schema=_BLOCK)


def answers(table: pa.Table, step: int, data: list[bytes]) -> pa.Table:
    """Replies to the rows of a bucket, in their order."""
    return pa.table([table.column("cell"), table.column("bucket"), pa.array(np.full(table.num_rows, step), pa.int32()), pa.array(data, pa.binary())], schema=_ANSWER)


def received(table: pa.Table, step: int) -> list[bytes]:
    """A step's replies to a cell, in the order of the buckets, which is that of its hashes."""
    buckets, steps = table.column("bucket").to_numpy(), table.column("step").to_numpy()
    rows = np.flatnonzero(steps == step)
    data = table.column("data")
    return [data[int(i)].as_py() for i in rows[np.argsort(buckets[rows], kind="stable")]]


def ask(cells: DataFrame, work: Callable[[pa.Table], pa.Table]) -> DataFrame:
    return cells.groupBy("cell").applyInArrow(work, BLOCK)


def ask_again(cells: DataFrame, replies: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str = BLOCK) -> DataFrame:
    """Every cell with its replies so far."""
    return cells.groupBy("cell").cogroup(replies.groupBy("cell")).applyInArrow(work, schema)


def reply(asked: DataFrame, work: Callable[[pa.Table], pa.Table]) -> DataFrame:
    return asked.groupBy("bucket").applyInArrow(work, ANSWER)


def joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def split(values: np.ndarray, sizes: list[int]) -> Iterator[np.ndarray]:
    at = 0
    for size in sizes:
        yield values[at : at + size]
        at += size


def seen_twice(table: pa.Table, step: int) -> pa.Table:
    """Bucket's reply to blocks of (hash, whether the cell itself has it twice): bits, set where it occurs twice in all."""
    got = [unpack(d.as_py(), np.uint64, np.bool_) for d in table.column("data")]
    hashes, own = joined([g[0] for g in got], np.uint64), joined([g[1] for g in got], np.bool_)
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(hashes), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    return answers(table, step, [np.packbits(part).tobytes() for part in split(twice | own, [len(g[0]) for g in got])])


def bits(data: list[bytes], hashes: np.ndarray, n: int) -> np.ndarray:
    """The replies of ``seen_twice`` as one mask over a cell's sorted hashes."""
    sizes = np.diff(bucket_edges(hashes, n))
    return joined([np.unpackbits(np.frombuffer(d, np.uint8), count=int(s)).astype(bool) for d, s in zip(data, sizes[sizes > 0], strict=True)], np.bool_)
