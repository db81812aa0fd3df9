"""Near-duplicate groups by circulant MinHash, banding and exact verification.

Method: a document's set are the hashes of its five-word shingles. One permutation places every
shingle on a ring of 2**32; a second permutation, shifted by k, gives the k-th coordinate as its
minimum over the set, so two permutations make the whole signature. Bands of coordinates are
keys; documents with a key in common are candidates, and a link counts only if the full sets
meet the threshold. Links are made in steps that never emit all pairs of a group:

1. Documents with equal sets are one class, whose smallest id stands for it.
2. Shingles that no other candidate has bound a class's similarity to any other; classes and
   keys where the bound is too low have no link. Every key's head is the class with the
   smallest share of such shingles, for a family's original has few. Each class is verified
   against the head it shares most keys with. Verified links give components.
3. Classes that share a band's key with another component are met across components by prefix
   filtering on their full sets, which loses no pair, and verified. Then the components are final.

Step 3 finds every candidate pair that could still join two components, so no link that the
bands see is lost; within a component further links change nothing. With 40 bands of 4
coordinates a pair at the threshold is missed with a probability of about 3e-7.

Defined results: null, empty or blank text has an empty set, is linked with nothing and kept.
A text of fewer than five words has one shingle, all its words. A null id comes before all
others. Rows that share an id are judged by their own texts. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroll.llm import cells as C
from tallyroll.llm import kernels as K
from tallyroll.llm.components import components
from tallyroll.llm.tables import NO_ID, keyed
from tallyroll.session import settle

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 40, 4
FLAT = 1 << 15

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of rows with their distinct shingle hashes, sorted by row, and the bounds of each row."""
    data, offsets = K.strings(column)
    for found in K.words(LOWER[data], offsets):
        n = found.high - found.low
        window = K.rolling(found.hash, SHINGLE)
        at = np.flatnonzero(found.row[: len(window)] == found.row[SHINGLE - 1 :]) if len(window) else np.zeros(0, np.int64)
        row, value = found.row[at], window[at]
        # Rows with one to four words: a hash of all their words and how many there are.
        bounds = found.bounds()
        size = np.diff(bounds)
        for r in np.flatnonzero((size > 0) & (size < SHINGLE)):
            own = K.rolling(found.hash[bounds[r] : bounds[r + 1]], int(size[r])) ^ np.uint64(int(size[r]))
            row, value = np.append(row, r), np.append(value, own)
        order = np.lexsort((value, row))
        row, value = row[order], value[order]
        if len(row):
            new = np.concatenate(([True], (row[1:] != row[:-1]) | (value[1:] != value[:-1])))
            row, value = row[new], value[new]
        yield found.low, found.high, value, np.searchsorted(row, np.arange(n + 1))


def _ring(values: np.ndarray) -> np.ndarray:
    """First permutation: the place of a shingle on the ring."""
    return (K.mix(values ^ np.uint64(0xA5A5A5A55A5A5A5A)) >> np.uint64(32)).astype(np.uint32)


def _permuted(place: np.ndarray, buffer: np.ndarray) -> np.ndarray:
    """Second permutation of the ring, written into ``buffer``: a mixing bijection of 32-bit numbers."""
    np.right_shift(place, np.uint32(16), out=buffer)
    buffer ^= place
    buffer *= np.uint32(0x7FEB352D)
    buffer ^= buffer >> np.uint32(15)
    buffer *= np.uint32(0x846CA68B)
    return buffer


def signatures(values: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """The n coordinates of each set (rows without shingles get all ones)."""
    out = np.full((len(bounds) - 1, n), 0xFFFFFFFF, np.uint32)
    size = np.diff(bounds)
    low = 0
    while low < len(size):
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + FLAT, side="right")) - 1)
        rows = np.flatnonzero(size[low:high]) + low
        if len(rows):
            # A long set is taken in pieces, so that the work stays in the cache.
            for start in range(int(bounds[low]), int(bounds[high]), FLAT if high == low + 1 else int(bounds[high] - bounds[low])):
                stop = min(int(bounds[high]), start + FLAT) if high == low + 1 else int(bounds[high])
                place = _ring(values[start:stop])
                first = bounds[rows] - start if high > low + 1 else np.zeros(1, np.int64)
                buffer = np.empty_like(place)
                for k in range(n):
                    least = np.minimum.reduceat(_permuted(place, buffer), first)
                    out[rows, k] = np.minimum(out[rows, k], least)
                    place += np.uint32(1)
        low = high
    return out


SIGNED = "doc_id long, id long, h long, n_shingles long, node long, bands array<long>"


def signed(docs: DataFrame) -> DataFrame:
    """One row for each of ``docs`` (doc_id, id, h, text): size and hash of the set, band keys."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, values, bounds in shingle_sets(batch.column("text")):
                coordinates = signatures(values, bounds, BANDS * ROWS)
                size = np.diff(bounds)
                filled = size > 0
                banded = coordinates.astype(np.uint64).reshape(-1, BANDS, ROWS)
                key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (high - low, BANDS))
                for r in range(ROWS):
                    key = K.mix(key * K.BASE + banded[:, :, r])
                ends = np.concatenate(([0], np.cumsum(np.where(filled, BANDS, 0))))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(key[filled].ravel().view(np.int64)))
                set_hash = np.zeros(high - low, np.uint64)
                if filled.any():
                    set_hash[filled] = K.mix(np.add.reduceat(K.mix(values), bounds[:-1][filled]) + size[filled].astype(np.uint64))
                own = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [*(own.column(c) for c in ("doc_id", "id", "h")), pa.array(size.astype(np.int64)), pa.array(set_hash.view(np.int64)), lists],
                    ["doc_id", "id", "h", "n_shingles", "node", "bands"],
                )

    return docs.select("doc_id", "id", "h", "text").mapInArrow(K.tidy(sign), SIGNED)


def verified(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full sets meet the threshold. ``texts`` has a text for each node."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                a, b = (_sets(part.column(c)) for c in ("text_a", "text_b"))
                good = []
                for x, y in zip(a, b, strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(K.tidy(meet), "a long, b long")


def across(nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (node, part, n, least, text) in different parts that may meet the threshold.

    Prefix filtering, which loses no pair: with all shingles in one order, rare ones first, two
    sets that share enough must share one among the first few of each, with enough left behind
    it. ``least`` bounds the size of a node's partners from below. The part with the most nodes
    at a shingle is met by the others only, so a large component is never paired with itself.
    """

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, values, bounds in shingle_sets(batch.column("text")):
                row = pa.array(np.repeat(np.arange(low, high), np.diff(bounds)))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(row) for c in ("node", "part", "n", "least")), pa.array(values.view(np.int64))], ["node", "part", "n", "least", "shingle"])

    rows = nodes.select("node", "part", "n", "least", "text").mapInArrow(K.tidy(exploded), "node long, part long, n long, least long, shingle long")
    counts = rows.groupBy("shingle", "part").agg(F.count("*").alias("size"))
    counts = counts.groupBy("shingle").agg(F.sum("size").alias("times"), F.max_by("part", F.struct("size", "part")).alias("major"), F.count("*").alias("parts"))
    rows = rows.join(counts, "shingle").withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy("times", "shingle")))

    def overlap(one: Column, two: Column) -> Column:
        return F.ceil(percent * (one + two) / (100 + percent))

    partner = F.greatest("least", F.ceil(percent * F.col("n") / 100))
    rows = rows.filter((F.col("place") <= F.col("n") - overlap(F.col("n"), partner) + 1) & (F.col("parts") > 1))
    rows = settle(rows.select("shingle", "node", "part", "n", "place", (F.col("part") == F.col("major")).alias("main")), "prefixes")
    one, two = (rows.select("shingle", *(F.col(c).alias(f"{c}_{side}") for c in ("node", "part", "n", "place", "main"))) for side in "ab")
    left = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) + 1
    enough = left >= overlap(F.col("n_a"), F.col("n_b"))
    met = one.filter("NOT main_a").join(two, "shingle").filter((F.col("part_a") != F.col("part_b")) & enough & (F.col("main_b") | (F.col("node_a") < F.col("node_b"))))
    return met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def alone(texts: DataFrame) -> DataFrame:
    """``node, n, alone``: how many shingles of each of ``texts`` (node, n, id, h, text) no other of them has."""
    dealt, size = C.dealt(texts)

    def own(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sets = _sets(table.column("text"))
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        return (row, *np.unique(C.joined(sets, np.uint64), return_inverse=True))

    def blocks(table: pa.Table) -> pa.Table:
        _, distinct, back = own(table)
        return C.blocks(table.column("cell")[0].as_py(), distinct, size, np.bincount(back, minlength=len(distinct)) > 1)

    def counted(table: pa.Table, replies: pa.Table) -> pa.Table:
        row, distinct, back = own(table)
        single = ~C.bits(C.received(replies, 1), distinct, size)[back]
        return pa.table([table.column("node"), table.column("n"), pa.array(np.bincount(row[single], minlength=table.num_rows))], names=["node", "n", "alone"])

    replies = C.reply(C.ask(dealt, blocks), lambda table: C.seen_twice(table, 1))
    return C.ask_again(dealt, replies, counted, "node long, n long, alone long")


def _sets(column: pa.Array) -> list[np.ndarray]:
    return [values[bounds[r] : bounds[r + 1]] for _, _, values, bounds in shingle_sets(column) for r in range(len(bounds) - 1)]


def groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, id, h, n_shingles, component, component_h``: for each row of ``docs`` (as from ``keyed``) the smallest id it reaches.

    ``component_h`` is the ``h`` of the row that stands for the group, the smallest of those with that id.
    """
    rows = settle(signed(docs), "signed")
    whole = rows.filter("n_shingles > 0")
    classes = settle(whole.groupBy("node").agg(F.min(F.struct("id", "h")).alias("first"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "classes")
    keys = classes.select("node", F.explode("bands").alias("key"))
    shared = settle(keys.join(keys.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1").select("key"), "key"), "shared")
    wanted = shared.select("node").distinct().join(classes.select("node", "n", "first"), "node").select("node", "n", "first.*")
    texts = settle(wanted.join(docs.select("id", "h", "text"), ["id", "h"]).dropDuplicates(["id", "h"]).select("node", "n", "id", "h", "text"), "texts")

    # What a class has alone bounds its similarity to every other: n - alone shingles can be shared at most.
    bounds = settle(alone(texts).withColumn("most", F.col("n") - F.col("alone")), "bounds")
    shared = shared.join(bounds.filter(100 * F.col("most") >= percent * F.col("n")), "node")
    least = shared.groupBy("key").agg(F.min("n").alias("least"))
    partner = F.greatest(F.col("least"), F.ceil(percent * F.col("n") / 100))
    shared = settle(shared.join(least, "key").filter((100 + percent) * F.col("most") >= percent * (F.col("n") + partner)).drop("alone"), "shared")

    # Step 2: each class and the head it shares most keys with. The head of a key has the smallest share of its own.
    heads = shared.groupBy("key").agg(F.min(F.struct((1 - F.col("most") / F.col("n")).alias("own"), "node")).getField("node").alias("head"))
    stars = shared.join(heads, "key").filter("node <> head").groupBy("node", "head").agg(F.count("*").alias("times"))
    stars = stars.groupBy("node").agg(F.max_by("head", F.struct("times", "head")).alias("head")).select(F.col("head").alias("a"), F.col("node").alias("b"))
    links = settle(verified(stars, texts, percent).distinct(), "links")
    label = components(links)

    # Step 3: what shares a key across components.
    label = label.withColumnRenamed("root", "part")
    labelled = shared.join(label, "node", "left").withColumn("part", F.coalesce("part", "node"))
    mixed = labelled.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low <> high").select("key")
    still = labelled.join(mixed, "key").groupBy("node").agg(F.first("part").alias("part"), F.min("least").alias("least"))
    pairs = across(still.join(texts.select("node", "n", "text"), "node"), percent)
    more = settle(verified(pairs, texts, percent).distinct(), "links")
    if not more.isEmpty():
        label = components(links.unionByName(more)).withColumnRenamed("root", "part")

    named = classes.join(label, "node", "left").select("node", F.coalesce("part", "node").alias("part"), "first")
    smallest = named.groupBy("part").agg(F.min("first").alias("first"))
    named = named.drop("first").join(smallest, "part").select("node", F.col("first.id").alias("component"), F.col("first.h").alias("component_h"))
    own = [F.when(F.col("n_shingles") > 0, F.col(c)).otherwise(F.col(other)).alias(c) for c, other in (("component", "id"), ("component_h", "h"))]
    return rows.join(named, "node", "left").select("doc_id", "id", "h", "n_shingles", *own)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``."""
    found = groups(keyed(docs, id_col, text_col), percent)
    return found.select("doc_id", "n_shingles", F.when(F.col("component") != NO_ID, F.col("component")).alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each group, that with the smallest id and hash; of rows equal in both, any one."""
    found = groups(keyed(docs, id_col, text_col), percent).filter("n_shingles > 0")
    stays = (F.col("id") == F.col("component")) & (F.col("h") == F.col("component_h"))
    marks = settle(found.groupBy("id", "h", stays.alias("stays")).agg(F.count("*").alias("times")).filter("NOT stays OR times > 1"), "marks")
    gone, repeated = marks.select("id", "h"), marks.filter("stays").select("id", "h")
    mark = [F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)), F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))]
    names = docs.columns
    own = docs.select(F.struct(*(F.col(f"`{n}`") for n in names)).alias("row"), mark[0].alias("id"), mark[1].alias("h"))
    kept = own.join(gone, ["id", "h"], "left_anti")
    if not repeated.isEmpty():
        kept = kept.unionByName(own.join(repeated, ["id", "h"], "left_semi").dropDuplicates(["id", "h"]))
    return kept.select(*(F.col("row").getField(n).alias(n) for n in names))
