"""Benchmark passages in documents, exact or with few edits, by q-gram lemma filtering.

Method: an item of m characters that occurs with at most k edits shares at least
m + 1 - q (k + 1) of its q-grams with the text, all of them on k + 1 neighbouring diagonals.
Every text's q-grams are looked up in the items' sorted q-gram table (after a bit table that
rules most of them out), and shared q-grams are counted per item in two tilings of diagonal
bands that overlap by half a band, so that some band holds the whole match. Bands that reach the
count are verified by an alignment within the band.

Texts are compared as code points with A-Z in lower case and each run of white space as one
space. The edit budget is 10 % of the item's length, less where the lemma would say nothing, and none
under 32 characters.

Items go to the tasks as a table of bounded size. A larger benchmark is cut into blocks, and the rows with what
was found so far are written to the shared folder between two blocks: neither the driver nor a task holds
more than one. Within a block, items of similar budget have a table of their own, so that one long item does
not widen the bands of short ones.

Defined results: null or empty text has no match. Items that are null or shorter than 8 characters, white space
counted once, have no q-gram and are not looked for; ``unsearchable`` lists them. Items that repeat are reported under each of their
ids, a null item_id as null. Any doc_id, repeated rows and other columns don't matter; each row is
searched by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm import kernels as K
from tallyroll.llm.tables import numbered, renamed, text_place
from tallyroll.session import settle

Q = 8
EDIT_PERCENT = 10
MIN_EDITED = 32  # characters of an item that may have edits
BLOCK_CHARS = 4 << 20
BIT_TABLE, COUNT_TABLE = 22, 18
MATCH = "array<struct<item_id: long, edits: int, start: int, stop: int>>"
ARROW_MATCH = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())]))
_SEED = 0x9FB21C651E98DF25
NOTHING = 0xFFFFFFFF  # no code point

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
LOWER[K.SPACE] = 0x20


def normal(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of rows of UTF-8, and the rows' edges among them."""
    if not len(data):
        return np.zeros(0, np.uint32), np.zeros(len(edges), np.int64)
    space = K.SPACE[data]
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, space[:-1]
    before[edges[edges < len(data)]] = False
    keep = ~(space & before)
    data = LOWER[data[keep]]
    edges = np.concatenate(([0], np.cumsum(keep)))[edges]
    edges = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[edges]
    return np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32), edges


def grams(points: np.ndarray) -> np.ndarray:
    return K.rolling(points.astype(np.uint64) * K.BASE, Q, base=_SEED)


def edit_budget(m: int) -> int:
    """The most edits for which the lemma still asks for a shared q-gram, up to the percentage."""
    return max(0, min(m * EDIT_PERCENT // 100, (m + 1) // Q - 2)) if m >= MIN_EDITED else 0


def budget_class(m: int) -> int:
    """Items whose budgets differ by less than four times share a table."""
    return (edit_budget(m).bit_length() + 1) // 2


@dataclass
class Items:
    """Items of one class: code points, budgets and the table of q-grams."""

    ids: list[int | None]
    points: list[np.ndarray]

    def __post_init__(self):
        self.length = np.array([len(p) for p in self.points], np.int64)
        self.budget = np.array([edit_budget(int(m)) for m in self.length], np.int64)
        self.needed = self.length + 1 - Q * (self.budget + 1)
        # A band is twice as wide as the largest budget needs, and every second tiling is shifted by half of it.
        self.half = int(self.budget.max(initial=0)) + 1
        codes = [grams(p) for p in self.points]
        item = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        place = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.zeros(0, np.int64)
        code = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        order = np.argsort(code, kind="stable")
        self.code, first = np.unique(code[order], return_index=True)
        self.edges = np.concatenate((first, [len(code)]))
        self.item, self.place = item[order], place[order]
        self.table = np.zeros(1 << BIT_TABLE, bool)
        self.table[self.code >> np.uint64(64 - BIT_TABLE)] = True

    def shared(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shared ones of a text's q-grams: place in the text, item, place in the item."""
        at = np.flatnonzero(self.table[code >> np.uint64(64 - BIT_TABLE)])
        which = np.minimum(np.searchsorted(self.code, code[at]), max(0, len(self.code) - 1))
        true = self.code[which] == code[at] if len(self.code) else np.zeros(0, bool)
        at, which = at[true], which[true]
        count = self.edges[which + 1] - self.edges[which]
        entry = np.repeat(self.edges[which] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        return np.repeat(at, count), self.item[entry], self.place[entry]

    def regions(self, code: np.ndarray, edges: np.ndarray) -> set[tuple[int, int, int]]:
        """Row, item and first diagonal of every band with enough shared q-grams, of which a text has ``code``."""
        at, item, place = self.shared(code)
        if not len(at):
            return set()
        longest = int(self.length.max())
        diagonal = at - place + longest
        out: set[tuple[int, int, int]] = set()
        width = 2 * self.half
        bands = (int(edges[-1]) + longest) // width + 2
        for shift in (0, self.half):
            key = item * bands + (diagonal + shift) // width
            # A first count over all rows, in a table of fixed size, leaves few; then each row counts for itself.
            cell = (key.astype(np.uint64) * K.BASE >> np.uint64(64 - COUNT_TABLE)).astype(np.int64)
            enough = np.bincount(cell, minlength=1 << COUNT_TABLE)[cell] >= self.needed[item]
            some = np.flatnonzero(enough)
            row = np.searchsorted(edges, at[some], side="right") - 1
            whole = at[some] + Q <= edges[row + 1]
            some, row = some[whole], row[whole]
            # Each q-gram of the item counts once in a band, however often the text has it there.
            spots = np.unique((row * (len(self.length) * bands) + key[some]) * (longest + 1) + place[some]) // (longest + 1)
            pairs, count = np.unique(spots, return_counts=True)
            pairs = np.stack(np.divmod(pairs, len(self.length) * bands))
            for r, k, n in zip(*pairs.tolist(), count.tolist(), strict=True):
                if n >= self.needed[k // bands]:
                    out.add((r, k // bands, (k % bands) * width - shift - longest))
        return out


def align(pattern: np.ndarray, text: np.ndarray, low: int, high: int, budget: int, anchored: bool = False) -> tuple[int, int] | None:
    """Fewest edits of ``pattern`` against a stretch of ``text`` whose path stays on the diagonals from low to high
    (place in the text less place in the pattern); with the end of the stretch. None if over the budget.
    """
    # Row i of the table has the cells (i, i + low) to (i, i + high); a start anywhere is free, unless it is anchored to
    # the start of the text. Beyond its ends the text goes on with a letter that matches nothing, which costs what leaving out a letter costs.
    n, width, m = len(text), high - low + 1, len(pattern)
    left, right = max(0, -low), max(0, m + high - n)
    padded = np.concatenate((np.full(left, NOTHING, np.uint32), text, np.full(right, NOTHING, np.uint32)))
    step = np.arange(width)
    row = np.abs(step + low) if anchored else np.zeros(width, np.int64)
    for i in range(m):
        at = i + low + left
        new = row + (padded[at : at + width] != pattern[i])
        np.minimum(new[:-1], row[1:] + 1, out=new[:-1])
        row = np.minimum.accumulate(new - step) + step
        if i % 8 == 0 and row.min() > budget:
            return None
    best = int(row.argmin())
    return (int(row[best]), min(max(best + low + m, 0), n)) if row[best] <= budget else None


def begin(pattern: np.ndarray, text: np.ndarray, end: int, edits: int) -> int:
    """Start of a stretch of ``text`` that ends there and costs just so many edits: the alignment read backwards from its end."""
    if not edits:
        return end - len(pattern)
    before = text[max(0, end - len(pattern) - edits) : end]
    _, length = align(pattern[::-1], before[::-1], -edits, edits, edits, anchored=True)
    return end - length


def best_of(items: Items, points: np.ndarray, code: np.ndarray, edges: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
    """For rows and items that match: fewest edits and the first end, in the text of all rows, of a stretch that costs no more."""
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for r, item, diagonal in sorted(items.regions(code, edges)):
        if best.get((r, item), (1, 0))[0] == 0:
            continue
        pattern, budget = items.points[item], int(items.budget[item])
        start = max(int(edges[r]), diagonal - budget)
        stop = min(int(edges[r + 1]), diagonal + 2 * items.half + len(pattern) + budget)
        text = points[start:stop]
        place = text.tobytes().find(pattern.tobytes())
        if place >= 0 and place % 4 == 0:
            found = (0, place // 4 + len(pattern))
        else:
            found = align(pattern, text, diagonal - budget - start, diagonal + 2 * items.half + budget - start, budget)
        if found:
            end = found[1] + start
            best[r, item] = min(best.get((r, item), (found[0], end)), (found[0], end))
    return best


def find(block: list[Items], column: pa.Array) -> list[list[dict]]:
    """Best match of each item of a block in each text."""
    data, offsets = K.strings(column)
    out: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
    for low, high in K.runs(offsets):
        points, edges = normal(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        code = grams(points)
        for items in block:
            for (r, item), (edits, end) in best_of(items, points, code, edges).items():
                first = int(edges[r])
                start = begin(items.points[item], points[first : int(edges[r + 1])], end - first, edits)
                out[low + r].append({"item_id": items.ids[item], "edits": edits, "start": start, "stop": end - first})
    for rows in out:
        rows.sort(key=lambda m: (m["item_id"] is not None, m["item_id"] or 0, m["start"]))
    return out


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``item, text`` with each run of white space as one space."""
    text = F.regexp_replace(F.col(f"`{text_col}`").cast("string"), r"[\x20\x09-\x0D]+", " ")
    return benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item"), text.alias("text"))


def unsearchable(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, text`` of the items that are not looked for, because they are null or have no q-gram."""
    rows = _items(benchmark, item_col, text_col)
    return rows.where(F.coalesce(F.length("text"), F.lit(0)) < Q).select(F.col("item").alias("item_id"), "text")


def blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> Iterator[list[Items]]:
    """The benchmark in blocks of at most so many characters (and one item), read one at a time; items of a block by class."""
    rows = _items(benchmark, item_col, text_col).filter(F.length("text") >= Q)
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    # Blocks by hash are even; half the size leaves room for those that aren't.
    n = 1 if total <= block_chars else 2 * -(-total // block_chars)
    for b in range(n):
        classes: dict[int, list[tuple[int | None, np.ndarray]]] = {}
        for r in rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b).toLocalIterator():
            data = np.frombuffer(r.text.encode(), np.uint8)
            points = normal(data, np.array([0, len(data)]))[0]
            classes.setdefault(budget_class(len(points)), []).append((r.item, points))
        if classes:
            yield [Items([i for i, _ in own], [p for _, p in own]) for own in classes.values()]


def searched(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with the column ``_matches``: best match of each item that occurs."""
    return renamed(by_place(docs, benchmark, text_col, block_chars), docs, "_matches")


def by_place(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The columns of ``docs`` by their places, ``c0, c1, ...``, with the column ``_matches``: best match of each item that occurs."""
    out, text = numbered(docs, text_col, F.array().cast(MATCH).alias("_matches")), text_place(docs, text_col)
    for number, block in enumerate(blocks(benchmark, text_col="text", block_chars=block_chars)):
        # Written between blocks, so that what is left of an earlier block are its matches.
        before = settle(out, "searched") if number else out
        out = before.mapInArrow(K.tidy(_search(block, text)), before.schema)
    return out


def _search(block: list[Items], text: str):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = find(block, batch.column(text))
            # Batches with and without matches must have one schema, so the column is always made anew.
            matches = [a + b for a, b in zip(batch.column("_matches").to_pylist(), found, strict=True)]
            place = batch.schema.get_field_index("_matches")
            yield batch.set_column(place, pa.field("_matches", ARROW_MATCH), pa.array(matches, ARROW_MATCH))

    return search


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, edits, start, stop``: the best match of each item in each text that holds it.

    Places are in the normalized text. The stretch from ``start`` to ``stop`` is the first to end of those with the fewest edits.
    """
    read = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return searched(read, benchmark).select("doc_id", F.explode("_matches").alias("m")).select("doc_id", "m.*")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_items, items, fewest_edits, contaminated``."""
    read = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    ids = F.array_sort(F.array_distinct(F.transform("_matches", lambda m: m["item_id"])))
    return searched(read, benchmark).select(
        "doc_id",
        F.size("_matches").cast("long").alias("n_items"),
        F.array_join(ids.cast("array<string>"), ",").alias("items"),
        F.array_min(F.transform("_matches", lambda m: m["edits"])).alias("fewest_edits"),
        (F.size("_matches") > 0).alias("contaminated"),
    )


def keep_unseen(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item occurs."""
    return renamed(by_place(docs, benchmark, text_col).filter(F.size("_matches") == 0), docs)
