"""Word passages that an earlier document already has, by Rabin-Karp hashes of every window.

Method: each window of 13 words has a rolling hash. Windows that could repeat are found first:
winnowing gives every window an anchor, a run of six words within it that equal windows share,
and only windows whose anchor occurs twice in the corpus go on. Their hashes are counted per cell
and then per bucket: a bucket finds the smallest id of each hash and tells every cell whether
some smaller id than its own has it. Windows with an earlier owner merge into maximal intervals,
which are cut.

Defined results: null or empty text has no words. Kept words are joined by one space. A null id
comes before all others. Rows of one id don't cut each other's words; a window counts as in a
document with a smaller id only if that id is smaller. Other columns are not read.

Hashes have 64 bits over a fixed random table; two different windows agree with a probability of
about 5e-20 for each pair, and the pairs that matter are those of repeated anchors.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroll.llm import cells as C
from tallyroll.llm import kernels as K
from tallyroll.llm.tables import keyed

WINDOW, ANCHOR = 13, 6
# Cells are smaller where texts and other columns go through Python and come back.
PASSED_CELL = 4 << 20
RESULT = "n_words long, n_removed long, kept_text string, kept_sha256 string"


class _Cell:
    """Words of all rows of a cell, its anchors and windows."""

    def __init__(self, table: pa.Table, window: int):
        self.table, self.window = table, window
        self.data, self.offsets = K.strings(table.column("text"))
        parts = [(w.hash, w.row + w.low, w.start, w.end) for w in K.words(self.data, self.offsets)]
        kinds = (np.uint64, np.int64, np.int64, np.int64)
        self.hash, self.row, self.start, self.end = (C.joined([p[i] for p in parts], kind) for i, kind in enumerate(kinds))
        self.bounds = np.searchsorted(self.row, np.arange(table.num_rows + 1))

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash of each anchor, first and last window that has it."""
        size = min(ANCHOR, self.window)
        keys = K.rolling(self.hash, size, base=0x9FB21C651E98DF25)
        place, first, last = K.anchors(keys, self.window - size + 1)
        if not len(place):
            return np.zeros(0, np.uint64), place, place
        # Windows that run over the end of a row don't count.
        windows = len(self.hash) - self.window + 1
        whole = self.row[:windows] == self.row[self.window - 1 :]
        count = np.concatenate(([0], np.cumsum(whole)))
        some = count[last + 1] > count[first]
        return keys[place[some]], first[some], last[some]

    def candidates(self, replies: pa.Table, n: int, step: int) -> np.ndarray:
        """Windows whose anchor occurs twice."""
        keys, first, last = self.anchors()
        distinct, back = np.unique(keys, return_inverse=True)
        twice = C.bits(C.received(replies, step), distinct, n)[back]
        windows = max(0, len(self.hash) - self.window + 1)
        mask = K.covered(first[twice], (last - first + 1)[twice], windows)
        mask &= self.row[:windows] == self.row[self.window - 1 :]
        return np.flatnonzero(mask)

    def owners(self, candidates: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes of the windows, smallest id of each, and for each window its hash's place and own id."""
        hashes = K.rolling(self.hash, self.window)[candidates]
        own = ids[self.row[candidates]]
        distinct, back = np.unique(hashes, return_inverse=True)
        least = np.full(len(distinct), np.iinfo(np.int64).max)
        np.minimum.at(least, back, own)
        return distinct, least, back, own


def _cell_number(*tables: pa.Table) -> int:
    return next(t.column("cell")[0].as_py() for t in tables if t.num_rows)


def _smaller_owner(table: pa.Table) -> pa.Table:
    """Bucket's reply to blocks of (hash, smallest id): bits, set where another cell has a smaller id."""
    got = [C.unpack(d.as_py(), np.uint64, np.int64) for d in table.column("data")]
    hashes, ids = C.joined([g[0] for g in got], np.uint64), C.joined([g[1] for g in got], np.int64)
    distinct, back = np.unique(hashes, return_inverse=True)
    least = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(least, back, ids)
    return C.answers(table, 2, [np.packbits(part).tobytes() for part in C.split(least[back] < ids, [len(g[0]) for g in got])])


def removed_passages(docs: DataFrame, window: int = WINDOW, texts: bool = True, cell_bytes: int = C.CELL_BYTES) -> DataFrame:
    """What ``keyed`` gives, with ``n_words, n_removed, kept_text, kept_sha256`` in place of its text.

    Either ``kept_text`` is given, which is the text itself where nothing is removed, or ``kept_sha256``; the other is null.
    """
    dealt, n = C.dealt(docs, cell_bytes)
    passed = [f for f in docs.schema.fields if f.name != "text"]
    result = T.StructType([*passed, *T.StructType.fromDDL(RESULT).fields])

    def anchor_blocks(table: pa.Table) -> pa.Table:
        K.give_back()
        keys, times = np.unique(_Cell(table, window).anchors()[0], return_counts=True)
        return C.blocks(_cell_number(table), keys, n, times > 1)

    def window_blocks(table: pa.Table, replies: pa.Table) -> pa.Table:
        K.give_back()
        if not replies.num_rows:
            return C._BLOCK.empty_table()
        cell = _Cell(table, window)
        distinct, least, _, _ = cell.owners(cell.candidates(replies, n, 1), table.column("id").to_numpy())
        return C.blocks(_cell_number(table), distinct, n, least)

    def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
        K.give_back()
        cell = _Cell(table, window)
        gone = np.zeros(len(cell.hash), bool)
        if replies.num_rows:
            candidates = cell.candidates(replies, n, 1)
            distinct, least, back, own = cell.owners(candidates, table.column("id").to_numpy())
            elsewhere = C.bits(C.received(replies, 2), distinct, n)
            gone = K.covered(candidates[elsewhere[back] | (own > least[back])], window, len(cell.hash))
        text, digest, removed = [], [], []
        for r in range(table.num_rows):
            low, high = int(cell.bounds[r]), int(cell.bounds[r + 1])
            mask, whole = gone[low:high], cell.data[cell.offsets[r] : cell.offsets[r + 1]].tobytes()
            removed.append(int(mask.sum()))
            if texts:
                text.append((b" ".join(compress(whole.split(), ~mask)) if removed[-1] else whole).decode())
            else:
                words = whole.split()
                digest.append(hashlib.sha256(b" ".join(compress(words, ~mask) if removed[-1] else words)).hexdigest())
        text, digest = (found or [None] * table.num_rows for found in (text, digest))
        columns = [table.column(f.name) for f in passed]
        columns += [pa.array(np.diff(cell.bounds)), pa.array(removed, pa.int64()), pa.array(text, pa.string()), pa.array(digest, pa.string())]
        return pa.table(columns, names=result.names)

    first = C.reply(C.ask(dealt, anchor_blocks), lambda table: C.seen_twice(table, 1))
    second = C.reply(C.ask_again(dealt, first, window_blocks), _smaller_owner)
    return C.ask_again(dealt, first.unionByName(second), cut, result)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_sha256``."""
    return removed_passages(keyed(docs, id_col, text_col), window, texts=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


def cut_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without the passages: a text that loses words has the others joined by one space; ``n_chars`` follows."""
    names = docs.columns
    others = [F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(names) if name != text_col]
    read = keyed(docs, id_col, text_col, F.col(f"`{text_col}`").isNull().alias("missing"), *others)
    found = removed_passages(read, window, cell_bytes=PASSED_CELL)
    new = {text_col: F.when(~F.col("missing"), F.col("kept_text"))}
    if "n_chars" in names:
        place = f"c{names.index('n_chars')}"
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col(place)).cast(docs.schema["n_chars"].dataType)
    return found.select(*(new.get(name, F.col(f"c{i}")).alias(name) for i, name in enumerate(names)))
