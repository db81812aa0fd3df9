"""Stupid-backoff scores of documents under n-gram counts of the whole corpus.

Method: every document is exploded into its n-grams, up to the given order. Counts are summed
per cell, then in tables partitioned by the hash of the n-gram; each cell joins its n-grams to
the counts and sums the scores per document. A document doesn't score itself: its own
occurrences are taken off every count, so n-grams found nowhere else back off.

From order 3 on a cell counts an n-gram only where other documents have both n-grams of one word
less in it. Where one of the two is in no other document, neither is the longer one: the count of
the others is 0 without asking, and no other document's count lacks it.

With c the counts of the other documents, N their number of words and a the back-off factor:
S(w | u) = c(u w) / c(u) if c(u w) > 0, else a * S(w | u without its first word); a single word
has S(w) = c(w) / N, or a / (N + 1) if no other document has it. ``log_score`` is the sum of
ln S over a document's words, ``mean_log_score`` that over the number of words.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, A-Z in lower case. N-grams don't cross
documents. Defined results: null or empty text has no words, a sum of 0 and no mean. Rows equal
in id and text are one document: their repeats count once. Any id and other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm import cells as C
from tallyroll.llm import kernels as K
from tallyroll.llm.tables import keyed

ORDER, BACKOFF = 3, 0.4
# Up to this order all n-grams are counted at once; longer ones after the replies to shorter ones.
UNASKED = 2
# N-grams of every order take several times the memory of the texts, hence smaller cells.
CELL_BYTES = 8 << 20
RESULT = "doc_id long, n_words long, log_score double, mean_log_score double"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


class _Cell:
    """N-grams of a cell's documents, order by order."""

    def __init__(self, table: pa.Table):
        order = np.lexsort((table.column("h").to_numpy(), table.column("id").to_numpy()))
        self.table = table.take(pa.array(order))
        ids, hs = self.table.column("id").to_numpy(), self.table.column("h").to_numpy()
        same = (ids[1:] == ids[:-1]) & (hs[1:] == hs[:-1])
        self.again = np.concatenate(([False], same)) if len(ids) else np.zeros(0, bool)
        data, offsets = K.strings(self.table.column("text"))
        parts = [(w.hash, w.row + w.low) for w in K.words(LOWER[data], offsets)]
        self.hash, self.row = C.joined([p[0] for p in parts], np.uint64), C.joined([p[1] for p in parts], np.int64)
        if self.again.any():
            keep = ~self.again[self.row]
            self.hash, self.row = self.hash[keep], self.row[keep]
        self.n_words = np.bincount(self.row, minlength=self.table.num_rows)

    def grams(self, order: int, shared: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Place of the first word of each n-gram; distinct n-grams, which one each place has, and their counts.

        ``shared`` marks the places whose n-gram of one word less other documents have; only n-grams made of two such count.
        """
        values = K.rolling(self.hash, order)
        at = self.whole(order)
        if shared is not None:
            at = at[shared[at] & shared[at + 1]]
        distinct, back, count = np.unique(values[at], return_inverse=True, return_counts=True)
        return at, distinct, back, count

    def whole(self, order: int) -> np.ndarray:
        """Places with an n-gram of this order."""
        n = len(self.row) - order + 1
        return np.flatnonzero(self.row[:n] == self.row[order - 1 :]) if n > 0 else np.zeros(0, np.int64)

    def others(self, order: int, replies: pa.Table, before: np.ndarray | None, n: int) -> np.ndarray:
        """How often other documents have the n-gram of each place, 0 where there is none; ``before`` is that of one word less."""
        at, distinct, back, count = self.grams(order, before > 0 if order > UNASKED else None)
        sizes = np.diff(C.bucket_edges(distinct, n))
        more = [_dense(int(size), *C.unpack(d, np.uint8, np.uint8, np.int64)) for d, size in zip(C.received(replies, order), sizes[sizes > 0], strict=True)]
        out = np.zeros(len(self.hash), np.int64)
        out[at] = (count + C.joined(more, np.int64))[back] - self.own(at, back)
        return out

    def own(self, at: np.ndarray, back: np.ndarray) -> np.ndarray:
        """How often the document of each place has its n-gram."""
        pairs = back.astype(np.int64) * (self.table.num_rows + 1) + self.row[at]
        _, which, times = np.unique(pairs, return_inverse=True, return_counts=True)
        return times[which]


def _summed(table: pa.Table, order: int) -> pa.Table:
    """Reply to blocks of (n-gram, count): what the other cells have of each."""
    got = [_met(d.as_py()) for d in table.column("data")]
    distinct, back = np.unique(C.joined([g[0] for g in got], np.uint64), return_inverse=True)
    own = C.joined([g[1] for g in got], np.int64)
    total = np.bincount(back, weights=own, minlength=len(distinct)).astype(np.int64)
    return C.answers(table, order, [C.pack(*_sparse(part)) for part in C.split(total[back] - own, [len(g[0]) for g in got])])


def _sparse(counts: np.ndarray) -> list[np.ndarray]:
    """Counts that are mostly 0: a bit each, the others in a byte each; larger ones follow, in order."""
    some = counts[counts > 0]
    return [np.packbits(counts > 0), np.minimum(some, 255).astype(np.uint8), some[some >= 255].astype(np.int64)]


def _dense(n: int, bits: np.ndarray, small: np.ndarray, large: np.ndarray) -> np.ndarray:
    some = small.astype(np.int64)
    some[small == 255] = large
    out = np.zeros(n, np.int64)
    out[np.unpackbits(bits, count=n).astype(bool)] = some
    return out


def _sent(cell: int, step: int, hashes: np.ndarray, counts: np.ndarray, n: int) -> pa.Table:
    """A cell's sorted n-grams of an order and their counts, as one row for each bucket.

    The upper 16 bits of sorted hashes are sent as how many hashes have each value, the lower 48 as
    they are; of a count only what exceeds 1.
    """
    edges = C.bucket_edges(hashes, n)
    filled = np.flatnonzero(np.diff(edges))
    upper = (hashes >> np.uint64(48)).astype(np.int64)
    lower = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    data = []
    for low, high in zip(edges[filled].tolist(), edges[filled + 1].tolist(), strict=True):
        first = upper[low]
        data.append(C.pack(upper[low : low + 1], *_sparse(np.bincount(upper[low:high] - first)), lower[low:high], *_sparse(counts[low:high] - 1)))
    buckets = pa.array(step * n + filled, pa.int32())
    return pa.table([buckets, pa.array(np.full(len(filled), cell), pa.int32()), pa.array(data, pa.binary())], schema=C._BLOCK)


def _met(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """N-grams and counts of a block."""
    first, bits, small, large, lower, *counts = C.unpack(data, np.int64, np.uint8, np.uint8, np.int64, np.uint8, np.uint8, np.uint8, np.int64)
    size = len(lower) // 6
    raw = np.zeros((size, 8), np.uint8)
    raw[:, :6] = lower.reshape(size, 6)
    times = _dense(8 * len(bits), bits, small, large)
    upper = np.repeat(np.arange(len(times)) + first[0], times).astype(np.uint64)
    return raw.view("<u8").ravel().astype(np.uint64) | upper << np.uint64(48), _dense(size, *counts) + 1


def _met_with(work: Callable[[pa.Table, pa.Table, int], pa.Table], order: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    return lambda table, replies: work(table, replies, order)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, backoff: float = BACKOFF) -> DataFrame:
    """One row per input row: ``doc_id, n_words, log_score, mean_log_score``."""
    dealt, n = C.dealt(keyed(docs, id_col, text_col), CELL_BYTES)

    def blocks(table: pa.Table) -> pa.Table:
        """The shorter n-grams of the cell, and its number of words, for every cell to know the total."""
        cell, number = _Cell(table), table.column("cell")[0].as_py()
        total = np.array([len(cell.hash)], np.int64)
        parts = [pa.table([pa.array([0], pa.int32()), pa.array([number], pa.int32()), pa.array([total.tobytes()], pa.binary())], schema=C._BLOCK)]
        for k in range(1, min(order, UNASKED) + 1):
            _, distinct, _, count = cell.grams(k)
            parts.append(_sent(number, k, distinct, count, n))
        return pa.concat_tables(parts)

    def longer_blocks(table: pa.Table, replies: pa.Table, k: int) -> pa.Table:
        cell, others = _Cell(table), None
        for shorter in range(UNASKED, k):
            others = cell.others(shorter, replies, others, n)
        _, distinct, _, count = cell.grams(k, others > 0)
        return _sent(table.column("cell")[0].as_py(), k, distinct, count, n)

    def answered(table: pa.Table) -> pa.Table:
        """Each order has n buckets; the first n are those of the number of words, of which one is used."""
        step = table.column("bucket")[0].as_py() // n
        if step:
            return _summed(table, step)
        total = sum(int(np.frombuffer(d.as_py(), np.int64)[0]) for d in table.column("data"))
        return C.answers(table, 0, [np.array([total], np.int64).tobytes()] * table.num_rows)

    def sums(table: pa.Table, replies: pa.Table) -> pa.Table:
        cell = _Cell(table)
        total = np.frombuffer(C.received(replies, 0)[0], np.int64)[0]
        rest = np.maximum(total - cell.n_words[cell.row], 0)
        # From the shortest n-gram up: value of the word at each place, given its context so far.
        others = None
        value = np.zeros(len(cell.hash))
        for k in range(1, order + 1):
            # The context of an n-gram is the shorter n-gram that starts at the same place.
            context, others = others, cell.others(k, replies, others, n)
            if k == 1:
                with np.errstate(divide="ignore"):
                    value = np.where(others > 0, np.log(np.maximum(others, 1)) - np.log(np.maximum(rest, 1)), np.log(backoff) - np.log(rest + 1))
            else:
                at = cell.whole(k)
                last = at + k - 1
                shorter = value[last] + np.log(backoff)
                value[last] = np.where(others[at] > 0, np.log(np.maximum(others[at], 1)) - np.log(np.maximum(context[at], 1)), shorter)
        logs = np.bincount(cell.row, weights=value, minlength=cell.table.num_rows)
        n_words = cell.n_words.astype(np.int64)
        for r in np.flatnonzero(cell.again):
            logs[r], n_words[r] = logs[r - 1], n_words[r - 1]
        mean = np.where(n_words > 0, logs / np.maximum(n_words, 1), np.nan)
        return pa.table([cell.table.column("doc_id"), pa.array(n_words), pa.array(logs), pa.array(mean, pa.float64(), from_pandas=True)], names=["doc_id", "n_words", "log_score", "mean_log_score"])

    replies = C.reply(C.ask(dealt, blocks), answered)
    for k in range(UNASKED + 1, order + 1):
        asked = C.ask_again(dealt, replies.filter(F.col("step") >= UNASKED), _met_with(longer_blocks, k))
        replies = replies.unionByName(C.reply(asked, answered))
    return C.ask_again(dealt, replies, sums, RESULT)
