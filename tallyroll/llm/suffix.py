"""Repeated byte strings by enhanced suffix arrays, bucket by bucket.

Method: every 100-byte window has a seed, the winnowed 32-byte string that equal windows share
at the same place. Windows whose seed occurs twice in the corpus are cut out as contexts (a seed
with its run of windows, at most 168 bytes) and sent to the seed's bucket; equal contexts of a
cell go as one. A bucket sorts the suffixes of its distinct contexts, computes the common
prefixes of neighbours and scans them with a stack: every interval of suffixes that share at
least 100 bytes, and whose bytes to the left differ, is a maximal repeat within its contexts,
with all occurrences. A repeat that is longer than a context is found piece by piece and its
pieces overlap, so merged spans are the maximal ones. All occurrences but the first are removed.

A seed that very many cells have may have more distinct contexts than a task should hold. Its
windows go one by one instead, by a 128-bit hash, each to its own hash's bucket.

Defined results: null or empty text, and text under 100 bytes, loses nothing. A null id comes
before all others; texts that share an id come in the order of a hash of the text; rows equal in
id and text are one document and get the same result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm import cells as C
from tallyroll.llm import kernels as K
from tallyroll.llm.tables import NO_ID, keyed

LENGTH, SEED = 100, 32
# Contexts take several times the memory of the texts they come from, hence smaller cells.
CELL_BYTES = 2 << 20
# Suffixes that are sorted at once (or one group of equal beginnings), and contexts (or those of one seed).
CHUNK, CONTEXTS = 100_000, 4_000
# Types of what is kept of a repeat: context, offset, depth, number, first.
KEPT = (np.int32, np.uint16, np.uint16, np.int64, np.bool_)
# A seed in at least this many cells goes window by window (replies count up to 255).
HOT_CELLS = 255
SPANS = "doc_id long, id long, h long, n_bytes long, n_removed long, spans array<struct<start: long, stop: long>>, kept_sha256 string"
GROUPS = "group long, length long, doc_id long, start long, first boolean"
KINDS = (np.uint64, np.int32, np.int64, np.int64, np.int64, np.bool_, np.uint8)  # seed, size, id, h, place, several here, bytes


class _Cell:
    """Seeds of a cell's texts and the contexts of those that repeat."""

    def __init__(self, table: pa.Table, length: int):
        order = np.lexsort((table.column("h").to_numpy(), table.column("id").to_numpy()))
        self.table = table.take(pa.array(order))
        self.id, self.h = self.table.column("id").to_numpy(), self.table.column("h").to_numpy()
        self.length, self.seed = length, min(SEED, length)
        self.data, self.offsets = K.strings(self.table.column("text"))
        # Rows equal in id and text: the first one speaks for all.
        same = (self.id[1:] == self.id[:-1]) & (self.h[1:] == self.h[:-1])
        self.again = np.concatenate(([False], same)) if len(self.id) else np.zeros(0, bool)

    def pieces(self) -> Iterator[tuple[int, int]]:
        """Ranges of bytes to look at together; neighbours overlap by less than a window within a long row."""
        for low, high in K.runs(self.offsets):
            at, stop = int(self.offsets[low]), int(self.offsets[high])
            while at < stop:
                end = min(stop, at + K.SLICE_BYTES + self.length - 1) if stop - at > 2 * K.SLICE_BYTES else stop
                yield at, end
                if end == stop:
                    break
                at = end - self.length + 1

    def seeds(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, tuple[int, int]]]:
        """Hash of each seed, its row, its first and last window (places in the whole buffer), and the piece."""
        for low, high in self.pieces():
            keys = K.rolling(K.TABLE[self.data[low:high]], self.seed)
            place, first, last = K.anchors(keys, self.length - self.seed + 1)
            if not len(place):
                continue
            row = np.searchsorted(self.offsets, place + low, side="right") - 1
            first = np.maximum(first + low, self.offsets[row])
            last = np.minimum(last + low, self.offsets[row + 1] - self.length)
            some = (first <= last) & ~self.again[row]
            yield keys[place[some]], row[some], first[some], last[some], (low, high)

    def seed_counts(self) -> tuple[np.ndarray, np.ndarray]:
        keys = C.joined([s[0] for s in self.seeds()], np.uint64)
        return np.unique(keys, return_counts=True)

    def contexts(self, replies: pa.Table, n: int, hot: int) -> tuple[list[bytes], np.ndarray, list[list[tuple[int, int, int]]]]:
        """Distinct contexts in the order of their seeds; of each its occurrences (row, place in the row, bytes), the earliest first."""
        distinct, _ = self.seed_counts()
        sizes = np.diff(C.bucket_edges(distinct, n))
        cells = C.joined([np.frombuffer(d, np.uint8) for d, _ in zip(C.received(replies, 1), sizes[sizes > 0], strict=True)], np.uint8)
        found: dict[bytes, tuple[int, list[tuple[int, int, int]]]] = {}
        raw, length = self.data.tobytes(), self.length
        for keys, row, first, last, (low, high) in self.seeds():
            count = cells[np.searchsorted(distinct, keys)]
            start = self.offsets[row]
            plain = np.flatnonzero((count > 1) & (count < hot))
            for key, r, a, b, s in zip(keys[plain].tolist(), row[plain].tolist(), first[plain].tolist(), (last[plain] + length).tolist(), start[plain].tolist(), strict=True):
                text = raw[a:b]
                if text in found:
                    found[text][1].append((r, a - s, b - a))
                else:
                    found[text] = (key, [(r, a - s, b - a)])
            often = np.flatnonzero(count >= hot)
            if len(often):
                one, two = (K.rolling(K.TABLE[self.data[low:high]], length, base=base) for base in (0x9FB21C651E98DF25, 0xD1B54A32D192ED03))
                for r, a, b, s in zip(row[often].tolist(), first[often].tolist(), last[often].tolist(), start[often].tolist(), strict=True):
                    for place in range(a, b + 1):
                        key = int(one[place - low])
                        text = key.to_bytes(8, "little") + int(two[place - low]).to_bytes(8, "little")
                        found.setdefault(text, (key, []))[1].append((r, place - s, length))
        order = sorted(found, key=lambda text: found[text][0])
        return order, np.array([found[text][0] for text in order], np.uint64), [found[text][1] for text in order]


def _number(table: pa.Table) -> int:
    return table.column("cell")[0].as_py()


def _count_cells(table: pa.Table) -> pa.Table:
    """Reply to blocks of (seed, whether it is there twice): 0 or 1 for a seed that occurs once, else how many cells have it (2 at least, 255 at most)."""
    got = [C.unpack(d.as_py(), np.uint64, np.bool_) for d in table.column("data")]
    seeds, several = C.joined([g[0] for g in got], np.uint64), C.joined([g[1] for g in got], np.bool_)
    _, back, times = np.unique(seeds, return_inverse=True, return_counts=True)
    count = np.minimum(np.maximum(times[back], np.where(several, 2, 1)), 255).astype(np.uint8)
    return C.answers(table, 1, [part.tobytes() for part in C.split(count, [len(g[0]) for g in got])])


def intervals(common: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stack scan: first and last place and depth of every interval of a suffix array whose members share ``least`` or more.

    ``common[i]`` is the common prefix of the suffixes i and i + 1.
    """
    out, stack = [], []
    values = common.tolist()
    values.append(0)
    for i, value in enumerate(values):
        left = i
        while stack and stack[-1][1] > value:
            left, depth = stack.pop()
            out.append((left, i, depth))
        if value >= least and (not stack or stack[-1][1] < value):
            stack.append((left, value))
    found = np.array(out, np.int64).reshape(-1, 3)
    return found[:, 0], found[:, 1], found[:, 2]


def repeats(texts: list[bytes], rank: np.ndarray, length: int, every: bool = True) -> tuple[np.ndarray, ...]:
    """Maximal repeats among distinct contexts: context, offset, depth, number of the repeat and whether it is the earliest, for every occurrence.

    ``rank`` orders the contexts' earliest occurrences; an offset never changes that order within
    a repeat. Without ``every``, just the longest repeat at each place that has an earlier occurrence.
    """
    size = np.array([len(t) for t in texts], np.int64)
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    base = np.cumsum(size) - size
    windows = np.maximum(size - length + 1, 0)
    context = np.repeat(np.arange(len(texts), dtype=np.int32), windows)
    place = (np.arange(len(context)) - np.repeat(np.cumsum(windows) - windows, windows)).astype(np.int32)
    # The first 100 bytes of every suffix, some contexts at a time.
    head = np.zeros(len(context), np.uint64)
    at = 0
    for low, high in K.runs(np.append(base, len(buffer))):
        n = int(windows[low:high].sum())
        own = K.rolling(K.TABLE[buffer[base[low] : base[high - 1] + size[high - 1]]], length)
        head[at : at + n] = own[base[context[at : at + n]] - base[low] + place[at : at + n]]
        at += n
    # Only suffixes whose first 100 bytes occur twice can share them.
    order = np.argsort(head)
    head = head[order]
    new = np.concatenate(([True], head[1:] != head[:-1])) if len(head) else np.zeros(0, bool)
    single = new & np.append(new[1:], True) if len(head) else new
    some, group = order[~single], np.cumsum(new)[~single]
    del head, order, new, single
    context, offset = context[some], place[some]
    del some, place
    # Suffixes that differ in their first 100 bytes share no interval, so a run of whole groups is a suffix array by itself.
    edges = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True]))) if len(group) else np.zeros(1, np.int64)
    found, at, repeats_so_far = [], 0, 0
    while at < len(edges) - 1:
        stop = max(at + 1, int(np.searchsorted(edges, edges[at] + CHUNK, side="right")) - 1)
        part = slice(int(edges[at]), int(edges[stop]))
        where, begin, depth, number, first = _chunk(buffer, base, size, rank, context[part].astype(np.int64), offset[part].astype(np.int64), group[part], length)
        if not every:
            where, begin, depth = _longest(*(x[~first] for x in (where, begin, depth)))
            number, first = np.zeros(len(where), np.int64), np.zeros(len(where), bool)
        repeats_so_far, number = repeats_so_far + int(number.max(initial=-1)) + 1, number + repeats_so_far
        found.append(tuple(x.astype(kind) for x, kind in zip((where, begin, depth, number, first), KEPT, strict=True)))
        at = stop
    kinds = KEPT
    return tuple(C.joined([f[i] for f in found], kind) for i, kind in enumerate(kinds))


def _longest(context: np.ndarray, offset: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The greatest depth at each place."""
    order = np.lexsort((-depth, offset, context))
    context, offset, depth = context[order], offset[order], depth[order]
    new = np.concatenate(([True], (context[1:] != context[:-1]) | (offset[1:] != offset[:-1]))) if len(order) else np.zeros(0, bool)
    return context[new], offset[new], depth[new]


def _chunk(buffer: np.ndarray, base: np.ndarray, size: np.ndarray, rank: np.ndarray, context: np.ndarray, offset: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Sort the suffixes of some groups, scan their common prefixes and keep the intervals that differ to the left."""
    start, rest = base[context] + offset + length, size[context] - offset - length
    width = -(-max(1, int(rest.max())) // 8) * 8
    tail = np.zeros((len(context), width), np.uint8)
    for column in range(int(rest.max())):
        there = rest > column
        tail[there, column] = buffer[start[there] + column] + 1  # 0 is the end; UTF-8 has no byte 255
    words = tail.view(">u8")
    order = np.lexsort((*(words[:, c] for c in range(words.shape[1] - 1, -1, -1)), group))
    context, offset, group, tail, rest = context[order], offset[order], group[order], tail[order], rest[order]
    differ = tail[1:] != tail[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    shared = np.minimum(shared, np.minimum(rest[1:], rest[:-1])) + length
    shared[group[1:] != group[:-1]] = 0
    low, high, depth = intervals(shared, length)
    # Left extension: the byte before, or a mark of its own where the context begins.
    before = np.where(offset > 0, buffer[np.maximum(base[context] + offset - 1, 0)].astype(np.int64), -1 - np.arange(len(context)))
    turns = np.concatenate(([0], np.cumsum(before[1:] != before[:-1])))
    diverse = turns[high] > turns[low]
    low, high, depth = low[diverse], high[diverse], depth[diverse]
    if not len(low):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, bool),)
    own = np.append(rank[context], np.iinfo(np.int64).max)
    least = np.minimum.reduceat(own, np.stack((low, high + 1), axis=1).ravel())[::2]
    count = high - low + 1
    number = np.repeat(np.arange(len(low)), count)
    member = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    return context[member], offset[member], depth[number], number, own[member] == least[number]


def _intervals_of(table: pa.Table, length: int, every: bool) -> pa.Table:
    """Reply to blocks of contexts: whether the cell has the earliest one of its kind, whether it repeats at all, and the spans within it that have an earlier occurrence (or every repeat, if asked for)."""
    got = [C.unpack(d.as_py(), *KINDS) for d in table.column("data")]
    texts: dict[bytes, int] = {}
    which = []
    for block in got:
        raw, at = block[6].tobytes(), 0
        for size in block[1].tolist():
            which.append(texts.setdefault(raw[at : at + size], len(texts)))
            at += size
    which = np.array(which, np.int64)
    seed, _, ids, hs, place, several = (C.joined([g[i] for g in got], kind) for i, kind in enumerate(KINDS[:6]))
    # The earliest entry of each context, and the order of contexts by it.
    order = np.lexsort((place, hs, ids))
    turn = np.empty(len(order), np.int64)
    turn[order] = np.arange(len(order))
    rank = np.full(len(texts), np.iinfo(np.int64).max)
    np.minimum.at(rank, which, turn)
    times = np.bincount(which, weights=1 + several, minlength=len(texts)).astype(np.int64)
    earliest = rank[which] == turn
    # Contexts alone with their seed share nothing with others.
    seed_of = np.zeros(len(texts), np.uint64)
    seed_of[which] = seed
    _, back, kinds = np.unique(seed_of, return_inverse=True, return_counts=True)
    met = np.flatnonzero(kinds[back] > 1)
    met = met[np.argsort(back[met], kind="stable")]
    names = list(texts)
    # Equal windows have one seed, so whole seeds go one run after another.
    runs = np.flatnonzero(np.concatenate(([True], back[met[1:]] != back[met[:-1]], [True]))) if len(met) else np.zeros(1, np.int64)
    found, at, repeats_so_far = [], 0, 0
    while at < len(runs) - 1:
        stop = max(at + 1, int(np.searchsorted(runs, runs[at] + CONTEXTS, side="right")) - 1)
        own = met[runs[at] : runs[stop]]
        where, begin, depth, number, first = repeats([names[i] for i in own], rank[own], length, every)
        found.append((own[where].astype(np.int32), begin, depth, number + repeats_so_far, first))
        repeats_so_far += int(number.max(initial=-1)) + 1
        at = stop
    context, offset, depth, number, first = (C.joined([f[i] for f in found], kind) for i, kind in enumerate(KEPT))
    # Spans of a context, for each of its entries that needs them.
    by = np.argsort(context, kind="stable")
    context, offset, depth, number, first = (x[by] for x in (context, offset, depth, number, first))
    edges = np.searchsorted(context, np.arange(len(texts) + 1))
    salt = K.mix(np.array([int(table.column("bucket")[0].as_py())], np.uint64))[0]
    data, at = [], 0
    for block in got:
        n = len(block[0])
        own = np.arange(at, at + n)
        at += n
        wanted = own if every else own[earliest[own]]
        count = edges[which[wanted] + 1] - edges[which[wanted]]
        take = np.repeat(edges[which[wanted]] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        entry = np.repeat(wanted - own[0] if n else wanted, count)
        data.append(C.pack(earliest[own], times[which[own]] > 1, entry.astype(np.uint32), offset[take], depth[take], number[take].astype(np.uint64) ^ salt, first[take]))
    return C.answers(table, 2, data)


REPLY = (np.bool_, np.bool_, np.uint32, np.uint16, np.uint16, np.uint64, np.bool_)


def _asked(docs: DataFrame, length: int, hot: int, every: bool) -> tuple[DataFrame, DataFrame, int]:
    """Cells and all replies to them."""
    dealt, n = C.dealt(docs, CELL_BYTES)

    def seed_blocks(table: pa.Table) -> pa.Table:
        seeds, times = _Cell(table, length).seed_counts()
        return C.blocks(_number(table), seeds, n, times > 1)

    def context_blocks(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows or not replies.num_rows:
            return C._BLOCK.empty_table()
        cell = _Cell(table, length)
        texts, seeds, places = cell.contexts(replies, n, hot)
        edges = C.bucket_edges(seeds, n)
        rows = []
        for b in np.flatnonzero(np.diff(edges)):
            own = range(edges[b], edges[b + 1])
            first = [places[i][0] for i in own]
            data = C.pack(
                seeds[edges[b] : edges[b + 1]], np.array([len(texts[i]) for i in own], np.int32), cell.id[[f[0] for f in first]], cell.h[[f[0] for f in first]],
                np.array([f[1] for f in first], np.int64), np.array([len(places[i]) > 1 for i in own], bool), np.frombuffer(b"".join(texts[i] for i in own), np.uint8),
            )
            rows.append({"bucket": int(b), "cell": _number(table), "data": data})
        return pa.Table.from_pylist(rows, schema=C._BLOCK)

    first = C.reply(C.ask(dealt, seed_blocks), _count_cells)
    second = C.reply(C.ask_again(dealt, first, context_blocks), lambda table: _intervals_of(table, length, every))
    return dealt, first.unionByName(second), n


def _replies(cell: _Cell, replies: pa.Table, n: int, hot: int):
    """Contexts' occurrences and, for all buckets together, what the replies say of each context."""
    _, seeds, places = cell.contexts(replies, n, hot)
    edges = C.bucket_edges(seeds, n)
    starts = edges[:-1][np.diff(edges) > 0]
    got = [C.unpack(d, *REPLY) for d in C.received(replies, 2)]
    earliest, repeated = (C.joined([g[i] for g in got], np.bool_) for i in (0, 1))
    entry = C.joined([g[2].astype(np.int64) + s for g, s in zip(got, starts, strict=True)], np.int64)
    return places, earliest, repeated, entry, *(C.joined([g[i] for g in got], REPLY[i]) for i in (3, 4, 5, 6))


def removed_spans(docs: DataFrame, length: int = LENGTH, hot_cells: int = HOT_CELLS) -> DataFrame:
    """Of what ``keyed`` gives: ``doc_id, id, h, n_bytes, n_removed, spans, kept_sha256``, a row for each row."""
    dealt, replies, n = _asked(docs, length, hot_cells, every=False)

    def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
        cell = _Cell(table, length)
        starts, sizes = [], []
        if replies.num_rows and table.num_rows:
            places, earliest, _, entry, offset, depth, _, _ = _replies(cell, replies, n, hot_cells)
            for own, first in zip(places, earliest.tolist(), strict=True):
                for r, at, size in own[1 if first else 0 :]:
                    starts.append(int(cell.offsets[r]) + at)
                    sizes.append(size)
            for e, o, d in zip(entry.tolist(), offset.tolist(), depth.tolist(), strict=True):
                r, at, _ = places[e][0]
                starts.append(int(cell.offsets[r]) + at + o)
                sizes.append(d)
        gone = K.covered(np.array(starts, np.int64), np.array(sizes, np.int64), len(cell.data))
        digest, removed, spans = [], [], []
        for r in range(cell.table.num_rows):
            if cell.again[r]:
                for out in (digest, removed, spans):
                    out.append(out[-1])
                continue
            low, high = int(cell.offsets[r]), int(cell.offsets[r + 1])
            mask = gone[low:high]
            edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])))).reshape(-1, 2)
            spans.append([{"start": a, "stop": b} for a, b in edge.tolist()])
            removed.append(int(mask.sum()))
            digest.append(hashlib.sha256(cell.data[low:high][~mask] if removed[-1] else cell.data[low:high]).hexdigest())
        columns = [cell.table.column(c) for c in ("doc_id", "id", "h")]
        columns += [pa.array(np.diff(cell.offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(digest, pa.string())]
        return pa.table(columns, names=["doc_id", "id", "h", "n_bytes", "n_removed", "spans", "kept_sha256"])

    return C.ask_again(dealt, replies, cut, SPANS)


def repeat_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``group, length, doc_id, start, first``: every occurrence of every repeat, in bytes.

    A context that occurs twice as a whole is a repeat too; its group is a hash of its text.
    """
    dealt, replies, n = _asked(keyed(docs, id_col, text_col), length, 256, every=True)

    def members(table: pa.Table, replies: pa.Table) -> pa.Table:
        cell = _Cell(table, length)
        rows = []
        if replies.num_rows and table.num_rows:
            texts, _, _ = cell.contexts(replies, n, 256)
            places, earliest, repeated, entry, offset, depth, number, first = _replies(cell, replies, n, 256)
            ids = [None if i == NO_ID else i for i in cell.id.tolist()]
            for text, own, is_first, again in zip(texts, places, earliest.tolist(), repeated.tolist(), strict=True):
                group = int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)
                rows += [(group, size, ids[r], at, is_first and k == 0) for k, (r, at, size) in enumerate(own)] if again else []
            for e, o, d, group, f in zip(entry.tolist(), offset.tolist(), depth.tolist(), number.view(np.int64).tolist(), first.tolist(), strict=True):
                rows += [(group, d, ids[r], at + o, f and bool(earliest[e]) and k == 0) for k, (r, at, _) in enumerate(places[e])]
        names = ("group", "length", "doc_id", "start", "first")
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        return pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)

    return C.ask_again(dealt, replies, members, GROUPS)


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, hot_cells: int = HOT_CELLS) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    found = removed_spans(keyed(docs, id_col, text_col), length, hot_cells)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
