"""Token counts by a longest-match automaton, without building the pieces.

Method: the vocabulary is a trie. When a word leaves the trie, the longest pieces that cover what
was read so far are popped and matching goes on at the failure link, the node of what is left over;
the number of popped pieces is precomputed, so a word takes time in proportion to its length and
nothing is matched twice. All distinct words of a batch step through the automaton together: one
array operation per byte position, transitions found by binary search in the sorted edges. Where
only a few long words are left, each is read to its end by itself.

The vocabulary comes from the file of a byte-level vocabulary, a parameter, read where it lies:
its tokens that begin with a space's symbol begin a word, all others continue one. A word that
pieces cannot cover counts as one unknown token, as does, only where that is given, a word of more than ``max_bytes`` bytes,
if there is such a limit. The registered query has none.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, unchanged. Defined results: null or empty
text has no words and no tokens. Any id, repeated rows and other columns don't matter; each row is
counted by itself.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm import kernels as K
from tallyroll.llm.bpe import byte_symbols

# So many words or fewer are read one by one, which then takes less time than array operations.
FEW = 64
RESULT = "doc_id long, n_words long, n_tokens long, n_unknown long"


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces_of(path: str) -> tuple[set[bytes], set[bytes]]:
    """Pieces that begin a word, and pieces that continue one, as bytes."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte = {s: b for b, s in enumerate(byte_symbols())}
    space, special = byte_symbols()[0x20], {t["content"] for t in spec["added_tokens"]}
    first, rest = set(), set()
    for token in spec["model"]["vocab"]:
        if token in special:
            continue
        if token.startswith(space) and len(token) > 1:
            first.add(bytes(byte[c] for c in token[1:]))
        else:
            rest.add(bytes(byte[c] for c in token))
    return first, rest


class Automaton:
    """Trie with two roots, for the first piece and for the others, failure links and popped counts.

    Nodes: 0 is the first root, 1 the root of continuing pieces. ``fail[v]`` is the node of what
    is left after popping, or -1 if the pieces can't cover node v's string; ``pops[v]`` is how
    many pieces are popped on the way.
    """

    def __init__(self, first: set[bytes], rest: set[bytes]):
        edges: dict[tuple[int, int], int] = {}
        piece = {}
        parent = [(-1, -1), (-1, -1)]
        for root, words in ((0, first), (1, rest)):
            for word in sorted(words):
                node = root
                for byte in word:
                    if (node, byte) not in edges:
                        edges[node, byte] = len(parent)
                        parent.append((node, byte))
                    node = edges[node, byte]
                piece[node] = True
        n = len(parent)
        self.fail, self.pops = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        # Parents come before their children within a root's trie; failure links lead to the second
        # root's trie and to shorter strings, so nodes go by depth.
        depth = [0] * n
        for v in range(2, n):
            depth[v] = depth[parent[v][0]] + 1
        for v in sorted(range(2, n), key=depth.__getitem__):
            if v in piece:
                self.fail[v], self.pops[v] = 1, 1
                continue
            node, byte = parent[v]
            at, popped = int(self.fail[node]), int(self.pops[node])
            while at >= 0 and (at, byte) not in edges:
                popped += int(self.pops[at])
                at = int(self.fail[at])
            if at >= 0:
                self.fail[v], self.pops[v] = edges[at, byte], popped
        order = sorted(edges)
        self.keys = np.array([node << 8 | byte for node, byte in order], np.int64)
        self.to = np.array([edges[key] for key in order], np.int64)
        self.ways = dict(zip(self.keys.tolist(), self.to.tolist(), strict=True))
        self.links = list(zip(self.fail.tolist(), self.pops.tolist(), strict=True))

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Where each node goes with its byte, or -1."""
        key = node << 8 | byte
        at = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
        return np.where(self.keys[at] == key, self.to[at], -1) if len(self.keys) else np.full(len(node), -1)

    def read(self, node: int, popped: int, word: bytes) -> tuple[int, int]:
        """Node (-1: not covered) and number of popped pieces after the bytes of one word."""
        ways, links = self.ways, self.links
        for byte in word:
            while (to := ways.get(node << 8 | byte)) is None:
                node, more = links[node]
                popped += more
                if node < 0:
                    return node, popped
            node = to
        return node, popped

    def count(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of pieces of each word, -1 if they can't cover it."""
        total = np.zeros(len(start), np.int64)
        order = np.argsort(start - end, kind="stable")  # longest first: at each position the words still read are a prefix
        size = (end - start)[order]
        node = np.zeros(len(start), np.int64)
        popped = np.zeros(len(start), np.int64)
        shortest_last = -size
        for i in range(int(size.max(initial=0))):
            n = int(np.searchsorted(shortest_last, -i, side="left"))
            if n <= FEW:
                for k in np.flatnonzero(node[:n] >= 0).tolist():
                    node[k], popped[k] = self.read(int(node[k]), int(popped[k]), data[start[order[k]] + i : end[order[k]]].tobytes())
                break
            live = np.flatnonzero(node[:n] >= 0)
            byte = data[start[order[live]] + i].astype(np.int64)
            while len(live):
                new = self.step(node[live], byte)
                node[live[new >= 0]] = new[new >= 0]
                stuck = new < 0
                live, byte = live[stuck], byte[stuck]
                popped[live] += self.pops[node[live]]
                node[live] = self.fail[node[live]]
                going = node[live] >= 0
                live, byte = live[going], byte[going]
        # The end of a word pops until nothing is left over: the root of continuing pieces.
        live = np.flatnonzero(node > 1)
        while len(live):
            popped[live] += self.pops[node[live]]
            node[live] = self.fail[node[live]]
            live = live[node[live] > 1]
        total[order] = np.where((node == 1) & (size > 0), popped, -1)
        return total


@cache
def automaton(path: str) -> Automaton:
    return Automaton(*pieces_of(path))


def token_counts(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", max_bytes: int | None = None) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_tokens, n_unknown``."""
    path = path or vocabulary_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            sums = np.zeros((3, n), np.int64)
            data, offsets = K.strings(batch.column("text"))
            for found in K.words(data, offsets):
                size = found.end - found.start
                # Words that agree in 64 bits of hash and in length are one word.
                _, first, back = np.unique(found.hash, return_index=True, return_inverse=True)
                fit = np.full(len(first), True) if max_bytes is None else size[first] <= max_bytes
                pieces = np.full(len(first), -1, np.int64)
                pieces[fit] = automaton(path).count(data, found.start[first][fit], found.end[first][fit])
                unknown = pieces[back] < 0
                for k, weight in enumerate((np.ones(len(back)), np.where(unknown, 1, pieces[back]), unknown)):
                    sums[k, found.low : found.high] += np.bincount(found.row, weight, minlength=found.high - found.low).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(s) for s in sums)], ["doc_id", "n_words", "n_tokens", "n_unknown"])

    read = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return read.mapInArrow(count, RESULT)
