"""Byte-pair encoding and decoding with word ends, as the tokenizers library does it.

Method: the distinct new words of a batch of documents lie in one flat array of symbols. In each
round every adjacent pair is looked up by binary search in the sorted pair keys, each word takes
its lowest rank, and all its places of that pair merge at once, from the left and without overlap.
Words that have no pair left drop out. Documents are then put together from their words' ids.

The vocabulary file is a parameter and is read where it lies. It must be a BPE model with word
ends whose normalizer is NFC, white space to one space, lower case, and whose words are those of
its pre-tokenizer's pattern; anything else is refused.

Defined results: null or empty text gives no tokens and the hash of nothing. Special tokens'
strings in a text are those tokens, as in the library. Any id, repeated rows and other columns
don't matter; every row is encoded by itself. A text of any length is one row's work; the cache
of words is bounded.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm import kernels as K

CACHED_WORDS = 200_000
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
# The printable stand-ins of bytes in byte-level vocabularies, as ranges of bytes that stand for themselves.
PRINTABLE = [(0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)]


def byte_symbols() -> list[str]:
    """Byte -> its character; bytes that aren't printable get the characters from U+0100 on, in order."""
    own = {b for low, high in PRINTABLE for b in range(low, high + 1)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def merge_words(words: list[np.ndarray], keys: np.ndarray, ranks: np.ndarray, made: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge the symbols of many words. Returns all symbols, and the bounds of each word.

    ``keys`` are the sorted pairs (left << 32 | right), ``ranks`` and ``made`` their rank and the symbol they form.
    """
    length = np.array([len(w) for w in words], np.int64)
    flat = np.concatenate(words) if words else np.zeros(0, np.int64)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    number = np.arange(len(words))
    while len(number):
        first = np.cumsum(length) - length
        last = first + length - 1
        pair = np.append((flat[:-1] << 32) | flat[1:], -1)
        at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        rank = np.where(keys[at] == pair, ranks[at], np.iinfo(np.int64).max)
        rank[last] = np.iinfo(np.int64).max
        best = np.minimum.reduceat(rank, first)
        rest = best == np.iinfo(np.int64).max
        if rest.any():
            keep = np.repeat(rest, length)
            done.append((number[rest], flat[keep], length[rest]))
            number, keep = number[~rest], ~keep
            flat, at, rank, length, best = flat[keep], at[keep], rank[keep], length[~rest], best[~rest]
            if not len(number):
                break
        hit = rank == np.repeat(best, length)
        # Of places in a row (the same symbol again and again) every other one merges, from the left.
        place = np.flatnonzero(hit)
        start = np.concatenate(([True], place[1:] != place[:-1] + 1))
        within = np.arange(len(place)) - np.maximum.accumulate(np.where(start, np.arange(len(place)), 0))
        place = place[within % 2 == 0]
        flat[place] = made[at[place]]
        left = np.ones(len(flat), bool)
        left[place + 1] = False
        length = np.add.reduceat(left.astype(np.int64), np.cumsum(length) - length)
        flat = flat[left]
    if not done:
        return flat, np.zeros(len(words) + 1, np.int64)
    number = np.concatenate([d[0] for d in done])
    length = np.concatenate([d[2] for d in done])
    flat = np.concatenate([d[1] for d in done])
    # Back to the words' own order.
    order = np.argsort(number)
    source = (np.cumsum(length) - length)[order]
    length = length[order]
    bounds = np.concatenate(([0], np.cumsum(length)))
    return flat[np.repeat(source - bounds[:-1], length) + np.arange(bounds[-1])], bounds


class Bpe:
    """A vocabulary file, ready to encode."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, kinds = spec["model"], [n["type"] for n in spec["normalizer"]["normalizers"]]
        pre = spec["pre_tokenizer"]["pretokenizers"]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in pre] != ["Split", "ByteLevel"] or spec["decoder"]:
            raise ValueError(f"not a vocabulary of this kind: {path}")
        self.end = model["end_of_word_suffix"] or ""
        vocabulary = model["vocab"]
        self.token = {i: t for t, i in vocabulary.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.is_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.pattern = regex.compile(pre[0]["pattern"]["Regex"])
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        pairs = np.array([(vocabulary[a] << 32) | vocabulary[b] for a, b in merges], np.int64)
        made = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        keys, first = np.unique(pairs[::-1], return_index=True)  # of a pair listed twice the last rank counts
        self.keys, self.ranks = keys, len(pairs) - 1 - first
        self.made = made[self.ranks]
        symbols = byte_symbols()
        self.inner = np.array([vocabulary.get(s, -1) for s in symbols], np.int64)
        self.final = np.array([vocabulary.get(s + self.end, -1) for s in symbols], np.int64)
        if (self.inner < 0).any() or (self.final < 0).any():
            raise ValueError(f"a byte has no symbol: {path}")
        self.known: dict[str, tuple[str, str, int]] = {}

    def normal(self, text: str) -> str:
        text = regex.sub(r"\p{White_Space}+", " ", unicodedata.normalize("NFC", text))
        # Lower case goes letter by letter: no final form of sigma.
        return text.replace("Σ", "σ").lower()

    def pieces(self, text: str) -> list[str]:
        """Words and special tokens of a text, in order."""
        out, at = [], 0
        if "<|" not in text:
            return self.pattern.findall(self.normal(text))
        for hit in self.is_special.finditer(text):
            out += self.pattern.findall(self.normal(text[at : hit.start()]))
            out.append(hit[0])
            at = hit.end()
        return out + self.pattern.findall(self.normal(text[at:]))

    def learn(self, words: set[str]) -> None:
        """Encode words that aren't known yet: text of ids, text of tokens, number of tokens."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        for token, i in self.special.items():
            self.known[token] = (str(i), token, 1)
        new = [w for w in words if w not in self.known]
        arrays = []
        for word in new:
            data = np.frombuffer(word.encode(), np.uint8)
            array = self.inner[data]
            array[-1] = self.final[data[-1]]
            arrays.append(array)
        flat, bounds = merge_words(arrays, self.keys, self.ranks, self.made)
        ids, bounds = flat.tolist(), bounds.tolist()
        for word, low, high in zip(new, bounds, bounds[1:], strict=False):
            own = ids[low:high]
            self.known[word] = (" ".join(map(str, own)), " ".join(map(self.token.__getitem__, own)), high - low)

    def digests(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """Per text: number of tokens, SHA-256 of the ids, SHA-256 of the decoded text."""
        split = [self.pieces(t) for t in texts]
        self.learn(set().union(*split))
        known = self.known
        for words in split:
            rows = [known[w] for w in words]
            ids = " ".join([r[0] for r in rows])
            decoded = " ".join([r[1] for r in rows])
            yield sum([r[2] for r in rows]), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    def encode(self, text: str) -> list[int]:
        words = self.pieces(text)
        self.learn(set(words))
        return [int(i) for w in words for i in self.known[w][0].split()]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space: what the file's missing decoder means."""
        return " ".join(self.token[i] for i in ids if i in self.token)


@cache
def model(path: str) -> Bpe:
    return Bpe(path)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def bpe_digests(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", batch_chars: int = 1 << 20) -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    path = path or vocabulary_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        for batch in batches:
            ids, low, size, out = batch.column("doc_id"), 0, 0, []
            texts = batch.column("text")
            group: list[str] = []
            for value in texts:
                group.append(value.as_py() or "")
                size += len(group[-1])
                if size >= batch_chars:
                    out += bpe.digests(group)
                    group, size = [], 0
            out += bpe.digests(group) if group else []
            n, coded, decoded = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    read = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return read.mapInArrow(K.tidy(encode), RESULT)
