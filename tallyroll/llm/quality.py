"""Quality rules: counts per document, and how far its histograms lie from its language's.

Method: each document has a histogram of character classes and one of common words. The
reference of a language is the mean histogram of all its documents, so that one very long
document weighs no more than another. The Jensen-Shannon distance (base 2, 0 to 1) of a
document from its reference rejects it, where it is long enough for the histograms to say
something. The fewer words a document has, the farther its histogram of words lies from the
reference by chance alone, so the limit of that distance follows the number of words.

Defined results: null or empty text has no words and fails the base rule (fewer than ten
words). A null language is a language of its own. Null ids, repeated rows and other columns
don't matter; each row is judged by itself against the references of the whole table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroll.llm import kernels as K
from tallyroll.llm.tables import numbered, renamed, text_place

# The symbols and limits of the contract.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
# Guards: a histogram of fewer characters than the first doesn't reject; one of fewer words than the
# second is not part of a reference and has a wider limit.
MIN_CHARS, MIN_COMMON_WORDS = 200, 100
# A document is rejected beyond the first distance of its characters, or if both histograms are odd:
# beyond the second one of its characters and beyond that of its words.
MAX_CHAR_DISTANCE, ODD_CHAR_DISTANCE, ODD_WORD_DISTANCE = 0.30, 0.14, 0.24
# Under MIN_COMMON_WORDS words that limit grows with 1 / sqrt(words), at this rate and up to this.
WORD_SPREAD, MOST_WORD_DISTANCE = 2.4, 0.31
# A table of references up to this many languages is broadcast (about 200 bytes each).
BROADCAST_LANGUAGES = 10_000

# Common words of the four languages; the histogram counts each, and all others together.
COMMON = (
    "the of and to a in is that it for on was with as be this by at are from "
    "der die und das den von zu mit sich des auf ist im dem nicht ein eine als auch es "
    "le la les et un une du que est pour qui dans par pas au sur se ou avec son "
    "el los las y del por con para su al lo como más pero sus este ya entre cuando todo"
).split()
# Character classes: lower, upper, digit, space, sentence marks, other ASCII signs, all beyond ASCII.
CLASSES = ("lower", "upper", "digit", "space", "mark", "sign", "beyond")


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES.index("sign"), np.int64)
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    table[K.SPACE] = 3
    table[list(b".,;:!?'\"()-")] = 4
    table[0x80:0xC0] = -1  # continues a character
    table[0xC0:] = 6
    return table


CLASS = _class_table()
SYMBOL = np.zeros(256, bool)
SYMBOL[list(SYMBOLS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
# For common words everything but letters separates.
APART = np.array([not (97 <= b <= 122 or b >= 0x80) for b in range(256)])


def _hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    return next(K.words(data, np.array([0, len(data)]))).hash


COMMON_HASH = np.sort(_hashes(sorted(set(COMMON))))
COUNTS = ("n_chars", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_row(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(rows, weights, minlength=n).astype(np.int64)


def _repeated_words(found: K.Words, n: int) -> np.ndarray:
    """Words of each row within windows that the row has twice or more."""
    window = K.rolling(found.hash, WINDOW)
    if not len(window):
        return np.zeros(n, np.int64)
    row = found.row[: len(window)]
    whole = np.flatnonzero(row == found.row[WINDOW - 1 :])
    key = window[whole] ^ K.mix(row[whole].astype(np.uint64) + np.uint64(1))
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    again = whole[times[back] > 1]
    return _per_row(found.row[K.covered(again, WINDOW, len(found.row))], n)


def _duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines) - len(set(lines))


def features(column: pa.Array, counts: bool = True) -> dict[str, np.ndarray]:
    """Histograms of every text, and its counts unless they aren't wanted."""
    data, offsets = K.strings(column)
    parts: dict[str, list[np.ndarray]] = {name: [] for name in (*COUNTS, "chars", "words")}
    found_words = K.words(data, offsets) if counts else None
    for low, high in K.runs(offsets):
        found = next(found_words) if counts else None
        n, base = high - low, int(offsets[low])
        piece = data[base : int(offsets[high])]
        edges = offsets[low : high + 1] - base
        # Whole-row sums as differences of running sums, class by class.
        kind = CLASS[piece]

        def between(mask: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate(([0], np.cumsum(mask, dtype=np.int32 if len(mask) < 2**31 else np.int64)))[edges])  # noqa: B023

        chars = np.stack([between(kind == c) for c in range(len(CLASSES))], axis=1)
        parts["chars"].append(chars)
        parts["n_chars"].append(chars.sum(axis=1))
        if counts:
            parts["word_chars"].append(chars.sum(axis=1) - chars[:, 3])
            parts["n_symbols"].append(between(SYMBOL[piece]))
            parts["n_words"].append(_per_row(found.row, n))
            parts["n_repeat_words"].append(_repeated_words(found, n))
            parts["n_dup_lines"].append(np.array([_duplicate_lines(piece[a:b].tobytes()) for a, b in zip(edges, edges[1:], strict=False)], np.int64))
        common = np.zeros((n, len(COMMON_HASH) + 1), np.int64)
        for plain in K.words(LOWER[piece], edges, limit=len(piece) + 1, space=APART):
            at = np.minimum(np.searchsorted(COMMON_HASH, plain.hash), len(COMMON_HASH) - 1)
            at = np.where(COMMON_HASH[at] == plain.hash, at, len(COMMON_HASH))
            cells = np.bincount((plain.low + plain.row) * common.shape[1] + at, minlength=common.size)
            common += cells.reshape(common.shape)
        parts["words"].append(common)
    empty = {"chars": np.zeros((0, len(CLASSES)), np.int64), "words": np.zeros((0, len(COMMON_HASH) + 1), np.int64)}
    return {k: np.concatenate(v) if v else empty.get(k, np.zeros(0, np.int64)) for k, v in parts.items()}


def shares(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, row by row: the root of the divergence in bits."""
    m = (p + q) / 2

    def part(x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / m), 0).sum(axis=1)

    return np.sqrt(np.clip((part(p) + part(q)) / 2, 0, 1))


def word_limit(n_words: np.ndarray) -> np.ndarray:
    """The distance of words beyond which a document of so many words is odd."""
    spread = WORD_SPREAD * (1 / np.sqrt(np.maximum(n_words, 1)) - 1 / np.sqrt(MIN_COMMON_WORDS))
    return np.minimum(ODD_WORD_DISTANCE + np.maximum(spread, 0), MOST_WORD_DISTANCE)


def _as_lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(values.astype(np.float64).ravel()))


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, chars, words``: mean histograms over the documents that are long enough."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sums of each batch and language; Spark adds these few rows up.
        for batch in batches:
            got = features(batch.column("text"), counts=False)
            known, code = np.unique([str(x) if x is not None else "" for x in batch.column("lang").to_pylist()], return_inverse=True)
            null = np.array([x is None for x in batch.column("lang").to_pylist()], bool)
            code = np.where(null, len(known), code)
            out = []
            for kind, guard in (("chars", got["n_chars"] >= MIN_CHARS), ("words", got["words"].sum(axis=1) >= MIN_COMMON_WORDS)):
                share = shares(got[kind])
                for c in np.unique(code[guard]):
                    chosen = share[guard & (code == c)]
                    lang = None if c == len(known) else str(known[c])
                    out += [(lang, kind, place, float(total), len(chosen)) for place, total in enumerate(chosen.sum(axis=0))]
            yield pa.RecordBatch.from_pylist([dict(zip(("lang", "kind", "place", "total", "n"), row, strict=True)) for row in out], schema=pa.schema([("lang", pa.string()), ("kind", pa.string()), ("place", pa.int32()), ("total", pa.float64()), ("n", pa.int64())]))

    read = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    # Sums of doubles depend on the order of rows; rounding the means makes them the same in every run.
    cells = read.mapInArrow(K.tidy(sums), "lang string, kind string, place int, total double, n long").groupBy("lang", "kind", "place").agg((F.round(F.sum("total") / F.sum("n"), 9)).alias("share"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("place", "share"))), lambda x: x["share"])
    kinds = cells.groupBy("lang", "kind").agg(ordered.alias("histogram"))
    return kinds.groupBy("lang").agg(F.max(F.when(F.col("kind") == "chars", F.col("histogram"))).alias("ref_chars"), F.max(F.when(F.col("kind") == "words", F.col("histogram"))).alias("ref_words"))


def judged(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with its counts, distances and verdict in the struct column ``_quality``."""
    return renamed(by_place(docs, text_col, lang_col), docs, "_quality")


def by_place(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The columns of ``docs`` by their places, ``c0, c1, ...``, with counts, distances and verdict in the struct column ``_quality``."""
    reference = references(docs, text_col, lang_col).persist()
    if reference.count() <= BROADCAST_LANGUAGES:
        rows = [tuple(r) for r in reference.collect()]
        reference.unpersist()
        reference = F.broadcast(docs.sparkSession.createDataFrame(rows, reference.schema))
    own = numbered(docs, text_col, F.col(f"`{lang_col}`").cast("string").alias("own_lang"))
    text = text_place(docs, text_col)
    met = own.join(reference, F.col("own_lang").eqNullSafe(F.col("lang")), "left").drop("lang", "own_lang")
    added = T.StructType.fromDDL("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, char_distance double, word_distance double")
    passed = [f.name for f in met.schema.fields if f.name.startswith("c") and f.name[1:].isdigit()]
    schema = T.StructType([met.schema[n] for n in passed] + [T.StructField("_quality", added)])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = features(batch.column(text))
            n = batch.num_rows
            far, counted = {}, got["words"].sum(axis=1)
            for kind, guard in (("chars", got["n_chars"] >= MIN_CHARS), ("words", counted > 0)):
                lists = batch.column(f"ref_{kind}")
                usable = guard & ~np.asarray(lists.is_null())
                result = np.full(n, np.nan)
                if usable.any():
                    flat = lists.filter(pa.array(usable)).flatten().to_numpy(zero_copy_only=False)
                    result[usable] = distance(shares(got[kind][usable]), flat.reshape(int(usable.sum()), -1))
                far[kind] = result
            failed = (got["n_words"] < MIN_WORDS) | (100 * got["n_repeat_words"] > REPEAT_PERCENT * got["n_words"])
            with np.errstate(invalid="ignore"):
                odd = (far["chars"] > MAX_CHAR_DISTANCE) | ((far["chars"] > ODD_CHAR_DISTANCE) & (far["words"] > word_limit(counted)))
            columns = [pa.array(got[c]) for c in COUNTS[1:]]
            columns += [pa.array(failed), pa.array(~failed & ~odd)]
            columns += [pa.array(far[k], pa.float64(), from_pandas=True) for k in ("chars", "words")]
            struct = pa.StructArray.from_arrays(columns, names=[f.name for f in added])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in passed), struct], [*passed, "_quality"])

    return met.mapInArrow(K.tidy(judge), schema)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: the id, counts, ``base_failed``, ``kept`` and the two distances (null under MIN_CHARS characters, without words, or without a reference)."""
    read = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    return judged(read).select("doc_id", "_quality.*")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep."""
    return renamed(by_place(docs, text_col, lang_col).filter("_quality.kept"), docs)
