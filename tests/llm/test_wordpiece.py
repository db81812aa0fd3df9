"""Counts against plain greedy matching, on small vocabularies and on the public one."""

import re

import numpy as np
import pytest

from tallyroll.llm.catalogue import op4_token_counts
from tallyroll.llm.wordpiece import FEW, Automaton, pieces_of, token_counts, vocabulary_path

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def greedy(word, first, rest):
    at, count, own = 0, 0, first
    while at < len(word):
        for end in range(len(word), at, -1):
            if word[at:end] in own:
                at, count, own = end, count + 1, rest
                break
        else:
            return -1
    return count


@pytest.mark.parametrize("seed", range(6))
def test_small_vocabularies(seed):
    rng = np.random.default_rng(seed)
    make = lambda k: {bytes(rng.choice(list(b"abc"), int(rng.integers(1, 6))).tolist()) for _ in range(k)}
    first, rest = make(12), make(14) | ({b"a", b"b"} if seed % 2 else set())
    words = [bytes(rng.choice(list(b"abcd"), int(rng.integers(1, 14)), p=[0.35, 0.35, 0.27, 0.03]).tolist()) for _ in range(800)]
    data = np.frombuffer(b" ".join(words), np.uint8)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = end - [len(w) for w in words]
    got = Automaton(first, rest).count(data, start, end)
    expected = [greedy(w, first, rest) for w in words]
    assert got.tolist() == expected
    assert -1 in expected and max(expected) > 2


def plain(text, first, rest, most, max_bytes=None):
    counts = [greedy_bounded(w, first, rest, most) if max_bytes is None or len(w) <= max_bytes else -1 for w in WORD.findall((text or "").encode())]
    return len(counts), sum(max(c, 1) if c > 0 else 1 for c in counts), sum(c < 0 for c in counts)


def check(docs, **options):
    first, rest = pieces_of(vocabulary_path())
    most = max(map(len, first | rest))
    rows = sorted((str(r[0]), *r[1:]) for r in token_counts(docs, **options).collect())
    assert rows == sorted((str(d.doc_id), *plain(d.text, first, rest, most, **options)) for d in docs.collect())
    return rows


def test_whole_table(spark, sf_dir):
    assert sum(r[2] for r in check(spark.read.parquet(f"{sf_dir}/documents.parquet"))) > 0


def test_odd_rows(spark):
    data = [(1, None), (2, ""), (None, "the éa 日本 \x00 😀"), (3, "x" * 100_000 + " y"), (4, "tokens tokens"), (4, "tokens tokens"), (5, "a b " * 300_000), (6, "q" * 200), (7, "a" * 201)]
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 as n_words", "2 as low")
    check(docs)
    # Only where a limit is asked for.
    check(docs, max_bytes=200)
    assert token_counts(docs.limit(0)).collect() == []


def greedy_bounded(word, first, rest, most):
    """As ``greedy``, trying no end beyond the size of the longest piece."""
    at, count, own = 0, 0, first
    while at < len(word):
        end = next((e for e in range(min(len(word), at + most), at, -1) if word[at:e] in own), None)
        if end is None:
            return -1
        at, count, own = end, count + 1, rest
    return count


def test_registered_query_counts_long_words(spark, tmp_path):
    rng = np.random.default_rng(5)
    letters = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789/_-=日本語"), 100_000))
    texts = [letters, "the\u00e9" * 30_000, "日本語" * 23, "https://" + "a1/" * 71, "x" * 201 + " tokens", None]
    # More long words than are read one by one.
    texts.append(" ".join(letters[k * 1000 : k * 1000 + 300 + k] for k in range(FEW + 30)))
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    first, rest = pieces_of(vocabulary_path())
    most = max(map(len, first | rest))
    for row in op4_token_counts(spark, str(tmp_path)).collect():
        counts = [greedy_bounded(w, first, rest, most) for w in WORD.findall((texts[row.doc_id] or "").encode())]
        assert row[1:] == (len(counts), sum(max(c, 1) for c in counts), sum(c < 0 for c in counts))
        assert row.n_tokens > row.n_words or not counts


def test_long_words_of_small_vocabularies():
    rng = np.random.default_rng(8)
    first, rest = {b"a", b"ab", b"ba"}, {b"a", b"abb", b"bab", b"b"}
    words = [bytes(rng.choice(list(b"abc"), int(rng.integers(1, 3000)), p=[0.5, 0.4999, 0.0001]).tolist()) for _ in range(3 * FEW)]
    data = np.frombuffer(b" ".join(words), np.uint8)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    got = Automaton(first, rest).count(data, end - [len(w) for w in words], end)
    expected = [greedy_bounded(w, first, rest, 3) for w in words]
    assert got.tolist() == expected and -1 in expected and max(expected) > 500
