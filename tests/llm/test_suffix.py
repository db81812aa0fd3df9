"""Removed bytes against a plain version; the stack scan and the groups against all pairs."""

import hashlib

import numpy as np
import pytest

from tallyroll.llm import suffix
from tallyroll.llm.suffix import intervals, repeat_groups, suffix_dedup


def plain(rows, length=100):
    """Rows of (id, text): windows in order of id and place, the first one of each string stays."""
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: r[0]):
        data, gone = text.encode(), np.zeros(len(text.encode()), bool)
        for k in range(len(data) - length + 1):
            window = data[k : k + length]
            if window in seen:
                gone[k : k + length] = True
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(docs, length=100, hot=255):
    got = sorted(tuple(r) for r in suffix_dedup(docs, length=length, hot_cells=hot).collect())
    assert got == plain([(r.doc_id, r.text or "") for r in docs.collect()], length)
    return got


def test_chunks_change_nothing(monkeypatch):
    rng = np.random.default_rng(8)
    texts = list({"".join(rng.choice(list("ab"), int(rng.integers(12, 40)))).encode() for _ in range(300)})
    rank = rng.permutation(len(texts))

    def found():
        context, offset, depth, number, first = suffix.repeats(texts, rank, 9)
        by = {}
        for c, o, d, n, f in zip(context.tolist(), offset.tolist(), depth.tolist(), number.tolist(), first.tolist(), strict=True):
            by.setdefault(n, []).append((c, o, d, f))
        return sorted(sorted(v) for v in by.values())

    whole = found()
    monkeypatch.setattr(suffix, "CHUNK", 20)
    assert found() == whole and len(whole) > 100


@pytest.mark.parametrize("folder,hot", [("sf0.001", 255), ("sf0.001", 2), ("sf0.01", 255)])
def test_whole_table(spark, folder, hot):
    assert any(r[2] for r in check(spark.read.parquet(f"/root/testdata/{folder}/documents.parquet"), hot=hot))


@pytest.mark.parametrize("length,hot", [(100, 255), (40, 255), (7, 255), (40, 3), (170, 255)])
def test_few_letters(spark, length, hot):
    """Periodic and random texts of few letters: repeats within and between documents, and chains of overlaps."""
    rng = np.random.default_rng(7)
    pool = ["".join(rng.choice(list("ab\néñ"), 180)) for _ in range(4)]
    data = []
    for i in range(60):
        parts = [pool[rng.integers(0, 4)][int(rng.integers(0, 60)) : int(rng.integers(80, 180))] for _ in range(rng.integers(0, 4))]
        data.append((i, "-".join(parts) + "ab" * int(rng.integers(0, 120)) + "z" * int(rng.integers(0, 150))))
    check(spark.createDataFrame(data, "doc_id long, text string"), length, hot)


def test_odd_rows(spark):
    passage = "".join(chr(97 + (i * i) % 26) + str(i) for i in range(60))
    data = [(1, None), (2, ""), (None, passage), (3, "é" + passage + "\x00\x00z"), (3, "é" + passage + "\x00\x00z"), (4, passage[:99]), (5, "\x00" * 3_000), (6, "q" * 2_600_000 + passage)]
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 as cell", "'q' as spans")
    got = {r.doc_id: r for r in suffix_dedup(docs).collect()}
    n = len(passage)
    assert suffix_dedup(docs).count() == len(data)
    assert got[1][1:4] == got[2][1:4] == (0, 0, 0) and got[None].n_removed == 0 and got[4].n_removed == 0
    assert (got[3].n_bytes, got[3].n_removed, got[3].n_spans) == (n + 5 - 0, n, 1)
    assert (got[5].n_removed, got[5].n_spans) == (2_999, 1)
    assert (got[6].n_bytes, got[6].n_removed, got[6].n_spans) == (2_600_000 + n, 2_599_999 + n, 1)
    assert suffix_dedup(docs.limit(0)).collect() == []


def test_stack_scan():
    rng = np.random.default_rng(4)
    for _ in range(50):
        common = rng.integers(0, 6, rng.integers(0, 25))
        expected = set()
        for depth in range(2, 6):
            i = 0
            while i < len(common):
                if common[i] >= depth:
                    j = i
                    while j < len(common) and common[j] >= depth:
                        j += 1
                    if common[i:j].min() == depth:
                        expected.add((i, j, depth))
                    i = j
                else:
                    i += 1
        assert {tuple(map(int, x)) for x in zip(*intervals(common, 2), strict=True)} == expected


def test_groups_have_all_occurrences(spark):
    rng = np.random.default_rng(9)
    passage = ["".join(rng.choice(list("abcdefgh"), 150)) for _ in range(2)]
    texts = ["".join(rng.choice(list("abcdefgh"), 50)) + passage[i % 2] + "".join(rng.choice(list("abcdefgh"), 50)) for i in range(9)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = repeat_groups(docs).collect()
    by = {}
    for r in rows:
        by.setdefault(r.group, []).append(r)
        assert r.length >= 100
    for members in by.values():
        strings = {texts[r.doc_id][r.start : r.start + r.length] for r in members}
        assert len(strings) == 1 and sum(r.first for r in members) == 1
        string = strings.pop()
        assert {(i, t.find(string)) for i, t in enumerate(texts) if string in t} == {(r.doc_id, r.start) for r in members}
    # Together the repeats cover every shared window.
    for i, t in enumerate(texts):
        covered = {p for r in rows if r.doc_id == i for p in range(r.start, r.start + r.length)}
        assert covered >= set(range(50, 200))
