"""Groups against all pairs on small tables, and the parts on random sets."""

import re

import numpy as np
import pytest

from tallyroll.llm.components import components
from tallyroll.llm.minhash import keep_one, near_duplicates, signatures

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def plain(rows):
    """doc_id and text -> size, smallest id reached."""
    order = lambda i: -(2**63) if i is None else i
    sets = [(order(i), shingles(t)) for i, t in rows]
    by = {}
    for n, (_, s) in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(n)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (_, s) in enumerate(sets):
        both = {}
        for x in s:
            for m in by[x]:
                if m < n:
                    both[m] = both.get(m, 0) + 1
        for m, k in both.items():
            if 100 * k >= 75 * (len(s) + len(sets[m][1]) - k):
                root[find(n)] = find(m)
    least = {}
    for n, (i, _) in enumerate(sets):
        least[find(n)] = min(least.get(find(n), i), i)
    return sorted((i, len(s), least[find(n)]) for n, (i, s) in enumerate(sets))


def check(docs, key="doc_id"):
    order = lambda i: -(2**63) if i is None else i
    rows = near_duplicates(docs).collect()
    expected = plain([(r[key], r.text) for r in docs.collect()])
    assert sorted((order(r.doc_id), r.n_shingles, order(r.component_id)) for r in rows) == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return rows


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_whole_table(spark, folder):
    rows = check(spark.read.parquet(f"/root/testdata/{folder}/documents.parquet"))
    assert any(not r.kept for r in rows)


def test_chains_and_near_copies(spark):
    """Random edits of one text: many links are near the threshold, and groups form chains."""
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 5000, 120)]
    data = []
    for i in range(300):
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 9)):
            words[at] = f"v{rng.integers(0, 10**6)}"
        data.append((int(rng.integers(0, 10**9)), " ".join(words)))
        if i % 10 == 0:
            base[rng.integers(0, 120)] = f"u{i}"
    check(spark.createDataFrame(data, "doc_id long, text string"))


def test_family_of_an_original(spark):
    """Copies of one text that are near it but not near each other, with and without the text itself."""
    rng = np.random.default_rng(6)
    data = []
    for family in range(2):
        base = [f"f{family}w{x}" for x in range(190)]
        for i in range(250):
            words = list(base)
            for at in rng.integers(0, 190, rng.integers(0 if family == 0 else 2, 11)):
                words[at] = f"v{rng.integers(0, 10**6)}"
            data.append((int(rng.integers(0, 10**9)), " ".join(words)))
    check(spark.createDataFrame(data, "doc_id long, text string"))


def test_odd_rows(spark):
    data = [
        (5, None), (6, ""), (7, " \n"), (8, "One two"), (3, "one TWO"), (9, "a b c d e"), (None, "A B C D E"), (10, "a b c d e"), (10, "a b c d e"), (11, "a b c d e"),
        (11, "other words that are not the same"), (2, "two one"), (1, "x " * 50_000 + "y z w v u " * 3), (12, "x " * 60_000 + "y z w v u " * 3),
    ]
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 as id", "'q' as node", "2 as h")
    check(docs)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect()) == [(False, 0), (True, 1), (True, 2), (True, 3), (True, 5), (True, 6), (True, 7), (True, 11)]
    assert near_duplicates(docs.limit(0)).collect() == []


def test_one_row_of_a_group_stays(spark):
    near = [" ".join(f"w{i if i != at else -at}" for i in range(60)) for at in (0, 30)]
    data = [
        (1, "a b c d e f"), (1, "a b c d e f"), (1, "A b c d e f"), (2, "a b c d e f"), (4, near[0]), (4, near[1]), (5, near[1]),
        (None, "q r s t u v"), (None, "q r s t u v"), (None, "Q r s t u v"), (None, "some other text of its own"), (7, ""), (7, ""),
    ]
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "map('a', 1) as more")
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r.doc_id), (r.text or "").lower()) for r in kept.collect())
    assert [i for i, _ in got] == ["1", "4", "7", "7", "None", "None"]
    assert [t for i, t in got if i in ("1", "None")] == ["a b c d e f", "q r s t u v", "some other text of its own"]


def test_components(spark):
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, x) for x in range(5001, 5200)]
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}


def test_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    common, own = rng.integers(0, 2**63, 600, dtype=np.uint64), rng.integers(0, 2**63, (2, 200), dtype=np.uint64)
    values = np.concatenate((common, own[0], common, own[1]))
    a, b = signatures(values, np.array([0, 800, 1600]), 512)
    assert abs((a == b).mean() - 0.6) < 0.1
