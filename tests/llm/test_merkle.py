"""Proofs against a tree built by plain loops; ragged ends in every round; odd rows."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyroll.llm.merkle import document_leaves, fold, height, manifest, merkle_digests

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, more=0):
    values = (*row[:3], None if row[3] is None else row[3] + more, row[4])
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, fanout=2):
    steps, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, of = [], []
        for a in range(0, len(nodes), fanout):
            run = nodes[a : a + fanout]
            for i in range(len(run)):
                for o in owners[a + i]:
                    steps[o].append(("".join(run[:i]), "".join(run[i + 1 :])))
            up.append(H("".join(run)))
            of.append(sum(owners[a : a + fanout], []))
        nodes, owners = up, of
    return nodes[0], steps


def brute(rows, fanout=2):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = tree([leaf(r) for r in groups[g]], fanout)
    root, tops = tree([trees[g][0] for g in names], fanout)
    for g, top in zip(names, tops, strict=True):
        for r, own in zip(groups[g], trees[g][1], strict=True):
            steps, node = own + top, leaf(r, int(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0))
            for before, after in steps:
                node = H(before + node + after)
            yield r[0], leaf(r), trees[g][0], root, H("".join(a + b for a, b in steps)), node, node == root


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = Counter(brute([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]))
    assert Counter(tuple(r) for r in merkle_digests(docs).collect()) == want


# Sizes around powers, so that the last subtrees are short in several rounds.
@pytest.mark.parametrize(("sizes", "options"), [
    ((1, 2, 3, 5, 17, 33, 70), {"chunk": 2, "swap": 2}), ((1, 4, 63, 64, 65, 129), {"chunk": 4, "swap": 4}), ((9, 10, 28, 82, 100), {"fanout": 3, "chunk": 3, "swap": 3}), ((40, 41), {"chunk": 2, "swap": 8}),
])
def test_rounds(spark, sizes, options):
    rows = [(i * 100 + k, "s", f"g{i}", k, f"t{k}") for i, n in enumerate(sizes) for k in range(n)]
    random.Random(1).shuffle(rows)
    got = Counter(tuple(r) for r in merkle_digests(spark.createDataFrame(rows, SCHEMA), **options).collect())
    assert got == Counter(brute(rows, options.get("fanout", 2)))


def test_many_groups(spark):
    """More groups than a chunk has leaves: the tree over their roots is made in rounds too."""
    rows = [(i, None, f"lang{i % 37}", i, "x") for i in range(80)]
    got = Counter(tuple(r) for r in merkle_digests(spark.createDataFrame(rows, SCHEMA), chunk=4, swap=2).collect())
    assert got == Counter(brute(rows))


def test_odd_rows(spark):
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (1, "", "", 0, ""), (7, "s", "é", None, "naïve"), (7, "s", "é", 2, "x" * 300_000), (7, "s", "é", 2, "x" * 300_000),
        (-(2**63), "s", "en", 2**63 - 1, "\x00"), (2**63 - 1, "s", "en", -1, "a:b"),
    ]
    # Ids that are tampered with, also where n_chars is null or the largest number.
    rows += [(i, "s", "en", (2**63 - 1, None, 5)[i % 3], "t") for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = Counter(brute(rows))
    assert Counter(tuple(r) for r in merkle_digests(docs).collect()) == want
    more = docs.selectExpr("*", "1 as leaf", "2 as grp", "3 as chunk", "4 as cell", "5 as root", "6 as id", "7 as pos")
    assert Counter(tuple(r) for r in merkle_digests(more).collect()) == want
    assert merkle_digests(docs.limit(0)).collect() == []
    assert Counter(tuple(r) for r in merkle_digests(docs.limit(1)).collect()) == Counter(brute([tuple(r) for r in docs.limit(1).collect()]))


def test_general_interface(spark):
    """Steps lead from each leaf to the root; other columns come along."""
    rows = [(i, "s", "ab"[i % 2], i, "t") for i in range(21)]
    found = manifest(document_leaves(spark.createDataFrame(rows, SCHEMA)).withColumn("extra", F.lit("e")), chunk=2, swap=2)
    got = found.select("grp", "extra", "subroot", (fold(F.col("leaf"), F.col("steps")) == F.col("root")).alias("ok")).collect()
    assert len(got) == 21 and all(r.ok and r.extra == "e" for r in got) and {r.grp for r in got} == {"a", "b"}
    assert [height(n, 2) for n in (0, 1, 2, 3, 4, 5)] == [0, 0, 1, 2, 2, 3]
