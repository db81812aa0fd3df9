"""Nodes against dictionaries of prefixes; shards of few rows, so that boundaries meet in several rounds."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyroll.llm import prefix_trie as module
from tallyroll.llm.prefix_trie import conversation_trie, conversations_of, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def nodes(conversations):
    members, ends, sums = defaultdict(list), defaultdict(list), {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = Counter(k[:-1] for k in members if k)
    for k in sorted(members, key=len, reverse=True):
        own = sums.setdefault(k, [0, 0])
        own[0] = own[0] or 1
        if k:
            own[1] += (len(members[k]) - 1) * len(k[-1][1])
            up = sums.setdefault(k[:-1], [0, 0])
            up[0] += own[0]
            up[1] += own[1]
    for k, m in members.items():
        text = ",".join(map(str, sorted(ends[k])))
        yield min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], *sums[k], hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns, key=lambda t: t[0])] for c, turns in own.items()}
    return nodes({c: own.get(c - int(math.fmod(c, 100)), [])[: (h := zlib.crc32(str(c).encode()) % 6)] + turns[h:] for c, turns in own.items()})


def got(spark, rows, **sizes):
    return Counter(tuple(r) for r in conversation_trie(spark.createDataFrame(rows, SCHEMA), **sizes).collect())


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    want = Counter(brute([(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]))
    assert Counter(tuple(r) for r in conversation_trie(table).collect()) == want


@pytest.mark.parametrize(("seed", "columns", "sizes"), [(0, 32, {}), (1, 2, {"paths": 2, "shard": 30}), (2, 3, {"paths": 4, "shard": 10}), (3, 1, {"paths": 1, "shard": 5})])
def test_random(spark, monkeypatch, seed, columns, sizes):
    monkeypatch.setattr(module, "COLUMNS", columns)
    monkeypatch.setattr(module, "PIECE", 3)
    rng = random.Random(seed)
    ids = rng.sample(range(400), 120)
    rows = [(c, t, rng.choice("ua"), rng.choice(["x", "yy", ""])) for c in ids for t in range(rng.choice([1, 2, 3, 8, 20]))]
    rng.shuffle(rows)
    assert got(spark, rows, **sizes) == Counter(brute(rows))


def test_one_conversation_copied_many_times(spark):
    """A third of all rows, cut among shards; and a common first turn."""
    rows = [(c, t, "user", f"same{t}") for c in range(300) for t in range(3)] + [(c, t, "user", f"same{t}" if t == 0 else f"own{c}") for c in range(300, 500) for t in range(3)]
    assert got(spark, rows, paths=3, shard=60) == Counter(brute(rows))


def test_long_conversations(spark):
    rows = [(c, t, "user", f"t{t}" if t < 900 else f"c{c}-{t}") for c in (1, 2) for t in range(1000)] + [(3, 0, "user", "z" * 200_000)]
    assert got(spark, rows) == Counter(brute(rows))


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "left out"), (None, None, None, None), (5, None, "user", "first"), (5, 0, None, "x"), (5, 1, "user", None), (6, 3, "user", "ü\U0001f600"), (6, -1, "", ""),
        (7, 0, "ab", "c"), (8, 0, "a", "bc"), (-3, 0, "u", "n"), (-205, 1, "u", "m"), (-(2**63), 0, "u", "low"), (2**63 - 1, 0, "u", "high"), (100, 0, "u", "base"), (101, 0, "u", "w"), (203, 0, "u", "no base"),
    ]
    want = Counter(brute(rows))
    assert got(spark, rows) == want
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as conv", "2 as id", "3 as len", "4 as h", "5 as base", "6 as seq", "7 as key")
    assert Counter(tuple(r) for r in conversation_trie(table).collect()) == want
    assert conversation_trie(table.limit(0)).collect() == []


def test_repeated_rows(spark):
    """Equal rows are turns of their own; turns of one number are in the same order wherever they come from."""
    rows = [(c, 0, "user", "same") for c in (1, 2) for _ in range(3)] + [(c, 1, "user", t) for c, order in ((1, "pq"), (2, "qp")) for t in order]
    tree = prefix_trie(conversations_of(spark.createDataFrame(rows, SCHEMA)))
    assert tree.where(F.col("n_convs") == 2).count() == tree.count() == 6
    assert tree.agg(F.sum(F.when(F.col("depth") == 0, F.col("saved_tokens")))).first()[0] == 3 * 4 + 2
