"""Costs against a search over all repairs; blocks against whole conversations."""

import hashlib
import re
from itertools import product

import numpy as np
import pytest

from tallyroll.llm import chat
from tallyroll.llm.chat import ROLES, chat_format, role_number

TURN = re.compile(r"<\|(\w+)\|>\n(.*?)\n<\|end\|>\n", re.DOTALL)


def cheapest(roles):
    """Least cost by trying every relabelling and, for each, every way to merge."""
    legal = re.compile("s?(ua)+$")

    def place(labels, merges):
        turns = [labels[0]]
        for label, m in zip(labels[1:], merges, strict=True):
            if m and label == turns[-1]:
                continue
            turns.append(label)
        # Empty turns: fill in what is missing, from the front.
        out, n = "", 0
        for t in turns:
            while not re.match("(s?(ua)*u?)$", out + t):
                nxt = "u" if out in ("", "s") or out.endswith("a") else "a"
                if t == "s":
                    return None
                out, n = out + nxt, n + 1
            out += t
        while not legal.match(out):
            out, n = out + ("u" if out in ("", "s") or out.endswith("a") else "a"), n + 1
        return n, len(labels) - len(turns)

    best = 10**9
    for labels in product("sua", repeat=len(roles)):
        relabelled = sum(a != b for a, b in zip(labels, roles, strict=True))
        for merges in product((0, 1), repeat=len(roles) - 1):
            got = place(labels, merges)
            if got:
                best = min(best, 3 * got[0] + got[1] + 2 * relabelled)
    return best


def test_least_cost(spark):
    rng = np.random.default_rng(2)
    conversations = [[str(rng.choice(["system", "user", "assistant", "tool"])) for _ in range(int(rng.integers(1, 6)))] for _ in range(60)]
    rows = [(c, t, role, f"t{c}-{t}") for c, roles in enumerate(conversations) for t, role in enumerate(roles)]
    got = {r.conv_id: r for r in chat_format(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    short = {"system": "s", "user": "u", "assistant": "a", "tool": "t"}
    for c, roles in enumerate(conversations):
        r = got[c]
        assert r.cost == cheapest([short[x] for x in roles]) == r.n_merged + 2 * r.n_relabelled + 3 * r.n_inserted, roles
        check_text(r.rendered, [f"t{c}-{t}" for t in range(len(roles))])


def check_text(rendered, texts):
    turns = TURN.findall(rendered)
    assert "".join(f"<|{role}|>\n{text}\n<|end|>\n" for role, text in turns) == rendered
    assert re.fullmatch("s?(ua)+", "".join(role[0] for role, _ in turns))
    assert "\n".join(text for _, text in turns if text) == "\n".join(texts)


@pytest.mark.parametrize("block", [1, 3, 7])
def test_blocks_make_up_the_whole(spark, block):
    rng = np.random.default_rng(block)
    rows = [(c, t, str(rng.choice(ROLES)), f"x{t}") for c in range(12) for t in range(int(rng.integers(1, 40)))] + [(99, t, "user", f"x{t}") for t in range(300)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = {r.conv_id: r for r in chat_format(docs).collect()}
    parts = {}
    for r in chat_format(docs, block=block).collect():
        parts.setdefault(r.conv_id, []).append(r)
    for c, r in whole.items():
        own = sorted(parts[c], key=lambda p: p.block)
        assert sum(p.cost for p in own) == r.cost and sum(p.n_turns for p in own) == r.n_turns
        check_text("".join(p.rendered for p in own), [f"x{t}" for t in range(r.n_turns)])


def test_whole_table(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    by = {}
    for r in conversations.collect():
        by.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    rows = chat_format(conversations).collect()
    assert {r.conv_id for r in rows} == set(by) and len(rows) == len(by)
    for r in rows:
        turns = sorted(by[r.conv_id])
        check_text(r.rendered, [t[2] for t in turns])
        assert r.rendered_sha256 == hashlib.sha256(r.rendered.encode()).hexdigest()
        if re.fullmatch("s?(ua)+", "".join(t[1][0] for t in turns)):
            assert r.cost == 0


def test_odd_rows(spark):
    rows = [(1, 0, " User ", None), (1, 1, "assistant", "a"), (2, None, None, "x"), (None, 5, "user", "n"), (3, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, "assistant", ""), (5, 1, "assistant", "b"), (5, 0, "user", "y" * 100_000)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as block", "2 as row_no", "'q' as rendered")
    got = {r.conv_id: r for r in chat_format(docs).collect()}
    assert got[1].rendered == "<|user|>\n\n<|end|>\n<|assistant|>\na\n<|end|>\n" and got[1].cost == 0
    assert (got[2].n_relabelled, got[2].n_inserted) == (1, 1)
    assert got[None].rendered == "<|user|>\nn\n<|end|>\n<|assistant|>\n\n<|end|>\n"
    assert (got[3].n_merged, got[3].n_inserted, got[3].cost) in ((1, 1, 4), (0, 0, 2)) and got[3].cost == 2
    assert got[4].cost == 3 and got[5].cost == 0
    assert chat_format(docs.limit(0)).collect() == []
    assert role_number(" Assistant\n") == 3 and role_number("bot") == 0


def test_cells_follow_the_bytes(spark, monkeypatch):
    """Long turns are spread over more cells; the rows are the same."""
    data = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c}-{t} " * 400) for c in range(12) for t in range(5)]
    docs = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    whole = sorted(map(tuple, chat_format(docs).collect()))
    monkeypatch.setattr(chat, "CELL_BYTES", 1 << 12)
    assert sorted(map(tuple, chat_format(docs).collect())) == whole and len(whole) == 12
