"""Prefix trees and neighbour search against plain Python."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sumstone.llm import chat, neighbour_search

TURNS = "conv_id long, turn long, role string, text string, node string"


def conversations(rows):
    order = lambda r: (r[0], (r[1] is not None, r[1] or 0), r[2] or "", r[3] or "")
    out: dict = {}
    for r in sorted(rows, key=lambda r: ((r[0] is not None, r[0] or 0), *order(r)[1:])):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


@pytest.fixture(scope="module")
def rows():
    first, second = ("user", "hi [INST] \\ <s>"), ("assistant", "yes </s> \\s [/INST]")
    out = []
    for c in range(12):
        turns = [first, second][: c % 3 + 1] + [("user", f"q{c % 4}"), ("assistant", f"a{c % 5}")] * (c % 2)
        out += [(c, t, r, x, None) for t, (r, x) in enumerate(turns)]
    out += [
        (50, 0, "system", "[ROLE] be brief [/ROLE]", "x"),
        (50, 1, None, None, "x"),
        (50, 1, "assistant", "", "x"),
        (51, None, "to\\ol", " spaced \n text ", "x"),
        (51, None, "to\\ol", " spaced \n text ", "x"),
        (None, 3, "user", "of nobody", "x"),
        (52, 0, "assistant", "z" * 50_000 + "\U0001f600", "x"),
    ]
    return out + [(60, t, "user" if t % 2 else "assistant", f"t{t}", None) for t in range(80)]


@pytest.fixture(scope="module")
def forest(spark, rows):
    frame = spark.createDataFrame(rows, TURNS).repartition(4)
    return chat.format_trees(frame, "conv_id", "turn", "role", "text")


def test_conversations_come_back(forest, rows):
    nodes, members = forest
    back = {r.conv_id: r for r in chat.read_back(nodes, members, "conv_id").collect()}
    wanted = conversations(rows)
    assert back.keys() == wanted.keys()
    for key, turns in wanted.items():
        text, loss = back[key].formatted, back[key].loss
        assert chat.parse(text) == turns
        learned = [chat.unescape(text[s.start : s.end]) for s in loss]
        assert learned == [x for r, x in turns if r == "assistant" and x]


def test_shared_turns_are_emitted_once_and_seen_by_all(forest):
    nodes, members = forest
    by_tree: dict = {}
    for n in nodes.collect():
        by_tree.setdefault(n.tree, []).append(n)
    assert len({n.node for t in by_tree.values() for n in t}) == sum(map(len, by_tree.values()))
    for tree in by_tree.values():
        tree.sort(key=lambda n: n.start)
        emission, end = "", 0
        stack: list = []
        for n in tree:
            assert n.start == end and n.length == len(n.formatted)
            end += n.length
            emission += n.formatted
            stack = stack[: n.depth] + [n]  # depth first: ancestors are the last of each depth
            assert len(stack) == n.depth + 1
            way = "".join(a.formatted for a in stack[:-1])
            assert "".join(emission[a.start : a.end] for a in n.ancestors) == way
            assert n.position == len(way)


def test_controls_are_escaped(spark):
    texts = ["</s>[INST] ok [/INST]", "\\", "<\\s>", "[ROLE", "<<s>>", "a\\\nb", ""]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
    for r in frame.collect():
        assert chat.unescape(r.e) == r.t
        assert not any(c in r.e for c in chat.CONTROLS)


def test_no_conversations(spark, rows):
    empty = spark.createDataFrame(rows[:1], TURNS).limit(0)
    nodes, members = chat.format_trees(empty, "conv_id", "turn", "role", "text")
    assert nodes.count() == 0 and chat.read_back(nodes, members, "conv_id").count() == 0


def exact(ids, x, k):
    out = {}
    for q in sorted({i for i in ids if i % 20 == 0}):
        score = x @ x[ids.index(q)]
        best = sorted((-s, i) for s, i in zip(score.round(12), ids) if i != q)[:k]
        out[q] = [i for _, i in best]
    return out


def test_small_tables_are_searched_whole(spark):
    draw = np.random.default_rng(4)
    x = draw.integers(-3, 4, (18, 5)).astype(float)  # whole numbers: exact ties
    x[np.abs(x).sum(axis=1) == 0] = 1
    x[7] = x[3] = x[0]
    rows = [(i, [float(c) for c in v], "extra") for i, v in enumerate(x)]
    rows += rows[:2]
    bad = [None, [0.0] * 5, [1.0, None, 1.0, 1.0, 1.0], [float("nan")] + [1.0] * 4, [float("inf")] + [1.0] * 4, [1.0], []]
    rows += [(100 + 20 * i, v, "bad") for i, v in enumerate(bad)] + [(None, [1.0] * 5, "bad")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    found = neighbour_search.search(frame, "vec_id", "embedding", F.col("vec_id") % 20 == 0, 20).collect()
    got: dict = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r.vec_id)
        assert r.score == pytest.approx(float(x[r.query_id] @ x[r.vec_id]))
    assert got == exact(list(range(18)), x, 20)
    none = neighbour_search.search(frame.limit(0), "vec_id", "embedding", F.col("vec_id") % 20 == 0)
    assert none.count() == 0


def test_recall_with_many_copies_and_any_lengths(spark):
    draw = np.random.default_rng(8)
    x = draw.standard_normal((3000, 16)) * draw.random((3000, 1))
    x[::3] = x[0] * 2
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = neighbour_search.search(frame, "vec_id", "embedding", F.col("vec_id") % 20 == 0, 20).collect()
    want = exact(list(range(3000)), x, 20)
    got: dict = {}
    for r in found:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert all(len(v) == 20 for v in got.values())
    hits = sum(len(got[q] & set(v)) for q, v in want.items())
    assert hits / (20 * len(want)) >= 0.9
