"""Nearest neighbours against brute force, factor one exactly, the production factor by recall."""

from __future__ import annotations

import math

import numpy as np
import pytest

from clickloom.llm import queries, vantage_trees
from clickloom.llm.vantage_trees import Tree


def plain(base, asked, k):
    """Brute force over (id, vector) pairs."""
    out = {}
    for q, v in asked:
        found = []
        for i, x in base:
            if i != q and len(x) == len(v):
                total = 0.0
                for a, b in zip(v, x):
                    total += a * b
                found.append((-total, i))
        out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return {q: rows for q, rows in out.items() if rows}


def collected(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(rows) for q, rows in out.items()}


def shapes(n, kind):
    rng = np.random.default_rng(7)
    if kind == "random":
        return rng.normal(size=(n, 16))
    if kind == "ties":  # few distinct values: equal scores everywhere
        return rng.integers(-1, 2, size=(n, 5)).astype(float)
    if kind == "clusters":
        return rng.normal(size=(20, 16))[rng.integers(0, 20, n)] + 0.1 * rng.normal(size=(n, 16))
    return rng.normal(size=(n, 16)) * 10.0 ** rng.integers(-6, 7, size=(n, 1))  # norms of many sizes


@pytest.mark.parametrize("kind", ["random", "ties", "clusters", "norms"])
def test_factor_one_is_exact(kind):
    x = shapes(900, kind)
    x = x[np.abs(x).max(axis=1) > 0]
    first = np.random.default_rng(1).permutation(len(x))
    scores, rows, _ = Tree(x, first, leaf=16).search(x[:200], 7, 1.0)
    for q, got, which in zip(x[:200], scores, rows):
        exact = vantage_trees.in_order(np.repeat(q[None], len(x), 0), x)
        want = np.lexsort((first, -exact))[:7]
        assert which.tolist() == want.tolist() and got.tolist() == exact[want].tolist()


def test_a_larger_factor_scores_fewer_pairs_and_one_row_is_a_tree():
    x = shapes(3000, "clusters")
    pairs = [Tree(x, np.arange(3000), leaf=32).search(x[:100], 10, f)[2] for f in (1.0, 2.0, 4.0)]
    assert pairs[0] > pairs[1] > pairs[2]
    scores, rows, _ = Tree(x[:1], np.arange(1)).search(x[:2], 3, 1.0)
    assert rows.tolist() == [[0, -1, -1]] * 2 and np.isneginf(scores[:, 1:]).all()


@pytest.mark.parametrize("kind", ["random", "clusters", "norms"])
def test_recall_of_the_production_factor(kind):
    x = shapes(4000, kind)
    _, rows, _ = Tree(x, np.arange(4000)).search(x[:200], 20, vantage_trees.FACTOR)
    want = np.argsort(-(x[:200] @ x.T), axis=1)[:, :20]
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(rows, want)]) >= 0.9


def test_the_join_equals_brute_force_with_copies_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(vantage_trees, "SHARD_ROWS", 60)
    monkeypatch.setattr(vantage_trees, "CHUNK_ROWS", 10)
    x = shapes(400, "ties").tolist()
    rows = [(i, v) for i, v in enumerate(x)] + [(1000 + i, [1.0, 0.0, -1.0, 0.0, 1.0]) for i in range(150)]
    rows += [(3, x[3]), (3000, None), (3020, []), (3040, [0.0, -0.0, 0.0, 0.0, 0.0]), (3060, [1.0, None, 0.0, 0.0, 0.0]),
             (3080, [math.nan, 1.0, 0.0, 0.0, 0.0]), (3100, [math.inf, 1.0, 0.0, 0.0, 0.0]), (None, x[5]),
             (4000, [1.0, 2.0]), (4001, [2.0, 1.0]), (4020, [1.0, 2.0, 3.0])]
    table = spark.createDataFrame([(a, b, 0, "n") for a, b in rows], "vec_id long, embedding array<double>, ids int, x string")
    seen = {}
    for i, v in rows:
        if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v):
            seen.setdefault(i, v)
    base = list(seen.items())
    want = plain(base, [(i, v) for i, v in base if i % 20 == 0], 20)
    assert 4020 not in want and len(want[4000]) == 1 and len(want[1000]) == 20
    got = collected(vantage_trees.nearest(table, table.where("vec_id % 20 = 0"), factor=1.0))
    assert got == want


def test_keys_with_two_vectors_and_an_empty_table(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.5, 0.0]), (21, [2.0, 0.0]), (22, [3.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = collected(vantage_trees.nearest(table, table.where("vec_id = 20")))
    assert got == {20: [(1, 22, 1.5), (2, 21, 1.0)]}
    none = vantage_trees.nearest(table.limit(0), table)
    assert none.columns == ["query_id", "rank", "vec_id", "score"] and none.count() == 0
    assert vantage_trees.nearest(table, table.limit(0)).count() == 0


def test_the_query_against_brute_force(spark, sf):
    got = collected(queries.op13(spark, sf))
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = plain(rows, [(i, v) for i, v in rows if i % 20 == 0], 20)
    assert set(got) == set(want)
    hits = sum(len({i for _, i, _ in got[q]} & {i for _, i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    exact = {(q, i): s for q in want for _, i, s in want[q]}
    assert all(exact.get((q, i), s) == s for q in got for _, i, s in got[q])
