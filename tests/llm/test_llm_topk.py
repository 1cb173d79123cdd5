"""Threshold algorithm against all inner products."""

import math
import random

import numpy as np
import pytest
from panelkit.llm import topk

SCHEMA = "vec_id long, embedding array<double>, block string, n int, score double, rank int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, None, None, None, None) for i, v in rows], SCHEMA)


def plain(rows, every, k):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(good):
        if i is not None and i % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(q, v)), j is None, j or 0)
                            for b, (j, v) in enumerate(good) if b != a)
            out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def got(spark, rows, every, k):
    found = topk.search(vectors(spark, rows), lambda i: i % every == 0, k)
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("block", [16, 4096])
def test_all_products(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = random.Random(block)
    few = [[rng.choice([-1, 0, 0, 1]) / 256 for _ in range(4)] for _ in range(120)]  # mostly ties
    many = [[rng.gauss(0, 0.2) for _ in range(24)] for _ in range(300)]
    for vecs in (few, many):
        rows = list(enumerate(vecs))
        rng.shuffle(rows)
        assert got(spark, rows, 7, 5) == plain(rows, 7, 5)


def test_edge_vectors(spark):
    rows = [(0, [1.0, -2.0]), (0, [1.0, -2.0]), (None, [4.0, 4.0]), (None, [1.0, -2.0]), (3, None), (4, [None, 1.0]),
            (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (10, []), (20, [0.0, 0.0]), (30, [1.0]), (40, [1.0, 2.0, 3.0]),
            (2 ** 60, [0.5, 0.25]), (2 ** 60 + 10, [0.5, 0.25])]
    assert got(spark, rows, 10, 5) == plain(rows, 10, 5)
    assert got(spark, rows[:1], 10, 5) == []
    assert got(spark, [], 10, 5) == []
    assert got(spark, rows[:3], 10, 5) == plain(rows[:3], 10, 5)  # fewer candidates than k


def test_numbers_beyond_doubles(spark):
    rows = [(0, [2.0 ** 40, 1.0]), (1, [2.0 ** 20, 1 / 256]), (2, [2.0 ** 20, 2 / 256]), (3, [-1e300, 0.0]), (4, [1e300, 0.0])]
    most = 2 ** 63 - 1  # products of 2^76 and more count as the largest long
    assert got(spark, rows, 10, 5) == sorted([(0, 1, 1, most), (0, 2, 2, most), (0, 3, 4, most), (0, 4, 3, -most - 1)], key=repr)
    close = [(0, [2.0 ** 22, 1.0]), (1, [2.0 ** 20, 1 / 256]), (2, [2.0 ** 20, 2 / 256]), (3, [2.0 ** 20, 0.0])]
    assert got(spark, close, 10, 5) == plain(close, 10, 5)  # products of 2^58 that differ by 256


def test_reading_stops_at_the_bound(monkeypatch):
    """Two long components decide: few rows of a block are scored, and later blocks are not read at all."""
    rng = np.random.default_rng(1)
    x = np.floor(rng.exponential(40, (4000, 3)) ** 2).astype(np.int64)
    import pandas as pd

    def row(number, x):
        raw, kind = topk.packed(x)
        lists = np.argsort(x, axis=0, kind="stable").T.astype("<u2").tobytes()
        ids = np.arange(len(x), dtype=np.int64) + number * 10_000
        return dict(block=number, n=len(x), ids=ids.tobytes(), known=np.ones(len(x), bool).tobytes(), kind=kind, vectors=raw, lists=lists)

    blocks = list(pd.DataFrame([row(0, x), row(1, x // 50)]).itertuples())
    raw, kind = topk.packed(np.array([[5, 3, 0]]))
    asked = list(pd.DataFrame([dict(block=9, pos=0, id=0, kind=kind, vector=raw)]).itertuples())
    scored = []
    add = topk.Best.add
    monkeypatch.setattr(topk.Best, "add", lambda self, s, i, n: (scored.append(len(s)), add(self, s, i, n)))
    found = topk.search_blocks(blocks, asked, 5)
    want = sorted(((-(5 * a + 3 * b), i) for i, (a, b, _) in enumerate(x.tolist())))[:5]
    assert [(f[4], f[3]) for f in found] == [(-s, i) for s, i in want]
    assert sum(scored) < 400
