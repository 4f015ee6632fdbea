"""Operator 11 against brute force over all pairs."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from kpilens.llm import gnat, hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, leaf int, q string, score long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, 1, "x", 2) for i, v, y in rows], SCHEMA)


def expected(rows, every=100):
    rows = [(i, y, [math.floor(256 * x) for x in v]) for i, v, y in rows
            if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    rows = list({r[0]: r for r in sorted(rows, reverse=True)}.values())
    out = []
    for i, y, a in rows:
        if i % every:
            continue
        s = sorted((-sum(p * q for p, q in zip(a, b)), j, z) for j, z, b in rows if j != i)
        for p, j, _ in [t for t in s if t[2] == y][:5]:
            near = [t for t in s if t[2] != y and 30 * -p <= 100 * -t[0] <= 90 * -p][:10]
            out += [(i, j, k + 1, n, -p, -t) for k, (t, n, _) in enumerate(near)]
    return sorted(out)


def got(spark, rows, every=100):
    out = hn.mine(hn.usable(frame(spark, rows), "vec_id", "embedding", F.col("label")), F.col("id") % every == 0)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()))


def clustered(rng, n, dim):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(12)]
    cells = [rng.randrange(12) for _ in range(n)]
    return [(i, [x + rng.gauss(0, .4) for x in centres[c]], c % 4) for i, c in enumerate(cells)]


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(gnat.build, "__defaults__", (gnat.SAMPLE, 40, 30))       # many leaves of small blocks
    rng = random.Random(1)
    rows = clustered(rng, 900, 8)
    assert got(spark, rows, 20) == expected(rows, 20)


def test_ties_common_vectors_and_unusable_rows(spark, monkeypatch):
    monkeypatch.setattr(gnat.build, "__defaults__", (gnat.SAMPLE, 20, 16))
    rng = random.Random(2)
    rows = clustered(rng, 200, 4)
    rows += [(i, [1.0, .5, .25, .25], i % 3) for i in range(200, 350)]             # a third is one vector
    rows += [(400, None, 1), (401, [1.0, None, 0.0, 0.0], 1), (402, [math.nan, 1.0, 1.0, 1.0], 1), (403, [1.0, math.inf, 0.0, 0.0], 2),
             (404, [1.0, 1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0, 1.0], 1), (405, [], 1), (406, [2.0], 0), (410, [0.0] * 4, 2)]
    rows += rows[:30] + [(10, [9.0, 9.0, 9.0, 9.0], 3)]                           # repeated rows, and an id with two vectors
    assert got(spark, rows, 10) == expected(rows, 10)


def test_small_tables(spark):
    for rows in ([], [(0, [1.0, 0.0], 1)], [(0, [1.0], 1), (1, [1.0], 1), (2, [.5], 2)], [(100, None, 1)], [(0, [], 1), (1, [], 1), (2, [], 3)]):
        assert got(spark, rows) == expected(rows)


def test_ranges_rule_out_whole_subtrees(spark):
    rng = random.Random(5)
    rows = [(i, [10 * (i % 30) + rng.random(), 7 * (i % 13) + rng.random()], i % 5) for i in range(3000)]
    index = gnat.build(hn.usable(frame(spark, rows), "vec_id", "embedding", F.col("label")), leaf_rows=50)
    q = np.array([[math.floor(256 * x) for x in rows[7][1]]])
    score = [int(q[0] @ np.array([math.floor(256 * x) for x in v])) for _, v, _ in rows]
    lo, hi = np.quantile(score, [.98, 1]).astype(np.int64)               # an annulus around the query
    left = index.tree.reached(q, np.array([lo]), np.array([hi]))
    assert 0 < len(left) < 0.5 * len(index.tree.blocks)
    kept = {r["id"] for r in index.rows.where(F.col("leaf").isin([int(x) for x in left[:, 1]])).select("id").collect()}
    assert kept >= {i for (i, *_), s in zip(rows, score) if lo <= s <= hi}


def test_whole_numbers_beyond_doubles(spark):
    rng = random.Random(6)
    rows = [(i, [float(rng.randrange(1 << 21)) for _ in range(8)], i % 2) for i in range(60)]
    index = gnat.build(hn.usable(frame(spark, rows), "vec_id", "embedding", F.col("label")))
    assert not index.tree.exact
    assert got(spark, rows, 10) == expected(rows, 10)
