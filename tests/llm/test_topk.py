from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from staylens.llm import topk


def brute(rows, every, k):
    good = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for i, v in dict(sorted(((i, v) for i, v in good if i % every == 0), reverse=True)).items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in good if j != i and len(w) == len(v))
        found += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(found)


def check(spark, rows, every=5, k=4, **sizes):
    df = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<FLOAT>").selectExpr("*", "1 AS score", "2 AS block")
    got = topk.top_k(df, F.col("vec_id") % every == 0, k, **sizes).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, every, k)


def vectors(n, size, seed):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 0.2) for _ in range(size)]) for i in range(n)]


def test_matches_brute_force(spark):
    check(spark, vectors(300, 16, 0), k=20, candidates=70, queries=20)


def test_ties_copies_and_rows_that_take_no_part(spark):
    rows = vectors(40, 3, 1)
    rows += [(100 + i, rows[0][1]) for i in range(30)] + [(5, rows[5][1]), (5, rows[5][1]), (200, [0.0, 0.0, 0.0])]
    rows += [(300, None), (305, [1.0, None, 2.0]), (310, [float("nan")] * 3), (315, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(400, [0.5, 0.5]), (401, [0.25, -0.5]), (405, [])]
    check(spark, rows, candidates=16, queries=5)


def test_few_rows_and_none(spark):
    check(spark, vectors(3, 4, 2))
    check(spark, [])


def test_reading_stops_before_the_end():
    rng = np.random.default_rng(4)
    base = rng.integers(-3, 4, (2000, 6))
    base[:30] = 40
    lists = topk.Lists(np.arange(2000), base)

    class Watched(np.ndarray):
        most = 0

        def __getitem__(self, key):
            if isinstance(key, tuple) and isinstance(key[1], slice) and len(key[0]):
                Watched.most = max(Watched.most, key[1].stop)
            return super().__getitem__(key)

    lists.rows = lists.rows.view(Watched)
    ids, scores = lists.top(0, base[0], 20)
    assert ids.tolist() == list(range(1, 21)) and set(scores.tolist()) == {6 * 1600}
    assert Watched.most < 1000
