"""Hard negatives against brute force."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from placekit.llm import hard_negatives as H
from placekit.llm.vectors import best

SCHEMA = "vec_id long, v array<double>, label int, rank string, kind int"
NAN, INF = float("nan"), float("inf")


def brute(rows, anchors):
    """The rows of the result, by comparison of every anchor with every row."""
    low = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i not in low or (label, v) < low[i]:
            low[i] = (label, v)
    whole = {i: (label, [math.floor(256 * x) if abs(x) < 2 ** 60 else int(x) * 256 for x in v])
             for i, (label, v) in low.items()}
    out = []
    for a in filter(anchors, whole):
        score = {i: max(-H._MOST, min(H._MOST, sum(x * y for x, y in zip(whole[a][1], v)))) for i, (_, v) in whole.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        same = [i for i in order if whole[i][0] == whole[a][0]]
        other = [i for i in order if whole[i][0] != whole[a][0]]
        for p in same[:5]:
            ok = [i for i in other if 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            out += [(a, p, k, i, score[p], score[i]) for k, i in enumerate(ok[:10], 1)]
    return sorted(out)


def mined(spark, rows, block, every=10):
    df = spark.createDataFrame(rows, SCHEMA)
    got = H.hard_negatives(df, F.col("vec_id") % every == 0, block)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                               "negative_score").collect())


def test_hard_negatives_equal_brute_force(spark):
    rng = random.Random(1)
    center = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(4)]
    rows = []
    for i in range(230):
        label = rng.randrange(4)
        rows.append((i, [x + rng.gauss(0, 0.8) for x in center[label]], label, "clash", 1))
    rows += [(i, rows[7][1], rows[7][2], "clash", 1) for i in range(230, 290)]  # a hot vector
    rows += [(i, [0.25] * 8, 9, None, None) for i in range(290, 320)]  # ties
    rows += [(320, None, 1, None, 0), (330, [1.0, None], 1, None, 0), (340, [NAN], 1, None, 0), (350, [INF], 1, None, 0),
             (360, [1.0] * 8, None, None, 0), (None, [1.0] * 8, 1, None, 0),
             (370, [], 2, None, 0), (380, [0.0] * 8, 2, None, 0), (390, [0.5, -0.5], 2, None, 0), (400, [-1.0] * 9, 77, None, 0)]
    rows += [rows[0], rows[10], (20, [0.1] * 8, 0, "other", 3)]  # repeated rows, one id with two vectors
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 500
    for block in (8192, 64):
        assert mined(spark, rows, block) == want


def test_large_components_stay_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([1e9, 3e7, -2.5, 1e-3]) * rng.random() for _ in range(5)], i % 3, "", 0) for i in range(40)]
    assert mined(spark, rows, 16, 4) == brute(rows, lambda i: i % 4 == 0)
    huge = [(i, [1e308 * rng.random(), 1.0], i % 2, "", 0) for i in range(8)]
    assert mined(spark, huge, 8, 4) == brute(huge, lambda i: i % 4 == 0)


def test_empty_tables_and_single_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert H.hard_negatives(df, F.col("vec_id") % 10 == 0).count() == 0
    assert mined(spark, [(0, [1.0], 1, "", 0)], 8) == []
    assert mined(spark, [(0, [1.0], 1, "", 0), (1, [1.0], 1, "", 0)], 8) == []  # a positive, no negative


def test_best_breaks_ties_by_id():
    score, ids = np.array([3, 5, 5, 1, 5]), np.array([9, 8, 2, 1, 4])
    assert ids[best(score, ids, 2)].tolist() == [2, 4] and ids[best(score, ids, 9)].tolist() == [2, 4, 8, 9, 1]
