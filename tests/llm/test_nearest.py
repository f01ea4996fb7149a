"""Nearest neighbours against brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from placekit.llm import nearest as A
from placekit.sources.tables import table
from tests.conftest import SF_CHECK

SCHEMA = "vec_id long, v array<double>, label int, rep string, leaf int, n string"
NAN, INF = float("nan"), float("inf")


def brute(rows, is_query, k=5):
    """{query: [(score, id) of all others, best first]}"""
    low = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        low[i] = min(low.get(i, v), v)
    width = max(map(len, low.values()), default=0)
    ids = np.array(sorted(low))
    x = np.array([np.pad(np.array(low[i], float), (0, width - len(low[i]))) for i in ids]).reshape(len(ids), width)
    x = A.scaled(x)
    out = {}
    for i, q in zip(ids, x):
        if is_query(i):
            s = A.cosines(q, x)
            order = [n for n in np.lexsort((ids, -s)) if ids[n] != i]
            out[int(i)] = [(float(s[n]), int(ids[n])) for n in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want, k=5):
    hits = total = 0
    for q, w in want.items():
        true = {i for _, i in w[:k]}
        assert len(got.get(q, [])) == len(true), q  # a whole answer, in order, with true scores
        scores = dict((i, s) for s, i in w)
        assert all(abs(scores[i] - s) < 1e-12 for s, i in got.get(q, []))
        assert got.get(q, []) == sorted(got.get(q, []), key=lambda x: (-x[0], x[1]))
        hits += len(true & {i for _, i in got.get(q, [])})
        total += len(true)
    return hits / max(1, total)


def test_all_leaves_give_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)], 1, "clash", 0, "") for i in range(200)]
    rows += [(i, rows[5][1], 1, None, 0, "") for i in range(200, 260)]  # a hot vector
    rows += [(i, [2 * x for x in rows[5][1]], 1, None, 0, "") for i in range(260, 290)]  # its direction
    rows += [(300, None, 1, "", 0, ""), (310, [1.0, None], 1, "", 0, ""), (320, [NAN] * 6, 1, "", 0, ""), (330, [0.0] * 6, 1, "", 0, ""),
             (340, [], 1, "", 0, ""), (350, [INF], 1, "", 0, ""), (None, [1.0] * 6, 1, "", 0, ""), (360, [1e300, -1e300], 1, "", 0, ""),
             (370, [1e-300] * 7, 1, "", 0, ""), (10, [0.5] * 6, 2, "", 0, ""), rows[20], rows[20]]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows, lambda i: i % 10 == 0)
    got = found(A.nearest(df, F.col("vec_id") % 10 == 0, recall=1.0, leaf=16, block=20))
    assert recall(got, want) > 0.99
    whole = found(A.nearest(df, F.col("vec_id") % 10 == 0, leaves=1))
    assert {q: [i for _, i in w] for q, w in whole.items()} == {q: [i for _, i in w[:5]] for q, w in want.items()}


def test_calibrated_recall_on_clusters_and_on_noise(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(40, 16)) * 3
    near = centre[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16))
    for x in (near, rng.normal(size=(3000, 12))):
        rows = [(i, v, 0, "", 0, "") for i, v in enumerate(x.tolist())]
        df = spark.createDataFrame(rows, SCHEMA)
        got = found(A.nearest(df, F.col("vec_id") % 50 == 0, leaf=64, block=100))
        assert recall(got, brute(rows, lambda i: i % 50 == 0)) >= 0.9


def test_few_rows_and_empty_tables(spark):
    q = F.col("vec_id") % 10 == 0
    assert A.nearest(spark.createDataFrame([], SCHEMA), q).count() == 0
    one = [(0, [1.0], 0, "", 0, "")]
    assert A.nearest(spark.createDataFrame(one, SCHEMA), q).count() == 0
    few = one + [(1, [2.0], 0, "", 0, ""), (2, [-1.0], 0, "", 0, "")]
    assert found(A.nearest(spark.createDataFrame(few, SCHEMA), q)) == {0: [(1.0, 1), (-1.0, 2)]}
    assert A.nearest(spark.createDataFrame(few[1:], SCHEMA), q).count() == 0


def test_op12_recall(spark):
    rows = [tuple(r) for r in table(spark, SF_CHECK, "embeddings").select("vec_id", "embedding").collect()]
    got = found(A.op12_nearest(spark, SF_CHECK))
    assert recall(got, brute(rows, lambda i: i % 50 == 0)) >= 0.9


def test_tree_walk_is_best_bin_first():
    rng = np.random.default_rng(5)
    x = A.unit(rng.normal(size=(2000, 8)))
    tree = A.Tree(x, 20, 100)
    leaves = set(tree.leaf_of(x).tolist())
    order = list(tree.visits(x[0]))
    assert leaves <= set(order) and len(order) == len(set(order)) <= 100
    # greedy descent and the queue part only where another branch's centre is nearer
    assert sum(next(tree.visits(v)) == leaf for v, leaf in zip(x[:200], tree.leaf_of(x[:200]))) >= 190
