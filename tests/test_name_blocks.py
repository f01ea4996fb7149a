"""Blocking by names keeps every passing pair, once, and few others."""

import random

import pytest
from pyspark.sql import functions as F

from placekit.functions.text import edit_similarity
from placekit.operators.name_blocks import LengthBands, Segments, blocked_join, name_blocks


def names(rng, n):
    base = ["".join(rng.choice("abcde é日") for _ in range(rng.randrange(0, 45))) for _ in range(n // 4)]
    out = ["", "", "a", "ab", "ba", "aaaaaaaaaa", "aaaaaaaaaaa", "a" * 30, "a" * 33]
    for b in base:
        for _ in range(4):
            x = list(b)
            for _ in range(rng.randrange(0, 4)):
                at = rng.randrange(len(x) + 1)
                x[at:at + rng.randrange(2)] = rng.choice(["", "x", "ab"])
            out.append("".join(x))
    return out


def blocked(spark, m, a, b, cls=name_blocks, dense_rows=2):
    A = spark.createDataFrame([(i, x, i % 50) for i, x in enumerate(a)], "aid long, an string, k int")
    B = spark.createDataFrame([(i, x, 1) for i, x in enumerate(b)], "bid long, bn string, k int")
    A = A.withColumn("k", F.when(F.col("k") < 40, 1).otherwise(F.col("k")))  # one dense cell
    B = B.unionByName(B.filter("bid < 3").withColumn("k", F.lit(41)))  # and a thin one
    return A, B, blocked_join(A, B, ["k"], cls(m, "an", "bn"), block=30, dense_rows=dense_rows)


@pytest.mark.parametrize("m", [0.7, 0.85, 0.9, 0.95, 1.0])
def test_blocking_equals_all_pairs(spark, m):
    rng = random.Random(int(100 * m))
    a, b = names(rng, 160), names(rng, 40)
    b += rng.sample(a, 60)
    A, B, pairs = blocked(spark, m, a, b)
    similar = edit_similarity("an", "bn") >= F.lit(m)
    got = [(r["aid"], r["bid"]) for r in pairs.filter(similar).select("aid", "bid").collect()]
    want = {(r["aid"], r["bid"]) for r in A.join(B, "k").filter(similar).select("aid", "bid").collect()}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 40
    assert isinstance(name_blocks(m, "an", "bn"), Segments if m >= 0.85 else LengthBands)
    every = pairs.select("aid", "bid")
    assert every.count() == every.distinct().count()


def test_segments_leave_few_pairs_of_a_dense_cell(spark):
    """Names of one cell, all of about one length: a tenth of the pairs of the
    length bands at most are compared."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(4, 9))) for _ in range(300)]
    a = [" ".join(rng.sample(words, 3)) for _ in range(600)]
    b = rng.sample(a, 200) + [" ".join(rng.sample(words, 3)) for _ in range(200)]
    similar = edit_similarity("an", "bn") >= F.lit(0.9)
    counted = {}
    for cls in (LengthBands, Segments):
        _, _, pairs = blocked(spark, 0.9, a, b, cls)
        counted[cls] = pairs.count(), pairs.filter(similar).count()
    assert counted[Segments][1] == counted[LengthBands][1] >= 100
    assert counted[Segments][0] * 10 <= counted[LengthBands][0]
