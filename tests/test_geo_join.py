"""Grid radius join equals brute force, including poles, antimeridian and
identical points."""

import math
import random

import pytest

from placekit.operators.geo_join import radius_join


def hav(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = (math.sin(math.radians(lat2 - lat1) / 2) ** 2
         + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2)
    return 2 * 3959.0 * math.asin(math.sqrt(min(max(a, 0.0), 1.0)))


def points(rng, n, radius):
    deg = max(radius / 69.0, 1e-4)
    out = []
    anchors = [(90.0, 0.0), (-90.0, 10.0), (89.99, 179.99), (0.0, 180.0), (0.0, -180.0),
               (45.0, 179.999), (45.0, -179.999), (10.0, 10.0)]
    for i in range(n):
        la, lo = rng.choice(anchors)
        lat = max(-90.0, min(90.0, la + rng.uniform(-3, 3) * deg))
        lon = lo + rng.uniform(-3, 3) * deg * (1 if abs(lat) < 89 else 50)
        lon = ((lon + 180.0) % 360.0) - 180.0
        out.append((i, lat, lon))
    out.append((n, 10.0, 10.0))
    out.append((n + 1, 10.0, 10.0))
    return out


@pytest.mark.parametrize("radius", [0.05, 0.2, 2.0, 25.0, 300.0, 4000.0])
def test_grid_equals_brute_force(spark, radius):
    rng = random.Random(int(radius * 100))
    a = points(rng, 150, radius)
    b = points(rng, 150, radius)
    A = spark.createDataFrame(a, "aid long, alat double, alon double")
    B = spark.createDataFrame(b, "bid long, blat double, blon double")
    got = radius_join(A, B, radius, ("alat", "alon"), ("blat", "blon")).select("aid", "bid").collect()
    got_pairs = [(r.aid, r.bid) for r in got]
    assert len(got_pairs) == len(set(got_pairs)), "pairs must not repeat"
    expected = {(i, j) for i, la, lo in a for j, lb, lob in b if hav(la, lo, lb, lob) <= radius}
    # pairs within float noise of the radius may fall either way
    border = {(i, j) for i, la, lo in a for j, lb, lob in b
              if abs(hav(la, lo, lb, lob) - radius) <= 1e-9 * max(1.0, radius)}
    assert set(got_pairs) - border == expected - border


def test_latitudes_out_of_range_keep_their_partners(spark):
    """The haversine formula takes any angle; so does the grid."""
    import random
    from pyspark.sql import functions as F
    from placekit.functions.geo import haversine_miles
    from placekit.operators.geo_join import radius_join
    rng = random.Random(1)
    pts = [(i, rng.choice([200.0, -95.0, 89.99, 100.0, 80.0, 350.0, -170.0]) + rng.uniform(-0.02, 0.02),
            rng.choice([0.0, 180.0, -179.99, 10.0]) + rng.uniform(-0.02, 0.02)) for i in range(300)]
    a = spark.createDataFrame(pts, "a long, alat double, alon double")
    b = spark.createDataFrame(pts[:150], "b long, blat double, blon double")
    want = (a.crossJoin(b).filter(haversine_miles(F.col("alat"), F.col("alon"), F.col("blat"), F.col("blon")) <= 1.0)
             .select("a", "b"))
    got = radius_join(a, b, 1.0, ("alat", "alon"), ("blat", "blon")).select("a", "b")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 300


def test_hot_point_is_dealt_out(spark):
    """A fifth of both sides at one point: every pair once, in cells of bounded size."""
    rng = random.Random(8)
    rows = [(i, 0.0, 0.0) if i % 5 == 0 else (i, rng.uniform(-1, 1), rng.uniform(-1, 1)) for i in range(2000)]
    a = spark.createDataFrame(rows, "aid long, alat double, alon double")
    b = spark.createDataFrame(rows[:1000], "bid long, blat double, blon double")
    got = [(r.aid, r.bid) for r in radius_join(a, b, 0.5, ("alat", "alon"), ("blat", "blon"), block=50).collect()]
    want = {(i, j) for i, la, lo in rows for j, lb, ob in rows[:1000] if abs(la - lb) < 0.01 and hav(la, lo, lb, ob) <= 0.5}
    assert len(got) == len(set(got)) and set(got) == want
    assert sum(i % 5 == 0 and j % 5 == 0 for i, j in got) == 400 * 200


def test_dealt_join_bounds_a_task(spark):
    from pyspark.sql import functions as F
    from placekit.operators import joins as J
    left = spark.range(3000).select(F.when(F.col("id") < 1500, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("x"))
    right = spark.range(900).select(F.when(F.col("id") < 300, 0).otherwise(F.col("id") + 1000).alias("k"), F.col("id").alias("y"))
    hot = J.hot_keys(left, right, ["k"], 100).collect()
    assert [(r["k"], r["_ln"], r["_rn"]) for r in hot] == [(0, 15, 3)]
    got = J.dealt_join(left, right, ["k"], 100)
    assert got.columns == ["k", "x", "y"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, left.join(right, "k").collect()))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:  # the pairs of the hot key lie in 45 cells of about 100 by 100, dealt over the tasks
        sizes = sorted(r["count"] for r in J.dealt_join(left, right, ["k"], 100).groupBy(
            F.spark_partition_id()).count().collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and sizes[-1] <= 4 * sizes[len(sizes) // 2]
