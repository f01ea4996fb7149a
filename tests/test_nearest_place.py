"""Nearest places equal brute force, and no point meets many candidates."""

import random

import pytest

from placekit.operators import nearest_place as N
from tests.test_geo_join import hav


def brute(points, places):
    out = {}
    for p in points:
        known = [(hav(la, lo, *p), c, s) for c, s, la, lo in places if la is not None and lo is not None]
        out[p] = min(known) if known else None
    return out


def cases(rng):
    dense = [(30.0 + rng.gauss(0, 1e-3), -90.0 + rng.gauss(0, 1e-3)) for _ in range(400)]
    wide = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(60)]
    poles = [(90.0, 0.0), (-90.0, 5.0), (89.999, 179.0), (0.0, 180.0), (0.0, -179.999), (100.0, 10.0), (-200.0, 30.0)]
    return dense, wide, poles


@pytest.mark.parametrize("leaf", [64, 4])
def test_nearest_places_equal_brute_force(spark, leaf):
    rng = random.Random(leaf)
    dense, wide, poles = cases(rng)
    places = [(f"c{n % 300}", f"s{n % 7}", la, lo) for n, (la, lo) in enumerate(dense + wide + poles)]
    places += [("b", "z", *dense[0]), ("a", "z", *dense[0]), ("x", "x", None, 1.0), ("x", "x", 1.0, None)]
    points = sorted({(round(rng.uniform(-90, 90), 3), round(rng.uniform(-180, 180), 3)) for _ in range(150)}
                    | {(round(la, 3), round(lo, 3)) for la, lo in dense[:60]} | set(dense[:5]) | set(poles)
                    | {(29.0, -90.0), (30.02, -90.0), (30.0, 90.0)})
    got = N.nearest_places(spark.createDataFrame(points, "lat double, lon double"),
                           spark.createDataFrame(places, "city string, state string, plat double, plon double"), leaf=leaf)
    rows = {(r["lat"], r["lon"]): r["near"] for r in got.collect()}
    assert len(rows) == len(points)
    for p, (d, c, s) in brute(points, places).items():
        near = rows[p]
        assert abs(near["distance"] - d) < 1e-6, p
        at_least_as_near = {(x, y) for x, y, la, lo in places if la is not None and lo is not None and hav(la, lo, *p) <= d + 1e-9}
        assert (near["city"], near["state"]) in at_least_as_near


def test_candidates_are_few_beside_a_dense_town(spark):
    rng = random.Random(2)
    places = [("c", "s", 30.0 + rng.gauss(0, 0.02), -90.0 + rng.gauss(0, 0.02)) for _ in range(5000)]
    points = [(35.0 + n / 10, -90.0) for n in range(20)] + [(round(la, 3), round(lo, 3)) for _, _, la, lo in places[:50]]
    P = spark.createDataFrame(sorted(set(points)), "lat double, lon double")
    G = spark.createDataFrame(places, "city string, state string, plat double, plon double")
    counts = N.candidates(P, G, leaf=16).groupBy("lat", "lon").count().collect()
    assert len(counts) == len(set(points)) and max(r["count"] for r in counts) <= 300
    want = brute(points, places)
    assert all(abs(r["near"]["distance"] - want[r["lat"], r["lon"]][0]) < 1e-6 for r in N.nearest_places(P, G, leaf=16).collect())


def test_empty_tables(spark):
    points = spark.createDataFrame([(1.0, 1.0)], "lat double, lon double")
    none = spark.createDataFrame([("x", "y", None, None)], "city string, state string, plat double, plon double")
    assert N.nearest_places(points, none).count() == 0
    some = spark.createDataFrame([("x", "y", 1.0, 2.0)], "city string, state string, plat double, plon double")
    assert N.nearest_places(points.limit(0), some).count() == 0
    assert N.nearest_places(points, some).first()["near"]["city"] == "x"
