"""Rule vectors (the source system's unit cases) on tiny DataFrames."""

import pytest
from pyspark.sql import functions as F

from placekit.functions import (edit_similarity, haversine_miles, name_similarity, name_uuid,
                                normalize_name, street_component, street_similarity, strip_suffix,
                                state_from_json, state_from_text, clean_business_name, name_key)
from placekit.functions.scoring import confidence, reachable_radius
from placekit.operators.match import PRODUCTION, DESKTOP, GEOGRAPHIC
from tests.conftest import one


def ev(spark, expr, *vals, schema=None):
    n = len(vals)
    schema = schema or ", ".join(f"c{i} string" for i in range(n))
    df = spark.createDataFrame([tuple(vals)], schema)
    return one(df.select(expr(*[F.col(f"c{i}") for i in range(n)]).alias("v")), "v")


def test_haversine_nyc_la(spark):
    d = ev(spark, haversine_miles, 40.7128, -74.0060, 34.0522, -118.2437,
           schema="c0 double, c1 double, c2 double, c3 double")
    assert 2400 < d < 2500


@pytest.mark.parametrize("a,b,lo,hi", [
    ("123 Main St", "123 Main Street", 0.7, 1.01),
    ("123 Main St", "456 Oak Ave", -0.01, 0.5),
    (None, "123 Main St", 0.0, 0.0),
])
def test_street_similarity(spark, a, b, lo, hi):
    v = ev(spark, street_similarity, a, b)
    assert lo <= v <= hi if lo != hi else v == lo


def test_edit_similarity(spark):
    assert ev(spark, edit_similarity, "test", "test") == 1.0
    assert ev(spark, edit_similarity, "abc", "xyz") < 1.0
    assert ev(spark, edit_similarity, "", "") == 1.0


@pytest.mark.parametrize("a,b,check", [
    ("Target", "TARGET", lambda v: v == 1.0),
    ("  Target  ", "Target", lambda v: v == 1.0),
    ("Starbucks", "Starbucks Coffee", lambda v: v > 0.5),
    ("Apple Store", "Best Buy", lambda v: v < 0.5),
    (None, "Target", lambda v: v == 0.0),
    ("", "Target", lambda v: v == 0.0),
    ("   ", "Target", lambda v: v == 0.0),
    ("Home Depot", "The Home Depot", lambda v: v > 0.7),
    ("CVS Pharmacy", "CVS", lambda v: v > 0.2),
    ("Walmart Supercenter", "Walmart", lambda v: v > 0.3),
])
def test_name_similarity(spark, a, b, check):
    assert check(ev(spark, name_similarity, a, b))


@pytest.mark.parametrize("raw,expected", [
    ("Shop USA", "Shop"), ("Shop usd", "Shop"), ("Shop-USA", "Shop"), ("Shop US", "Shop"),
    ("Shop®", "Shop"), ("Shop (Same Day Delivery)", "Shop"), ("Shop USA US", "Shop USA"),
    ("Shop USA ", "Shop USA"), ("Kohl’s", "Kohl's"), ("A&amp;B", "A&B"), ("Plain", "Plain"),
    ("Bus", "Bus"),
])
def test_normalize_name(spark, raw, expected):
    assert ev(spark, normalize_name, raw) == expected


def test_name_key_alias(spark):
    assert ev(spark, name_key, "Domino's Pizza") == "dominos"
    assert ev(spark, name_key, "Kohl's") == "kohls"


def test_name_uuid_format(spark):
    import hashlib
    import uuid
    h = hashlib.sha256("Target".encode()).digest()[:16]
    assert ev(spark, name_uuid, "Target") == str(uuid.UUID(bytes=h))


@pytest.mark.parametrize("addr,street", [
    ("123 Main St, Springfield, IL, 62704", "123 Main St"),
    ("CA, 90210", ""), ("CA, 90210-1234", ""), ("123 Main St", "123 Main St"),
    ("  1 A St ,x", "1 A St"), ("NY, abc", "NY"),
])
def test_street_component(spark, addr, street):
    assert ev(spark, street_component, addr) == street


def test_states(spark):
    assert ev(spark, state_from_json, "NY") == "New York"
    assert ev(spark, state_from_json, " Hawaii") == "Hawaii"
    assert ev(spark, state_from_json, "New,Hampshire ") == "New Hampshire"
    assert ev(spark, state_from_json, "") is None
    assert ev(spark, state_from_text, "ZZ ") == "ZZ "
    assert ev(spark, state_from_text, "") == ""


def test_clean_business_name(spark):
    assert ev(spark, clean_business_name, "The Coffee Co., Inc.") == "coffee"
    assert ev(spark, clean_business_name, "A Best LLC") == "best"


def test_reachable_radius():
    # production: pairs beyond 0.1 mi cannot reach 0.8 confidence
    assert reachable_radius(PRODUCTION) == 0.1
    assert reachable_radius(DESKTOP) == 0.2
    assert reachable_radius(GEOGRAPHIC) == 0.1


def test_confidence_caps(spark):
    df = spark.createDataFrame([(0.15, 1.0, 1.0), (0.005, 1.0, 1.0), (0.3, 1.0, 1.0)],
                               "d double, n double, s double")
    c = confidence("d", "n", "s", F.lit(False), F.lit(False), F.lit(False), PRODUCTION)
    vals = [r[0] for r in df.select(c).collect()]
    assert vals == [0.6, 1.0, 0.4]
