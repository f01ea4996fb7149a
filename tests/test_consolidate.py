"""Consolidation equals a sequential simulation of the source system's loop."""

import hashlib
import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from placekit.operators.consolidate import combine_feeds
from placekit.operators.changes import keyed_diff, content_fingerprint


def _strip(n):
    low = n.lower()
    if low.endswith(" usd") or low.endswith(" usa") or low.endswith("-usa"):
        n = n[:-4]
    elif low.endswith(" us"):
        n = n[:-3]
    elif n.endswith("®"):
        n = n[:-1]
    elif n.endswith("(Same Day Delivery)"):
        n = n[:-len("(Same Day Delivery)")]
    return n.replace("’", "'").strip()


def norm(n):
    return _strip(n).replace("&amp;", "&")


def key(n):
    n = {"Domino's Pizza": "Domino's"}.get(n, n)
    return n.lower().replace("'", "")


def simulate(A, B, matches):
    """The source system's combine loop over lists of dicts."""
    names, logos, ids = {}, {}, {}

    def add(name, logo, mid):
        if name is None:
            return
        k = key(norm(name))
        names.setdefault(k, norm(name))
        if logo is not None:
            logos.setdefault(k, logo)
        if mid is not None:
            ids.setdefault(k, mid)

    def canon(name):
        n = norm(name)
        return names.get(key(n), n)

    def uid(name):
        n = norm(name)
        k = key(n)
        if k not in ids:
            ids[k] = str(uuid.UUID(bytes=hashlib.sha256(n.encode()).digest()[:16]))
        return ids[k]

    def logo(name):
        return logos.get(key(norm(name)))

    prov = {}

    def link(row, source_id):
        if row["merchantId"] is None or row["source"] is None:
            return
        prov[(row["merchantId"], row["source"])] = (source_id, row["savingsPercentage"])

    res = []
    for bi, ai in matches:
        a, b = A[ai], B[bi]
        m = dict(a, savingsPercentage=max(a["savingsPercentage"] or 0, b["savingsPercentage"] or 0),
                 plusCode="merged")
        add(m["name"], m["logoLocation"], a["merchantId"])
        link(a, a["merchantId"])
        link(dict(b, merchantId=a["merchantId"]), b["merchantId"])
        res.append(m)
    ma = {ai for _, ai in matches}
    mb = {bi for bi, _ in matches}
    for i, a in enumerate(A):
        if i in ma:
            continue
        add(a["name"], a["logoLocation"], a["merchantId"])
        n = dict(a, merchantId=uid(a["name"]), name=canon(a["name"]), logoLocation=logo(a["name"]))
        res.append(n)
        link(n, a["merchantId"])
    for i, b in enumerate(B):
        if i in mb:
            continue
        add(b["name"], b["logoLocation"], None)
        n = dict(b, name=canon(b["name"]), merchantId=uid(b["name"]), logoLocation=logo(b["name"]))
        if b["type"] == "online":
            ex = next((r for r in res if r["name"] == canon(b["name"]) and r["type"] == "online"), None)
            if ex is not None:
                s = max(b["savingsPercentage"] or 0, ex["savingsPercentage"] or 0)
                res.remove(ex)
                res.append(dict(ex, name=canon(b["name"]), merchantId=uid(b["name"]),
                                logoLocation=logo(b["name"]), savingsPercentage=s))
                link(dict(n, merchantId=ex["merchantId"]), b["merchantId"])
            else:
                res.append(n)
                link(n, b["merchantId"])
        else:
            res.append(n)
            link(n, b["merchantId"])
    return res, prov


POOL = ["Shop", "Shop USA", "SHOP®", " shop ", "Cafe", "Cafe US", "Kohl’s", "Kohl's", "Mart"]
COLS = ["row_id", "seq", "merchantId", "name", "address1", "latitude", "longitude", "city", "territory",
        "type", "savingsPercentage", "logoLocation", "source", "sourceId", "active", "redeemType",
        "denominationsType"]
SCHEMA = ("row_id long, seq long, merchantId string, name string, address1 string, latitude double, "
          "longitude double, city string, territory string, type string, savingsPercentage int, "
          "logoLocation string, source string, sourceId string, active boolean, redeemType string, "
          "denominationsType string")


def feed(rng, n, source, base):
    rows = []
    for i in range(n):
        rows.append({"row_id": base + i, "seq": base + i,
                     "merchantId": None if (source == "A" and rng.random() < 0.1) else f"{source}{rng.randint(0, 3)}",
                     "name": rng.choice(POOL), "address1": "x", "latitude": 1.0, "longitude": 1.0,
                     "city": None, "territory": None, "type": rng.choice(["online", "physical"]),
                     "savingsPercentage": rng.choice([None, 10, 50, 200]),
                     "logoLocation": rng.choice([None, None, f"logo{source}{i}"]), "source": source,
                     "sourceId": None, "active": True, "redeemType": None, "denominationsType": None})
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_combine_matches_sequential_loop(spark, seed):
    rng = random.Random(seed)
    A, B = feed(rng, 9, "A", 0), feed(rng, 9, "B", 100)
    pairs = sorted({(rng.randrange(9), rng.randrange(9)) for _ in range(rng.randint(0, 5))})
    exp_rows, exp_prov = simulate(A, B, pairs)
    a = spark.createDataFrame([tuple(r[c] for c in COLS) for r in A], SCHEMA)
    b = spark.createDataFrame([tuple(r[c] for c in COLS) for r in B], SCHEMA)
    m = spark.createDataFrame(
        [(B[bi]["row_id"], A[ai]["row_id"], B[bi]["seq"], A[ai]["seq"], 0.0, 1.0, 1.0, 1.0, "r", True,
          True, "", 1) for bi, ai in pairs],
        "b_row_id long, a_row_id long, b_seq long, a_seq long, distance_miles double, name_similarity double, "
        "address_similarity double, confidence double, reasons string, city_match boolean, "
        "state_match boolean, geographic_warning string, match_stage int")
    r = combine_feeds([a, b], matches=m)
    got = sorted(((x.name, x.merchantId, x.logoLocation, x.savingsPercentage, x.type, x.plusCode)
                  for x in r.places.collect()), key=repr)
    want = sorted(((x["name"], x["merchantId"], x["logoLocation"], x["savingsPercentage"], x["type"],
                    x.get("plusCode")) for x in exp_rows), key=repr)
    assert got == want
    got_links = {(x.merchantId, x.provider): (x.sourceId, x.savingsPercentage) for x in r.links.collect()}
    assert got_links == exp_prov


def test_single_feed_passthrough(spark):
    rng = random.Random(1)
    A = feed(rng, 5, "A", 0)
    a = spark.createDataFrame([tuple(r[c] for c in COLS) for r in A], SCHEMA)
    r = combine_feeds([a])
    assert r.places.count() == 5
    with pytest.raises(ValueError):
        combine_feeds([a, a, a])


def test_diff_self_is_empty(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "name string")
    d = keyed_diff(df, df, "name")
    assert d.new.count() == 0 and d.removed.count() == 0


def test_diff_cases(spark):
    p = spark.createDataFrame([("apple",), ("banana",), ("cherry",)], "name string")
    c = spark.createDataFrame([("BANANA",), ("cherry",), ("date",)], "name string")
    d = keyed_diff(p, c, F.lower(F.col("name")))
    assert [r.name for r in d.new.collect()] == ["date"]
    assert [r.name for r in d.removed.collect()] == ["apple"]


def test_fingerprint_order_independent(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).cast("string").alias("s"))
    f1 = content_fingerprint(df).collect()
    f2 = content_fingerprint(df.repartition(7).orderBy(F.rand(3))).collect()
    assert f1 == f2
    f3 = content_fingerprint(df.filter("id <> 5")).collect()
    assert f1 != f3


def test_rank_within_hot_key(spark):
    from pyspark.sql import Window
    from placekit.operators.ranking import rank_within
    # one key holds most rows; ranks must equal a plain row_number
    df = spark.range(5000).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise((F.col("id") % 37).cast("string")).alias("k"),
        ((F.col("id") * 7919) % 5003).alias("o"))
    got = rank_within(df, "k", "o", "r", partitions=8)
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    assert sorted(got.select("k", "o", "r").collect()) == sorted(want.select("k", "o", "r").collect())


def test_no_feed_and_unnamed_online_rows(spark):
    from placekit.operators.consolidate import PLACE_SCHEMA, combine_feeds
    none = combine_feeds([])
    assert none.places.count() == 0 and none.links.count() == 0
    schema = PLACE_SCHEMA + ", row_id long, seq long"

    def row(i, name, kind):
        return (f"m{i}", name, "online", None, None, None, "", kind, 5, None, "B", f"s{i}", True, "barcode", "fixed", None, i, i)

    a = spark.createDataFrame([row(1, "Shop", "online")], schema).drop("plusCode")
    b = spark.createDataFrame([row(2, None, "online"), row(3, "Shop", "online"), row(4, None, "online")], schema).drop("plusCode")
    got = combine_feeds([a, b])
    assert sorted(r["uid"] for r in got.places.collect()) == ["a:1", "b:2", "b:4"]  # 3 folds onto a's row


def test_strategies_in_one_pass_equal_one_by_one(spark):
    import random
    from placekit.operators import changes as CH
    rng = random.Random(4)
    schema = "row_id long, merchantId string, name string, latitude double, longitude double, at timestamp"

    def rows(n):
        return [(i, rng.choice(["m1", "m2", f"m{i}", None]), rng.choice(["Shop", " shop", f"S{i % 9}", None]),
                 rng.choice([0.0, -0.0, 1.00001, 1.00002, float("nan"), None]), rng.choice([2.0, None]), None) for i in range(n)]
    prev, curr = rows(60), rows(50)
    curr += prev[:5] + prev[:2]
    prev, curr = spark.createDataFrame(prev, schema), spark.createDataFrame(curr, schema)
    key = lambda r: repr(tuple(r))
    got = CH.diff_by_strategies(prev, curr)
    assert got.filter("strategy = 'all'").count() > 20
    for strategy in (*CH.STRATEGIES, "all"):
        d = CH.diff_by_strategy(prev, curr, strategy)
        for kind, want in (("new", d.new), ("removed", d.removed)):
            mine = got.filter((F.col("strategy") == strategy) & (F.col("kind") == kind)).drop("strategy", "kind")
            assert sorted(map(key, mine.collect())) == sorted(map(key, want.collect())), (strategy, kind)
    assert CH.diff_by_strategies(prev.limit(0), curr.limit(0)).count() == 0
