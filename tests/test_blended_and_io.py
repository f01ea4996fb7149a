"""Blended (Ratcliff/Obershelp) scores and the CSV / publish sinks."""

import os
import tempfile
from difflib import SequenceMatcher

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from placekit.functions import blended as BL
from placekit.sources import io


def plain_score(x, y):
    """P13 over cleaned names, in plain Python."""
    if not x or not y:
        return 0.0
    if x == y:
        return 1.0
    if min(len(x), len(y)) / max(len(x), len(y)) < 0.3:
        return 0.0
    r = SequenceMatcher(None, x, y).ratio()
    a, b = set(x.split()), set(y.split())
    words = 0.4 * len(a & b) / len(a | b) + 0.3 * any(len(w) > 3 and w in y for w in a)
    return 0.4 * r if r < 0.3 else min(1.0, 0.5 * r + words)


def test_blended_name_score(spark):
    names = ["Starbucks Coffee", "Starbucks", "The Home Depot", "Home Depot Inc", "Apple Store", "Best Buy", None, "x",
             "A", "Alphabet Corporation Limited", "Inc", "a the b", "Café Ünion", "zzzz qqqq", "Coffee Star-bucks"]
    n = spark.createDataFrame([(x,) for x in names], "name string").select("name", BL.name_form("name").alias("c"))
    rows = (n.selectExpr("name a", "c ca").crossJoin(n.selectExpr("name b", "c cb"))
             .withColumn("r", F.when(F.col("ca").isNotNull() & F.col("cb").isNotNull(),
                                     BL.ratcliff_ratio(F.coalesce("ca", F.lit("")), F.coalesce("cb", F.lit("")))))
             .withColumn("score", BL.name_score("ca", "cb", "r"))
             .withColumn("bound", BL.name_score_bound("ca", "cb")).collect())
    clean = {r["a"]: r["ca"] for r in rows}
    assert clean["The Home Depot"] == clean["Home Depot Inc"] == "home depot" and clean["Inc"] is None
    for r in rows:
        assert abs(r["score"] - plain_score(r["ca"], r["cb"])) < 1e-12, r
        assert r["bound"] >= r["score"] - 1e-12


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("abcd é", max_size=25), st.text("abcd é\U0001F600", max_size=25)), min_size=1, max_size=12))
def test_matched_characters_equal_the_library(pairs):
    x, y = zip(*pairs)
    got = BL.matched_characters(list(x), list(y)).tolist()
    assert got == [sum(m.size for m in SequenceMatcher(None, a, b).get_matching_blocks()) for a, b in pairs]


def test_ratio_of_long_and_empty_strings(spark):
    rows = [("", ""), ("a", ""), ("ab " * 90, "ab " * 80 + "xyz"), ("abc", "a" * 200 + "bc"), ("a" * 300, "a" * 199)]
    got = spark.createDataFrame(rows, "x string, y string").select(BL.ratcliff_ratio("x", "y")).collect()
    assert [round(r[0], 12) for r in got] == [round(SequenceMatcher(None, a, b).ratio(), 12) for a, b in rows]


def test_blended_street(spark):
    rows = [("123 Main St, Springfield, IL, 62704", "123 main st"), ("IL, 62704", "il"), (", x", None), (None, None),
            (" !! ", ""), ("1  Elm-St.", "1 elm st")]
    df = spark.createDataFrame(rows, "a string, want string")
    assert all(r["got"] == r["want"] for r in df.select("want", BL.street_form("a").alias("got")).collect())


def test_blended_matches_drop_pairs(spark):
    """Pairs that must fail: other names, other streets, too far."""
    from placekit.operators.match import BLENDED, match_places
    schema = ("row_id long, seq long, name string, address1 string, latitude double, longitude double, "
              "city string, territory string")
    a = spark.createDataFrame([(1, 1, "Starbucks Coffee", "1 Main St", 10.0, 10.0, "X", "NY"),
                               (2, 2, "Best Buy", "2 Elm St", 10.0, 10.0, "X", "NY"),
                               (3, 3, "Corner Shop", "3 Oak St", 40.0, 10.0, "X", "NY")], schema)
    b = spark.createDataFrame([(1, 1, "Starbucks", "1 Main Street", 10.0, 10.0, "X", "NY"),
                               (2, 2, "Zq Kw", "9 Pine", 10.0, 10.0, "X", "NY"),
                               (3, 3, "Corner Shop", "3 Oak St", 10.0, 10.0, "X", "NY")], schema)
    got = match_places(a, b, BLENDED).collect()
    assert [(r["b_row_id"], r["a_row_id"]) for r in got] == [(1, 1)]
    assert abs(got[0]["name_similarity"] - plain_score("starbucks", "starbucks coffee")) < 1e-9


def test_csv_round_trip(spark):
    d = tempfile.mkdtemp(prefix="pk-csv-")
    rows = [("a,b", 'say "hi"', 1.5, None, True, 12), ("plain", None, None, 2.25, None, None)]
    df = spark.createDataFrame(rows, "name string, address1 string, latitude double, longitude double, "
                                     "active boolean, savingsPercentage int")
    io.csv_export(df, d)
    back = io.csv_place_scan(spark, d)
    assert len(back.columns) == 45
    got = sorted((r.name, r.address1, r.latitude, r.longitude, r.active, r.savingsPercentage)
                 for r in back.collect())
    assert got == sorted(rows, key=lambda r: r[0])
    text = "".join(open(os.path.join(d, f)).read() for f in os.listdir(d) if f.endswith(".csv"))
    assert '"a,b"' in text and '"say ""hi"""' in text


def test_publish_if_changed(spark):
    root = tempfile.mkdtemp(prefix="pk-pub-")
    t = {"links": spark.range(10).select(F.col("id").cast("string").alias("merchantId"))}
    assert io.publish_if_changed(t, root, "PRODUCTION", "2024-01-01") is True
    assert io.publish_if_changed(t, root, "PRODUCTION", "2024-01-02") is False
    assert io.publish_if_changed(t, root, "PRODUCTION", "2024-01-03", force=True) is True
    t2 = {"links": spark.range(11).select(F.col("id").cast("string").alias("merchantId"))}
    assert io.publish_if_changed(t2, root, "PRODUCTION", "2024-01-04") is True
    back = spark.read.parquet(f"{root}/links").filter("snapshot_date = '2024-01-04'")
    assert back.count() == 11


def test_nonempty_guard(spark):
    import pytest
    with pytest.raises(ValueError):
        io.nonempty_guard(spark.range(0), "t")


def test_compare_job_on_csv_files(spark):
    from placekit.plans.compare import main
    from placekit.sources import fixtures as fx
    from tests.conftest import SF_SMALL
    d = tempfile.mkdtemp(prefix="pk-cmp-")
    io.csv_export(fx.place_a(spark, SF_SMALL), f"{d}/a")
    io.csv_export(fx.place_b(spark, SF_SMALL), f"{d}/b")
    main(["--a", f"{d}/a", "--b", f"{d}/b", "--out", f"{d}/out"])
    rep = spark.read.option("header", True).csv(f"{d}/out")
    kinds = {r.match_type for r in rep.select("match_type").distinct().collect()}
    assert "A_UNIQUE" in kinds and any(k.endswith("DUPLICATE") for k in kinds)


def test_csv_export_quoting_is_minimal(spark):
    """Fields are quoted only for comma, quote or line break; whitespace kept."""
    import glob
    vals = [" lead", "trail ", "a,b", 'q"x', "line\nbreak", "", None, "#hash", "tab\tx"]
    df = spark.createDataFrame([(v,) for v in vals], "name string").coalesce(1)
    d = tempfile.mkdtemp(prefix="pk-q-")
    io.csv_export(df, d)
    body = open(glob.glob(d + "/*.csv")[0]).read().split("\n", 1)[1]

    def rule(f):
        if f is None:
            return ""
        e = f.replace('"', '""')
        return f'"{e}"' if any(c in e for c in ',"\n\r') else e
    assert body == "".join(",,,,,,,," + rule(v) + "," * 36 + "\n" for v in vals)


def test_read_feed_json_strict_and_quarantine(spark):
    import pytest
    d = tempfile.mkdtemp(prefix="pk-json-")
    with open(f"{d}/b.json", "w") as f:
        f.write('{"seq": 1, "name": "ok", "brand_id": "7", "latitude": 1.5, "longitude": 2.0}\n')
        f.write('{"seq": 2, "name": "bad", "brand_id": "7", "latitude": "north", "longitude": 2.0}\n')
        f.write('{"seq": 3, "name": "missing"}\n')
    schema = io.FEED_SCHEMAS["locations_b"]
    with pytest.raises(Exception):
        io.read_feed_json(spark, d, schema, strict=True).collect()
    df = io.read_feed_json(spark, d, schema, strict=False)
    rows = {r.seq: r for r in df.collect()}
    assert rows[1].latitude == 1.5 and rows[1]._corrupt_record is None
    assert rows[2].latitude is None and "north" in rows[2]._corrupt_record
    assert rows[3].latitude is None and rows[3]._corrupt_record is None


def test_csv_rows_of_other_lengths(spark, tmp_path):
    n = len(io.PLACE_CSV_COLUMNS)
    name = io.PLACE_CSV_COLUMNS.index("name")

    def row(text, fields):
        cells = ["" for _ in range(fields)]
        cells[name] = text
        return ",".join(cells)

    lines = [",".join(io.PLACE_CSV_COLUMNS), row("full", n), row('"lo,ng"', n + 2), row("short", n - 3), row("last", n)]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    for multi in (True, False):
        got = io.csv_place_scan(spark, str(tmp_path / "a.csv"), multi)
        assert sorted(r["name"] for r in got.collect()) == ["full", "last", "lo,ng"] and got.count() == 3
        assert [r["name"] for r in io.csv_short_rows(spark, str(tmp_path / "a.csv"), multi).collect()] == ["short"]


def test_publish_on_one_date_and_moved_values(spark, tmp_path):
    root = str(tmp_path / "p")
    a, b = spark.range(10).selectExpr("cast(id as string) x"), spark.range(11).selectExpr("cast(id as string) x")
    assert [io.publish_if_changed({"t": t}, root, "M", "2024-01-01") for t in (a, b, a, a)] == [True, True, True, False]
    assert spark.read.parquet(f"{root}/t").count() == 10
    one = spark.createDataFrame([("x", None)], "a string, b string")
    two = spark.createDataFrame([(None, "x")], "a string, b string")
    assert [io.publish_if_changed({"t": t}, f"{root}2", "M", "2024-01-01") for t in (one, two)] == [True, True]
    (tmp_path / "bad" / "_manifest").mkdir(parents=True)
    (tmp_path / "bad" / "_manifest" / "part-0.parquet").write_text("no parquet")
    import pytest
    with pytest.raises(Exception):  # a manifest that cannot be read is no missing one
        io.publish_if_changed({"t": a}, str(tmp_path / "bad"), "M", "2024-01-01")
