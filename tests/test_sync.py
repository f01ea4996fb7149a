"""End-to-end sync on the raw fixtures: publishes once, then only on change."""

import tempfile

from placekit.plans.sync import run_sync
from placekit.sources import fixtures as fx
from tests.conftest import SF_SMALL


def _inputs(spark):
    return {"brands_a": fx.raw_brand_a(spark, SF_SMALL), "locations_a": fx.raw_location_a(spark, SF_SMALL),
            "brands_b": fx.raw_brand_b(spark, SF_SMALL), "offers_b": fx.raw_offer_b(spark, SF_SMALL),
            "locations_b": fx.raw_location_b(spark, SF_SMALL), "sheet_c": fx.raw_sheet_c(spark, SF_SMALL),
            "kiosks": fx.raw_kiosk(spark, SF_SMALL)}


def test_sync_publishes_only_on_change(spark):
    root = tempfile.mkdtemp(prefix="pk-sync-")
    r1 = run_sync(_inputs(spark), root, "TESTNET", "2024-05-01", blocklist=fx.TEST_OFFER_BLOCKLIST)
    assert r1.published
    rep = r1.report.first()
    assert rep.total_locations > 0 and rep.total_merchants > 0
    prev = spark.read.parquet(f"{root}/from_providers")
    r2 = run_sync(_inputs(spark), root, "TESTNET", "2024-05-02", previous=prev,
                  blocklist=fx.TEST_OFFER_BLOCKLIST)
    assert not r2.published
    counts = {r.source: r for r in r2.sources.collect()}
    # the brands of the feed's pages against the names of the previous run
    enabled = {r.name for r in _inputs(spark)["brands_a"].filter("enabled").collect() if r.name is not None}
    before = {r.name for r in prev.filter("source = 'A'").collect() if r.name is not None}
    assert counts["A"].new_brands == len(enabled - before) and counts["A"].removed_brands == len(before - enabled)
    # feed A's locations are counted before the name check, so there are more than places
    assert counts["A"].locations >= prev.filter("source = 'A'").count()
    assert spark.read.parquet(f"{root}/merchant").count() == r1.tables["merchant"].count()


def test_sync_cli_reads_landed_parquet(spark, capsys):
    from placekit.plans.sync import INPUTS, main
    land = tempfile.mkdtemp(prefix="pk-land-")
    out = tempfile.mkdtemp(prefix="pk-out-")
    for name, df in _inputs(spark).items():
        df.write.mode("overwrite").parquet(f"{land}/{name}")
    assert set(INPUTS) == set(_inputs(spark))
    main(["--input", land, "--output", out, "--mode", "DEVNET", "--date", "2024-06-01"])
    assert "published" in capsys.readouterr().out
    main(["--input", land, "--output", out, "--mode", "DEVNET", "--date", "2024-06-02"])
    assert "unchanged" in capsys.readouterr().out


def test_sync_cli_reads_landed_json(spark, capsys):
    from placekit.plans.sync import main
    from placekit.sources import io as IO
    land = tempfile.mkdtemp(prefix="pk-landj-")
    out = tempfile.mkdtemp(prefix="pk-outj-")
    from pyspark.sql import functions as F
    for name, df in _inputs(spark).items():
        if name == "offers_b":   # the fixture's arrival key is a decimal; land a bigint one
            df = df.withColumn("seq", F.monotonically_increasing_id())
        # land with the feed schema's column names and types
        want = spark.createDataFrame([], IO.FEED_SCHEMAS[name])
        cols = [c for c in want.columns if c in df.columns]
        df.select(*[df[c].cast(want.schema[c].dataType) for c in cols]).write.mode("overwrite").json(f"{land}/{name}")
    main(["--input", land, "--output", out, "--mode", "TESTNET", "--date", "2024-07-01", "--format", "json"])
    assert "published" in capsys.readouterr().out
    assert spark.read.parquet(f"{out}/merchant").count() > 0


def test_sync_reports_what_the_query_reports(spark):
    """The job's summary and the checked query are one function of the same inputs."""
    from placekit.plans.catalog import QUERIES
    from placekit.plans.sync import source_summary
    from placekit.sources import feeds as FD
    x = _inputs(spark)
    fb = FD.feed_b(x["brands_b"], x["offers_b"], x["locations_b"], blocklist=fx.TEST_OFFER_BLOCKLIST)
    got, _ = source_summary(FD.feed_a_brand_registry(x["brands_a"]), x["brands_a"], x["locations_a"], x["brands_b"], fb,
                            fx.previous_brand_names(spark, SF_SMALL, "A"), fx.previous_brand_names(spark, SF_SMALL, "B"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, QUERIES["source_report"](spark, SF_SMALL).collect()))
