"""End-to-end sync job: landed feeds -> combined snapshot -> publish if changed.

``run_sync`` takes the landed raw feed tables as DataFrames; ``main`` reads
them as parquet from an input root.  Each place feed needs an arrival-order
column ``seq`` (brand and location tables) so the order-dependent
consolidation is reproducible.
"""

from __future__ import annotations

import argparse
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placekit.operators import changes as CH
from placekit.operators import report as R
from placekit.operators.consolidate import combine_feeds
from placekit.operators.match import PRODUCTION, MatchParams
from placekit.session import get_spark, materialize
from placekit.sources import feeds as FD
from placekit.sources import io as IO

INPUTS = ["brands_a", "locations_a", "brands_b", "offers_b", "locations_b", "sheet_c", "kiosks"]


class SyncResult(NamedTuple):
    published: bool
    tables: dict
    report: DataFrame
    sources: DataFrame
    source_lists: DataFrame


def _numbered(df: DataFrame) -> DataFrame:
    """Places keyed by their arrival order."""
    return df.withColumn("row_id", F.col("seq"))


def source_summary(reg, brands_a: DataFrame, locations_a: DataFrame, brands_b: DataFrame, fb,
                   previous_a: DataFrame | None = None, previous_b: DataFrame | None = None):
    """Counts and name lists per source (``report.source_report``): feed A's
    locations before the name check, and the enabled brands of its pages, not
    those of its places, against the names of the previous run."""
    a = {"brands": reg.enabled, "locations": FD.feed_a_counted_locations(reg.enabled, locations_a),
         "disabled": reg.disabled.select("name")}
    b = {"brands": brands_b, "locations": fb.places.filter(F.col("type") == "physical"),
         "negative": fb.rejected_brands.filter(F.col("reason") == "negative_discount").select("name")}
    for feed, before, now, normalized in ((a, previous_a, brands_a.filter("enabled"), False),
                                          (b, previous_b, brands_b, True)):
        if before is not None:
            d = CH.new_removed_brands(before, now.select("name"), normalized)
            feed.update(new=d.new, removed=d.removed)
    return R.source_report({"A": a, "B": b})


def run_sync(inputs: dict, output_root: str, mode: str, snapshot_date: str,
             previous: DataFrame | None = None, params: MatchParams = PRODUCTION,
             blocklist: dict | None = None, force: bool = False) -> SyncResult:
    reg = FD.feed_a_brand_registry(inputs["brands_a"])
    places_a = materialize(_numbered(FD.feed_a_places(reg.enabled, inputs["locations_a"])))
    fb = FD.feed_b(inputs["brands_b"], inputs["offers_b"], inputs["locations_b"], blocklist=blocklist)
    places_b = materialize(_numbered(fb.places))
    places_c = FD.feed_c_places(inputs["sheet_c"])
    kiosks = FD.kiosk_places(inputs["kiosks"])

    combined = combine_feeds([places_a, places_b], params)
    providers = R.archive(places_a).unionByName(R.archive(places_b))
    tables = {
        "merchant": IO.explore_table(places_c, combined.places),
        "provider_links": combined.links,
        "atm": kiosks,
        "from_providers": providers,
        "final": R.archive(combined.places),
        "duplicates": R.duplicates_table(places_a, places_b, combined.matches),
    }
    for name in ("merchant", "provider_links", "atm"):
        IO.nonempty_guard(tables[name], name)

    names = [None if previous is None else previous.filter(F.col("source") == src).select("name") for src in "AB"]
    sources, lists = source_summary(reg, inputs["brands_a"], inputs["locations_a"], inputs["brands_b"], fb, *names)
    published = IO.publish_if_changed(tables, output_root, mode, snapshot_date, force=force)
    report = R.sync_report(combined.places, combined.links, combined.matches)
    return SyncResult(published, tables, report, sources, lists)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Combine landed place feeds and publish a snapshot.")
    ap.add_argument("--input", required=True, help="root with one parquet folder per input table")
    ap.add_argument("--output", required=True, help="publish root (shared storage)")
    ap.add_argument("--mode", required=True, choices=["PRODUCTION", "TESTNET", "DEVNET"])
    ap.add_argument("--date", required=True, help="snapshot date yyyy-MM-dd")
    ap.add_argument("--force", action="store_true")
    ap.add_argument("--format", choices=["parquet", "json"], default="parquet",
                    help="landed input format; JSON is read with the typed feed schemas (strict)")
    args = ap.parse_args(argv)
    spark = get_spark()
    root = args.input.rstrip("/")
    if args.format == "json":
        inputs = {n: IO.read_feed_json(spark, f"{root}/{n}", IO.FEED_SCHEMAS[n]) for n in INPUTS}
    else:
        inputs = {n: spark.read.parquet(f"{root}/{n}") for n in INPUTS}
    previous = None
    archive = f"{args.output.rstrip('/')}/from_providers"
    snaps = IO.read_if_there(spark, archive)
    if snaps is not None:
        last = (snaps.filter((F.col("mode") == args.mode) & (F.col("snapshot_date") != args.date))
                     .agg(F.max("snapshot_date")).first()[0])
        if last is not None:
            previous = IO.snapshot_scan(spark, archive).filter(
                (F.col("mode") == args.mode) & (F.col("snapshot_date") == last))
    res = run_sync(inputs, args.output, args.mode, args.date, previous=previous, force=args.force)
    res.report.show(truncate=False)
    res.sources.show(truncate=False)
    print("published" if res.published else "unchanged; nothing published")


if __name__ == "__main__":
    main()
