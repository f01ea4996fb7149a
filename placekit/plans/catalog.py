"""Registry of the named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the landed tables (directly or through the derived feeds) so
its work grows with them.  Doubles are rounded to 6 dp for cross-engine
comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placekit.operators import match as M
from placekit.operators.geo_join import radius_join
from placekit.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r6(c) -> "F.Column":
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def pair_out(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "b_row_id", "a_row_id", r6("distance_miles").alias("distance_miles"),
        r6("name_similarity").alias("name_similarity"),
        r6("address_similarity").alias("address_similarity"),
        r6("confidence").alias("confidence"), "reasons", "city_match", "state_match",
        "geographic_warning", "match_stage")


def feeds(spark: SparkSession, sf_dir: str):
    return fx.place_a(spark, sf_dir), fx.place_b(spark, sf_dir)


@query("geo_radius_join")
def q_geo_radius_join(spark, sf_dir):
    a, b = feeds(spark, sf_dir)
    a = a.select(F.col("row_id").alias("a_row_id"), F.col("latitude").alias("a_lat"),
                 F.col("longitude").alias("a_lon"))
    b = b.select(F.col("row_id").alias("b_row_id"), F.col("latitude").alias("b_lat"),
                 F.col("longitude").alias("b_lon"))
    pairs = radius_join(a, b, 0.2, ("a_lat", "a_lon"), ("b_lat", "b_lon"))
    return pairs.select("a_row_id", "b_row_id", r6("distance_miles").alias("distance_miles"))


@query("coordinate_cell_join")
def q_coordinate_cell_join(spark, sf_dir):
    a, b = feeds(spark, sf_dir)
    pairs = M.coordinate_cell_pairs(a, b, M.PRODUCTION)
    return pairs.select("b_row_id", "a_row_id", r6("distance_miles").alias("distance_miles"),
                        "match_type", "coordinate_precision")


@query("match_exact_stage")
def q_match_exact_stage(spark, sf_dir):
    a, b = feeds(spark, sf_dir)
    return pair_out(M.exact_stage(a, b, M.PRODUCTION))


@query("match_proximity_stage")
def q_match_proximity_stage(spark, sf_dir):
    a, b = feeds(spark, sf_dir)
    exact = M.exact_stage(a, b, M.PRODUCTION)
    return pair_out(M.proximity_stage(a, b, exact, M.PRODUCTION))


def _match_query(params):
    def run(spark, sf_dir):
        a, b = feeds(spark, sf_dir)
        return pair_out(M.match_places(a, b, params))
    return run


QUERIES["match_places"] = _match_query(M.PRODUCTION)
QUERIES["match_places_geographic"] = _match_query(M.GEOGRAPHIC)
QUERIES["match_places_coords_only"] = _match_query(M.COORDS_ONLY)
QUERIES["match_places_best_only"] = _match_query(M.PRODUCTION.with_(show_all_matches=False))


# ------------------------------------------------------------ consolidation

from placekit.operators import consolidate as C  # noqa: E402


def combined(spark, sf_dir):
    a, b = feeds(spark, sf_dir)
    return a, b, C.combine_feeds([a, b], M.PRODUCTION)


@query("standardize_names")
def q_standardize_names(spark, sf_dir):
    a, b = feeds(spark, sf_dir)
    u = a.select("source", "row_id", "name").unionByName(b.select("source", "row_id", "name"))
    return C.standardize_names(u).select("source", "row_id", "name_std", "name_key")


@query("brand_dictionary")
def q_brand_dictionary(spark, sf_dir):
    return combined(spark, sf_dir)[2].dictionary.select("name_key", "canon_name", "canon_id", "first_logo")


@query("merged_places")
def q_merged_places(spark, sf_dir):
    return combined(spark, sf_dir)[2].merged.select(
        "uid", "merchantId", "name", "savingsPercentage", "plusCode", "logoLocation")


def _unmatched_query(side):
    def run(spark, sf_dir):
        r = combined(spark, sf_dir)[2]
        return (r.unmatched_a if side == "a" else r.unmatched_b).select(
            "uid", "merchantId", "name", "logoLocation", "savingsPercentage")
    return run


QUERIES["unmatched_a"] = _unmatched_query("a")
QUERIES["unmatched_b"] = _unmatched_query("b")


@query("online_fold")
def q_online_fold(spark, sf_dir):
    return combined(spark, sf_dir)[2].folds.select("b_row_id", F.col("j").cast("bigint").alias("j"), "k",
                                                   "target_uid", "link_merchantId")


@query("combine_feeds")
def q_combine_feeds(spark, sf_dir):
    p = combined(spark, sf_dir)[2].places
    return p.select("uid", "merchantId", "name", "address1", r6("latitude").alias("latitude"),
                    r6("longitude").alias("longitude"), "type", "savingsPercentage", "logoLocation",
                    "source", "sourceId", "plusCode")


@query("provider_links")
def q_provider_links(spark, sf_dir):
    return combined(spark, sf_dir)[2].links


@query("dedupe_places")
def q_dedupe_places(spark, sf_dir):
    r = combined(spark, sf_dir)[2]
    return C.dedupe_places(r.places, r.dictionary).select("uid", "dedupe_key")


@query("dropped_duplicates")
def q_dropped_duplicates(spark, sf_dir):
    r = combined(spark, sf_dir)[2]
    return C.dropped_duplicates(r.places, r.dictionary).select("uid", "dedupe_key")


# ------------------------------------------------------------ reports

from placekit.operators import report as R  # noqa: E402


def _desktop(spark, sf_dir):
    from placekit.session import materialize
    a, b = feeds(spark, sf_dir)
    a, b = R.valid_coordinates(a), R.valid_coordinates(b)
    return a, b, materialize(M.match_places(a, b, M.DESKTOP))


def _report_out(rep):
    return rep.select("match_type", r6("confidence_score").alias("confidence_score"),
                      "b_name", "b_address", "b_city", "b_state", r6("b_lat").alias("b_lat"),
                      r6("b_lon").alias("b_lon"), "a_name", "a_address", "a_city", "a_territory",
                      r6("a_lat").alias("a_lat"), r6("a_lon").alias("a_lon"),
                      r6("distance_miles").alias("distance_miles"),
                      r6("name_similarity").alias("name_similarity"),
                      r6("address_similarity").alias("address_similarity"),
                      "city_match", "state_match", "zip_match", "match_reasons", "geographic_warning",
                      "b_row_id", "a_row_id")


@query("comparison_report")
def q_comparison_report(spark, sf_dir):
    a, b, m = _desktop(spark, sf_dir)
    return _report_out(R.comparison_report(a, b, m))


@query("match_tier_summary")
def q_match_tier_summary(spark, sf_dir):
    a, b, m = _desktop(spark, sf_dir)
    return R.match_tier_summary(R.comparison_report(a, b, m))


@query("top_matches_sample")
def q_top_matches_sample(spark, sf_dir):
    a, b, m = _desktop(spark, sf_dir)
    t = R.top_matches_sample(a, b, m)
    return t.select("b_name", "a_name", r6("distance_miles").alias("distance_miles"),
                    r6("confidence").alias("confidence"), "b_row_id", "a_row_id")


@query("valid_coordinate_profile")
def q_valid_coordinate_profile(spark, sf_dir):
    a, b = feeds(spark, sf_dir)
    return R.valid_coordinate_profile({"A": a, "B": b})


def _dups(spark, sf_dir):
    a, b, r = combined(spark, sf_dir)
    return R.duplicates_table(a, b, r.matches)


def _r6_all(df):
    return df.select(*[r6(c).alias(c) if dict(df.dtypes)[c] == "double" else F.col(c) for c in df.columns])


@query("duplicates_table")
def q_duplicates_table(spark, sf_dir):
    return _r6_all(_dups(spark, sf_dir))


@query("mismatched_duplicate_names")
def q_mismatched_duplicate_names(spark, sf_dir):
    return _r6_all(R.mismatched_duplicate_names(_dups(spark, sf_dir)))


@query("mismatched_duplicate_streets")
def q_mismatched_duplicate_streets(spark, sf_dir):
    return _r6_all(R.mismatched_duplicate_names(_dups(spark, sf_dir), with_streets=True))


@query("sync_report")
def q_sync_report(spark, sf_dir):
    r = combined(spark, sf_dir)[2]
    return R.sync_report(r.places, r.links, r.matches)


def _provider_archive(spark, sf_dir):
    a, b = feeds(spark, sf_dir)
    return R.archive(a).unionByName(R.archive(b))


def _final_archive(spark, sf_dir):
    return R.archive(combined(spark, sf_dir)[2].places)


@query("provider_archive")
def q_provider_archive(spark, sf_dir):
    return _r6_all(_provider_archive(spark, sf_dir))


@query("final_archive")
def q_final_archive(spark, sf_dir):
    return _r6_all(_final_archive(spark, sf_dir))


@query("count_source_places")
def q_count_source_places(spark, sf_dir):
    return _provider_archive(spark, sf_dir).filter(F.col("source") == "A").agg(F.count("*").alias("n"))


@query("online_offers_by_savings")
def q_online_offers_by_savings(spark, sf_dir):
    f = _final_archive(spark, sf_dir)
    return (f.filter((F.col("source") == "B") & (F.col("address1") == "online"))
             .select("name", "savingsPercentage").orderBy("savingsPercentage"))


@query("distinct_source_names")
def q_distinct_source_names(spark, sf_dir):
    return (_provider_archive(spark, sf_dir).filter(F.col("name").isNotNull())
            .select("source", "name").distinct())


# ------------------------------------------------------------ snapshot changes

from placekit.operators import changes as CH  # noqa: E402

SNAPSHOT_TODAY = "1998-08-02"


def _tag(df, **tags):
    return df.select(*[F.lit(v).alias(k) for k, v in tags.items()], *df.columns)


@query("keyed_diff")
def q_keyed_diff(spark, sf_dir):
    prev, curr = fx.brand_names(spark, sf_dir, False), fx.brand_names(spark, sf_dir, True)
    d = CH.keyed_diff(prev, curr, F.lower(F.col("name")))
    return _tag(d.new, kind="new").unionByName(_tag(d.removed, kind="removed"))


@query("new_removed_brands")
def q_new_removed_brands(spark, sf_dir):
    prev, curr = fx.brand_names(spark, sf_dir, False), fx.brand_names(spark, sf_dir, True)
    out = None
    for rule, normalized in (("verbatim", False), ("normalized", True)):
        d = CH.new_removed_brands(prev, curr, normalized)
        part = _tag(d.new, rule=rule, kind="new").unionByName(_tag(d.removed, rule=rule, kind="removed"))
        out = part if out is None else out.unionByName(part)
    return out


@query("diff_by_strategy")
def q_diff_by_strategy(spark, sf_dir):
    prev, curr = fx.place_snapshot(spark, sf_dir, False), fx.place_snapshot(spark, sf_dir, True)
    return CH.diff_by_strategies(prev, curr).select("strategy", "kind", "row_id")


@query("latest_snapshot")
def q_latest_snapshot(spark, sf_dir):
    s = CH.latest_snapshot(fx.snapshot_names(spark, sf_dir), SNAPSHOT_TODAY)
    return s.select("mode", "name", F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot_date"))


@query("content_fingerprint")
def q_content_fingerprint(spark, sf_dir):
    links = combined(spark, sf_dir)[2].links
    return CH.content_fingerprint(links).select(
        "row_count", "hash_xor", F.col("hash_sum").cast("string").alias("hash_sum"))


# ------------------------------------------------------------ feed assembly

from placekit.sources import feeds as FD  # noqa: E402


def _registry(spark, sf_dir):
    return FD.feed_a_brand_registry(fx.raw_brand_a(spark, sf_dir))


@query("feed_a_brand_registry")
def q_feed_a_brand_registry(spark, sf_dir):
    r = _registry(spark, sf_dir)
    cols = ["id", "name", "type", "savingsPercentage", "seq", "enabled"]
    return _tag(r.enabled.select(*cols), status="enabled").unionByName(
        _tag(r.disabled.select(*cols), status="disabled"))


@query("feed_a_places")
def q_feed_a_places(spark, sf_dir):
    p = FD.feed_a_places(_registry(spark, sf_dir).enabled, fx.raw_location_a(spark, sf_dir))
    return p.select("row_id", "merchantId", "name", "address1", r6("latitude").alias("latitude"),
                    r6("longitude").alias("longitude"), "territory", "city", "type", "savingsPercentage",
                    "logoLocation", "source", "sourceId")


@query("feed_a_orphan_locations")
def q_feed_a_orphan_locations(spark, sf_dir):
    return FD.feed_a_orphan_locations(_registry(spark, sf_dir).enabled, fx.raw_location_a(spark, sf_dir))


@query("feed_a_rejects")
def q_feed_a_rejects(spark, sf_dir):
    return FD.feed_a_rejects(_registry(spark, sf_dir).enabled, fx.raw_location_a(spark, sf_dir))


def _offers(spark, sf_dir):
    return FD.offer_blocklist(fx.raw_offer_b(spark, sf_dir), fx.TEST_OFFER_BLOCKLIST)


@query("offer_blocklist")
def q_offer_blocklist(spark, sf_dir):
    return _offers(spark, sf_dir).select("brand_id", "l_orderkey", "l_linenumber", "l_suppkey", "name")


@query("offer_selection")
def q_offer_selection(spark, sf_dir):
    s = FD.offer_selection(_offers(spark, sf_dir))
    return s.select("brand_id", "name", "price_type", r6("discount_percentage").alias("discount_percentage"),
                    "image", "offers")


@query("offer_savings")
def q_offer_savings(spark, sf_dir):
    s = FD.offer_savings(FD.offer_selection(_offers(spark, sf_dir)))
    return s.select("brand_id", "savingsPercentage", "denominationsType")


def _feed_b(spark, sf_dir):
    return FD.feed_b(fx.raw_brand_b(spark, sf_dir), fx.raw_offer_b(spark, sf_dir),
                     fx.raw_location_b(spark, sf_dir), blocklist=fx.TEST_OFFER_BLOCKLIST)


@query("feed_b_places")
def q_feed_b_places(spark, sf_dir):
    p = _feed_b(spark, sf_dir).places
    return p.select("row_id", "merchantId", "name", "address1", r6("latitude").alias("latitude"),
                    r6("longitude").alias("longitude"), "territory", "city", "type", "savingsPercentage",
                    "logoLocation", "denominationsType", "website")


@query("feed_b_rejects")
def q_feed_b_rejects(spark, sf_dir):
    return _feed_b(spark, sf_dir).rejected_locations


@query("feed_b_rejected_brands")
def q_feed_b_rejected_brands(spark, sf_dir):
    return _feed_b(spark, sf_dir).rejected_brands


def _feed_c(spark, sf_dir):
    return FD.feed_c_places(fx.raw_sheet_c(spark, sf_dir))


@query("feed_c_places")
def q_feed_c_places(spark, sf_dir):
    return _feed_c(spark, sf_dir).select("row_key", "merchantId", "active", "name", "address1",
                                         r6("latitude").alias("latitude"), r6("longitude").alias("longitude"),
                                         "territory", "sourceId", "type", "paymentMethod", "logoLocation",
                                         "redeemType", "source")


@query("feed_c_stats")
def q_feed_c_stats(spark, sf_dir):
    return FD.feed_c_stats(_feed_c(spark, sf_dir))


@query("kiosk_places")
def q_kiosk_places(spark, sf_dir):
    return _r6_all(FD.kiosk_places(fx.raw_kiosk(spark, sf_dir)))


# ------------------------------------------------------------ standardization

from placekit.operators import standardize as ST  # noqa: E402


@query("standardize_states")
def q_standardize_states(spark, sf_dir):
    loc = fx.raw_location_a(spark, sf_dir).select("id", "territory")
    return ST.standardize_states(loc)


@query("street_component")
def q_street_component(spark, sf_dir):
    return ST.with_street_component(feeds(spark, sf_dir)[1].select("row_id", "address1"))


@query("clean_business_names")
def q_clean_business_names(spark, sf_dir):
    return ST.clean_business_names(feeds(spark, sf_dir)[1].select("row_id", "name"))


@query("standardize_cities")
def q_standardize_cities(spark, sf_dir):
    return ST.standardize_cities(feeds(spark, sf_dir)[1].select("row_id", "city"))


@query("gazetteer_enrich")
def q_gazetteer_enrich(spark, sf_dir):
    b = feeds(spark, sf_dir)[1].select("row_id", "latitude", "longitude")
    return ST.gazetteer_enrich(b, fx.gazetteer(spark, sf_dir)).select(
        "row_id", "corrected_city", "corrected_state")


@query("match_places_blended")
def q_match_places_blended(spark, sf_dir):
    a, b = feeds(spark, sf_dir)
    a, b = R.valid_coordinates(a), R.valid_coordinates(b)
    return pair_out(M.match_places(a, b, M.BLENDED))


def _source_report(spark, sf_dir):
    from placekit.plans.sync import source_summary
    brands_a, brands_b = fx.raw_brand_a(spark, sf_dir), fx.raw_brand_b(spark, sf_dir)
    return source_summary(_registry(spark, sf_dir), brands_a, fx.raw_location_a(spark, sf_dir), brands_b,
                          _feed_b(spark, sf_dir), fx.previous_brand_names(spark, sf_dir, "A"),
                          fx.previous_brand_names(spark, sf_dir, "B"))


@query("source_report")
def q_source_report(spark, sf_dir):
    return _source_report(spark, sf_dir)[0]


@query("source_report_lists")
def q_source_report_lists(spark, sf_dir):
    return _source_report(spark, sf_dir)[1]


@query("explore_table")
def q_explore_table(spark, sf_dir):
    from placekit.sources.io import explore_table
    c = _feed_c(spark, sf_dir)
    p = combined(spark, sf_dir)[2].places
    return explore_table(c, p).select("part", "merchantId", "active", "name", "address1",
                                      r6("latitude").alias("latitude"), r6("longitude").alias("longitude"),
                                      "source", "sourceId", "type", "redeemType", "savingsPercentage",
                                      "plusCode", "logoLocation")


# ------------------------------------------------------------ sources and sinks round trips

def _scratch(spark, name):
    import uuid
    from placekit.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/placekit-io/{name}-{uuid.uuid4().hex}"


@query("csv_round_trip")
def q_csv_round_trip(spark, sf_dir):
    """Export the combined places as place CSV and scan them back."""
    from placekit.sources import io as IO
    path = _scratch(spark, "csv")
    IO.csv_export(combined(spark, sf_dir)[2].places, path)
    back = IO.csv_place_scan(spark, path)
    return back.select("merchantId", "name", "address1", r6("latitude").alias("latitude"),
                       r6("longitude").alias("longitude"), "type", "savingsPercentage", "logoLocation",
                       "source", "sourceId", "plusCode", "active", "redeemType")


@query("snapshot_scan")
def q_snapshot_scan(spark, sf_dir):
    """Publish the provider archive, then read back one source's rows."""
    from placekit.sources import io as IO
    root = _scratch(spark, "publish")
    IO.publish_tables({"from_providers": _provider_archive(spark, sf_dir)}, root, "PRODUCTION", "2024-01-01")
    prev = IO.snapshot_scan(spark, f"{root}/from_providers", source="A")
    return _r6_all(prev.drop("mode", "snapshot_date"))


@query("nonempty_guard")
def q_nonempty_guard(spark, sf_dir):
    """A table that passes the non-empty guard comes through unchanged."""
    from placekit.sources import io as IO
    return _r6_all(IO.nonempty_guard(_provider_archive(spark, sf_dir), "provider_archive"))


@query("detect_coordinate_columns")
def q_detect_coordinate_columns(spark, sf_dir):
    """The coordinate columns that are found by name, under other names, with their values."""
    b = feeds(spark, sf_dir)[1].select("row_id", F.col("latitude").alias("Latitude"), F.col("longitude").alias("lng"))
    lat, lon = ST.detect_coordinate_columns(b)
    return b.select("row_id", F.lit(lat).alias("lat_column"), F.lit(lon).alias("lon_column"),
                    r6(lat).alias("lat"), r6(lon).alias("lon"))


@query("read_feed_json")
def q_read_feed_json(spark, sf_dir):
    """Land feed A's brand pages as JSON and read them with the feed's schema."""
    from placekit.sources import io as IO
    path = _scratch(spark, "json")
    fx.raw_brand_a(spark, sf_dir).write.json(path)
    return IO.read_feed_json(spark, path, IO.FEED_SCHEMAS["brands_a"]).select(
        "seq", "id", "name", "enabled", "type", "savingsPercentage", "logoUrl", "deeplink")


@query("read_sheet_csv")
def q_read_sheet_csv(spark, sf_dir):
    """Export the curated sheet under another header and read it by position."""
    from placekit.sources import io as IO
    path = _scratch(spark, "sheet")
    sheet = fx.raw_sheet_c(spark, sf_dir).select(*fx.SHEET_COLUMNS)
    (sheet.toDF(*[f"column {i}" for i in range(len(fx.SHEET_COLUMNS))])
          .write.option("header", True).option("quote", '"').option("escape", '"').csv(path))
    return FD.feed_c_places(IO.read_sheet_csv(spark, path)).select(
        "merchantId", "active", "name", "address1", r6("latitude").alias("latitude"),
        r6("longitude").alias("longitude"), "territory", "sourceId", "type", "paymentMethod", "logoLocation")


@query("publish_if_changed")
def q_publish_if_changed(spark, sf_dir):
    """Publish contents A, B, A for one date, then for the next date a table
    whose values moved between two nullable columns: what each date holds."""
    from placekit.sources import io as IO
    root = _scratch(spark, "changed")
    a = _provider_archive(spark, sf_dir).select("source", "sourceId", "name", F.lit(None).cast("string").alias("other"))
    less = a.filter(F.col("source") == "A")
    moved = a.select("source", "sourceId", F.col("other").alias("name"), F.col("name").alias("other"))
    for date, t in (("2024-01-01", a), ("2024-01-01", less), ("2024-01-01", a), ("2024-01-02", moved),
                    ("2024-01-03", moved)):
        IO.publish_if_changed({"places": t}, root, "PRODUCTION", date)
    return spark.read.parquet(f"{root}/places").select(
        "source", "sourceId", "name", "other", F.col("snapshot_date").cast("string").alias("snapshot_date"))


@query("archive_sql")
def q_archive_sql(spark, sf_dir):
    """The archive and the duplicates as SQL views: names that differ, by source and distance of spelling."""
    from placekit.sources import io as IO
    a, b, r = combined(spark, sf_dir)
    IO.register_views({"from_providers": R.archive(a).unionByName(R.archive(b)),
                       "duplicates": R.duplicates_table(a, b, r.matches)}, prefix="archive_")
    return spark.sql("""
        SELECT p.source, count(*) AS places, count(DISTINCT p.name) AS names,
               max((SELECT count(*) FROM archive_duplicates d WHERE d.A_name <> d.B_name)) AS mismatched
        FROM archive_from_providers p GROUP BY p.source""")
