"""Feed assembly jobs: landed raw feed tables -> typed place rows.

Raw inputs are landed tables (parquet/JSON/CSV read with explicit schemas);
fetching them over HTTP is outside this library.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placekit.functions.names import strip_suffix
from placekit.functions.regions import state_from_json, state_from_text
from placekit.functions.text import utrim

# Constants of the place rows built by the feed jobs.
PAYMENT_METHOD = "gift card"
SERVICE_FEE_BP = 150                     # basis points subtracted from feed B discounts
INSTANT_PHRASE = "(instant delivery)"
FIXED_PRICE_TYPES = ["Fixed", "Option"]
RANGE_PRICE_TYPE = "Range"
# Offers blocked per brand id (brand id -> phrases contained in the offer name).
OFFER_BLOCKLIST = {"174": ["Xbox Live", "Xbox Game Pass"]}
BOOLEAN_TRUE = ["TRUE", "YES", "1"]
BOOLEAN_FALSE = ["FALSE", "NO", "0"]
KIOSK_TYPES = ("Buy and Sell", "Sell Only", "Buy Only")


def _empty(c: Column) -> Column:
    return c.isNull() | (c == "")


class BrandRegistry(NamedTuple):
    enabled: DataFrame
    disabled: DataFrame


def feed_a_brand_registry(brands: DataFrame) -> BrandRegistry:
    """Split brand rows on ``enabled``; per side one row per id, last row wins."""
    def last(df):
        cols = [c for c in df.columns if c != "id"]
        return (df.groupBy("id").agg(F.max_by(F.struct(*cols), "seq").alias("r"))
                  .select("id", "r.*"))
    on = F.col("enabled") == True  # noqa: E712
    return BrandRegistry(last(brands.filter(on)), last(brands.filter(~on | F.col("enabled").isNull())))


def place_type_a(brand_type: Column, address1: Column) -> Column:
    """physical -> physical; online with a street address -> physical; online -> online."""
    return (F.when(brand_type == "physical", F.lit("physical"))
             .when((brand_type == "online") & ~address1.eqNullSafe(F.lit("online")), F.lit("physical"))
             .when(brand_type == "online", F.lit("online")))


def valid_location_a(ptype: Column, address1: Column, address2: Column, lat: Column, lon: Column) -> Column:
    """Online rows are valid; others need an address or a non-zero coordinate
    (a missing coordinate counts as non-zero)."""
    return (F.when(ptype.isNull(), F.lit(False))
             .when(ptype == "online", F.lit(True))
             .otherwise(~_empty(address1) | ~_empty(address2)
                        | ~lat.eqNullSafe(F.lit(0.0)) | ~lon.eqNullSafe(F.lit(0.0))))


# Weekday field names of feed A locations -> place columns.
WEEKDAYS = [("Monday", "mon"), ("Tuesday", "tue"), ("Wednesday", "wed"), ("Thursday", "thu"),
            ("Friday", "fri"), ("Saturday", "sat"), ("Sunday", "sun")]
# Optional brand fields of feed A -> place columns (null when the feed lacks them).
BRAND_A_OPTIONAL = {"cardImageUrl": "coverImage", "deeplink": "deeplink"}


def _opt(df: DataFrame, c: str, alias: str) -> Column:
    return (F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(alias)


def _a_candidates(enabled: DataFrame, locations: DataFrame) -> DataFrame:
    b = enabled.select(F.col("id").alias("_bid"), F.col("name").alias("_bname"),
                       F.col("type").alias("_btype"), F.col("savingsPercentage").alias("_bsav"),
                       F.col("logoUrl").alias("_blogo"), F.col("website").alias("_bweb"),
                       F.col("redeemType").alias("_bredeem"), F.col("denominationsType").alias("_bdenom"),
                       *[_opt(enabled, c, "_b_" + c) for c in BRAND_A_OPTIONAL])
    j = locations.join(b, locations.merchantId == b._bid)
    ptype = place_type_a(F.col("_btype"), F.col("address1"))
    return (j.withColumn("type", ptype)
             .withColumn("_valid", valid_location_a(F.col("type"), F.col("address1"), F.col("address2"),
                                                    F.col("latitude"), F.col("longitude"))))


def feed_a_places(enabled: DataFrame, locations: DataFrame, source: str = "A") -> DataFrame:
    """Locations joined to enabled brands -> place rows (valid rows with a
    name and a real address only)."""
    c = _a_candidates(enabled, locations)
    ok = (F.col("_valid") & ~_empty(F.col("_bname"))
          & ~F.coalesce(F.col("address1").contains("Address 1"), F.lit(False)))
    return c.filter(ok).select(
        F.col("id").alias("row_id"), F.col("_bid").alias("merchantId"), F.col("_bname").alias("name"),
        "address1", "address2", "latitude", "longitude", F.col("_bweb").alias("website"),
        F.coalesce(state_from_json(F.col("territory")), F.lit("")).alias("territory"), "city",
        F.lit(source).alias("source"), "sourceId", F.col("_blogo").alias("logoLocation"), "type",
        F.col("_bredeem").alias("redeemType"), F.col("_bsav").alias("savingsPercentage"),
        F.col("_bdenom").alias("denominationsType"), F.lit(True).alias("active"),
        F.lit(PAYMENT_METHOD).alias("paymentMethod"),
        *[F.col("_b_" + c).alias(t) for c, t in BRAND_A_OPTIONAL.items()],
        _opt(locations, "postalCode", "address3"), _opt(locations, "phone", "phone"),
        *[_opt(locations, f"{day}{oc}", f"{short}{oc}") for day, short in WEEKDAYS for oc in ("Open", "Close")],
        *([F.col("seq")] if "seq" in locations.columns else []))


def feed_a_orphan_locations(enabled: DataFrame, locations: DataFrame) -> DataFrame:
    """Distinct location merchant ids with no enabled brand."""
    return (locations.select("merchantId").distinct()
                     .join(enabled.select(F.col("id").alias("merchantId")), "merchantId", "left_anti"))


def feed_a_rejects(enabled: DataFrame, locations: DataFrame) -> DataFrame:
    c = _a_candidates(enabled, locations)
    bad_name = _empty(F.col("_bname")) | F.coalesce(F.col("address1").contains("Address 1"), F.lit(False))
    reason = (F.when(~F.col("_valid"), F.lit("invalid_location"))
               .when(bad_name, F.lit("invalid_name_or_address")))
    return c.select("id", "merchantId", reason.alias("reason")).filter(F.col("reason").isNotNull())


def feed_a_counted_locations(enabled: DataFrame, locations: DataFrame) -> DataFrame:
    """Valid candidate rows before the name/address check: what the report counts."""
    return _a_candidates(enabled, locations).filter("_valid")


# ---------------------------------------------------------------- feed B

def offer_blocklist(offers: DataFrame, blocklist: dict | None = None) -> DataFrame:
    """Drop offers whose brand is listed and whose name contains a listed phrase."""
    blocklist = OFFER_BLOCKLIST if blocklist is None else blocklist
    rows = [(b, p) for b, ps in blocklist.items() for p in ps]
    if not rows:
        return offers
    spark = offers.sparkSession
    block = spark.createDataFrame(rows, "_bb string, _bp string")
    # the blocklist is a fixed configuration table of a few rows
    cond = (offers.brand_id == block._bb) & offers.name.contains(block._bp)
    return offers.join(F.broadcast(block), cond, "left_anti")


def offer_selection(offers: DataFrame) -> DataFrame:
    """One representative offer per brand (by arrival order ``seq``, a number
    that is unique in its brand): first instant-delivery offer with the max
    discount over instant and fixed offers; else the first non-fixed offer;
    else the first offer with the max discount.  Brands without offers
    produce no row.

    Fixed-width aggregates find the chosen offer's number (a hash aggregate,
    partial on the map side); one join brings its other columns.
    """
    name, pt, disc = F.col("name"), F.col("price_type"), F.col("discount_percentage")
    instant = F.lower(name).contains(INSTANT_PHRASE)
    fixed_extra = (pt == "Fixed") & ~name.contains(INSTANT_PHRASE)
    is_fixed = F.coalesce(pt.isin(*FIXED_PRICE_TYPES), F.lit(False))
    per = offers.groupBy(F.col("brand_id").alias("_brand")).agg(
        F.min(F.when(instant, F.col("seq"))).alias("_inst"),
        F.max(F.when(instant | fixed_extra, disc)).alias("_inst_max"),
        F.min(F.when(~is_fixed, F.col("seq"))).alias("_range"),
        F.min("seq").alias("_first"), F.max(disc).alias("_max"), F.count("*").alias("offers"))
    per = per.withColumn("_seq", F.coalesce("_inst", "_range", "_first"))
    best = (F.when(F.col("_inst").isNotNull(), F.col("_inst_max"))
             .when(F.col("_range").isNotNull(), disc).otherwise(F.col("_max")))
    return offers.join(per, (F.col("brand_id") == F.col("_brand")) & (F.col("seq") == F.col("_seq"))).select(
        "brand_id", "name", "price_type", best.alias("discount_percentage"), "image", "offers")


def offer_savings(selected: DataFrame) -> DataFrame:
    """Savings in basis points after the service fee; denomination type."""
    sav = F.col("discount_percentage") * F.lit(100.0)
    return (selected.withColumn("savingsPercentage", sav.cast("int") - F.lit(SERVICE_FEE_BP))
                    .withColumn("denominationsType",
                                F.when(F.col("price_type") == RANGE_PRICE_TYPE, F.lit("min-max"))
                                 .otherwise(F.lit("fixed"))))


class FeedB(NamedTuple):
    places: DataFrame
    rejected_brands: DataFrame
    rejected_locations: DataFrame


def _b_location_valid() -> Column:
    """Valid when street and number are both non-empty, or a coordinate is non-zero."""
    some = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    nonzero = lambda c: F.coalesce(F.col(c) != 0.0, F.lit(False))
    return ((some("loc_street") & some("loc_street_number"))
            | nonzero("loc_latitude") | nonzero("loc_longitude"))


def feed_b(brands: DataFrame, offers: DataFrame, locations: DataFrame, country: str = "US",
           source: str = "B", blocklist: dict | None = None) -> FeedB:
    """Per accepted brand one online row plus one row per valid location in
    ``country``; brands with an empty name, without offers or with negative
    savings are rejected.  A null never passes a check, so every location is
    either a place or a reject."""
    sel = (offer_savings(offer_selection(offer_blocklist(offers, blocklist)))
           .withColumnRenamed("name", "offer_name"))
    br = brands.join(sel, brands.id == sel.brand_id, "left").withColumn("_pname", strip_suffix(brands.name))
    reject = (F.when(_empty(F.col("_pname")), F.lit("empty_name"))
               .when(F.col("brand_id").isNull(), F.lit("no_offers"))
               .when(F.col("savingsPercentage") < 0, F.lit("negative_discount")))
    br = br.withColumn("_reject", reject)
    rejected = br.filter(F.col("_reject").isNotNull()).select(
        F.col("id").alias("brand_id"), F.col("_pname").alias("name"), "savingsPercentage",
        F.col("_reject").alias("reason"))
    brand_seq = [F.col("seq").alias("_brand_seq")] if "seq" in brands.columns else []
    ok = br.filter(F.col("_reject").isNull()).select(
        *brand_seq,
        F.col("id").alias("merchantId"), F.col("_pname").alias("name"),
        F.lit(source).alias("source"), F.col("id").alias("sourceId"),
        F.col("image").alias("logoLocation"), F.col("image").alias("coverImage"),
        F.lit("barcode").alias("redeemType"), "savingsPercentage", "denominationsType",
        F.lit(True).alias("active"), F.lit(PAYMENT_METHOD).alias("paymentMethod"))
    online = ok.select(F.concat(F.lit("o:"), F.col("merchantId")).alias("row_id"), "*",
                       F.lit("online").alias("address1"), F.lit(None).cast("double").alias("latitude"),
                       F.lit(None).cast("double").alias("longitude"), F.lit("").alias("territory"),
                       F.lit(None).cast("string").alias("city"), F.lit(None).cast("string").alias("website"),
                       F.lit("online").alias("type"))
    loc = locations.select(*[F.col(c).alias("loc_" + c) for c in locations.columns])
    loc = loc.join(ok, loc.loc_brand_id == ok.merchantId)
    here = F.coalesce(F.col("loc_country") == F.lit(country), F.lit(False))
    good = _b_location_valid() & here
    addr = (F.when(F.col("loc_street_number") != "Unknown",
                   F.concat(F.col("loc_street_number"), F.lit(" "), F.col("loc_street")))
             .otherwise(F.col("loc_street")))
    physical = loc.filter(good).select(
        F.concat(F.lit("l:"), F.col("loc_name")).alias("row_id"), *ok.columns,
        addr.alias("address1"), F.col("loc_latitude").alias("latitude"),
        F.col("loc_longitude").alias("longitude"), state_from_text(F.col("loc_state")).alias("territory"),
        F.col("loc_city").alias("city"), F.col("loc_website").alias("website"),
        F.lit("physical").alias("type"),
        *([F.col("loc_seq").alias("_loc_seq")] if "seq" in locations.columns else []))
    bad = loc.filter(~good).select(
        F.col("loc_name").alias("name"), F.col("loc_brand_id").alias("brand_id"),
        F.when(~here, F.lit("other_country"))
         .otherwise(F.lit("invalid_location")).alias("reason"),
        F.col("loc_seq").alias("seq") if "seq" in locations.columns else F.lit(0).alias("seq"))
    # keyed by location name, the last one wins
    bad = (bad.groupBy("name").agg(F.max_by(F.struct("brand_id", "reason"), "seq").alias("r"))
              .select("name", "r.*"))
    places = online.unionByName(physical, allowMissingColumns=True)
    if brand_seq and "seq" in locations.columns:
        # arrival order: each brand's online row, then its locations in order;
        # an order-preserving decimal key, no shuffle needed
        scale = F.lit(str(10 ** 19)).cast("decimal(38,0)")
        loc = F.coalesce(F.col("_loc_seq").cast("decimal(38,0)") + F.lit(1), F.lit(0).cast("decimal(38,0)"))
        places = (places.withColumn("seq", (F.col("_brand_seq").cast("decimal(38,0)") * scale + loc)
                                    .cast("decimal(38,0)"))
                        .drop("_loc_seq", "_brand_seq"))
    else:
        places = places.drop("_loc_seq", "_brand_seq")
    return FeedB(places, rejected, bad)


# ---------------------------------------------------------------- feed C (curated sheet)

def feed_c_places(sheet: DataFrame, source: str = "C") -> DataFrame:
    """Positional sheet rows -> place rows.  Empty cells are null; rows whose
    cells are all empty are skipped."""
    from placekit.sources.fixtures import SHEET_COLUMNS
    cell = {c: F.when(F.col(c) == "", F.lit(None).cast("string")).otherwise(F.col(c)) for c in SHEET_COLUMNS}
    nonempty = None
    for c in SHEET_COLUMNS:
        e = F.coalesce(F.col(c) != "", F.lit(False))
        nonempty = e if nonempty is None else nonempty | e
    mid, sid = cell["MERCHANT_ID"], cell["SOURCE_ID"]
    mid_num, sid_num = mid.try_cast("double"), sid.try_cast("double")
    up = F.upper(cell["ACTIVE"])
    active = F.when(up.isin(*BOOLEAN_TRUE), F.lit(True)).when(up.isin(*BOOLEAN_FALSE), F.lit(False))
    return sheet.filter(nonempty).select(
        "row_key",
        cell["PLUS_CODE"].alias("plusCode"), utrim(cell["PAYMENT_METHOD"]).alias("paymentMethod"),
        F.coalesce(mid_num.try_cast("bigint").cast("string"), mid).alias("merchantId"),
        active.alias("active"), cell["NAME"].alias("name"),
        cell["ADDRESS1"].alias("address1"), cell["ADDRESS2"].alias("address2"),
        cell["ADDRESS3"].alias("address3"), cell["ADDRESS4"].alias("address4"),
        cell["LATITUDE"].try_cast("double").alias("latitude"),
        cell["LONGITUDE"].try_cast("double").alias("longitude"),
        cell["WEBSITE"].alias("website"), cell["PHONE"].alias("phone"),
        utrim(cell["TERRITORY"]).alias("territory"), F.lit(source).alias("source"),
        F.coalesce(sid_num.try_cast("int").cast("string"), sid, F.lit("0")).alias("sourceId"),
        cell["LOGO_LOCATION"].alias("logoLocation"), cell["GOOGLE_MAPS"].alias("googleMaps"),
        F.lit(None).cast("string").alias("coverImage"), utrim(cell["TYPE"]).alias("type"),
        F.lit("none").alias("redeemType"), cell["INSTAGRAM"].alias("instagram"),
        cell["TWITTER"].alias("twitter"), cell["DELIVERY"].alias("delivery"),
        *[cell[f"{short.upper()}_{oc.upper()}"].alias(f"{short}{oc}")
          for _, short in WEEKDAYS for oc in ("Open", "Close")],
        *([F.col("seq")] if "seq" in sheet.columns else []))


def feed_c_stats(places: DataFrame) -> DataFrame:
    return places.agg(F.count("*").alias("rows"), F.count_distinct("name").alias("names"))


# ---------------------------------------------------------------- kiosks

def kiosk_places(kiosks: DataFrame, source: str = "kiosk") -> DataFrame:
    """Kiosk rows -> 21-column kiosk place rows."""
    buy, sell = F.col("buy") == 1, F.col("sell") == 1
    ktype = (F.when(buy & sell, F.lit(KIOSK_TYPES[0])).when(sell, F.lit(KIOSK_TYPES[1]))
              .otherwise(F.lit(KIOSK_TYPES[2])))
    state = state_from_text(F.col("state"))
    return kiosks.select(
        F.lit("").alias("postcode"), F.col("operator").alias("manufacturer"), F.col("id").alias("kiosk_id"),
        F.lit(True).alias("active"), F.col("location").alias("name"), F.col("address").alias("address1"),
        F.lit("").alias("address2"), F.lit("").alias("address3"), F.lit("").alias("address4"),
        F.coalesce("lat", F.lit(0.0)).alias("latitude"), F.coalesce("lng", F.lit(0.0)).alias("longitude"),
        F.col("url").alias("website"), F.col("operator_phone").alias("phone"),
        F.when(_empty(state), F.col("city")).otherwise(state).alias("territory"), "city",
        F.lit(source).alias("source"), F.col("id").cast("string").alias("sourceId"),
        F.col("operator_logo").alias("logoLocation"), F.lit("").alias("googleMaps"),
        F.lit("").alias("coverImage"), ktype.alias("type"))
