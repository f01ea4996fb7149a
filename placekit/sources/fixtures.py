"""Place feeds derived from the landed tables (see FIXTURES.md).

Every feed is a pure DataFrame function of the source tables, so it scales
with them.  The DuckDB twins used by the correctness check live in
:mod:`placekit.plans.oracle`; both must build identical rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placekit.sources.tables import table

SOURCE_A = "A"
SOURCE_B = "B"

# Latitude shift of feed B physical rows by k % 7: one value per distance tier.
LAT_SHIFTS = [0.0, 0.00003, 0.0002, 0.0006, 0.0011, 0.0025, 0.05]


def _k() -> Column:
    return F.col("k")


def _pick(selector: Column, values: list) -> Column:
    expr = None
    for i, v in enumerate(values):
        v = v if isinstance(v, Column) else F.lit(v)
        expr = F.when(selector == i, v) if expr is None else expr.when(selector == i, v)
    return expr


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One candidate place per customer: key, name, street, coordinates.  Twenty
    customers are places of one brand, so brands and names grow with the data."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    k = F.col("c_custkey")
    return (c.join(p, p.p_partkey == F.floor(k / 20))
             .select(k.alias("k"), F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("nm"),
                     F.concat((F.lit(100) + k % 900).cast("string"), F.lit(" "),
                              F.col("c_mktsegment"), F.lit(" Street")).alias("addr"),
                     (F.lit(25.0) + ((k * 7919) % 240000) / F.lit(10000.0)).alias("lat"),
                     (F.lit(-124.0) + ((k * 104729) % 570000) / F.lit(10000.0)).alias("lon")))


def place_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _k()
    online = k % 10 == 9
    return base(spark, sf_dir).select(
        k.alias("row_id"), k.alias("seq"),
        F.concat(F.lit("A"), (k % 40).cast("string")).alias("merchantId"),
        F.col("nm").alias("name"),
        F.when(online, F.lit("online")).otherwise(F.col("addr")).alias("address1"),
        F.when(online, F.lit(None).cast("double")).otherwise(F.col("lat")).alias("latitude"),
        F.when(online, F.lit(None).cast("double")).otherwise(F.col("lon")).alias("longitude"),
        F.concat(F.lit("City "), (k % 50).cast("string")).alias("city"),
        F.concat(F.lit("State "), (k % 10).cast("string")).alias("territory"),
        F.when(online, F.lit("online")).otherwise(F.lit("physical")).alias("type"),
        F.when(k % 19 == 0, F.lit(None).cast("int"))
         .otherwise(((k * 37) % 1000).cast("int")).alias("savingsPercentage"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("logo-a-"), k.cast("string"))).alias("logoLocation"),
        F.lit(SOURCE_A).alias("source"),
        F.concat(F.lit("a-"), k.cast("string")).alias("sourceId"),
        (k % 23 != 0).alias("active"),
        _pick(k % 3, ["barcode", "online", F.lit(None).cast("string")]).alias("redeemType"),
        F.when(k % 2 == 0, F.lit("fixed")).otherwise(F.lit("min-max")).alias("denominationsType"),
    )


def _b_name(online: bool) -> Column:
    nm = F.col("nm")
    last = nm if online else F.concat(F.lit(" "), nm, F.lit(" "))
    return _pick(_k() % 5, [F.concat(nm, F.lit(" USA")), F.concat(F.upper(nm), F.lit("®")),
                            nm, F.concat(nm, F.lit(" store")), last])


def _b_common(k: Column) -> list:
    return [F.lit(SOURCE_B).alias("source"),
            F.concat(F.lit("b-"), k.cast("string")).alias("sourceId"),
            F.lit(True).alias("active"),
            F.lit("barcode").alias("redeemType"),
            F.when(k % 2 == 1, F.lit("min-max")).otherwise(F.lit("fixed")).alias("denominationsType")]


def place_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Physical rows (shifted copies of A's places) plus online brand rows."""
    k = _k()
    b = base(spark, sf_dir)
    city = F.concat(F.lit("City "), (k % 50).cast("string"))
    physical = b.filter((k % 3 != 0) & (k % 10 != 9)).select(
        (k * 2).alias("row_id"), (k * 2 + 1).alias("seq"),
        F.concat(F.lit("B"), (k % 40).cast("string")).alias("merchantId"),
        _b_name(False).alias("name"),
        F.when(k % 4 == 0, F.replace(F.col("addr"), F.lit("Street"), F.lit("St")))
         .otherwise(F.col("addr")).alias("address1"),
        (F.col("lat") + _pick(k % 7, LAT_SHIFTS)).alias("latitude"),
        F.col("lon").alias("longitude"),
        F.when(k % 6 == 0, F.upper(city)).when(k % 11 == 0, F.lit("Other"))
         .otherwise(city).alias("city"),
        F.when(k % 9 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("State "), (k % 10).cast("string"))).alias("territory"),
        F.lit("physical").alias("type"),
        ((k * 53) % 1000).cast("int").alias("savingsPercentage"),
        F.concat(F.lit("logo-b-"), k.cast("string")).alias("logoLocation"),
        *_b_common(k))
    online = b.filter(k % 8 == 5).select(
        (k * 2 + 1).alias("row_id"), (k * 2).alias("seq"),
        F.concat(F.lit("B"), k.cast("string")).alias("merchantId"),
        _b_name(True).alias("name"),
        F.lit("online").alias("address1"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        F.lit(None).cast("string").alias("city"),
        F.lit("").alias("territory"),
        F.lit("online").alias("type"),
        ((k * 71) % 1000).cast("int").alias("savingsPercentage"),
        F.concat(F.lit("logo-b-"), k.cast("string")).alias("logoLocation"),
        *_b_common(k))
    return physical.unionByName(online)


def brand_names(spark: SparkSession, sf_dir: str, current: bool) -> DataFrame:
    """Brand-name lists of two runs: previous (``p % 11 <> 0``) and current
    (``p % 13 <> 0``, with ' USA' appended when ``p % 6 = 0``)."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    k = F.col("p_partkey")
    name = F.concat_ws(" ", "p_name", "p_brand", k.cast("string"))
    if current:
        return p.filter(k % 13 != 0).select(
            F.when(k % 6 == 0, F.concat(name, F.lit(" USA"))).otherwise(name).alias("name"))
    return p.filter(k % 11 != 0).select(name.alias("name"))


def place_snapshot(spark: SparkSession, sf_dir: str, current: bool) -> DataFrame:
    """Two snapshots of feed A: previous keeps ``k % 11 <> 0``; current keeps
    ``k % 13 <> 0``, upper-cases names when ``k % 6 = 0`` and moves the
    latitude by 0.00001 when ``k % 5 = 0``."""
    a = place_a(spark, sf_dir).select("row_id", "merchantId", "name", "latitude", "longitude", "type")
    k = F.col("row_id")
    if not current:
        return a.filter(k % 11 != 0)
    return (a.filter(k % 13 != 0)
             .withColumn("name", F.when(k % 6 == 0, F.upper("name")).otherwise(F.col("name")))
             .withColumn("latitude", F.when(k % 5 == 0, F.col("latitude") + F.lit(0.00001))
                         .otherwise(F.col("latitude"))))


SNAPSHOT_MODES = ["TESTNET", "PRODUCTION", "DEVNET"]


def snapshot_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of archived snapshots, one per (mode, order date)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    k = F.col("o_orderkey")
    date = F.when(k % 50 == 0, F.lit("2001-13-45")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select(F.concat(F.lit("locations-"), _pick(k % 3, SNAPSHOT_MODES), F.lit("-"), date,
                             F.lit(".db")).alias("name")).distinct()


# ---------------------------------------------------------------- raw feeds

def raw_brand_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed A brand pages: one row per part, plus a later second-page copy of
    every 17th part (upper-cased name, other enabled flag)."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    k = F.col("p_partkey")
    common = [k.cast("string").alias("id"),
              F.concat(F.lit("logo-"), k.cast("string")).alias("logoUrl"),
              F.concat(F.lit("site-"), k.cast("string")).alias("website"),
              F.lit("barcode").alias("redeemType"), F.lit("fixed").alias("denominationsType")]
    first = p.select(
        (k * 2).alias("seq"), F.col("p_name").alias("name"), (k % 13 != 0).alias("enabled"),
        F.when(F.col("p_size") % 10 == 0, F.lit("unknown"))
         .when(F.col("p_size") % 2 == 1, F.lit("physical")).otherwise(F.lit("online")).alias("type"),
        (F.col("p_retailprice").cast("bigint") % 2000).cast("int").alias("savingsPercentage"), *common)
    second = p.filter(k % 17 == 0).select(
        (k * 2 + 1).alias("seq"), F.upper("p_name").alias("name"), (k % 2 == 0).alias("enabled"),
        F.lit("online").alias("type"), F.lit(100).alias("savingsPercentage"), *common)
    return first.unionByName(second)


_TERRITORIES = ["NY", " Hawaii", "New,Hampshire ", "ZZ", ""]


def _coord(k: Column, base: float) -> Column:
    return (F.when(k % 9 == 0, F.lit(None).cast("double")).when(k % 11 == 1, F.lit(0.0))
             .otherwise(F.lit(base) + (k % 240000) / F.lit(10000.0)))


def raw_location_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    k = F.col("o_orderkey")
    return o.select(
        k.cast("string").alias("id"), (F.col("o_custkey") * 2).cast("string").alias("merchantId"),
        _pick(k % 11, ["online", "", "Address 1 TBD"] + [None] * 8).alias("_a"),
        F.concat((k % 900).cast("string"), F.lit(" Main St")).alias("_street"),
        _coord(k, 25.0).alias("latitude"), _coord(k, -124.0).alias("longitude"),
        _pick(F.col("o_custkey") % 5, _TERRITORIES).alias("territory"),
        F.concat(F.lit("City "), (k % 50).cast("string")).alias("city"),
        F.concat(F.lit("loc-"), k.cast("string")).alias("sourceId"), k.alias("seq"),
    ).select("seq", "id", "merchantId", F.coalesce("_a", "_street").alias("address1"),
             F.lit(None).cast("string").alias("address2"), "latitude", "longitude", "territory",
             "city", "sourceId")


def raw_brand_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    k = F.col("p_partkey")
    return p.select(k.alias("seq"), k.cast("string").alias("id"),
                    F.when(k % 5 == 0, F.concat("p_name", F.lit(" USA"))).otherwise(F.col("p_name")).alias("name"))


_PRICE_TYPES = {"A": "Fixed", "R": "Option", "N": "Range"}


def _digits(*parts) -> Column:
    """Non-negative numbers side by side in one decimal, so that it is ordered
    as they are; each with its number of digits."""
    out = F.lit(0).cast("decimal(38,0)")
    for c, digits in parts:
        c = F.col(c) if isinstance(c, str) else c
        out = (out * F.lit(10 ** digits) + F.round(c).cast("bigint")).cast("decimal(38,0)")
    return out


def raw_offer_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers (gift cards) per brand; arrival order is the decimal ``seq``."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag")
    q = F.col("l_quantity")
    rf = F.col("l_returnflag")
    price = F.when(rf == "A", F.lit("Fixed")).when(rf == "R", F.lit("Option")).when(rf == "N", F.lit("Range"))
    # every third brand has no offer with a price range
    price = F.when((F.col("l_partkey") % 3 == 0) & (rf == "N"), F.lit("Fixed")).otherwise(price)
    return li.select(
        "l_orderkey", "l_linenumber", "l_suppkey", _digits(
            ("l_orderkey", 12), ("l_linenumber", 2), ("l_suppkey", 8), (F.col("l_extendedprice") * 100, 10),
            ("l_quantity", 4)).alias("seq"),
        F.col("l_partkey").cast("string").alias("brand_id"),
        F.concat(F.lit("Card "), F.col("l_linenumber").cast("string"),
                 F.when(q == 1, F.lit(" (Instant Delivery)")).when(q == 2, F.lit(" (instant delivery)"))
                  .otherwise(F.lit(""))).alias("name"),
        price.alias("price_type"),
        (F.col("l_discount") * F.lit(100.0)).alias("discount_percentage"),
        F.concat(F.lit("img-"), F.col("l_partkey").cast("string")).alias("image"))


def raw_location_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    k = F.col("o_orderkey")
    zero = k % 16 == 0
    return o.select(
        F.concat(F.lit("loc-"), k.cast("string")).alias("name"), k.alias("seq"),
        F.col("o_custkey").cast("string").alias("brand_id"),
        F.when(k % 6 == 0, F.lit("Unknown")).otherwise((k % 900).cast("string")).alias("street_number"),
        F.when(k % 8 == 0, F.lit("")).when(k % 48 == 17, F.lit(None).cast("string"))
         .otherwise(F.lit("Oak Ave")).alias("street"),
        F.concat(F.lit("City "), (k % 50).cast("string")).alias("city"),
        _pick(F.col("o_custkey") % 5, _TERRITORIES).alias("state"),
        F.when(k % 5 == 0, F.lit("CA")).when(k % 33 == 1, F.lit(None).cast("string"))
         .otherwise(F.lit("US")).alias("country"),
        F.when(zero, F.lit(0.0)).otherwise(F.lit(25.0) + (k % 240000) / F.lit(10000.0)).alias("latitude"),
        F.when(zero, F.lit(0.0)).otherwise(F.lit(-124.0) + (k % 240000) / F.lit(10000.0)).alias("longitude"),
        F.concat(F.lit("web-"), k.cast("string")).alias("website"))


# Fixed test configuration: offers blocked per brand (brand id -> phrases).
TEST_OFFER_BLOCKLIST = {"174": ["Card 1", "Card 2"]}

# The curated sheet's columns, in positional order.
SHEET_COLUMNS = ["SOURCE_ID", "ADD_DATE", "UPDATE_DATE", "NAME", "ADDRESS1", "ADDRESS2", "ADDRESS3",
                 "ADDRESS4", "LATITUDE", "LONGITUDE", "PLUS_CODE", "TERRITORY", "GOOGLE_MAPS",
                 "LOGO_LOCATION", "WEBSITE", "PAYMENT_METHOD", "TYPE", "PHONE", "MON_OPEN", "MON_CLOSE",
                 "TUE_OPEN", "TUE_CLOSE", "WED_OPEN", "WED_CLOSE", "THU_OPEN", "THU_CLOSE", "FRI_OPEN",
                 "FRI_CLOSE", "SAT_OPEN", "SAT_CLOSE", "SUN_OPEN", "SUN_CLOSE", "INSTAGRAM", "TWITTER",
                 "DELIVERY", "ACTIVE", "MERCHANT_ID", "SAVINGS_PERCENTAGE"]


def raw_sheet_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated sheet rows (all strings); every 29th row is empty."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    k = F.col("p_partkey")
    ks = k.cast("string")
    vals = {
        "SOURCE_ID": F.concat(ks, F.lit(".0")),
        "NAME": F.col("p_name"),
        "ADDRESS1": F.col("p_type"),
        "LATITUDE": F.when(k % 5 == 0, F.lit("n/a")).otherwise((F.lit(30.0) + k % 20).cast("string")),
        "LONGITUDE": (F.lit(-100.0) - k % 50).cast("string"),
        "TERRITORY": F.concat(F.lit(" "), F.col("p_brand"), F.lit(" ")),
        "LOGO_LOCATION": F.concat(F.lit("logo-c-"), ks),
        "PAYMENT_METHOD": F.lit(" gift card "),
        "TYPE": F.lit(" physical "),
        "ACTIVE": _pick(k % 4, ["TRUE", "no", "1", "maybe"]),
        "MERCHANT_ID": F.when(k % 3 == 0, F.concat(F.lit("x-"), ks)).otherwise(F.concat(ks, F.lit(".0"))),
    }
    empty = k % 29 == 0
    return p.select(F.concat(F.lit("r"), ks).alias("row_key"), (k + 1).alias("seq"), *[
        F.when(empty, F.lit("")).otherwise(vals.get(c, F.lit(""))).alias(c) for c in SHEET_COLUMNS])


def raw_kiosk(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("s_suppkey")
    nocoord = k % 10 == 0
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        k.cast("int").alias("id"), F.col("s_name").alias("location"),
        F.concat(F.lit("Addr "), k.cast("string")).alias("address"),
        F.col("n_name").alias("city"),
        _pick(k % 3, ["CA", "", F.lit(None).cast("string")]).alias("state"),
        (k % 2).cast("int").alias("buy"), ((k / 2).cast("bigint") % 2).cast("int").alias("sell"),
        F.when(nocoord, F.lit(None).cast("double")).otherwise(F.lit(30.0) + k % 20).alias("lat"),
        F.when(nocoord, F.lit(None).cast("double")).otherwise(F.lit(-100.0) - k % 30).alias("lng"),
        F.concat(F.lit("op-"), (k % 7).cast("string")).alias("operator"),
        F.concat(F.lit("https://kiosk/"), k.cast("string")).alias("url"),
        F.concat(F.lit("oplogo-"), (k % 7).cast("string")).alias("operator_logo"),
        F.lit("555-0100").alias("operator_phone"))


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference places for reverse lookups: all base places."""
    k = _k()
    return base(spark, sf_dir).select(
        F.concat(F.lit("City "), k.cast("string")).alias("city"),
        F.concat(F.lit("State "), (k % 10).cast("string")).alias("state"), "lat", "lon")


def previous_brand_names(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """Brand names of the previous run (parts with ``p % 11 <> 0``)."""
    src = raw_brand_a(spark, sf_dir) if feed == "A" else raw_brand_b(spark, sf_dir)
    src = src.filter(F.col("id").cast("bigint") % 11 != 0)
    if feed == "A":
        src = src.filter(F.col("seq") % 2 == 0)
    return src.select("name")
