"""Reports over matches and consolidated places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placekit.operators.match import match_order

# Confidence tiers of the comparison report (lower bounds).
TIERS = [(0.9, "HIGH_CONFIDENCE_DUPLICATE"), (0.7, "MEDIUM_CONFIDENCE_DUPLICATE"),
         (0.5, "LOW_CONFIDENCE_DUPLICATE")]
BELOW_TIERS = "POTENTIAL_MATCH"
UNIQUE_A, UNIQUE_B = "A_UNIQUE", "B_UNIQUE"
# A match at or above this confidence removes both rows from the unique lists.
MATCHED_AT = 0.5

ARCHIVE_COLUMNS = ["merchantId", "active", "name", "address1", "address2", "address3", "address4",
                   "latitude", "longitude", "website", "phone", "territory", "city", "source",
                   "sourceId", "type", "redeemType", "savingsPercentage", "denominationsType"]

_DUP_A = ["merchantId", "name", "address1", "address2", "address3", "address4", "latitude",
          "longitude", "website", "phone", "territory", "city", "source", "sourceId"]
_DUP_B = ["merchantId", "name", "address1", "address2", "address3", "address4", "latitude",
          "longitude", "territory", "city", "source", "sourceId"]

_STRING_DEFAULTS = {"address2", "address3", "address4", "website", "phone"}


def _col(df: DataFrame, c: str):
    if c in df.columns:
        return F.col(c)
    return F.lit(None).cast("double" if c in ("latitude", "longitude") else "string")


def tier(conf) -> F.Column:
    expr = None
    for bound, name in TIERS:
        expr = F.when(conf >= bound, F.lit(name)) if expr is None else expr.when(conf >= bound, F.lit(name))
    return expr.otherwise(F.lit(BELOW_TIERS))


def valid_coordinate_profile(feeds: dict) -> DataFrame:
    """Per feed: rows with both coordinates and total rows."""
    out = None
    for name, df in feeds.items():
        row = df.agg(F.count_if(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
                      .alias("valid_rows"), F.count("*").alias("total_rows")) \
                .select(F.lit(name).alias("feed"), "valid_rows", "total_rows")
        out = row if out is None else out.unionByName(row)
    return out


def valid_coordinates(df: DataFrame) -> DataFrame:
    """Rows with both coordinates (the comparison tool's matcher input)."""
    return df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def comparison_report(a: DataFrame, b: DataFrame, matches: DataFrame) -> DataFrame:
    """Every match with its tier, then B and A rows with no match of
    confidence >= 0.5 as unique rows (confidence 0)."""
    def side(df, p, state_col):
        return df.select(F.col("row_id").alias(f"{p}_row_id"), F.col("name").alias(f"{p}_name"),
                         F.col("address1").alias(f"{p}_address"), F.col("city").alias(f"{p}_city"),
                         F.col("territory").alias(state_col),
                         F.col("latitude").alias(f"{p}_lat"), F.col("longitude").alias(f"{p}_lon"))
    A, B = side(a, "a", "a_territory"), side(b, "b", "b_state")
    m = (matches.join(B, "b_row_id").join(A, "a_row_id")
                .select(tier(F.col("confidence")).alias("match_type"),
                        F.col("confidence").alias("confidence_score"),
                        *[c for c in B.columns if c != "b_row_id"],
                        *[c for c in A.columns if c != "a_row_id"],
                        "distance_miles", "name_similarity", "address_similarity", "city_match",
                        "state_match", F.lit(True).alias("zip_match"),
                        F.col("reasons").alias("match_reasons"), "geographic_warning",
                        "b_row_id", "a_row_id"))
    strong = matches.filter(F.col("confidence") >= MATCHED_AT)
    ub = B.join(strong.select("b_row_id").distinct(), "b_row_id", "left_anti")
    ua = A.join(strong.select("a_row_id").distinct(), "a_row_id", "left_anti")
    blank = lambda cols, t="string": [F.lit(None).cast(t).alias(c) for c in cols]
    tail = [F.lit(None).cast("double").alias(c) for c in ("distance_miles", "name_similarity",
                                                         "address_similarity")] + \
           [F.lit(False).alias(c) for c in ("city_match", "state_match", "zip_match")] + \
           [F.lit(None).cast("string").alias("match_reasons"), F.lit("").alias("geographic_warning")]
    ub_rows = ub.select(F.lit(UNIQUE_B).alias("match_type"), F.lit(0.0).alias("confidence_score"),
                        *[c for c in B.columns if c != "b_row_id"],
                        *blank(["a_name", "a_address", "a_city", "a_territory"]),
                        *blank(["a_lat", "a_lon"], "double"), *tail,
                        "b_row_id", F.lit(None).cast("bigint").alias("a_row_id"))
    ua_rows = ua.select(F.lit(UNIQUE_A).alias("match_type"), F.lit(0.0).alias("confidence_score"),
                        *blank(["b_name", "b_address", "b_city", "b_state"]),
                        *blank(["b_lat", "b_lon"], "double"),
                        *[c for c in A.columns if c != "a_row_id"], *tail,
                        F.lit(None).cast("bigint").alias("b_row_id"), "a_row_id")
    return m.unionByName(ub_rows).unionByName(ua_rows)


def match_tier_summary(report: DataFrame) -> DataFrame:
    mt = F.col("match_type")
    return report.agg(*[F.count_if(mt == name).alias(name.lower()) for _, name in TIERS],
                      F.count_if(mt == BELOW_TIERS).alias(BELOW_TIERS.lower()),
                      F.count_if(mt == UNIQUE_B).alias("unique_b"),
                      F.count_if(mt == UNIQUE_A).alias("unique_a"))


def top_matches_sample(a: DataFrame, b: DataFrame, matches: DataFrame, n: int = 3,
                       min_confidence: float = 0.9) -> DataFrame:
    """First ``n`` high-confidence matches in match order (a top-k report)."""
    m = match_order(matches).filter(F.col("confidence") >= min_confidence)
    top = m.orderBy("match_ord").limit(n)
    return (top.join(b.select(F.col("row_id").alias("b_row_id"), F.col("name").alias("b_name")), "b_row_id")
               .join(a.select(F.col("row_id").alias("a_row_id"), F.col("name").alias("a_name")), "a_row_id")
               .select("b_name", "a_name", "distance_miles", "confidence", "b_row_id", "a_row_id"))


def duplicates_table(a: DataFrame, b: DataFrame, matches: DataFrame,
                     a_prefix: str = "A_", b_prefix: str = "B_") -> DataFrame:
    """One wide row per match: 14 columns of the A row, 12 of the B row."""
    A = a.select(F.col("row_id").alias("a_row_id"), *[_col(a, c).alias(a_prefix + c) for c in _DUP_A])
    B = b.select(F.col("row_id").alias("b_row_id"), *[_col(b, c).alias(b_prefix + c) for c in _DUP_B])
    return (matches.select("a_row_id", "b_row_id").join(A, "a_row_id").join(B, "b_row_id")
                   .select(*[a_prefix + c for c in _DUP_A], *[b_prefix + c for c in _DUP_B]))


def mismatched_duplicate_names(dups: DataFrame, with_streets: bool = False,
                               a_prefix: str = "A_", b_prefix: str = "B_") -> DataFrame:
    cols = ["name"] + (["address1"] if with_streets else []) + ["latitude", "longitude"]
    return (dups.filter(F.col(a_prefix + "name") != F.col(b_prefix + "name"))
                .select(*[a_prefix + c for c in cols], *[b_prefix + c for c in cols]))


def archive(places: DataFrame) -> DataFrame:
    """19-column archive projection: nulls kept, ``active`` as 1/0."""
    cols = []
    for c in ARCHIVE_COLUMNS:
        if c == "active":
            cols.append(F.when(F.col("active") == True, F.lit(1)).otherwise(F.lit(0)).alias("active"))  # noqa: E712
        elif c == "savingsPercentage":
            cols.append(_col(places, c).cast("int").alias(c))
        else:
            cols.append(_col(places, c).alias(c))
    return places.select(*cols)


def sync_report(places: DataFrame, links: DataFrame, matches: DataFrame) -> DataFrame:
    """Totals: distinct merchants in the links, place rows, match rows."""
    kind = F.col("kind")
    u = (links.select("merchantId", F.lit(0).alias("kind"))
              .unionByName(places.select(F.lit(None).cast("string").alias("merchantId"), F.lit(1).alias("kind")))
              .unionByName(matches.select(F.lit(None).cast("string").alias("merchantId"), F.lit(2).alias("kind"))))
    return u.agg(F.count_distinct(F.when(kind == 0, F.col("merchantId"))).alias("total_merchants"),
                 F.count_if(kind == 1).alias("total_locations"),
                 F.count_if(kind == 2).alias("merged_locations"))


def source_report(feeds: dict) -> tuple[DataFrame, DataFrame]:
    """Per source counts plus the listed names in long form.

    ``feeds`` maps a source name to a dict with DataFrames ``brands`` (one row
    per brand), ``locations`` (rows counted as locations), ``disabled``
    (names), ``new`` / ``removed`` (names), ``negative`` (names).
    Returns ``(counts, lists)``; lists are rows ``(source, list, name)``.
    """
    counts = lists = None
    for src, f in feeds.items():
        parts = [f["brands"].select(F.lit("brands").alias("k")),
                 f["locations"].select(F.lit("locations").alias("k"))]
        named = []
        for lst in ("disabled", "new", "removed", "negative"):
            if f.get(lst) is not None:
                named.append(f[lst].select(F.lit(lst).alias("list"), F.col("name")))
        u = parts[0].unionByName(parts[1])
        for n in named:
            u = u.unionByName(n.select(F.col("list").alias("k")))
        c = u.agg(*[F.count_if(F.col("k") == k).alias(a) for k, a in
                    (("brands", "brands"), ("locations", "locations"), ("disabled", "disabled"),
                     ("new", "new_brands"), ("removed", "removed_brands"),
                     ("negative", "negative_discount"))]).select(F.lit(src).alias("source"), "*")
        counts = c if counts is None else counts.unionByName(c)
        for n in named:
            row = n.select(F.lit(src).alias("source"), "list", "name")
            lists = row if lists is None else lists.unionByName(row)
    return counts, lists
