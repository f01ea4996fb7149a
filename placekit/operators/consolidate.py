"""Consolidation of two matched feeds into one place table plus provider links.

The source system builds its result with a loop over in-memory lists and
process-global "first seen" dictionaries.  Here the same result is a pure
function of the inputs, made declarative by an explicit order struct ``ord``:

* phase 0 - matched A rows, in match order (see ``match_order``);
* phase 1 - unmatched A rows by ``seq``;
* phase 2 - unmatched B rows by ``seq`` (their merchant id is not used).

Dictionaries are aggregates (``min_by`` over ``ord``) grouped by name key, so
a brand that holds a large share of all rows is partially aggregated on the
map side instead of being collected into one task.
"""

from __future__ import annotations

from functools import cached_property
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placekit.functions.names import name_key, name_uuid, normalize_name
from placekit.operators.match import PRODUCTION, MatchParams, match_order, match_places
from placekit.operators.joins import left_join_nonnull
from placekit.operators.ranking import rank_within
from placekit.session import materialize

LINK_FIELDS = ["merchantId", "provider", "sourceId", "active", "redeemType",
               "savingsPercentage", "denominationsType"]


# Schemas of the result of no feed at all.
PLACE_SCHEMA = ("merchantId string, name string, address1 string, latitude double, longitude double, city string, "
                "territory string, type string, savingsPercentage int, logoLocation string, source string, "
                "sourceId string, active boolean, redeemType string, denominationsType string, plusCode string")
LINK_SCHEMA = ("merchantId string, provider string, sourceId string, active boolean, redeemType string, "
               "savingsPercentage int, denominationsType string")


class CombinedResult:
    """The combination of feed A and feed B, each table computed when it is
    first asked for.  Tables that others are made from are written to the
    shared folder once."""

    def __init__(self, a: DataFrame, b: DataFrame, params: MatchParams, matches: DataFrame | None = None,
                 dedupe: bool = False):
        self._feeds, self._params, self._given, self._dedupe = (a, b), params, matches, dedupe

    @cached_property
    def _staged(self) -> tuple[DataFrame, DataFrame]:
        """Both feeds with their standardized names, keys and ids, written once: matcher,
        dictionary, merge and links read them, and no stage computes them again."""
        return tuple(materialize(_standardized(f)) for f in self._feeds)

    @property
    def _a(self) -> DataFrame:
        return self._staged[0]

    @property
    def _b(self) -> DataFrame:
        return self._staged[1]

    @cached_property
    def matches(self) -> DataFrame:
        m = match_places(self._a, self._b, self._params) if self._given is None else self._given
        return materialize(match_order(m))

    @cached_property
    def dictionary(self) -> DataFrame:
        return materialize(brand_dictionary(dictionary_events(self._a, self._b, self.matches)))

    @cached_property
    def merged(self) -> DataFrame:
        return merged_places(self._a, self._b, self.matches)

    @cached_property
    def unmatched_a(self) -> DataFrame:
        return unmatched_rows(self._a, self.matches, self.dictionary, "a")

    @cached_property
    def unmatched_b(self) -> DataFrame:
        return unmatched_rows(self._b, self.matches, self.dictionary, "b")

    @cached_property
    def _rest(self) -> tuple[DataFrame, DataFrame]:
        """The unmatched rows of both feeds, once, for the tables made from them."""
        return materialize(self.unmatched_a), materialize(self.unmatched_b)

    @cached_property
    def folds(self) -> DataFrame:
        return materialize(online_fold(self.merged, *self._rest))

    @cached_property
    def places(self) -> DataFrame:
        un_a, un_b = self._rest
        inserted = self.folds.filter(F.col("target_uid").isNull()).select(F.col("b_uid").alias("uid"))
        b_rows = (un_b.filter(F.col("type").isNull() | (F.col("type") != "online"))
                      .unionByName(un_b.filter(F.col("type") == "online").join(inserted, "uid", "left_semi")))
        rows = _place_cols(self.merged).unionByName(_place_cols(un_a)).unionByName(_place_cols(b_rows))
        places = _apply_folds(rows, self.folds, un_b, self.dictionary)
        return dedupe_places(places, self.dictionary) if self._dedupe else places

    @cached_property
    def links(self) -> DataFrame:
        return provider_links(self._a, self._b, self.matches, *self._rest, self.folds)


class Uncombined(NamedTuple):
    """The result of one feed or none: nothing to match."""

    places: DataFrame
    links: DataFrame
    matches: None = None


def _ord(p: int | Column, m=0, s=None, c=0.0, a=0) -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(lit(p).cast("int").alias("p"), lit(m).cast("int").alias("m"),
                    lit(s).cast("decimal(38,0)").alias("s"), lit(c).cast("double").alias("c"),
                    lit(a).cast("decimal(38,0)").alias("a"))


def standardize_names(df: DataFrame, name_col: str = "name") -> DataFrame:
    """Add ``name_std`` (normalized name) and ``name_key`` (dictionary key)."""
    return (df.withColumn("name_std", normalize_name(name_col))
              .withColumn("name_key", name_key("name_std")))


_STANDARD = ["name_std", "name_key", "name_id"]


def _standardized(df: DataFrame) -> DataFrame:
    """``df`` with ``_STANDARD``; as it is if it has them."""
    if set(_STANDARD) <= set(df.columns):
        return df
    return standardize_names(df).withColumn("name_id", name_uuid("name_std"))


def _with_order(matches: DataFrame) -> DataFrame:
    if "match_ord" not in matches.columns:
        matches = match_order(matches)
    return matches.withColumn("ord", _ord(0, F.col("match_ord.s"), F.col("match_ord.b"),
                                          F.col("match_ord.c"), F.col("match_ord.a")))


def _unmatched(df: DataFrame, matches: DataFrame, side: str) -> DataFrame:
    ids = matches.select(F.col(f"{side}_row_id").alias("row_id")).distinct()
    return df.join(ids, "row_id", "left_anti")


def dictionary_events(a: DataFrame, b: DataFrame, matches: DataFrame) -> DataFrame:
    """Every contribution to the name dictionary, with its ``ord``."""
    m = _with_order(matches)
    A, B = _standardized(a), _standardized(b)
    first = m.groupBy("a_row_id").agg(F.min("ord").alias("ord"))
    ev0 = (first.join(A, A.row_id == first.a_row_id)
                .select("name_key", "name_std", F.col("logoLocation").alias("logo"),
                        F.col("merchantId").alias("id_candidate"), "ord"))
    ua = _unmatched(A, matches, "a")
    ev1 = ua.select("name_key", "name_std", F.col("logoLocation").alias("logo"),
                    F.coalesce("merchantId", "name_id").alias("id_candidate"),
                    _ord(1, 0, F.col("seq")).alias("ord"))
    ub = _unmatched(B, matches, "b")
    ev2 = ub.select("name_key", "name_std", F.col("logoLocation").alias("logo"),
                    F.col("name_id").alias("id_candidate"),
                    _ord(2, 0, F.col("seq")).alias("ord"))
    return ev0.unionByName(ev1).unionByName(ev2).filter(F.col("name_std").isNotNull())


def brand_dictionary(events: DataFrame) -> DataFrame:
    """Per name key: canonical name (first seen), canonical id (first
    non-null id candidate) and the first non-null logo with its position."""
    has_id = F.col("id_candidate").isNotNull()
    has_logo = F.col("logo").isNotNull()
    return events.groupBy("name_key").agg(
        F.min_by("name_std", "ord").alias("canon_name"),
        F.min_by("id_candidate", F.when(has_id, F.col("ord"))).alias("canon_id"),
        F.min_by("logo", F.when(has_logo, F.col("ord"))).alias("first_logo"),
        F.min(F.when(has_logo, F.col("ord"))).alias("first_logo_ord"))


def _logo_at(pos: Column) -> Column:
    """First non-null logo of the key up to and including position ``pos``."""
    return F.when(F.col("first_logo_ord") <= pos, F.col("first_logo"))


def _dict_join(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    return left_join_nonnull(_standardized(df), dictionary, ["name_key"])


def merged_places(a: DataFrame, b: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per match: the A row with the larger savings and ``plusCode='merged'``."""
    m = _with_order(matches).select("a_row_id", "b_row_id", "ord")
    bs = b.select(F.col("row_id").alias("b_row_id"), F.col("savingsPercentage").alias("_b_sav"))
    out = (m.join(a, a.row_id == m.a_row_id).join(bs, "b_row_id")
            .withColumn("savingsPercentage",
                        F.greatest(F.coalesce("savingsPercentage", F.lit(0)),
                                   F.coalesce("_b_sav", F.lit(0))))
            .withColumn("plusCode", F.lit("merged"))
            .withColumn("uid", F.concat_ws(":", F.lit("m"), F.col("a_row_id").cast("string"),
                                           F.col("b_row_id").cast("string")))
            .withColumn("pos", F.col("ord")))
    return out.drop("_b_sav", "ord", *_STANDARD)


def unmatched_rows(df: DataFrame, matches: DataFrame, dictionary: DataFrame, side: str) -> DataFrame:
    """Rows of one side in no match, renamed to the canonical name/id/logo."""
    phase = 1 if side == "a" else 2
    rows = _dict_join(_unmatched(df, matches, side), dictionary)
    pos = _ord(phase, 0, F.col("seq"))
    return (rows.withColumn("pos", pos)
                .withColumn("orig_merchantId", F.col("merchantId"))
                .withColumn("merchantId", F.col("canon_id"))
                .withColumn("name", F.col("canon_name"))
                .withColumn("logoLocation", _logo_at(F.col("pos")))
                .withColumn("uid", F.concat_ws(":", F.lit(side), F.col("row_id").cast("string"))))


def online_fold(merged: DataFrame, un_a: DataFrame, un_b: DataFrame) -> DataFrame:
    """Assign unmatched B online rows to existing online rows of the same name.

    For one canonical name let e1..ek be the existing online rows (merged rows
    by match order, then unmatched A rows) and p1..pm the unmatched B online
    rows by ``seq``.  Each update moves the row to the end of the list, so pj
    folds onto e[(j-1) mod k + 1]; with k = 0, p1 is inserted and p2..pm fold
    into it.  Returns one row per B online row with ``target_uid`` (null when
    inserted) and the merchant id its provider link uses.  A row without a name
    shares it with no other, so it is inserted.
    """
    unnamed = un_b.filter((F.col("type") == "online") & F.col("name").isNull())
    un_b = un_b.filter(F.col("name").isNotNull())
    existing = (merged.filter(F.col("type") == "online")
                      .select(F.col("name").alias("c"), "uid", "pos", F.col("merchantId").alias("orig_mid"))
                      .unionByName(un_a.filter(F.col("type") == "online")
                                   .select(F.col("name").alias("c"), "uid", "pos",
                                           F.col("merchantId").alias("orig_mid"))))
    # existing rows are only needed for names that receive B online rows
    p = (un_b.filter(F.col("type") == "online")
             .select(F.col("name").alias("c"), F.col("uid").alias("b_uid"), "row_id", "seq",
                     "pos", "canon_id", "name_key"))
    existing = existing.join(p.select("c").distinct(), "c", "left_semi")
    # one skew-safe rank pass for both lists: key = (list, name), order = pos
    # (pos orders B rows exactly like seq)
    both = (existing.withColumn("_list", F.lit("e"))
                    .unionByName(p.withColumn("_list", F.lit("p")), allowMissingColumns=True)
                    .withColumn("_rk", F.concat_ws("\u0000", "_list", "c")))
    both = rank_within(both, "_rk", "pos", "_r")
    existing = (both.filter(F.col("_list") == "e").withColumnRenamed("_r", "i")
                    .select("c", "uid", "pos", "orig_mid", "i"))
    p = (both.filter(F.col("_list") == "p").withColumnRenamed("_r", "j")
             .select("c", "b_uid", "row_id", "seq", "pos", "canon_id", "name_key", "j"))
    counts = existing.groupBy("c").agg(F.count("*").alias("k"))
    first_b = p.groupBy("c").agg(F.min_by("b_uid", "seq").alias("p1_uid"))
    p = p.join(first_b, "c")
    p = p.join(counts, "c", "left").withColumn("k", F.coalesce("k", F.lit(0)))
    p = p.withColumn("i", F.when(F.col("k") > 0, F.pmod(F.col("j") - 1, F.col("k")) + 1))
    e = existing.select("c", "i", F.col("uid").alias("e_uid"), "orig_mid")
    p = p.join(e, ["c", "i"], "left")
    alone = unnamed.select(
        F.col("row_id").alias("b_row_id"), F.col("uid").alias("b_uid"), "seq", "pos", "name_key",
        F.lit(1).cast("int").alias("j"), F.lit(0).cast("bigint").alias("k"),
        F.lit(None).cast("string").alias("target_uid"), F.col("canon_id").alias("link_merchantId"))
    folded = p.select(
        F.col("row_id").alias("b_row_id"), "b_uid", "seq", "pos", "name_key", "j", "k",
        F.when(F.col("k") > 0, F.col("e_uid"))
         .when(F.col("j") > 1, F.col("p1_uid")).alias("target_uid"),
        F.when((F.col("k") > 0) & (F.col("j") <= F.col("k")), F.col("orig_mid"))
         .otherwise(F.col("canon_id")).alias("link_merchantId"))
    return folded.unionByName(alone)


def _apply_folds(rows: DataFrame, folds: DataFrame, un_b: DataFrame, dictionary: DataFrame) -> DataFrame:
    sav = un_b.select(F.col("row_id").alias("b_row_id"), F.col("savingsPercentage").alias("_fs"))
    agg = (folds.filter(F.col("target_uid").isNotNull()).join(sav, "b_row_id")
                .groupBy(F.col("target_uid").alias("uid"))
                .agg(F.max(F.coalesce("_fs", F.lit(0))).alias("_fold_sav"),
                     F.max("pos").alias("_fold_pos"),
                     F.first("name_key").alias("_fold_key")))
    d = dictionary.select(F.col("name_key").alias("_fold_key"), F.col("canon_name").alias("_fn"),
                          F.col("canon_id").alias("_fid"), F.col("first_logo").alias("_fl"),
                          F.col("first_logo_ord").alias("_flo"))
    # resolve the fold targets against the dictionary while they are small,
    # then join the places once on their unique uid (no null-key hot spot)
    r = rows.join(agg.join(d, "_fold_key", "left"), "uid", "left")
    folded = F.col("_fold_pos").isNotNull()
    return (r.withColumn("name", F.when(folded, F.col("_fn")).otherwise(F.col("name")))
             .withColumn("merchantId", F.when(folded, F.col("_fid")).otherwise(F.col("merchantId")))
             .withColumn("logoLocation", F.when(folded, F.when(F.col("_flo") <= F.col("_fold_pos"), F.col("_fl")))
                         .otherwise(F.col("logoLocation")))
             .withColumn("savingsPercentage",
                         F.when(folded, F.greatest(F.coalesce("savingsPercentage", F.lit(0)),
                                                   F.col("_fold_sav")))
                          .otherwise(F.col("savingsPercentage")))
             .withColumn("pos", F.when(folded, F.col("_fold_pos")).otherwise(F.col("pos")))
             .drop("_fold_key", "_fold_sav", "_fold_pos", "_fn", "_fid", "_fl", "_flo"))


PLACE_OUT = ["uid", "pos", "merchantId", "name", "address1", "latitude", "longitude", "city",
             "territory", "type", "savingsPercentage", "logoLocation", "source", "sourceId",
             "active", "redeemType", "denominationsType", "plusCode"]


def _place_cols(df: DataFrame) -> DataFrame:
    cols = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in PLACE_OUT]
    return df.select(*cols)


def provider_links(a: DataFrame, b: DataFrame, matches: DataFrame, un_a: DataFrame,
                   un_b: DataFrame, folds: DataFrame) -> DataFrame:
    """Merchant <-> provider bridge rows; per (merchantId, provider) the last
    write in processing order wins."""
    m = _with_order(matches).select("a_row_id", "b_row_id", "ord")
    def link(mid, src, sid, df, order, t):
        return df.select(mid.alias("merchantId"), F.col(src).alias("provider"),
                         sid.alias("sourceId"), "active", "redeemType", "savingsPercentage",
                         "denominationsType",
                         F.struct(order.alias("o"), F.lit(t).alias("t")).alias("w"))
    ma = m.join(a, a.row_id == m.a_row_id)
    l0a = link(F.col("merchantId"), "source", F.col("merchantId"), ma, F.col("ord"), 0)
    mb = (m.join(a.select(F.col("row_id").alias("a_row_id"), F.col("merchantId").alias("_amid")), "a_row_id")
           .join(b, b.row_id == m.b_row_id))
    l0b = link(F.col("_amid"), "source", F.col("merchantId"), mb, F.col("ord"), 1)
    l1 = link(F.col("merchantId"), "source", F.col("orig_merchantId"), un_a, F.col("pos"), 0)
    ub = un_b.join(folds.select(F.col("b_row_id").alias("row_id"), "link_merchantId"), "row_id", "left")
    l2 = link(F.coalesce("link_merchantId", "merchantId"), "source", F.col("orig_merchantId"),
              ub, F.col("pos"), 0)
    allw = l0a.unionByName(l0b).unionByName(l1).unionByName(l2).filter(
        F.col("merchantId").isNotNull() & F.col("provider").isNotNull())
    fields = [c for c in LINK_FIELDS if c not in ("merchantId", "provider")]
    best = allw.groupBy("merchantId", "provider").agg(
        F.max_by(F.struct(*fields), "w").alias("v"))
    return best.select("merchantId", "provider", *[F.col(f"v.{c}").alias(c) for c in fields])


def combine_feeds(feeds: list, params: MatchParams = PRODUCTION, matches: DataFrame | None = None,
                  dedupe: bool = False) -> CombinedResult | Uncombined:
    """Combine feed A (``feeds[0]``, wins on merge) with feed B (``feeds[1]``).

    No feed -> empty places and links; 1 feed -> unchanged rows plus their links.
    """
    if len(feeds) > 2:
        raise ValueError("combine_feeds combines exactly two feeds; got %d" % len(feeds))
    if len(feeds) == 0:
        spark = SparkSession.getActiveSession()
        return Uncombined(spark.createDataFrame([], PLACE_SCHEMA), spark.createDataFrame([], LINK_SCHEMA))
    if len(feeds) == 1:
        f = feeds[0]
        links = (f.filter(F.col("merchantId").isNotNull() & F.col("source").isNotNull())
                  .withColumn("w", F.col("seq"))
                  .groupBy("merchantId", F.col("source").alias("provider"))
                  .agg(F.max_by(F.struct(F.col("merchantId").alias("sourceId"), "active", "redeemType",
                                         "savingsPercentage", "denominationsType"), "w").alias("v"))
                  .select("merchantId", "provider", "v.*"))
        return Uncombined(f, links)
    return CombinedResult(*feeds, params, matches, dedupe)


def _dedupe_key(places: DataFrame, dictionary: DataFrame) -> DataFrame:
    d = dictionary.select(F.col("name_key").alias("_k2"), F.col("canon_name").alias("_cn2"))
    p = left_join_nonnull(places.withColumn("_n2", normalize_name("name"))
                               .withColumn("_k2", name_key("_n2")), d, ["_k2"])
    fmt = lambda c: F.coalesce(F.format_string("%.4f", F.col(c)), F.lit("null"))
    key = F.concat_ws("|", F.coalesce("_cn2", "_n2", F.lit("")), fmt("latitude"), fmt("longitude"),
                      F.coalesce(F.col("type"), F.lit("null")))
    return p.withColumn("dedupe_key", key).drop("_k2", "_n2", "_cn2")


def _dedupe_split(places: DataFrame, dictionary: DataFrame) -> DataFrame:
    p = _dedupe_key(places, dictionary)
    first = p.groupBy("dedupe_key").agg(F.min("pos").alias("_first"))
    return p.join(first, "dedupe_key").withColumn("_keep", F.col("pos") == F.col("_first"))


def dedupe_places(places: DataFrame, dictionary: DataFrame) -> DataFrame:
    """First row (list order) per normalized name | 4-dp lat | 4-dp lon | type."""
    return _dedupe_split(places, dictionary).filter("_keep").drop("_keep", "_first")


def dropped_duplicates(places: DataFrame, dictionary: DataFrame) -> DataFrame:
    return _dedupe_split(places, dictionary).filter(~F.col("_keep")).drop("_keep", "_first")
