"""Coordinate-priority place matcher.

Stage 1 (exact cells): equi-join of the two feeds on truncated coordinates.
Stage 2 (proximity): rows of each side without a stage-1 match, joined with
the grid radius join.  Both stages keep pairs whose name similarity and
confidence pass the thresholds.  Matches are many-to-many.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placekit.functions.address import street_compare_form
from placekit.functions.geo import coordinate_cell, coordinate_score, haversine_miles
from placekit.functions.names import name_compare_form, similarity_of_forms
from placekit.functions.text import is_blank
from placekit.functions.regions import forms_equal, region_compare_form, zip_compare_form
from placekit.functions.scoring import confidence, reachable_radius
from placekit.operators.geo_join import radius_join
from placekit.operators.joins import dealt_join
from placekit.operators.name_blocks import Segments, blocked_join, name_blocks
from placekit.session import materialize


@dataclass(frozen=True)
class MatchParams:
    max_distance: float = 0.5
    min_name_similarity: float = 0.9
    min_confidence: float = 0.7
    include_address: bool = True
    show_all_matches: bool = False
    coordinate_precision: int = 4
    ignore_state: bool = False
    ignore_city: bool = False
    ignore_zip: bool = False
    ignore_name: bool = False
    # column compared by the zip rule (the source system passes address1)
    zip_column: str = "address1"
    # "edit": edit-distance name/street scores with exact geo checks;
    # "blended": the comparison tool's Ratcliff/Obershelp-based scores with
    # loose city/state/zip checks (Arrow pandas UDFs on surviving pairs)
    similarity: str = "edit"

    @property
    def geo_ignored(self) -> bool:
        return self.ignore_city or self.ignore_state or self.ignore_zip

    def with_(self, **kw) -> "MatchParams":
        return replace(self, **kw)


# The parameter profiles of the source system.
LIBRARY_DEFAULTS = MatchParams()
PRODUCTION = MatchParams(max_distance=0.2, min_name_similarity=0.9, min_confidence=0.80,
                         include_address=True, show_all_matches=True, coordinate_precision=4,
                         ignore_state=True, ignore_city=True, ignore_zip=True, ignore_name=False)
GEOGRAPHIC = PRODUCTION.with_(ignore_state=False, ignore_city=False, ignore_zip=False)
COORDS_ONLY = PRODUCTION.with_(ignore_name=True)
DESKTOP = MatchParams(max_distance=2.0, min_name_similarity=0.6, min_confidence=0.5,
                      include_address=True, show_all_matches=True, coordinate_precision=4)
BLENDED = DESKTOP.with_(similarity="blended")

_SIDE_COLS = ["row_id", "seq", "name", "address1", "latitude", "longitude", "city", "territory"]

PAIR_COLUMNS = ["b_row_id", "a_row_id", "b_seq", "a_seq", "distance_miles",
                "name_similarity", "address_similarity", "confidence", "reasons",
                "city_match", "state_match", "geographic_warning", "match_stage"]


def _name_blocking(params: MatchParams) -> bool:
    return (not params.ignore_name and params.similarity == "edit"
            and 0.0 < params.min_name_similarity)


def _blocks(params: MatchParams):
    """The blocking by names inside cells, if names decide."""
    return name_blocks(params.min_name_similarity, "a_name_cmp", "b_name_cmp") if _name_blocking(params) else None


def _near(a: DataFrame, b: DataFrame, params: MatchParams) -> DataFrame:
    """The pairs of two sides within the reachable radius that the names do not
    rule out.  Segments of names leave few pairs in a cell, so cells can be
    larger, and fewer copies of B rows are needed."""
    blocks = _blocks(params)
    return radius_join(a, b, reachable_radius(params),
                       build_coords=("a_latitude", "a_longitude"), probe_coords=("b_latitude", "b_longitude"),
                       blocking=blocks, side=8 if isinstance(blocks, Segments) else 2)


def _side(df: DataFrame, prefix: str, params: MatchParams) -> DataFrame:
    """Project one feed and compute its per-row comparison forms once, before
    any join, so a pair only costs the edit distances."""
    cols = [F.col(c).alias(f"{prefix}{c}") for c in _SIDE_COLS]
    if params.zip_column not in _SIDE_COLS:
        cols.append(F.col(params.zip_column).alias(f"{prefix}{params.zip_column}"))
    if params.similarity == "blended":
        from placekit.functions import blended as BL
        return df.select(*cols, BL.name_form("name").alias(f"{prefix}name_cmp"),
                         BL.street_form("address1").alias(f"{prefix}street_cmp"))
    if not params.ignore_name:
        cols.append(name_compare_form("name").alias(f"{prefix}name_cmp"))
        if _name_blocking(params):
            # a blank name scores 0.0 and can never pass a positive threshold
            df = df.filter(~is_blank(F.col("name")))
    if params.include_address and params.geo_ignored:
        cols.append(street_compare_form("address1").alias(f"{prefix}street_cmp"))
    if not params.ignore_city:
        cols.append(region_compare_form("city").alias(f"{prefix}city_cmp"))
    if not params.ignore_state:
        cols.append(region_compare_form("territory").alias(f"{prefix}state_cmp"))
    if not params.ignore_zip:
        cols.append(zip_compare_form(params.zip_column).alias(f"{prefix}zip_cmp"))
    return df.select(*cols)


def _ratios(pairs: DataFrame, x: str, y: str, wanted, out: str) -> DataFrame:
    """Add the Ratcliff/Obershelp ratio ``out`` of two string columns, computed
    once per distinct pair of strings among the ``wanted`` rows."""
    from placekit.functions.blended import ratcliff_ratio
    distinct = pairs.filter(wanted).select(x, y).distinct().withColumn(out, ratcliff_ratio(x, y))
    return pairs.join(distinct, [x, y], "left")


def _blended_names(pairs: DataFrame, params: MatchParams) -> DataFrame:
    """Add ``name_similarity``.  Pairs that cannot reach the threshold by lengths
    and words are dropped before Python; equal names need no ratio."""
    from placekit.functions import blended as BL
    x, y = "b_name_cmp", "a_name_cmp"
    pairs = pairs.filter(BL.name_score_bound(x, y) >= F.lit(params.min_name_similarity))
    ask = (F.col(x) != F.col(y)) & ~BL.lengths_differ(x, y)
    return (_ratios(pairs, x, y, ask, "_ratio")
            .withColumn("name_similarity", BL.name_score(x, y, "_ratio")).drop("_ratio"))


def _score_blended(pairs: DataFrame, params: MatchParams) -> DataFrame:
    from placekit.functions.regions import city_equal_loose, state_equal_loose, zip_equal_digits
    if params.ignore_name:
        pairs = pairs.withColumn("name_similarity", F.lit(0.0))
    elif "name_similarity" not in pairs.columns:
        pairs = _blended_names(pairs, params)
    if params.include_address and params.geo_ignored:
        both = F.col("b_street_cmp").isNotNull() & F.col("a_street_cmp").isNotNull()
        same = F.col("b_street_cmp") == F.col("a_street_cmp")
        pairs = (_ratios(pairs, "b_street_cmp", "a_street_cmp", both & ~same, "_ratio")
                 .withColumn("address_similarity", F.when(~both, 0.0).when(same, 1.0).otherwise(F.col("_ratio")))
                 .withColumn("address_similarity", F.coalesce("address_similarity", F.lit(0.0))).drop("_ratio"))
    else:
        pairs = pairs.withColumn("address_similarity", F.lit(0.0))
    z = params.zip_column
    pairs = pairs.withColumn("_coord", coordinate_score("distance_miles"))
    conf = confidence("distance_miles", "name_similarity", "address_similarity",
                      city_equal_loose("b_city", "a_city"), state_equal_loose("b_territory", "a_territory"),
                      zip_equal_digits(f"b_{z}", f"a_{z}"), params, coord_score="_coord")
    pairs = pairs.withColumn("confidence", conf).drop("_coord")
    keep = F.col("confidence") >= F.lit(params.min_confidence)
    if not params.ignore_name:
        keep = keep & (F.col("name_similarity") >= F.lit(params.min_name_similarity))
    return pairs.filter(keep)


def _score(pairs: DataFrame, params: MatchParams) -> DataFrame:
    """Add name/street similarity and confidence; apply both thresholds."""
    if params.similarity == "blended":
        return _score_blended(pairs, params)
    if params.ignore_name:
        pairs = pairs.withColumn("name_similarity", F.lit(0.0))
    elif "name_similarity" not in pairs.columns:
        pairs = pairs.withColumn("name_similarity", similarity_of_forms("b_name_cmp", "a_name_cmp"))
    if params.include_address and params.geo_ignored:
        street = similarity_of_forms("b_street_cmp", "a_street_cmp")
    else:
        street = F.lit(0.0)
    pairs = (pairs.withColumn("address_similarity", street)
                  .withColumn("_coord", coordinate_score("distance_miles")))
    no = F.lit(False)
    conf = confidence("distance_miles", "name_similarity", "address_similarity",
                      no if params.ignore_city else forms_equal("b_city_cmp", "a_city_cmp"),
                      no if params.ignore_state else forms_equal("b_state_cmp", "a_state_cmp"),
                      no if params.ignore_zip else forms_equal("b_zip_cmp", "a_zip_cmp"),
                      params, coord_score="_coord")
    pairs = pairs.withColumn("confidence", conf).drop("_coord")
    keep = F.col("confidence") >= F.lit(params.min_confidence)
    if not params.ignore_name:
        keep = keep & (F.col("name_similarity") >= F.lit(params.min_name_similarity))
    return pairs.filter(keep)


def _finish(pairs: DataFrame, params: MatchParams, stage: int, reasons) -> DataFrame:
    return pairs.select(
        "b_row_id", "a_row_id", "b_seq", "a_seq", "distance_miles", "name_similarity",
        "address_similarity", "confidence", reasons.alias("reasons"),
        F.lit(not params.ignore_city).alias("city_match"),
        F.lit(not params.ignore_state).alias("state_match"),
        F.lit("").alias("geographic_warning"),
        F.lit(stage).alias("match_stage"))


def coordinate_cell_pairs(a: DataFrame, b: DataFrame, params: MatchParams) -> DataFrame:
    """Pairs sharing a truncated (lat, lon) cell within ``max_distance`` whose
    name similarity passes (unless names are ignored)."""
    p = params.coordinate_precision
    A = materialize(_side(a, "a_", params).filter(F.col("a_latitude").isNotNull() & F.col("a_longitude").isNotNull()))
    B = materialize(_side(b, "b_", params).filter(F.col("b_latitude").isNotNull() & F.col("b_longitude").isNotNull()))
    A = A.withColumn("_clat", coordinate_cell("a_latitude", p)).withColumn("_clon", coordinate_cell("a_longitude", p))
    B = B.withColumn("_clat", coordinate_cell("b_latitude", p)).withColumn("_clon", coordinate_cell("b_longitude", p))
    pairs = (blocked_join(A, B, ["_clat", "_clon"], _blocks(params)).drop("_clat", "_clon")
             .withColumn("distance_miles",
                         haversine_miles("b_latitude", "b_longitude", "a_latitude", "a_longitude"))
             .filter(F.col("distance_miles") <= F.lit(params.max_distance)))
    if not params.ignore_name:
        if params.similarity == "blended":
            pairs = _blended_names(pairs, params)
        else:
            pairs = pairs.withColumn("name_similarity", similarity_of_forms("b_name_cmp", "a_name_cmp"))
        pairs = pairs.filter(F.col("name_similarity") >= F.lit(params.min_name_similarity))
    return pairs.withColumn("match_type", F.lit("COORDINATE_EXACT")) \
                .withColumn("coordinate_precision", F.lit(p))


def exact_stage(a: DataFrame, b: DataFrame, params: MatchParams) -> DataFrame:
    pairs = _score(coordinate_cell_pairs(a, b, params), params)
    reason = F.lit(f"truncated_coordinates_{params.coordinate_precision}dp, coordinate_priority_match")
    return _finish(pairs, params, 1, reason)


def proximity_stage(a: DataFrame, b: DataFrame, exact: DataFrame, params: MatchParams) -> DataFrame:
    rem_a = _side(a, "a_", params).join(
        exact.select(F.col("a_row_id")).distinct(), "a_row_id", "left_anti")
    rem_b = _side(b, "b_", params).join(
        exact.select(F.col("b_row_id")).distinct(), "b_row_id", "left_anti")
    pairs = _score(_near(rem_a, rem_b, params), params)
    reason = F.concat(F.lit("coordinate_priority_proximity, distance_"),
                      F.format_string("%.3f", F.col("distance_miles")), F.lit("mi"))
    out = _finish(pairs, params, 2, reason)
    if not params.show_all_matches:
        # best candidate per B row: highest confidence, earliest A row on ties
        best = (out.groupBy("b_row_id")
                   .agg(F.min_by(F.struct(*out.columns),
                                 F.struct(-F.col("confidence"), F.col("a_seq"))).alias("m")))
        out = best.select("m.*")
    return out


def candidate_pairs(a: DataFrame, b: DataFrame, params: MatchParams) -> DataFrame:
    """Every pair that can pass either stage: within the reachable radius
    (both stages score alike, so no pair beyond it reaches the confidence
    threshold) and, unless names are ignored, with name similarity >= min.
    ``same_cell`` marks the pairs of the exact-cell stage."""
    return _candidates(_side(a, "a_", params), _side(b, "b_", params), params)


def _candidates(a: DataFrame, b: DataFrame, params: MatchParams) -> DataFrame:
    p = params.coordinate_precision
    pairs = _near(a, b, params).withColumn(
        "same_cell",
        (coordinate_cell("a_latitude", p) == coordinate_cell("b_latitude", p))
        & (coordinate_cell("a_longitude", p) == coordinate_cell("b_longitude", p)))
    if not params.ignore_name:
        if params.similarity == "blended":
            pairs = _blended_names(pairs, params)
        else:
            pairs = pairs.withColumn("name_similarity", similarity_of_forms("b_name_cmp", "a_name_cmp"))
        pairs = pairs.filter(F.col("name_similarity") >= F.lit(params.min_name_similarity))
    return pairs


def _classes(side: DataFrame, prefix: str) -> tuple[DataFrame, DataFrame]:
    """(classes, members): rows of one coordinate and equal comparison forms are one
    class, known by its smallest row id, because their pairs score alike.
    Members are (class, row id, seq)."""
    row, seq = f"{prefix}row_id", f"{prefix}seq"
    keys = [f"{prefix}latitude", f"{prefix}longitude", *[c for c in side.columns if c.endswith("_cmp")]]
    rows = side.select(row, seq, *keys).filter(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull())
    classes = rows.groupBy(*keys).agg(F.min(row).alias(row), F.min(seq).alias(seq))
    key = F.xxhash64(*[x for k in keys for x in (F.col(k).isNull(), F.col(k))])
    # two classes of one hash stay apart: the keys are compared as well
    named = classes.select(key.alias("_key"), F.struct(*keys).alias("_of"), F.col(row).alias(f"{prefix}class"))
    members = (rows.select(key.alias("_key"), F.struct(*keys).alias("_is"), row, seq)
                   .join(named, "_key").filter(F.col("_is").eqNullSafe(F.col("_of"))))
    return classes, members.select(f"{prefix}class", row, seq)


def _expanded(pairs: DataFrame, a_members: DataFrame, b_members: DataFrame) -> DataFrame:
    """Pairs of classes as pairs of their members."""
    columns = pairs.columns
    for prefix, members in (("a_", a_members), ("b_", b_members)):
        pairs = pairs.drop(f"{prefix}seq").withColumnRenamed(f"{prefix}row_id", f"{prefix}class")
        pairs = dealt_join(pairs, members, [f"{prefix}class"]).drop(f"{prefix}class")
    return pairs.select(*columns)


def match_places(a: DataFrame, b: DataFrame, params: MatchParams = PRODUCTION) -> DataFrame:
    """Matches between feed A (primary) and feed B (secondary).

    Inputs need ``row_id, seq, name, address1, latitude, longitude, city,
    territory``; output columns are :data:`PAIR_COLUMNS`.

    One grid join produces the candidates of both stages, so each feed is
    shuffled by location once: stage 1 is the same-cell subset; stage 2 is the
    rest minus pairs touching a row matched in stage 1 (filtering the small
    pair table is the same as filtering the inputs first).

    Where names do not count, nothing thins a place that very many rows share.
    There rows are compared as classes of equal coordinates and comparison forms, so
    the work of scoring grows with different places, and the pairs of classes
    are turned into pairs of rows at the end.
    """
    side_a, side_b = _side(a, "a_", params), _side(b, "b_", params)
    if params.ignore_name and params.similarity == "edit":
        (side_a, a_members), (side_b, b_members) = _classes(side_a, "a_"), _classes(side_b, "b_")
        expand = lambda pairs: _expanded(pairs, a_members, b_members)
    else:
        expand = lambda pairs: pairs
    cands = materialize(_candidates(side_a, side_b, params))
    exact = materialize(_finish(_score(cands.filter("same_cell"), params), params, 1, F.lit(
        f"truncated_coordinates_{params.coordinate_precision}dp, coordinate_priority_match")))
    rest = (cands.join(exact.select("a_row_id").distinct(), "a_row_id", "left_anti")
                 .join(exact.select("b_row_id").distinct(), "b_row_id", "left_anti"))
    reason = F.concat(F.lit("coordinate_priority_proximity, distance_"),
                      F.format_string("%.3f", F.col("distance_miles")), F.lit("mi"))
    prox = expand(_finish(_score(rest, params), params, 2, reason))
    if not params.show_all_matches:
        best = (prox.groupBy("b_row_id")
                    .agg(F.min_by(F.struct(*prox.columns),
                                  F.struct(-F.col("confidence"), F.col("a_seq"))).alias("m")))
        prox = best.select("m.*")
    # the pair table feeds every later stage (reports, merge, links): once
    return expand(exact).unionByName(prox)


def match_order(pairs: DataFrame) -> DataFrame:
    """Add ``match_ord``: the order in which the source system lists matches
    (stage 1 by B then A; stage 2 by B, confidence desc, A)."""
    neg_conf = F.when(F.col("match_stage") == 2, -F.col("confidence")).otherwise(F.lit(0.0))
    return pairs.withColumn("match_ord", F.struct(
        F.col("match_stage").alias("s"), F.col("b_seq").alias("b"),
        neg_conf.alias("c"), F.col("a_seq").alias("a")))
