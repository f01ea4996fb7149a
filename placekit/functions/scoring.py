"""Match confidence (coordinate-priority scoring)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placekit.functions.geo import DISTANCE_TIERS, FAR_SCORE, coordinate_score
from placekit.functions.text import col


def _blend(coord, name, street, ignore_name: bool, geo_ignored: bool):
    if ignore_name:
        return coord * 0.7 + street * 0.3 if geo_ignored else coord
    return coord * 0.5 + name * 0.3 + street * 0.2 if geo_ignored else coord * 0.6 + name * 0.4




def confidence(distance, name_sim, street_sim, city_match, state_match, zip_match,
               params, coord_score=None) -> Column:
    """Confidence of one candidate pair under ``params`` (a MatchParams).

    ``coord_score`` may name a column already holding the coordinate score
    (keeps the generated code small when the expression is large).
    """
    geo_ignored = params.ignore_city or params.ignore_state or params.ignore_zip
    coord = col(coord_score) if coord_score is not None else coordinate_score(col(distance))
    name = F.lit(1.0) if params.ignore_name else col(name_sim)
    s = col(street_sim)
    street = F.when(s > 0, s).otherwise(F.lit(0.0)) if geo_ignored else F.lit(0.0)
    conf = _blend(coord, name, street, params.ignore_name, geo_ignored)
    conf = conf if isinstance(conf, Column) else F.lit(conf)
    bonus = F.lit(0.0)
    if not params.ignore_city:
        bonus = bonus + F.when(col(city_match), F.lit(0.05)).otherwise(F.lit(0.0))
    if not params.ignore_state:
        bonus = bonus + F.when(col(state_match), F.lit(0.05)).otherwise(F.lit(0.0))
    if not params.ignore_zip:
        bonus = bonus + F.when(col(zip_match), F.lit(0.02)).otherwise(F.lit(0.0))
    final = F.least(conf + bonus, F.lit(1.0))
    return (F.when(coord < 0.5, F.least(final, F.lit(0.4)))
             .when(coord < 0.7, F.least(final, F.lit(0.6)))
             .otherwise(final))


def reachable_radius(params) -> float:
    """Largest distance at which a pair can still reach ``min_confidence``.

    Pairs beyond it fail the confidence threshold whatever their names and
    streets, so the radius join can use it instead of ``max_distance``
    without changing results.
    """
    geo_ignored = params.ignore_city or params.ignore_state or params.ignore_zip
    bonus = ((0.0 if params.ignore_city else 0.05) + (0.0 if params.ignore_state else 0.05)
             + (0.0 if params.ignore_zip else 0.02))
    best = 0.0
    tiers = DISTANCE_TIERS + [(float("inf"), FAR_SCORE)]
    for bound, score in tiers:
        top = min(_blend(score, 1.0, 1.0, params.ignore_name, geo_ignored) + bonus, 1.0)
        if score < 0.5:
            top = min(top, 0.4)
        elif score < 0.7:
            top = min(top, 0.6)
        if top >= params.min_confidence - 1e-9:
            best = bound
    return min(params.max_distance, best)
