"""Great-circle distance and coordinate cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placekit.functions.text import col

# Fixed value: the source system's earth radius in miles.
EARTH_RADIUS_MILES = 3959.0

# Distance tiers (miles, inclusive upper bound) and their
# coordinate scores; anything farther scores the last value.
DISTANCE_TIERS = [(0.01, 1.0), (0.03, 0.95), (0.05, 0.85), (0.1, 0.7), (0.2, 0.5), (0.5, 0.3)]
FAR_SCORE = 0.1


def haversine_miles(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in miles; the inner term is clipped to [0, 1]."""
    lat1, lon1, lat2, lon2 = col(lat1), col(lon1), col(lat2), col(lon2)
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = (F.pow(F.sin(dlat / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2))
    a = F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0))
    return F.lit(2 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(a))


def coordinate_cell(c, precision: int) -> Column:
    """Truncation cell of a coordinate: ``floor(x * 10^p)`` as BIGINT.

    Equal cells <=> equal truncated values ``floor(x * 10^p) / 10^p``.
    """
    return F.floor(col(c) * F.lit(float(10 ** precision))).cast("bigint")


def coordinate_score(distance) -> Column:
    d = col(distance)
    expr = None
    for bound, score in DISTANCE_TIERS:
        expr = (F.when(d <= bound, F.lit(score)) if expr is None
                else expr.when(d <= bound, F.lit(score)))
    return expr.otherwise(F.lit(FAR_SCORE))
