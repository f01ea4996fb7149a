"""Standardization and quality jobs over place tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placekit.functions.address import street_component
from placekit.functions.names import clean_business_name
from placekit.functions.regions import CITY_ABBREVIATIONS, state_from_json, state_from_text
from placekit.functions.text import utrim
from placekit.operators.joins import left_join_nonnull
from placekit.operators.nearest_place import nearest_places

# Coordinate column names recognised by the geocoding job.
LATITUDE_NAMES = ["latitude", "Latitude", "LATITUDE"]
LONGITUDE_NAMES = ["longitude", "lng", "Lng", "Longitude", "LNG", "LONGITUDE"]


def standardize_states(df: DataFrame, col: str = "territory") -> DataFrame:
    """Both state rules: from a JSON value (null for empty) and from text
    (falls back to the original value)."""
    return (df.withColumn("state_from_json", state_from_json(F.col(col)))
              .withColumn("state_from_text", state_from_text(F.col(col))))


def with_street_component(df: DataFrame, col: str = "address1") -> DataFrame:
    return df.withColumn("street", street_component(F.col(col)))


def clean_business_names(df: DataFrame, col: str = "name") -> DataFrame:
    return df.withColumn("clean_name", clean_business_name(F.col(col)))


def standardize_cities(df: DataFrame, col: str = "city") -> DataFrame:
    """Lower-cased trimmed city with the word abbreviations applied in order."""
    c = F.lower(utrim(F.col(col)))
    for full, short in CITY_ABBREVIATIONS:
        c = F.replace(c, F.lit(full), F.lit(short))
    return df.withColumn("city_std", c)


def _last_named(columns: list[str], names: list[str]) -> str | None:
    """The last of the columns that has one of these names."""
    return max((c for c in columns if c in names), key=columns.index, default=None)


def detect_coordinate_columns(df: DataFrame) -> tuple[str, str]:
    """(latitude column, longitude column) by name; of several the last one counts."""
    found = tuple(_last_named(df.columns, names) for names in (LATITUDE_NAMES, LONGITUDE_NAMES))
    if None in found:
        raise ValueError(f"no latitude/longitude columns among {df.columns}")
    return found


def round_half_up(c, digits: int):
    """Round on the binary value: floor(x * 10^d + 0.5) / 10^d."""
    f = float(10 ** digits)
    return F.floor(c * F.lit(f) + F.lit(0.5)) / F.lit(f)


def gazetteer_enrich(df: DataFrame, gazetteer: DataFrame, digits: int = 3) -> DataFrame:
    """Add ``corrected_city`` / ``corrected_state`` from the gazetteer place
    nearest to the coordinates rounded to ``digits``.

    Lookups are done once per distinct rounded coordinate (the work grows
    with distinct locations, not rows), in a pyramid of cells
    (``nearest_place``).  Rows without coordinates, and all rows of an empty
    gazetteer, get ``''``.
    """
    lat, lon = detect_coordinate_columns(df)
    rows = df.withColumn("_rlat", round_half_up(F.col(lat), digits)) \
             .withColumn("_rlon", round_half_up(F.col(lon), digits))
    pts = rows.select("_rlat", "_rlon").filter(F.col("_rlat").isNotNull() & F.col("_rlon").isNotNull()).distinct()
    g = gazetteer.select("city", "state", F.col("lat").alias("_glat"), F.col("lon").alias("_glon"))
    best = nearest_places(pts, g, ("_rlat", "_rlon"), ("_glat", "_glon")).select(
        "_rlat", "_rlon", F.col("near.city").alias("_city"), F.col("near.state").alias("_state"))
    out = left_join_nonnull(rows, best, ["_rlat", "_rlon"])
    return (out.withColumn("corrected_city", F.coalesce(F.col("_city"), F.lit("")))
               .withColumn("corrected_state", F.coalesce(F.col("_state"), F.lit("")))
               .drop("_rlat", "_rlon", "_city", "_state"))
