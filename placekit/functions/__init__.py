"""Column-expression rules used inside the jobs.

Every function here takes and returns :class:`pyspark.sql.Column` objects built
from built-in Spark functions, so the rules stay inside whole-stage codegen.
The only Python-evaluated rules (Ratcliff/Obershelp ratios) live in
:mod:`placekit.functions.blended` as Arrow-batched pandas UDFs.
"""

from placekit.functions.text import utrim, is_blank, edit_similarity
from placekit.functions.names import (
    strip_suffix, normalize_name, name_key, name_uuid, name_similarity,
    clean_business_name,
)
from placekit.functions.address import street_component, street_similarity
from placekit.functions.geo import (
    haversine_miles, coordinate_cell, coordinate_score, EARTH_RADIUS_MILES,
)
from placekit.functions.regions import (
    state_from_json, state_from_text, city_equal, state_equal, zip_equal,
    city_equal_loose, state_equal_loose, zip_equal_digits,
)

__all__ = [
    "utrim", "is_blank", "edit_similarity",
    "strip_suffix", "normalize_name", "name_key", "name_uuid", "name_similarity",
    "clean_business_name", "street_component", "street_similarity",
    "haversine_miles", "coordinate_cell", "coordinate_score", "EARTH_RADIUS_MILES",
    "state_from_json", "state_from_text", "city_equal", "state_equal", "zip_equal",
    "city_equal_loose", "state_equal_loose", "zip_equal_digits",
]
