"""State, city and zip rules."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from placekit.functions.text import col, utrim, is_blank

# Abbreviation -> full name dictionary used to standardize
# states and provinces (US states, territories, Canadian provinces).
STATE_NAMES = {
    "AL": "Alabama", "AK": "Alaska", "AS": "American Samoa", "AZ": "Arizona",
    "AR": "Arkansas", "CA": "California", "CO": "Colorado", "CT": "Connecticut",
    "DE": "Delaware", "DC": "District Of Columbia",
    "FM": "Federated States Of Micronesia", "FL": "Florida", "GA": "Georgia",
    "GU": "Guam", "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois", "IN": "Indiana",
    "IA": "Iowa", "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine",
    "MH": "Marshall Islands", "MD": "Maryland", "MA": "Massachusetts",
    "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi", "MO": "Missouri",
    "MT": "Montana", "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire",
    "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York",
    "NC": "North Carolina", "ND": "North Dakota", "MP": "Northern Mariana Islands",
    "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PW": "Palau",
    "PA": "Pennsylvania", "PR": "Puerto Rico", "RI": "Rhode Island",
    "SC": "South Carolina", "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas",
    "UT": "Utah", "VT": "Vermont", "VI": "Virgin Islands", "VA": "Virginia",
    "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
    "ON": "Ontario", "QC": "Quebec", "NS": "Nova Scotia", "NB": "New Brunswick",
    "MB": "Manitoba", "BC": "British Columbia", "PE": "Prince Edward Island",
    "SK": "Saskatchewan", "AB": "Alberta", "NL": "Newfoundland and Labrador",
    "NT": "Northwest Territories", "YT": "Yukon", "NU": "Nunavut",
}
# Entries of the dictionary that are not one of the 50 US states
# (the loose state comparison maps only the 50 states' full names).
NON_STATE_ENTRIES = ["AS", "DC", "FM", "GU", "MH", "MP", "PW", "PR", "VI",
                     "ON", "QC", "NS", "NB", "MB", "BC", "PE", "SK", "AB", "NL",
                     "NT", "YT", "NU"]
# City word abbreviations, applied in this order as plain
# substring replacements.
CITY_ABBREVIATIONS = [("saint", "st"), ("mount", "mt"), ("fort", "ft"),
                      ("north", "n"), ("south", "s"), ("east", "e"), ("west", "w")]

FULL_STATE_TO_ABBR = {v.upper(): k for k, v in STATE_NAMES.items()
                      if k not in NON_STATE_ENTRIES}


def _literal_map(d: dict) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in d.items()))


def _lookup(d: dict, key: Column) -> Column:
    return F.try_element_at(_literal_map(d), key)


def _clean_state(c: Column) -> Column:
    return utrim(F.regexp_replace(c, ",", " "))


def state_from_json(state) -> Column:
    """Null/empty -> null; else dictionary name, falling back to the cleaned value."""
    s = col(state)
    t = _clean_state(s)
    return F.when(s.isNull() | (s == ""), F.lit(None).cast("string")) \
            .otherwise(F.coalesce(_lookup(STATE_NAMES, t), t))


def state_from_text(state) -> Column:
    """Dictionary name, falling back to the original (untrimmed) value."""
    s = col(state)
    return F.coalesce(_lookup(STATE_NAMES, _clean_state(s)), s)


def region_compare_form(c) -> Column:
    """Per-row form for the city/state rules: lower-cased trimmed value, null when blank."""
    c = col(c)
    return F.when(is_blank(c), F.lit(None).cast("string")).otherwise(F.lower(utrim(c)))


def zip_compare_form(c) -> Column:
    """Per-row form for the zip rule: first five characters, null when blank."""
    c = col(c)
    return F.when(is_blank(c), F.lit(None).cast("string")).otherwise(F.left(utrim(c), F.lit(5)))


def forms_equal(a, b) -> Column:
    return F.coalesce(col(a) == col(b), F.lit(False))


def _same_lower_trim(a: Column, b: Column) -> Column:
    return F.coalesce(~is_blank(a) & ~is_blank(b)
                      & (F.lower(utrim(a)) == F.lower(utrim(b))), F.lit(False))


def city_equal(a, b) -> Column:
    return _same_lower_trim(col(a), col(b))


def state_equal(a, b) -> Column:
    return _same_lower_trim(col(a), col(b))


def zip_equal(a, b) -> Column:
    a, b = col(a), col(b)
    return F.coalesce(~is_blank(a) & ~is_blank(b)
                      & (F.left(utrim(a), F.lit(5)) == F.left(utrim(b), F.lit(5))),
                      F.lit(False))


def _abbreviate_city(c: Column) -> Column:
    for full, short in CITY_ABBREVIATIONS:
        c = F.replace(c, F.lit(full), F.lit(short))
    return c


def city_equal_loose(a, b) -> Column:
    a, b = F.lower(utrim(col(a))), F.lower(utrim(col(b)))
    return F.coalesce((a == b) | (_abbreviate_city(a) == _abbreviate_city(b)), F.lit(False))


def state_equal_loose(a, b) -> Column:
    a, b = F.upper(utrim(col(a))), F.upper(utrim(col(b)))
    aa = F.coalesce(_lookup(FULL_STATE_TO_ABBR, a), a)
    bb = F.coalesce(_lookup(FULL_STATE_TO_ABBR, b), b)
    return F.coalesce((a == b) | (aa == bb), F.lit(False))


def zip_equal_digits(a, b) -> Column:
    a, b = F.left(utrim(col(a)), F.lit(5)), F.left(utrim(col(b)), F.lit(5))
    return F.coalesce(a.rlike(r"^\p{Nd}+$") & b.rlike(r"^\p{Nd}+$") & (a == b), F.lit(False))
