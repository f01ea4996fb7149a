"""Street-address rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placekit.functions.text import col, utrim, is_blank, edit_similarity


def _looks_like_zip(part: Column) -> Column:
    # digits once dashes are removed, 5 or 10 characters long
    return (F.regexp_replace(part, "-", "").rlike(r"^\p{Nd}*$")
            & F.length(part).isin(5, 10))


def _two_letters(part: Column) -> Column:
    return part.rlike(r"^\p{L}{2}$")


def street_component(address) -> Column:
    """Street part of a one-line address: the first comma component, trimmed.

    The one case where zip/state stripping changes the first component is an
    address of exactly two components, ``<two letters>, <zip>``: it yields ``""``.
    """
    a = utrim(col(address))
    parts = F.split(a, ",")
    first = utrim(F.try_element_at(parts, F.lit(1)))
    second = utrim(F.try_element_at(parts, F.lit(2)))
    only_state_zip = (F.size(parts) == 2) & _looks_like_zip(second) & _two_letters(first)
    return F.when(only_state_zip, F.lit("")).otherwise(first)


def _normalize_street(s: Column) -> Column:
    s = F.regexp_replace(F.lower(s), r"[^\w\s]", " ")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def street_compare_form(address) -> Column:
    """Per-row comparison form of the street; null when it cannot be compared."""
    a = col(address)
    s = street_component(a)
    return (F.when(is_blank(a) | is_blank(s), F.lit(None).cast("string"))
             .otherwise(_normalize_street(s)))


def street_similarity(addr1, addr2) -> Column:
    """Edit similarity of the normalized street components; blank -> 0.0."""
    a1, a2 = col(addr1), col(addr2)
    s1, s2 = street_component(a1), street_component(a2)
    return (F.when(is_blank(a1) | is_blank(a2), F.lit(0.0))
             .when(is_blank(s1) | is_blank(s2), F.lit(0.0))
             .otherwise(edit_similarity(_normalize_street(s1), _normalize_street(s2))))
