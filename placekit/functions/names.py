"""Brand-name rules: suffix stripping, normalization, keys, ids, similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placekit.functions.text import col, utrim, is_blank, edit_similarity

# Fixed values that must equal the source system's rules.
# Suffixes stripped from brand names (first matching rule only); the first
# four compare case-insensitively, the last two case-sensitively.
SUFFIX_RULES_CASELESS = [" usd", " usa", "-usa", " us"]
SUFFIX_RULES_EXACT = ["®", "(Same Day Delivery)"]
# Manual aliases applied before building a name key.
NAME_ALIASES = {"Domino's Pizza": "Domino's"}
# Legal-form words dropped by the business-name cleaner, then leading articles.
LEGAL_FORM_WORDS = ["inc", "llc", "corp", "ltd", "co", "company", "corporation", "limited"]
LEADING_ARTICLES = ["the ", "a "]


def _suffix_pattern() -> str:
    caseless = "|".join(x.replace("-", "\\-") for x in SUFFIX_RULES_CASELESS)
    exact = "|".join("".join("\\" + ch if ch in "()" else ch for ch in x) for x in SUFFIX_RULES_EXACT)
    return f"(?i:{caseless})\\z|(?:{exact})\\z"


# A name ends with at most one of the suffixes, so one end-anchored
# alternation removes exactly the suffix of the first matching rule.
SUFFIX_PATTERN = _suffix_pattern()


def strip_suffix(name) -> Column:
    """Drop one known suffix, map the typographic apostrophe, then trim."""
    stripped = F.regexp_replace(col(name), SUFFIX_PATTERN, "")
    return utrim(F.regexp_replace(stripped, "’", "'"))


def name_compare_form(name) -> Column:
    """Per-row comparison form: lower-cased normalized name, null when blank."""
    n = col(name)
    return F.when(is_blank(n), F.lit(None).cast("string")).otherwise(F.lower(normalize_name(n)))


def similarity_of_forms(a, b) -> Column:
    """Edit similarity of two comparison forms; a null form scores 0.0."""
    a, b = col(a), col(b)
    return F.when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(edit_similarity(a, b))


def normalize_name(name) -> Column:
    """Suffix rule, then the HTML ampersand entity."""
    return F.regexp_replace(strip_suffix(name), "&amp;", "&")


def name_key(normalized) -> Column:
    """Dictionary key of a normalized name: alias, lower case, no apostrophes."""
    n = col(normalized)
    aliased = n
    for src, dst in NAME_ALIASES.items():
        aliased = F.when(n == F.lit(src), F.lit(dst)).otherwise(aliased)
    return F.regexp_replace(F.lower(aliased), "'", "")


def name_uuid(normalized) -> Column:
    """Deterministic id: first 16 bytes of SHA-256(UTF-8 name) printed as a UUID."""
    h = F.sha2(col(normalized), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4),
                       F.substring(h, 13, 4), F.substring(h, 17, 4),
                       F.substring(h, 21, 12))


def name_similarity(a, b) -> Column:
    """Edit similarity of the lower-cased normalized names; blank -> 0.0."""
    a, b = col(a), col(b)
    return (F.when(is_blank(a) | is_blank(b), F.lit(0.0))
             .otherwise(edit_similarity(F.lower(normalize_name(a)),
                                        F.lower(normalize_name(b)))))


def clean_business_name(name) -> Column:
    """Lower, punctuation to space, drop legal-form words, strip leading articles."""
    n = utrim(F.lower(col(name)))
    n = F.regexp_replace(n, r"(?U)[^\w\s]", " ")
    n = F.trim(F.regexp_replace(n, r"(?U)\s+", " "))
    words = F.filter(F.split(n, " "),
                     lambda w: ~w.isin(*LEGAL_FORM_WORDS) & (w != F.lit("")))
    n = F.array_join(words, " ")
    for art in LEADING_ARTICLES:
        n = F.when(n.startswith(art), F.substring(n, len(art) + 1, 1 << 30)).otherwise(n)
    n = F.trim(n)
    return F.when(col(name).isNull(), F.lit("")).otherwise(n)
