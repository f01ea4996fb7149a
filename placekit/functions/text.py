"""Generic string helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as the source system trims it: ASCII whitespace plus Unicode
# space separators.
_EDGE_WS = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utrim(c) -> Column:
    """Trim Unicode whitespace at both ends (``F.trim`` strips spaces only)."""
    return F.regexp_replace(col(c), _EDGE_WS, "")


def is_blank(c) -> Column:
    """Null, empty, or whitespace only."""
    c = col(c)
    return c.isNull() | (utrim(c) == F.lit(""))


def edit_similarity(a, b) -> Column:
    """1 - levenshtein / longer length; both empty -> 1.0, one empty -> 0.0."""
    a, b = col(a), col(b)
    la, lb = F.length(a), F.length(b)
    return (F.when((la == 0) & (lb == 0), F.lit(1.0))
             .when((la == 0) | (lb == 0), F.lit(0.0))
             .otherwise(F.lit(1.0) - F.levenshtein(a, b).cast("double")
                        / F.greatest(la, lb).cast("double")))
