"""Snapshot-change jobs: keyed diffs, snapshot selection, content fingerprints."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placekit.functions.names import normalize_name
from placekit.functions.text import utrim

KeyFn = Callable[[DataFrame], Column]


class Diff(NamedTuple):
    new: DataFrame       # rows of ``curr`` whose key is absent from ``prev``
    removed: DataFrame   # rows of ``prev`` whose key is absent from ``curr``


def _key(df: DataFrame, key) -> Column:
    if callable(key):
        return key(df)
    if isinstance(key, str):
        return F.col(key)
    return key


def keyed_diff(prev: DataFrame, curr: DataFrame, key, drop_null_keys: bool = False) -> Diff:
    """Rows whose key has no partner on the other side; duplicates are kept
    and original values returned.  A null key compares equal to a null key
    unless ``drop_null_keys`` (then null-key rows are never reported)."""
    p = prev.withColumn("_dk", _key(prev, key))
    c = curr.withColumn("_dk", _key(curr, key))
    if drop_null_keys:
        p, c = p.filter(F.col("_dk").isNotNull()), c.filter(F.col("_dk").isNotNull())
    pk = p.select(F.col("_dk").alias("_ok")).distinct()
    ck = c.select(F.col("_dk").alias("_ok")).distinct()
    return Diff(_absent(c, pk).drop("_dk"), _absent(p, ck).drop("_dk"))


def _absent(side: DataFrame, other_keys: DataFrame) -> DataFrame:
    """Rows of ``side`` whose key ``_dk`` is not among ``other_keys._ok``
    (null equals null).  Null-key rows are not shuffled: whether the other
    side has a null key is a marker of at most one row, broadcast."""
    has = side.filter(F.col("_dk").isNotNull())
    nonnull = has.join(other_keys.filter(F.col("_ok").isNotNull()),
                       has["_dk"] == other_keys["_ok"], "left_anti")
    marker = other_keys.filter(F.col("_ok").isNull()).limit(1)
    nulls = side.filter(F.col("_dk").isNull())
    nulls = nulls.join(F.broadcast(marker), nulls["_dk"].eqNullSafe(marker["_ok"]), "left_anti")
    return nonnull.unionByName(nulls)


def row_diff(prev: DataFrame, curr: DataFrame) -> Diff:
    """Whole-row strategy: a row is new/removed when no identical row exists."""
    cols = list(curr.columns)
    other = lambda df: df.select(*[F.col(c).alias("_o_" + c) for c in cols]).distinct()
    return Diff(curr.join(other(prev), _all_eq(cols), "left_anti"),
                prev.join(other(curr), _all_eq(cols), "left_anti"))


def _all_eq(cols) -> Column:
    cond = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col("_o_" + c))
        cond = e if cond is None else cond & e
    return cond


def _fmt4(c: str) -> Column:
    return F.coalesce(F.format_string("%.4f", F.col(c)), F.lit("null"))


# Diff strategies by name (the source system's comparison options).
STRATEGIES: dict[str, KeyFn] = {
    "merchantId": lambda df: F.col("merchantId"),
    "name": lambda df: utrim(F.lower(F.col("name"))),
    "location": lambda df: F.concat(F.coalesce(F.col("latitude").cast("string"), F.lit("null")), F.lit("_"),
                                    F.coalesce(F.col("longitude").cast("string"), F.lit("null"))),
    "composite": lambda df: F.concat(F.coalesce(utrim(F.lower(F.col("name"))), F.lit("null")), F.lit("_"),
                                     _fmt4("latitude"), F.lit("_"), _fmt4("longitude")),
}


def diff_by_strategy(prev: DataFrame, curr: DataFrame, strategy: str = "composite") -> Diff:
    """Diff place snapshots by a named strategy; ``all`` compares whole rows.
    Unknown names fall back to ``merchantId``.  Null keys are never reported."""
    if strategy == "all":
        return row_diff(prev, curr)
    return keyed_diff(prev, curr, STRATEGIES.get(strategy, STRATEGIES["merchantId"]), drop_null_keys=True)


def _whole_row(df: DataFrame) -> Column:
    """A string that two rows share if they are identical, nulls included."""
    cols = []
    for f in df.schema.fields:
        kind, c = f.dataType.simpleString(), F.col(f.name)
        if kind in ("float", "double"):
            c = c + F.lit(0.0)  # one zero
        elif kind.startswith("timestamp"):
            c = c.cast("string")  # JSON has no microseconds
        cols.append(c.alias(f.name))
    return F.to_json(F.struct(*cols))


def diff_by_strategies(prev: DataFrame, curr: DataFrame, strategies=(*STRATEGIES, "all")) -> DataFrame:
    """The rows that ``diff_by_strategy`` reports for each of the strategies, with
    ``strategy`` and ``kind`` (``new`` or ``removed``), in one pass.

    Both snapshots are one table with a side flag, exploded to (strategy, key).
    One grouped count, partial in the map tasks, gives the keys that only one side has; these are
    the changes, mostly few, and rows are only looked up in them.  A key that a
    third of all rows share is one entry of each map task."""
    columns = curr.columns
    both = (prev.select(*columns).withColumn("_side", F.lit(1))
                .unionByName(curr.withColumn("_side", F.lit(2))))
    rows = both.drop("_side")
    entries = F.array(*[F.struct(F.lit(name).alias("strategy"), key.cast("string").alias("_dk")) for name, key in (
        (n, _whole_row(rows) if n == "all" else STRATEGIES[n](rows)) for n in strategies)])
    each = both.withColumn("_e", F.explode(entries)).select(*columns, "_side", "_e.strategy", "_e._dk")
    each = each.filter(F.col("_dk").isNotNull())
    one_sided = each.groupBy("strategy", "_dk").agg(F.bit_or("_side").alias("_sides")).filter(F.col("_sides") != 3)
    return each.join(one_sided, ["strategy", "_dk"]).select(
        "strategy", F.when(F.col("_side") == 2, "new").otherwise("removed").alias("kind"), *columns)


def new_removed_brands(prev_names: DataFrame, curr_names: DataFrame, normalized: bool,
                       name_col: str = "name") -> Diff:
    """Brand-name changes over distinct non-null names; ``normalized`` compares
    normalized names (feed B), otherwise verbatim (feed A)."""
    p = prev_names.select(name_col).filter(F.col(name_col).isNotNull()).distinct()
    c = curr_names.select(name_col).filter(F.col(name_col).isNotNull()).distinct()
    key = (lambda df: normalize_name(F.col(name_col))) if normalized else name_col
    return keyed_diff(p, c, key)


SNAPSHOT_PATTERN = r"^(?:.*/)?([A-Za-z]+)-([A-Z]+)-(\d{4}-\d{2}-\d{2})\.db$"


def latest_snapshot(snapshots: DataFrame, today, prefix: str = "locations",
                    name_col: str = "name") -> DataFrame:
    """Per mode, the snapshot with the latest parsable date other than ``today``."""
    n = F.col(name_col)
    parsed = snapshots.select(
        n.alias("name"),
        F.regexp_extract(n, SNAPSHOT_PATTERN, 1).alias("_prefix"),
        F.regexp_extract(n, SNAPSHOT_PATTERN, 2).alias("mode"),
        F.try_to_date(F.regexp_extract(n, SNAPSHOT_PATTERN, 3), "yyyy-MM-dd").alias("snapshot_date"))
    ok = parsed.filter((F.col("_prefix") == prefix) & F.col("snapshot_date").isNotNull()
                       & (F.col("snapshot_date") != F.to_date(F.lit(str(today)))))
    best = ok.groupBy("mode").agg(F.max_by("name", "snapshot_date").alias("name"),
                                  F.max("snapshot_date").alias("snapshot_date"))
    return best


def content_fingerprint(df: DataFrame, method: str = "sha2") -> DataFrame:
    """Order-independent fingerprint: row count, XOR and sum of a 48-bit row hash.

    ``sha2`` hashes a delimited text form of the row (portable across engines);
    ``xxhash64`` uses Spark's native hash (cheaper, Spark-only); it skips
    nulls, so each column brings whether it is null.
    """
    if method == "xxhash64":
        h = F.xxhash64(*[x for c in df.columns for x in (F.col(c).isNull(), F.col(c))])
        v = F.shiftright(h, 16)
    else:
        text = F.concat_ws("\u001f", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000"))
                                       for c in df.columns])
        v = F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("bigint")
    return df.select(v.alias("_h")).agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.bit_xor("_h"), F.lit(0)).cast("bigint").alias("hash_xor"),
        F.coalesce(F.sum(F.col("_h").cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("hash_sum"))
