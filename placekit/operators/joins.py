"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

# Rows of one key, on either side, that a task should meet at most.
BLOCK_ROWS = 4096
# Most keys that are dealt out; the table of them is broadcast.
MOST_KEYS = 4096


def left_join_nonnull(big: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """``big LEFT JOIN small USING (keys)`` without shuffling null keys.

    A row with a null key can never find a partner, but a shuffled join still
    hashes all of them to one partition; when many rows lack the key (online
    places have no coordinates, unnamed rows no name key) that partition holds
    them all.  Those rows bypass the join and get null right-side columns.
    """
    has_keys = None
    for k in keys:
        c = F.col(k).isNotNull()
        has_keys = c if has_keys is None else has_keys & c
    joined = big.filter(has_keys).join(small, keys, "left")
    rest = big.filter(~has_keys)
    for f in small.schema.fields:
        if f.name not in keys:
            rest = rest.withColumn(f.name, F.lit(None).cast(f.dataType))
    return joined.unionByName(rest)


def hot_keys(left: DataFrame, right: DataFrame, keys: list[str], block: int) -> DataFrame:
    """The keys with more than ``block`` rows on a side, and into how many blocks
    each side is dealt: one count pass, partial in the map tasks.

    Of these the ``MOST_KEYS`` with the most pairs are taken.  That bounds
    the table, and any other key has at most one in ``MOST_KEYS`` of all pairs.
    """
    sides = [d.groupBy(*keys).agg(F.count("*").alias("_n")).select(
        *keys, (F.col("_n") if s == 0 else F.lit(0)).alias("_ln"), (F.col("_n") if s == 1 else F.lit(0)).alias("_rn"))
        for s, d in enumerate((left, right))]
    both = sides[0].unionByName(sides[1]).groupBy(*keys).agg(F.sum("_ln").alias("_ln"), F.sum("_rn").alias("_rn"))
    hot = both.filter((F.greatest("_ln", "_rn") > block) & (F.least("_ln", "_rn") > 0))
    hot = hot.orderBy(F.desc(F.col("_ln").cast("double") * F.col("_rn"))).limit(MOST_KEYS)
    blocks = [F.ceil(F.col(c) / F.lit(block)).cast("int").alias(c) for c in ("_ln", "_rn")]
    return hot.select(*keys, *blocks)


def dealt_join(left: DataFrame, right: DataFrame, keys: list[str], block: int = BLOCK_ROWS, among=None) -> DataFrame:
    """``left JOIN right USING (keys)``, a hot key dealt out over many tasks.

    A hot key's rows get a block by the hash of the whole row, so a task that
    runs again deals them alike, and go once to each block of the other side: every
    pair meets in exactly one (key, left block, right block).  All other
    keys have one block.  The join sorts and merges: with a broadcast side a few
    tasks would make all pairs of a hot key.
    """
    hot = F.broadcast(hot_keys(left, right, keys, block))

    def deal(d, own, n_own, other, n_other):
        whole = [c for c in d.columns if not isinstance(d.schema[c].dataType, MapType)]
        d = d.join(hot, keys, "left")
        at = F.when(F.col(n_own).isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(F.lit(5), *whole), F.col(n_own)).cast("int"))
        # rows of all other keys pass a generator over one element
        to = F.when(F.col(n_other).isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col(n_other) - 1))
        return d.withColumn(own, at).withColumn(other, F.explode_outer(to)).drop("_ln", "_rn")

    left = deal(left, "_lb", "_ln", "_rb", "_rn")
    right = deal(right, "_rb", "_rn", "_lb", "_ln")
    return left.join(right.hint("merge"), [*keys, "_lb", "_rb"]).drop("_lb", "_rb")
