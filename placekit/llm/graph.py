"""Distributed helpers for similarity graphs: connected components and the
split of a large candidate group into block pairs.

Both use joins and grouped minima only; no group, link list or component is
gathered in one task or in the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placekit.session import discard, materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Union-find over an edge list: ``(node, root)`` with the smallest node
    of its component for every node that has an edge to another node.

    Alternating large-star and small-star rounds: every node links its larger
    neighbours, then its smaller ones, to the smallest node it knows, until
    nothing changes; the edges are then stars.  The minima are partial
    aggregates and the joins are plain equi-joins, so a hub node is split like
    any other hot join key.  Each round is written to the shared folder, and the
    round before it is deleted.
    Self-edges and nulls are ignored; an empty edge list gives no rows.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
              .filter(F.col("u") != F.col("v")).distinct())
    e = materialize(e)
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .filter("u != v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        before, e = e, materialize(small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                             .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        after = _state(e)
        discard(before)
        if after == state:
            break
        state = after
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
             .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count("*").alias("n"),
              F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def block_pairs(members: DataFrame, group: str, node: str, block: int) -> DataFrame:
    """Deal the members of each group out so that any two of them meet in
    exactly one ``(group, lo, hi)`` cell of about ``2 * block`` rows.

    A group of ``n`` members has ``ceil(n / block)`` blocks chosen by the
    node's hash; a member goes once to each pair that its block is part of.
    Adds ``lo``, ``hi`` and ``blk`` (the member's own block); two members are to be
    compared if ``lo = hi`` or their ``blk`` differ.  Groups of one are left out.
    """
    sizes = (members.groupBy(group).agg(F.count("*").alias("_n")).filter("_n > 1")
                    .select(group, F.ceil(F.col("_n") / block).cast("int").alias("_nb")))
    m = members.join(sizes, group)
    m = m.withColumn("blk", F.pmod(F.xxhash64(F.lit(7), F.col(node)), F.col("_nb")).cast("int"))
    m = m.withColumn("_c", F.explode_outer(F.sequence(F.lit(0), F.col("_nb") - 1)))
    return (m.withColumn("lo", F.least("blk", "_c")).withColumn("hi", F.greatest("blk", "_c"))
             .drop("_nb", "_c"))
