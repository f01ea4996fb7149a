"""Exact nearest neighbour on the sphere by a pyramid of cells.

Points are unit vectors, so poles and the antimeridian are no special cases, and the
chord between two vectors grows with their great-circle distance.  A cell of
level l is a cube of side 2**-l.

1. Places are counted per cell of each level, with one place of the cell as its
   representative.  Places of one coordinate are one place: the smallest label wins.
2. A point's smallest non-empty ancestor cell gives a representative, and its distance
   bounds that of the nearest place.
3. The cells of about the bound's size that the ball of that radius touches, 27 at most,
   are looked up.  A cell of more than ``LEAF`` places is replaced by its children, representatives
   tighten the bound, and cells beyond it go, until all are small.
4. The places of these cells are compared exactly.

No point meets more than a few cells of at most ``LEAF`` places, however dense the
table is elsewhere; all joins are on cells.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placekit.functions.geo import haversine_miles
from placekit.session import materialize

LEVELS = list(range(0, 19, 2))  # sides from an earth radius to about 80 feet
STEP = 2
LEAF = 64
# Room for rounding of vectors and chords; about a hundredth of an inch.
_SLACK = 1e-10
_AXES = ("x", "y", "z")


def _vector(df: DataFrame, lat: str, lon: str) -> DataFrame:
    la, lo = F.radians(lat), F.radians(lon)
    return df.withColumns({"x": F.cos(la) * F.cos(lo), "y": F.cos(la) * F.sin(lo), "z": F.sin(la)})


def _key(indexes: list[Column]) -> Column:
    """The cell's number from its index on each axis, 20 bits each."""
    i, j, k = (c.cast("bigint") for c in indexes)
    return F.shiftleft(i, 42).bitwiseOR(F.shiftleft(j, 21)).bitwiseOR(k)


def _index(key: Column, axis: int) -> Column:
    return F.shiftright(key, 42 - 21 * axis).bitwiseAND((1 << 21) - 1)


def _side(level: Column) -> Column:
    return F.pow(F.lit(2.0), -level)


def _at(value: Column, level: Column) -> Column:
    return F.floor((value + F.lit(1.0)) / _side(level))


def _in_all_levels(df: DataFrame) -> DataFrame:
    df = df.withColumn("level", F.explode(F.array(*[F.lit(n) for n in LEVELS])))
    return df.withColumn("cell", _key([_at(F.col(a), F.col("level")) for a in _AXES]))


def _chord(rep: str) -> Column:
    return F.sqrt(sum((F.pow(F.col(a) - F.col(f"{rep}.{a}"), 2) for a in _AXES), F.lit(0.0)))


def _gap2(level: Column, cell: Column) -> Column:
    """The square of a point's distance to a cell."""
    total = F.lit(0.0)
    for n, a in enumerate(_AXES):
        low = _index(cell, n) * _side(level) - F.lit(1.0)
        total = total + F.pow(F.greatest(low - F.col(a), F.col(a) - low - _side(level), F.lit(0.0)), 2)
    return total


def _touched(df: DataFrame) -> DataFrame:
    """A row for each cell that a point's ball of radius ``bound`` touches, at the
    level whose cells are the smallest not smaller than it."""
    fit = F.floor(-F.log2(F.greatest(F.col("bound"), F.lit(1e-9))) / STEP).cast("int") * STEP
    df = df.withColumn("level", F.least(F.greatest(fit, F.lit(LEVELS[0])), F.lit(LEVELS[-1])))
    most = F.floor(F.pow(F.lit(2.0), F.col("level") + 1))
    for a in _AXES:
        ends = [F.greatest(F.lit(0), F.least(most, _at(F.col(a) + F.lit(s) * F.col("bound"), F.col("level")))) for s in (-1, 1)]
        df = df.withColumn(f"i{a}", F.explode(F.sequence(*ends)))
    return df.withColumn("cell", _key([F.col(f"i{a}") for a in _AXES])).drop(*[f"i{a}" for a in _AXES])


def candidates(points: DataFrame, places: DataFrame, point=("lat", "lon"), place=("plat", "plon"),
               label=("city", "state"), leaf: int = LEAF) -> DataFrame | None:
    """(point, place, label) pairs among which each point's nearest place is; None
    without places."""
    some = places.filter(F.col(place[0]).isNotNull() & F.col(place[1]).isNotNull())
    some = some.groupBy(*place).agg(F.min(F.struct(*label)).alias("label"))
    some = materialize(_in_all_levels(_vector(some, *place)))
    pyramid = materialize(some.groupBy("level", "cell").agg(
        F.count("*").alias("n"), F.min(F.struct("x", "y", "z")).alias("rep")))
    top = pyramid.filter(F.col("level") == LEVELS[0]).select("rep").first()
    if top is None:
        return None
    own = ["x", "y", "z"]
    start = materialize(_vector(points.select(*point), *point))
    # the smallest non-empty ancestor; a point without one takes any place
    seen = (_in_all_levels(start).join(pyramid.select("level", "cell", "rep"), ["level", "cell"])
            .groupBy(*point).agg(F.max_by("rep", "level").alias("rep")))
    anywhere = F.struct(*[F.lit(top["rep"][a]).alias(a) for a in own])
    bounded = start.join(seen, list(point), "left").withColumn("rep", F.coalesce("rep", anywhere))
    bounded = bounded.withColumn("bound", _chord("rep") * F.lit(1 + 1e-9) + F.lit(_SLACK)).drop("rep")

    def inside(df):
        return df.filter(_gap2(F.col("level"), F.col("cell")) <= F.pow("bound", 2))

    front = inside(_touched(bounded)).join(pyramid, ["level", "cell"])
    front = materialize(front.select(*point, *own, "bound", "level", "cell", "n"))
    small = (F.col("n") <= leaf) | (F.col("level") == LEVELS[-1])
    parent = _key([F.shiftright(_index(F.col("cell"), n), STEP) for n in range(3)])
    children = pyramid.filter(F.col("level") > LEVELS[0]).select(
        (F.col("level") - STEP).alias("level"), parent.alias("cell"), F.col("cell").alias("child"), "n", "rep")
    done = front.filter(small)
    while True:
        large = front.filter(~small)
        if large.isEmpty():
            break
        below = large.drop("n").join(children, ["level", "cell"]).withColumn("near", _chord("rep"))
        tighter = below.groupBy(*point).agg(F.min("near").alias("near"))
        below = below.drop("near", "rep", "cell").join(tighter, list(point))
        below = below.withColumn("bound", F.least("bound", F.col("near") * F.lit(1 + 1e-9) + F.lit(_SLACK))).drop("near")
        below = below.withColumn("level", F.col("level") + STEP).withColumnRenamed("child", "cell")
        front = materialize(inside(below).select(*point, *own, "bound", "level", "cell", "n"))
        done = done.unionByName(front.filter(small))
    return done.select(*point, "level", "cell").join(some.select("level", "cell", *place, "label"), ["level", "cell"])


def nearest_places(points: DataFrame, places: DataFrame, point=("lat", "lon"), place=("plat", "plon"),
                   label=("city", "state"), leaf: int = LEAF) -> DataFrame:
    """For each row of ``points`` (distinct, no nulls): ``near``, the struct of the
    distance in miles and the labels of its nearest place, ties by the labels.
    With no places (null coordinates do not count) there are no rows."""
    found = candidates(points, places, point, place, label, leaf)
    if found is None:
        kinds = ", ".join(f"{c}: string" for c in label)
        return points.select(*point, F.lit(None).cast(f"struct<distance: double, {kinds}>").alias("near")).limit(0)
    return found.groupBy(*point).agg(F.min(F.struct(
        haversine_miles(*place, *point).alias("distance"), *[F.col(f"label.{c}").alias(c) for c in label])).alias("near"))
