"""Blocking keys for pairs of similar names.

A pair passes if 1 - distance / longer length >= m, with the edit distance of the
two name forms.  Both blockings keep every passing pair, once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placekit.operators.joins import BLOCK_ROWS, dealt_join, hot_keys

# From this similarity on, names are blocked by their segments.
SEGMENTS_FROM = 0.85
# Rows of a cell, on either side, from which its names are cut in segments.
DENSE_ROWS = 256
# Whether a row's cell is so.
DENSE = "_dense"
_EPS = 1e-9


class LengthBands:
    """Geometric bands of the length: lengths of a passing pair are in ratio
    >= m, so their bands differ by at most one.  Empty forms have their own."""

    keys = ["_nb"]

    def __init__(self, m: float, build: str, probe: str):
        self.width = math.log(1.0 / m) * (1 + 1e-9)
        self.columns = build, probe

    def _band(self, name: Column) -> Column:
        length = F.length(name).cast("double")
        return F.when(length == 0, F.lit(-(1 << 40))).otherwise(F.floor(F.log(length) / F.lit(self.width))).cast("bigint")

    def build(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_nb", self._band(F.col(self.columns[0])))

    def probe(self, df: DataFrame) -> DataFrame:
        band = self._band(F.col(self.columns[1]))
        near = F.when(F.length(self.columns[1]) == 0, F.array(band)).otherwise(F.array(band - 1, band, band + 1))
        return df.withColumn("_nb", F.explode(near))

    def accept(self, pairs: DataFrame) -> DataFrame:
        return pairs


class Segments:
    """Segments of the name: a partition-based edit-distance join.

    A build form of length n has partners of at most floor(n / m) characters, so
    of at most e(n) = floor((1 - m) * floor(n / m)) edits, and is cut into e(n) + 1
    segments: one of them is untouched in any passing pair.  It then stands in
    the probe form, moved by x, where |x| + |x - d| is at most the
    edits allowed at these two lengths, d their difference.  Segments, with length and number, are the
    build side's keys; the substrings of the probe form at these places are the probe side's.
    A pair that shares several segments is kept at the first one, which
    is tested on the two names: no pair comes twice, and none needs a distinct.

    Only rows of dense cells (column ``DENSE``) are cut; in all others each row
    has one key.
    """

    keys = ["_seg"]

    def __init__(self, m: float, build: str, probe: str):
        self.m = m
        self.columns = build, probe

    def _edits(self, longer: Column) -> Column:
        return F.floor(F.lit(1.0 - self.m + _EPS) * longer).cast("int")

    def _number(self, n: Column) -> Column:
        return self._edits(F.floor(n / F.lit(self.m) + F.lit(_EPS))) + 1

    @staticmethod
    def _start(i: Column, n: Column, number: Column) -> Column:
        return F.floor(i * n / number).cast("int")

    def _places(self, i: Column, n: Column, number: Column, probe_length: Column):
        """Where segment i of a build form of n characters can start in a probe
        form: first and last offset, and the segment's length."""
        start, end = self._start(i, n, number), self._start(i + 1, n, number)
        d, e = probe_length - n, self._edits(F.greatest(probe_length, n))
        first = start - F.floor((e - d) / 2).cast("int")
        last = start + F.floor((e + d) / 2).cast("int")
        return F.greatest(first, F.lit(0)), F.least(last, probe_length - (end - start)), end - start

    def build(self, df: DataFrame) -> DataFrame:
        name = F.col(self.columns[0])
        df = df.withColumn("_len", F.length(name)).withColumn("_number", self._number(F.col("_len")))
        df = df.withColumn("_i", F.explode(F.when(F.col(DENSE), F.sequence(F.lit(0), F.col("_number") - 1))
                                            .otherwise(F.array(F.lit(0)))))
        start = self._start(F.col("_i"), F.col("_len"), F.col("_number"))
        end = self._start(F.col("_i") + 1, F.col("_len"), F.col("_number"))
        key = F.xxhash64("_len", "_i", F.substring(name, start + 1, end - start))
        return df.withColumn("_seg", F.when(F.col(DENSE), key).otherwise(F.lit(0))).drop("_len", "_number")

    def probe(self, df: DataFrame) -> DataFrame:
        name = F.col(self.columns[1])
        length = F.length(name)
        least = F.ceil(length * F.lit(self.m) - F.lit(_EPS)).cast("int")
        most = F.floor(length / F.lit(self.m) + F.lit(_EPS)).cast("int")

        def of_segment(n, number):
            def keys(i):
                first, last, size = self._places(i, n, number, length)
                at = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
                return F.transform(at, lambda p: F.xxhash64(n, i, F.substring(name, p + 1, size)))
            return keys

        def of_length(n):
            number = self._number(n)
            return F.flatten(F.transform(F.sequence(F.lit(0), number - 1), of_segment(n, number)))

        keys = F.array_distinct(F.flatten(F.transform(F.sequence(least, most), of_length)))
        some = F.when(name.isNull(), F.lit(None)).when(F.col(DENSE), keys).otherwise(F.array(F.lit(0).cast("bigint")))
        return df.withColumn("_seg", F.explode(some))

    def accept(self, pairs: DataFrame) -> DataFrame:
        build, probe = (F.col(c) for c in self.columns)
        n, length = F.length(build), F.length(probe)
        number = self._number(n)

        def shared(i):
            first, last, size = self._places(i, n, number, length)
            segment = F.substring(build, self._start(i, n, number) + 1, size)
            return (first <= last) & F.contains(F.substring(probe, first + 1, last - first + size), segment)

        first = F.get(F.filter(F.sequence(F.lit(0), F.col("_i")), shared), F.lit(0))
        fit = F.abs(n - length) <= self._edits(F.greatest(n, length))
        return pairs.filter(fit & (~F.col(DENSE) | (first == F.col("_i")))).drop("_i")


def name_blocks(m: float, build: str, probe: str):
    """The blocking for a similarity of at least ``m`` of two columns."""
    return (Segments if m >= SEGMENTS_FROM else LengthBands)(m, build, probe)


def blocked_join(build: DataFrame, probe: DataFrame, keys: list[str], blocking=None,
                 block: int = BLOCK_ROWS, dense_rows: int = DENSE_ROWS) -> DataFrame:
    """``build JOIN probe USING (keys)`` without the pairs that the blocking rules out.

    For segments one count pass over the cells finds the dense ones
    (``joins.hot_keys``, a table of bounded size), and only there names are cut.
    What is still hot then, one name of a dense cell, is dealt out in blocks.
    """
    if blocking is None:
        return dealt_join(build, probe, keys, block)
    among = None
    if isinstance(blocking, Segments):
        hot = F.broadcast(hot_keys(build, probe, keys, dense_rows).select(*keys, F.lit(True).alias(DENSE)))
        build, probe = (d.join(hot, keys, "left").withColumn(DENSE, F.col(DENSE).isNotNull()) for d in (build, probe))
        keys, among = [*keys, DENSE], F.col(DENSE)
    pairs = dealt_join(blocking.build(build), blocking.probe(probe), keys + blocking.keys, block, among)
    return blocking.accept(pairs).drop(DENSE, *blocking.keys)
