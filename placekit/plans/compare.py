"""Comparison job: two place CSV files -> full comparison report.

The Spark form of the desktop comparison workflow: read both files, keep rows
with coordinates, match (blended profile by default), write the tiered
report as CSV and return the tier summary and the top high-confidence sample.
"""

from __future__ import annotations

import argparse
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placekit.operators import report as R
from placekit.operators.match import BLENDED, MatchParams, match_places
from placekit.session import get_spark, materialize
from placekit.sources.io import csv_place_scan


class Comparison(NamedTuple):
    report: DataFrame
    summary: DataFrame
    sample: DataFrame


def _keyed(df: DataFrame, salt: int) -> DataFrame:
    """Give scanned CSV rows a key and an order that depend on their content
    alone, not on how files are split: the hash of the row, then a counter of
    equal rows (which cannot be told apart)."""
    half = F.lit(1 << 62).cast("decimal(20,0)") * 2
    row = F.xxhash64(F.lit(salt), *[x for c in df.columns for x in (F.col(c).isNull(), F.col(c))])
    keyed = df.withColumn("_h", row)
    n = F.row_number().over(Window.partitionBy("_h").orderBy("_h"))
    key = ((F.col("_h").cast("decimal(20,0)") + half) * F.lit(10 ** 12) + n).cast("decimal(38,0)")
    return materialize(keyed.withColumn("row_id", key).withColumn("seq", key).drop("_h"))


def compare(a: DataFrame, b: DataFrame, params: MatchParams = BLENDED) -> Comparison:
    """``a`` is the primary feed, ``b`` the secondary; both need ``row_id``/``seq``."""
    a, b = R.valid_coordinates(a), R.valid_coordinates(b)
    m = materialize(match_places(a, b, params))
    rep = R.comparison_report(a, b, m)
    return Comparison(rep, R.match_tier_summary(rep), R.top_matches_sample(a, b, m))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Compare two place CSV files.")
    ap.add_argument("--a", required=True, help="primary place CSV (file or folder)")
    ap.add_argument("--b", required=True, help="secondary place CSV (file or folder)")
    ap.add_argument("--out", required=True, help="output folder for the report CSV")
    ap.add_argument("--max-distance", type=float, default=BLENDED.max_distance)
    ap.add_argument("--min-name", type=float, default=BLENDED.min_name_similarity)
    ap.add_argument("--min-confidence", type=float, default=BLENDED.min_confidence)
    args = ap.parse_args(argv)
    spark: SparkSession = get_spark()
    params = BLENDED.with_(max_distance=args.max_distance, min_name_similarity=args.min_name,
                           min_confidence=args.min_confidence)
    a = _keyed(csv_place_scan(spark, args.a), 0)
    b = _keyed(csv_place_scan(spark, args.b), 1)
    res = compare(a, b, params)
    res.report.write.mode("overwrite").option("header", True).csv(args.out)
    res.summary.show(truncate=False)
    res.sample.show(truncate=False)


if __name__ == "__main__":
    main()
