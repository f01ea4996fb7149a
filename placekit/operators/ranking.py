"""Skew-safe ranking within groups.

``row_number() OVER (PARTITION BY key ORDER BY o)`` sends every row of a key
to one task, so a key that holds a large share of the rows serializes the
job.  Here rows are range-partitioned on ``(key, o)`` instead - a hot key is
spread over many partitions - and ranked locally per (partition, key).  The
rank is the local rank plus the number of rows of the key in earlier
partitions, from a small per-(partition, key) count table.  The locally
ranked rows are checkpointed once, so both uses see one partition assignment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_within(df: DataFrame, key: str, order: str, out: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row within its ``key`` by
    ``order`` (ties must not occur; ``order`` should be unique per key)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, F.col(key), F.col(order))
                .withColumn("_pid", F.spark_partition_id()))
    local = ranged.withColumn(
        "_lr", F.row_number().over(Window.partitionBy("_pid", key).orderBy(order)))
    # Range bounds come from sampling, which depends on the input's row order;
    # pin the partition ids once so the counts below see the same assignment.
    from placekit.session import materialize
    local = materialize(local)
    counts = local.groupBy("_pid", key).agg(F.count("*").alias("_n"))
    # rows of the key in earlier partitions; one row per (partition, key)
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(
            Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0))).drop("_n")
    return (local.join(offsets, ["_pid", key])
                 .withColumn(out, (F.col("_off") + F.col("_lr")).cast("int"))
                 .drop("_pid", "_lr", "_off"))
