"""Session helpers.

On a cluster the session comes from the platform; ``get_spark`` only fills in
settings that are still unset, so cluster-level configuration always wins.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a job relies on. Each is applied only when the session does not
# already define it.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Keep the plan free of cross joins: every join in the library is keyed.
    "spark.sql.crossJoin.enabled": "false",
}


def get_spark(master: str | None = None, app_name: str = "placekit",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, or build a local one (tests, bench)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        spark = active
    else:
        builder = SparkSession.builder.appName(app_name)
        if master:
            builder = builder.master(master)
        builder = (builder
                   .config("spark.ui.enabled", "false")
                   .config("spark.ui.showConsoleProgress", "false")
                   .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
                   .config("spark.driver.memory", "8g"))
        if shuffle_partitions:
            builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        spark = builder.getOrCreate()
    conf = spark.conf
    for k, v in _DEFAULTS.items():
        if conf.get(k, None) is None:
            conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  Only a local session (tests, bench), where driver
    and tasks share one disk, gets a scratch folder when the setting is unset;
    a cluster session without it is an error, because other executors could
    not read what the driver's machine holds.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="placekit-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def materialize(df):
    """Cut lineage: write ``df`` as Parquet into the shared checkpoint folder
    and read it back.

    Used for tables that several later stages read (the match pairs, the
    brand dictionary), so their plans are computed once and survive lost
    executors; readers of the Parquet files still prune columns.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark):
    """What is written within removes its shuffle files as soon as it is written; else they
    stay until the driver happens to collect its garbage.  A data frame that is made
    within is not to be run twice."""
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVE_SHUFFLES)
        else:
            spark.conf.set(_REMOVE_SHUFFLES, before)


def discard(df) -> None:
    """Delete the files of a table that ``materialize`` returned.  Nothing that is
    still to be computed may read it; loops call this for the table of the round
    before."""
    path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._written_to)
    path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
