"""Publishing a set of tables as one snapshot.

The tables lie under ``root/<table>/mode=.../snapshot_date=...``.  What a
snapshot consists of is said by one record of the manifest, the list of its
files, so the set changes from one moment to the next:

1. under the lock of the mode, every table is written to a hidden staging folder;
2. the staged files move to their partitions, under names of their own;
3. one new manifest file, written by one task and put in place by a rename, commits the snapshot;
4. files of the partition that the manifest does not name any more are deleted.

``published`` reads the files of the newest manifest record.  A job that dies before step 3 leaves
the snapshot before it whole; what it has left is deleted by the next one.
"""

from __future__ import annotations

import json
import time
import uuid
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: after so many seconds a lock that was not taken away no longer counts.
LOCK_SECONDS = 600

_MANIFEST = ("table string, row_count bigint, hash_xor bigint, hash_sum string, files array<string>, "
             "published_at timestamp")


class Locked(RuntimeError):
    """Another job publishes this mode."""


class Store:
    """A folder of the file system that Spark uses for it."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self.root = root.rstrip("/")
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self._path("").getFileSystem(conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        """The visible files of a folder; none if it is not there."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        found = [s.getPath().getName() for s in self._fs.listStatus(path) if s.isFile()]
        return sorted(n for n in found if not n.startswith(("_", ".")))

    def move(self, old: str, new: str) -> None:
        target = self._path(new)
        self._fs.mkdirs(target.getParent())
        if not self._fs.rename(self._path(old), target):
            raise OSError(f"cannot move {old} to {new} under {self.root}")

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def create(self, name: str, text: str) -> bool:
        """Make a file that must not exist; false if it does."""
        path = self._path(name)
        self._fs.mkdirs(path.getParent())
        try:
            out = self._fs.create(path, False)
        except Exception as e:  # a Py4J error with the Java exception's name
            if "FileAlreadyExists" in str(e) or "already exists" in str(e):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def read(self, name: str) -> str | None:
        path = self._path(name)
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


@contextmanager
def job_lock(spark: SparkSession, root: str, mode: str, seconds: float = LOCK_SECONDS, now=time.time):
    """Hold the lock of a mode, or raise ``Locked``.  A lock older than ``seconds``
    was left by a job that died, and is replaced."""
    store, name, owner = Store(spark, root), f"_locks/{mode}", uuid.uuid4().hex

    def held():
        text = store.read(name)
        try:
            return json.loads(text) if text else None
        except ValueError:  # being written just now, or cut off: as new as can be
            return {"owner": "?", "created": now()}

    mine = json.dumps({"owner": owner, "created": now()})
    if not store.create(name, mine):
        other = held()
        if other is not None and now() < other["created"] + seconds:
            raise Locked(f"{mode} is being published by {other['owner']}")
        store.delete(name)
        if not store.create(name, mine):  # someone else was faster
            raise Locked(f"{mode} is being published")
    try:
        yield owner
    finally:
        other = held()
        if other is not None and other["owner"] == owner:
            store.delete(name)


def _partition(table: str, mode: str, date: str) -> str:
    return f"{table}/mode={mode}/snapshot_date={date}"


def read_manifest(spark: SparkSession, root: str) -> DataFrame | None:
    """All manifest records; None if nothing has been published."""
    try:
        m = spark.read.option("mergeSchema", True).parquet(f"{root.rstrip('/')}/_manifest")
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return m if "files" in m.columns else m.withColumn("files", F.lit(None).cast("array<string>"))


def newest(spark: SparkSession, root: str, mode: str, date: str | None = None) -> list:
    """The manifest's rows of the newest snapshot of a mode, or of a mode and date."""
    m = read_manifest(spark, root)
    if m is None:
        return []
    m = m.filter(F.col("mode") == mode)
    if date is not None:
        m = m.filter(F.col("snapshot_date").cast("string") == date)
    last = m.agg(F.max("published_at").alias("t")).first()["t"]
    return [] if last is None else m.filter(F.col("published_at") == last).collect()


def published(spark: SparkSession, root: str, table: str, mode: str, date: str | None = None) -> DataFrame | None:
    """A table of the newest committed snapshot of a mode (of a date, if given); None
    without one."""
    for r in newest(spark, root, mode, date):
        if r["table"] == table and r["files"] is not None:
            base = f"{root.rstrip('/')}/{table}"
            return spark.read.option("basePath", base).parquet(*[f"{root.rstrip('/')}/{f}" for f in r["files"]])
    return None


def commit_snapshot(tables: dict, root: str, mode: str, date: str, fingerprints: dict) -> None:
    """Replace the snapshot of a mode and date by ``tables``, all at once for
    readers of ``published``.  The caller holds the lock.  ``fingerprints`` has (rows, xor, sum) for each table."""
    spark = next(iter(tables.values())).sparkSession
    store, number = Store(spark, root), uuid.uuid4().hex
    staging = f"_staging/{mode}"
    store.delete(staging)  # of a job that died
    for r in newest(spark, root, mode, date):
        if r["files"] is not None:  # files that no manifest names: the same
            folder = _partition(r["table"], mode, date)
            for n in store.names(folder):
                if f"{folder}/{n}" not in r["files"]:
                    store.delete(f"{folder}/{n}")
    before = {name: store.names(_partition(name, mode, date)) for name in tables}
    for name, df in tables.items():
        df.write.parquet(f"{store.root}/{staging}/{number}/{name}")
    files = {}
    for name in tables:
        folder = _partition(name, mode, date)
        staged = store.names(f"{staging}/{number}/{name}")
        files[name] = [f"{folder}/{number}-{n}" for n in staged]
        for n, f in zip(staged, files[name]):
            store.move(f"{staging}/{number}/{name}/{n}", f)
    when = datetime.now(timezone.utc)
    rows = [(name, *fingerprints[name], files[name], when) for name in tables]
    (spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        .withColumn("mode", F.lit(mode)).withColumn("snapshot_date", F.lit(date))
        .write.mode("append").partitionBy("mode", "snapshot_date").parquet(f"{store.root}/_manifest"))
    for name, old in before.items():
        for n in old:
            store.delete(f"{_partition(name, mode, date)}/{n}")
    store.delete(f"{staging}/{number}")
