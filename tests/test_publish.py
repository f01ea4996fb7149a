"""Snapshots change at once, and one job at a time publishes a mode."""

import pytest
from pyspark.sql import functions as F

from placekit.sources import io as IO
from placekit.sources import publish as P


def tables(spark, n):
    return {t: spark.range(n).select(F.col("id"), F.lit(f"{t}-{n}").alias("x")) for t in ("merchant", "atm", "links")}


def seen(spark, root, mode="M", date=None):
    out = {}
    for t in ("merchant", "atm", "links"):
        df = P.published(spark, root, t, mode, date)
        out[t] = None if df is None else sorted({(r["x"], df.count()) for r in df.select("x").distinct().collect()})
    return out


def test_readers_see_the_old_or_the_new_snapshot_whole(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert seen(spark, root) == {"merchant": None, "atm": None, "links": None}
    assert IO.publish_if_changed(tables(spark, 5), root, "M", "2024-01-01")
    old = seen(spark, root)
    assert old == {t: [(f"{t}-5", 5)] for t in old}

    def dies(self, a, b, move=P.Store.move, done=[]):  # noqa: B006
        if "/atm" in a:
            raise KeyboardInterrupt
        move(self, a, b)
    monkeypatch.setattr(P.Store, "move", dies)
    with pytest.raises(KeyboardInterrupt):
        IO.publish_if_changed(tables(spark, 8), root, "M", "2024-01-01")
    monkeypatch.undo()
    assert seen(spark, root) == old
    assert spark.read.parquet(f"{root}/atm").count() == 5
    # the next job clears what the dead one left, and plain readers see one snapshot again
    assert IO.publish_if_changed(tables(spark, 9), root, "M", "2024-01-01")
    assert seen(spark, root) == {t: [(f"{t}-9", 9)] for t in old}
    assert [spark.read.parquet(f"{root}/{t}").count() for t in old] == [9, 9, 9]
    assert P.Store(spark, root).names("_staging/M") == []
    # other dates and modes keep their own snapshots
    assert IO.publish_if_changed(tables(spark, 3), root, "M", "2024-01-02")
    assert IO.publish_if_changed(tables(spark, 2), root, "N", "2024-01-02")
    assert seen(spark, root, "M", "2024-01-01")["atm"] == [("atm-9", 9)]
    assert seen(spark, root)["atm"] == [("atm-3", 3)] and seen(spark, root, "N")["links"] == [("links-2", 2)]
    assert spark.read.parquet(f"{root}/atm").count() == 14


def test_one_job_publishes_a_mode(spark, tmp_path):
    root = str(tmp_path)
    with P.job_lock(spark, root, "M"):
        with pytest.raises(P.Locked):
            IO.publish_if_changed(tables(spark, 1), root, "M", "2024-01-01")
        with P.job_lock(spark, root, "N"):
            pass
    assert IO.publish_if_changed(tables(spark, 1), root, "M", "2024-01-01")  # given back


def test_old_locks_no_longer_count(spark, tmp_path):
    root, clock = str(tmp_path), [1000.0]
    first = P.job_lock(spark, root, "M", now=lambda: clock[0])
    owner = first.__enter__()
    clock[0] += P.LOCK_SECONDS - 1
    with pytest.raises(P.Locked), P.job_lock(spark, root, "M", now=lambda: clock[0]):
        pass
    clock[0] += 2
    with P.job_lock(spark, root, "M", now=lambda: clock[0]) as second:
        assert second != owner
        first.__exit__(None, None, None)  # the late owner does not take the new lock away
        with pytest.raises(P.Locked), P.job_lock(spark, root, "M", now=lambda: clock[0]):
            pass
    assert P.Store(spark, root).read("_locks/M") is None
