"""Hard-negative mining by a secondary-sort shuffle.

A row's score for an anchor is an exact integer inner product.  An anchor's
positives are the best rows of its label; for each positive the first
negatives (rows of other labels) in a window of shares of the positive's score
are wanted.

1. Rows and anchors are dealt out to cells of one block of rows and one block
   of anchors each: the anchors are the stated query set, and every row meets
   each of them in one cell.  A cell keeps the best positives of its block.
2. These are keyed by (anchor, descending score, id), brought together by anchor
   and sorted inside the partitions; a streaming pass keeps the first ones.
3. The anchors meet the rows once more, now with their windows.  Of each window
   a cell keeps the first negatives of its block: no others can be among the
   first of all.
4. Positives and negatives, keyed by (anchor, descending score, kind, id), are
   sorted in the shuffle again.  One pass over each partition opens a window at
   every positive and writes the negatives that fall in an open one, so a task
   holds the few open windows of one anchor, never its rows.

``repartition`` by the anchor with ``sortWithinPartitions`` is the DataFrame
form of repartitionAndSortWithinPartitions.  Equal copies of an anchor or
of a row are only rows of some blocks: no key grows with them but the anchor's own
few candidates per block.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part.  Rows of one id are one row, the smallest
(label, vector) of them.  Vectors of different length are read as if the shorter
one went on with zeros.  Scores that do not fit 64 bits are held at their bounds.
An anchor without positives, and an empty table, gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placekit.llm.vectors import best, matrix, meet, one_row_per_id, same_width, sorted_cells, usable
from placekit.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 256.0
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # a negative's score in hundredths of the positive's
BLOCK = 8192  # rows, and anchors, of a cell
_MOST = (1 << 63) - 1


def scaled(vectors) -> np.ndarray:
    """floor(256 x) of every component."""
    with np.errstate(over="ignore"):
        x = matrix(vectors)
        y = np.floor(SCALE * x)
    return y if np.isfinite(y).all() else np.array([[math.floor(c) * int(SCALE) if abs(c) > 2.0 ** 60 else math.floor(
        SCALE * c) for c in r] for r in x.tolist()], dtype=object)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers."""
    a, b = same_width(a, b)
    top = [int(abs(x).max()) if x.size else 0 for x in (a, b)]
    if top[0] * top[1] * a.shape[1] < 1 << 53 and a.dtype != object and b.dtype != object:
        return (a @ b.T).astype(np.int64)
    a, b = (np.array([[int(c) for c in r] for r in x.tolist()], dtype=object).reshape(x.shape) for x in (a, b))
    return np.clip(a @ b.T, -_MOST, _MOST).astype(np.int64)


def _best_positives(block, anchors):
    ids, labels = (block.column(c).to_numpy() for c in ("vec_id", "label"))
    rows = scaled(block.column("v"))
    score = products(scaled(anchors.column("v")), rows)
    out = []
    for i, (a, label) in enumerate(zip(anchors.column("vec_id").to_pylist(), anchors.column("label").to_pylist())):
        at = np.flatnonzero((labels == label) & (ids != a))
        at = at[best(score[i, at], ids[at], POSITIVES)]
        out.append((np.full(len(at), a), -score[i, at], ids[at]))
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)],
                                     ["anchor_id", "descending", "id"])


def _first_positives(batches):
    """The first rows of every anchor, in sorted batches, as a list."""
    now, found = None, []

    def row():
        return pa.RecordBatch.from_pylist([{"anchor_id": now, "windows": found}], schema=_WINDOWS)

    for b in batches:
        for a, d, i in zip(*(b.column(c).to_pylist() for c in ("anchor_id", "descending", "id"))):
            if a != now:
                if found:
                    yield row()
                now, found = a, []
            if len(found) < POSITIVES:
                found.append({"id": i, "score": -d})
    if found:
        yield row()


_WINDOWS = pa.schema([("anchor_id", pa.int64()), ("windows", pa.list_(pa.struct([("id", pa.int64()), ("score", pa.int64())])))])


def _window(score: int) -> tuple[int, int]:
    """The smallest and the largest score of a negative of a positive's window."""
    return -(-LOW * score // 100), HIGH * score // 100


def _first_negatives(block, anchors):
    ids, labels = (block.column(c).to_numpy() for c in ("vec_id", "label"))
    score = products(scaled(anchors.column("v")), scaled(block.column("v")))
    out = []
    for i, (a, label, windows) in enumerate(zip(*(anchors.column(c).to_pylist() for c in ("vec_id", "label", "windows")))):
        other = np.flatnonzero(labels != label)
        s, n, wanted = score[i, other], ids[other], set()
        for w in windows:
            low, high = _window(w["score"])
            at = np.flatnonzero((s >= low) & (s <= high))
            wanted.update(at[best(s[at], n[at], NEGATIVES)].tolist())
        at = np.fromiter(wanted, np.int64, len(wanted))
        out.append((np.full(len(at), a), -s[at], n[at]))
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)],
                                     ["anchor_id", "descending", "id"])


def _mined(batches):
    """Batches sorted by (anchor, descending score, kind, id): positives (kind 0)
    open windows, negatives are written for each window that they fall in."""
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    now, windows = None, []  # of the anchor: positive, its score, the window, negatives so far
    for b in batches:
        out = []
        for a, d, kind, i in zip(*(b.column(c).to_pylist() for c in ("anchor_id", "descending", "kind", "id"))):
            if a != now:
                now, windows = a, []
            if kind == 0:
                windows.append([i, -d, *_window(-d), 0])
                continue
            for w in windows:
                if w[4] < NEGATIVES and w[2] <= -d <= w[3]:
                    w[4] += 1
                    out.append((a, w[0], w[4], i, w[1], -d))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if n == "rank" else pa.int64()) for n, c in zip(names, zip(*out))], names)


_FOUND = "anchor_id long, descending long, id long"


def hard_negatives(vectors: DataFrame, anchors, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) for the rows of ``vectors`` (vec_id, v, label) that the
    condition ``anchors`` on vec_id selects."""
    rows = vectors.filter(usable(F.col("v")) & F.col("label").isNotNull())
    rows = materialize(one_row_per_id(rows.select("vec_id", F.col("label").cast("long").alias("label"), "v"), "label", "v"))
    number = rows.agg(F.count("*").alias("rows"), F.count(F.when(anchors, 1)).alias("anchors")).first()
    row_blocks, anchor_blocks = (max(1, math.ceil(number[c] / block)) for c in ("rows", "anchors"))

    def deal(d, n, own):
        return d.withColumn(own, F.pmod(F.xxhash64("vec_id"), F.lit(n)))

    def to_all(d, n, other):
        return d.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))

    spread = to_all(deal(rows, row_blocks, "rb"), anchor_blocks, "ab")
    asked = to_all(deal(rows.filter(anchors), anchor_blocks, "ab"), row_blocks, "rb")
    cells = sorted_cells(spread, asked, ["rb", "ab"])
    found = cells.mapInArrow(lambda batches: meet(batches, ["rb", "ab"], _best_positives), _FOUND)
    windows = (found.repartition("anchor_id").sortWithinPartitions("anchor_id", "descending", "id")
                    .mapInArrow(_first_positives, "anchor_id long, windows array<struct<id: long, score: long>>"))
    windows = materialize(windows)

    asked = asked.join(windows.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    none = F.lit(None).cast("array<struct<id: long, score: long>>")
    cells = sorted_cells(spread.withColumn("windows", none), asked, ["rb", "ab"])
    negatives = cells.mapInArrow(lambda batches: meet(batches, ["rb", "ab"], _first_negatives), _FOUND)
    positives = windows.select("anchor_id", F.explode("windows").alias("w")).select(
        "anchor_id", (-F.col("w.score")).alias("descending"), F.col("w.id").alias("id"), F.lit(0).alias("kind"))
    both = positives.unionByName(negatives.withColumn("kind", F.lit(1)))
    return (both.repartition("anchor_id").sortWithinPartitions("anchor_id", "descending", "kind", "id")
                .mapInArrow(_mined, "anchor_id long, positive_id long, rank int, negative_id long, "
                                    "positive_score long, negative_score long"))


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of the anchors, the rows whose vec_id is divisible by 100.
    Where vec_id is divisible by 7, the label is the next one."""
    from placekit.sources.tables import table
    e = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(e.select("vec_id", label.alias("label"), F.col("embedding").alias("v")),
                          F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id AS id,
         list_dot_product(a.e, r.e)::BIGINT AS score
  FROM v a JOIN v r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
