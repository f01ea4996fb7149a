"""Repeated passages by hashes of content-selected positions, in place of a suffix array.

A passage of ``PASSAGE`` (50) words that stands in two places is a repeat; a
text's repeated words are those inside any such passage.  Words are those of
``words.py``, so case and punctuation don't matter.

1. Equal texts are one class: a text with copies repeats as a whole, and one
   of them goes on.
2. Positions are retained at content-selected positions: the smallest of each
   32 neighbouring eight-word hashes (minimisers), about one word in sixteen.  Each passage
   selects one by its first 39 words alone, wherever it stands, and the words from
   there on share at least 19 with those of the passage's other places.
3. The retained positions are grouped by the hash of these 19 words; those
   whose words stand nowhere else go.
4. Every passage that selects one of the others is hashed over its 50 words,
   and passages of the same hash are equal.
5. The matching passages of a text are joined to spans.

There is no suffix array: suffixes are not sorted, neighbours in an order are
not compared, and nothing is extended word by word.  Equal passages always
select equal positions, so grouping by hash finds the same passages; neighbours
in an order alone would miss one that shares its right side with suffixes of
other left contexts, and a sort by words would move all of them.

No step needs the rows of a group together: a hash that stands in two places
has a least and a greatest place.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placekit.llm.words import _powers, gram_hashes, hashed_words, mix
from placekit.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PASSAGE = 50
GRAM = 8
WINDOW = 32
SLICE_BYTES = 4 << 20


def run_hashes(h: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` word hashes from each position of ``at``, as a
    difference of one running sum."""
    up, down = _powers(max(len(h) + 1, 1))
    with np.errstate(over="ignore"):
        run = np.concatenate(([np.uint64(0)], np.cumsum(h * up[:len(h)])))
        return mix((run[at + size] - run[at]) * down[at] + np.uint64(size))


def selected(h: np.ndarray, counts: np.ndarray, passage: int = PASSAGE, gram: int = GRAM,
             window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Start of every passage inside a text, and the position that it selects:
    the leftmost smallest of its first ``window`` gram hashes (a power of 2)."""
    ends = np.cumsum(counts)
    starts = ends - counts
    room = np.maximum(counts - passage + 1, 0)
    s = np.repeat(starts - np.concatenate(([0], np.cumsum(room)[:-1])), room) + np.arange(room.sum())
    low = gram_hashes(h, gram)
    at = np.arange(len(low))
    step = 1
    while step < window and len(s):
        right = low[step:]
        less = right < low[:len(right)]
        at = np.where(less, at[step:], at[:len(right)])
        low = np.where(less, right, low[:len(right)])
        step *= 2
    return s, (at[s] if len(s) else s)


def _slices(texts):
    lo, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t or b"") > SLICE_BYTES:
            yield lo, k
            lo, size = k, 0
        size += len(t or b"")
    yield lo, len(texts)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64(text)).alias("did"),
                       F.xxhash64(text).alias("node"), text.cast("binary").alias("text"))


def retained_suffixes(ident: DataFrame, passage: int = PASSAGE) -> DataFrame:
    """(node, pos, head): the retained suffixes of every text; ``head`` is the hash of
    the words that all places of a passage share there."""
    shared = passage - WINDOW + 1

    def run(batches):
        for batch in batches:
            nodes = batch.column("node").to_numpy(zero_copy_only=False)
            texts = batch.column("text").to_pylist()
            for lo, hi in _slices(texts):
                h, counts = hashed_words(texts[lo:hi])
                _, p = selected(h, counts, passage)
                p = np.unique(p)
                owner = np.repeat(np.arange(hi - lo), counts)[p]
                first = np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[lo:hi][owner], pa.int64()), pa.array(p - first[owner], pa.int64()),
                     _signed(run_hashes(h, p, shared))], names=["node", "pos", "head"])

    return ident.select("node", "text").mapInArrow(run, "node bigint, pos bigint, head bigint")


def _word_counts(ident: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n = np.concatenate([hashed_words(texts[lo:hi])[1] for lo, hi in _slices(texts)])
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "did", "node")]
                                             + [pa.array(n, pa.int64())], names=["doc_id", "did", "node", "n_words"])

    kind = ident.schema["doc_id"].dataType.simpleString()
    return ident.mapInArrow(run, f"doc_id {kind}, did bigint, node bigint, n_words bigint")


def passages(picked: DataFrame, passage: int = PASSAGE) -> DataFrame:
    """From ``(node, text, at)``, one row per class with the positions of its remaining
    suffixes: (node, start, whole) of the passages that select one of them."""
    def run(batches):
        for batch in batches:
            nodes = batch.column("node").to_numpy(zero_copy_only=False)
            texts, at = batch.column("text").to_pylist(), batch.column("at")
            for lo, hi in _slices(texts):
                h, counts = hashed_words(texts[lo:hi])
                first = np.cumsum(counts) - counts
                chosen = np.zeros(len(h), bool)
                for k in range(lo, hi):
                    chosen[first[k - lo] + at[k].values.to_numpy()] = True
                s, p = selected(h, counts, passage)
                s = s[chosen[p]]
                owner = np.repeat(np.arange(hi - lo), counts)[s]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[lo:hi][owner], pa.int64()), pa.array(s - first[owner], pa.int64()),
                     _signed(run_hashes(h, s, passage))], names=["node", "start", "whole"])

    return picked.select("node", "text", "at").mapInArrow(run, "node bigint, start bigint, whole bigint")


def _spans(found: DataFrame, passage: int) -> DataFrame:
    """(node, spans, drop): the joined passages of each class, and of those
    that another class keeps."""
    def joined(starts: np.ndarray) -> list[dict]:
        if not len(starts):
            return []
        gap = np.flatnonzero(np.diff(starts) > passage)
        return [{"start": int(a), "end": int(b) + passage} for a, b in
                zip(starts[np.concatenate(([0], gap + 1))], starts[np.concatenate((gap, [len(starts) - 1]))])]

    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            spans, drop = [], []
            for starts, mine in zip(batch.column("starts"), batch.column("kept")):
                a = np.array(starts.values, np.int64)
                k = np.array(mine.values, bool)
                order = np.argsort(a)
                spans.append(joined(a[order]))
                drop.append(joined(a[order][~k[order]]))
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(spans, kind), pa.array(drop, kind)],
                                             names=["node", "spans", "drop"])

    lists = found.groupBy("node").agg(F.collect_list(F.struct("start", "kept")).alias("x")).select(
        "node", F.col("x.start").alias("starts"), F.col("x.kept").alias("kept"))
    span = "array<struct<start:bigint,end:bigint>>"
    return lists.mapInArrow(run, f"node bigint, spans {span}, drop {span}")


def repeated_passages(docs: DataFrame, passage: int = PASSAGE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_copies`` (rows
    of equal text), ``spans`` (first word and end of the maximal runs of repeated
    words; the whole text where it has copies) and ``drop`` (the part of them
    that a deduplication removes: whatever another text keeps).  Of equal
    texts the one with the smallest id stays; a passage stays in the class
    with the smallest hash, and a text's repeats of itself stay.

    Null, empty and shorter texts than a passage have no spans, with or
    without copies.  A document without id is known by the hash of its text;
    rows that repeat id and text stay together.  An empty table gives no rows; other columns
    are ignored.
    """
    ident = _identified(docs)
    classes = ident.groupBy("node").agg(F.min("did").alias("class_id"), F.count("*").alias("n_copies"))
    suffixes = materialize(retained_suffixes(ident, passage))
    place = F.xxhash64("node", "pos")
    heads = (suffixes.groupBy("head").agg(F.min(place).alias("a"), F.max(place).alias("b"))
                     .filter("a < b").select("head"))
    left = suffixes.join(heads, "head").groupBy("node").agg(F.collect_set("pos").alias("at"))
    picked = (ident.join(left.join(classes, "node").select("node", F.col("class_id").alias("did"), "at"),
                         ["node", "did"]).dropDuplicates(["node", "did"]))
    windows = materialize(passages(picked, passage))
    again = (windows.groupBy("whole").agg(F.count("*").alias("n"), F.min("node").alias("keeper"))
                    .filter("n > 1").select("whole", "keeper"))
    found = windows.join(again, "whole").select("node", "start", (F.col("node") == F.col("keeper")).alias("kept"))
    spans = _spans(found, passage).join(classes, "node", "right")
    rows = _word_counts(ident).join(spans, "node")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_words").alias("end")))
    copied = (F.col("n_copies") > 1) & (F.col("n_words") >= passage)
    return rows.select(
        "doc_id", "n_words", "n_copies",
        F.when(copied, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(copied & (F.col("did") != F.col("class_id")), whole).otherwise(F.coalesce("drop", none)).alias("drop"))


def op8_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    from placekit.sources.tables import table
    covered = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"])
    return repeated_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_copies", covered("spans").alias("n_repeated"), covered("drop").alias("n_dropped"),
        F.concat_ws(",", F.transform("spans", lambda x: F.concat_ws(":", x["start"], x["end"]))).alias("spans"))
