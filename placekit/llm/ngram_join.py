"""N-gram Jaccard self-join with Bayesian candidate pruning.

Texts are sets of five-word shingles (words as in ``words.py``); a link joins
two different texts whose sets have a Jaccard similarity of 0.8 or more.

1. Equal texts are one class, known by the 64-bit hash of the text.
2. MinHash values in bands of five: texts that agree in a band may be linked.
   At 30 bands a pair of similarity 0.8 shares none with probability 7e-6.
3. The agreements, as links to the smallest class of each band value, are
   closed by a distributed union-find.  Any pair that shares a band lies in
   one such candidate group.
4. A group is dealt out in block pairs (``graph.block_pairs``), so a group of
   any size is compared by many tasks of bounded size.
5. In a cell, MinHash values are compared step by step.  With a uniform prior
   and m agreements among n values, the similarity has a Beta(m + 1, n - m + 1)
   posterior; a pair is dropped as soon as its probability of reaching the
   threshold falls below ``TOLERANCE``.  The survivors' shingle sets are
   intersected exactly.
6. A cell returns counts of links and a spanning forest of them, never pairs.
   The forests are closed by union-find again: these are the groups.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placekit.llm.graph import block_pairs, components
from placekit.llm.words import hashed_words, mix, shingles
from placekit.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 30, 5
STEP = 15  # MinHash values compared between two looks at the posterior
TOLERANCE = 1e-6
BLOCK = 96
COLUMNS = 4096  # shingles in one step of the exact intersection
SLICE_BYTES = 4 << 20


def coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed multipliers (odd) and offsets of ``n`` hash functions."""
    with np.errstate(over="ignore"):
        x = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x >> np.uint64(32)).astype(np.uint32)
    return x[:n] | np.uint32(1), x[n:]


def minhashes(grams: np.ndarray, number: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHash values of each text with shingles (a row of the result)."""
    a, b = coefficients(n)
    starts = np.concatenate(([0], np.cumsum(number)[:-1]))[number > 0]
    x = (grams >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), n), np.uint32)
    for j in range(n if len(starts) else 0):
        out[:, j] = np.minimum.reduceat(x * a[j] + b[j], starts)
    return out


def least_agreements(threshold: float, n: int, step: int, tolerance: float) -> dict[int, int]:
    """For each number of compared values the least number of agreements with
    which the posterior probability of the threshold is not below the
    tolerance.  P(J >= t | m of n) = P(Binomial(n + 1, t) <= m)."""
    out = {}
    for k in range(step, n + 1, step):
        total = 0.0
        for m in range(k + 1):
            total += math.comb(k + 1, m) * threshold ** m * (1 - threshold) ** (k + 1 - m)
            if total >= tolerance:
                out[k] = m
                break
    return out


def surviving(sig: np.ndarray, i: np.ndarray, j: np.ndarray, least: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j) of rows of ``sig`` that Bayesian pruning keeps."""
    same = np.zeros(len(i), np.int64)
    done = 0
    for upto, need in least.items():
        same += (sig[i, done:upto] == sig[j, done:upto]).sum(axis=1)
        ok = same >= need
        i, j, same, done = i[ok], j[ok], same[ok], upto
        if not len(i):
            break
    return i, j


def exact(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of shingle sets have a Jaccard similarity >= threshold."""
    used = np.unique(np.concatenate((i, j)))
    row = np.zeros(len(sets), np.int64)
    row[used] = np.arange(len(used))
    all_grams = np.concatenate([sets[k] for k in used])
    owner = np.repeat(np.arange(len(used)), [len(sets[k]) for k in used])
    _, column, count = np.unique(all_grams, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    column, owner = column[shared], owner[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((len(used), len(used)), np.float32)
    top = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, top, COLUMNS):
        lo, hi = np.searchsorted(column, (at, at + COLUMNS))
        m = np.zeros((len(used), COLUMNS), np.float32)
        m[owner[lo:hi], column[lo:hi] - at] = 1
        both += m @ m.T
    size = np.array([len(s) for s in sets], np.int64)
    inter = both[row[i], row[j]].astype(np.int64)
    # in integers where the threshold is a ratio of small ones: 0.8 is 4 / 5
    top_, bottom = float(threshold).as_integer_ratio() if threshold in (0.0, 0.5, 1.0) else _ratio(threshold)
    return (inter > 0) & (inter * bottom >= (size[i] + size[j] - inter) * top_)


def _ratio(x: float) -> tuple[int, int]:
    from fractions import Fraction
    f = Fraction(x).limit_denominator(10_000)
    return f.numerator, f.denominator


def _slices(texts: list[bytes | None]):
    lo, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t or b"") > SLICE_BYTES:
            yield lo, k
            lo, size = k, 0
        size += len(t or b"")
    yield lo, len(texts)


def band_values(texts: list[bytes | None], words: int, bands: int, rows: int) -> list:
    """The band values of each text; none for a text without words."""
    out: list = []
    for lo, hi in _slices(texts):
        grams, number = shingles(*hashed_words(texts[lo:hi]), words)
        sig = minhashes(grams, number, bands * rows).astype(np.uint64).reshape(-1, bands, rows)
        value = np.tile(np.arange(bands, dtype=np.uint64), (len(sig), 1))
        with np.errstate(over="ignore"):
            for r in range(rows):
                value = mix(value * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, r])
        got = iter(value.view(np.int64))
        out += [next(got) if n else None for n in number.tolist()]
    return out


def _identified(docs: DataFrame) -> DataFrame:
    """Class of equal texts and the document's id; a document without id is
    known by the hash of its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.xxhash64(text).alias("node"),
                       F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64(text)).alias("did"),
                       "doc_id", text.alias("text"))


def candidate_groups(ident: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(node, root) of the classes that share a band value with another one."""
    def sign(batches):
        for batch in batches:
            values = band_values(batch.column("text").to_pylist(), words, bands, rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(values, pa.list_(pa.int64()))], names=["node", "bands"])

    signed = materialize(ident.select("node", F.col("text").cast("binary").alias("text"))
                              .mapInArrow(sign, "node bigint, bands array<bigint>"))
    each = signed.select("node", F.explode("bands").alias("band"))
    shared = (each.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high"))
                  .filter("low < high").select("band", "low"))
    return components(each.join(shared, "band").select("node", "low"), "node", "low")


def _compare(sets: list[np.ndarray], cross: np.ndarray | None, threshold: float, n: int, least: dict):
    number = np.array([len(s) for s in sets])
    sig = np.zeros((len(sets), n), np.uint32)
    if number.any():
        sig[number > 0] = minhashes(np.concatenate(sets), number, n)
    i, j = np.triu_indices(len(sets), 1)
    ok = (number[i] > 0) & (number[j] > 0)
    if cross is not None:
        ok &= cross[i] != cross[j]
    i, j = surviving(sig, i[ok], j[ok], least)
    if len(i):
        ok = exact(sets, i, j, threshold)
        i, j = i[ok], j[ok]
    return i, j


def links(groups: DataFrame, texts: DataFrame, words: int = WORDS, threshold: float = THRESHOLD,
          n: int = BANDS * ROWS, tolerance: float = TOLERANCE, block: int = BLOCK) -> DataFrame:
    """From groups ``(node, root)`` and ``(node, text)``, one row per class
    each: partial rows ``(a, b, n)``: ``b`` null: class ``a`` has ``n`` links more; else a link
    (a, b) of a spanning forest."""
    cells = block_pairs(groups, "root", "node", block).join(texts, "node")
    least = least_agreements(threshold, n, STEP, tolerance)

    def work(rows: list[tuple]):
        nodes = np.array([r[1] for r in rows], np.int64)
        grams, number = shingles(*hashed_words([r[0] for r in rows]), words)
        sets = [np.unique(x) for x in np.split(grams, np.cumsum(number)[:-1])]
        cross = np.array([r[2] for r in rows]) if rows[0][3] else None
        i, j = _compare(sets, cross, threshold, n, least)
        if not len(i):
            return [], [], []
        count = np.bincount(np.concatenate((i, j)), minlength=len(rows))
        has = np.flatnonzero(count)
        a, b, c = nodes[has].tolist(), [None] * len(has), count[has].tolist()
        up = list(range(len(rows)))
        for x, y in zip(i.tolist(), j.tolist()):
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            while up[y] != y:
                up[y] = up[up[y]]
                y = up[y]
            if x != y:
                up[max(x, y)] = min(x, y)
                a.append(int(nodes[x]))
                b.append(int(nodes[y]))
                c.append(0)
        return a, b, c

    def run(batches):
        held, key = [], None
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            cols = [batch.column(c).to_pylist() for c in ("root", "lo", "hi", "node", "blk", "text")]
            for root, lo, hi, node, blk, text in zip(*cols):
                if (root, lo, hi) != key:
                    if len(held) > 1:
                        for o, x in zip(out, work(held)):
                            o += x
                    held, key = [], (root, lo, hi)
                held.append((text, node, blk, lo != hi))
            yield _links(out)
        if len(held) > 1:
            yield _links(work(held))

    def _links(out):
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b", "n"])

    dealt = (cells.withColumn("text", F.col("text").cast("binary"))
                  .repartition(F.col("root"), F.col("lo"), F.col("hi"))
                  .sortWithinPartitions("root", "lo", "hi", "node"))
    return dealt.select("root", "lo", "hi", "node", "blk", "text").mapInArrow(run, "a bigint, b bigint, n bigint")


def similar_groups(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``did`` (the id, or the text's
    hash where it is null), ``node`` (hash of the text: the class of equal
    texts), ``class_id`` (smallest ``did`` of the class), ``n_copies`` (rows of
    the class), ``n_links`` (other classes with a similarity of the threshold
    or more) and ``group_id`` (smallest ``did`` of all classes that links
    connect).

    A null text is an empty one.  A text of fewer than five words, but some,
    has one shingle; a text without words has no links, but equal texts are
    still one class.  Repeated rows each give a row and count as copies.  An
    empty table gives none.  Other columns are ignored.
    """
    ident = _identified(docs)
    classes = ident.groupBy("node").agg(F.min("did").alias("class_id"), F.count("*").alias("n_copies"))
    groups = candidate_groups(ident, words)
    groups = materialize(groups)
    one = groups.join(classes, "node").select("node", F.col("class_id").alias("did"))
    texts = (ident.select("node", "did", "text").join(one, ["node", "did"])
                  .dropDuplicates(["node", "did"]).select("node", "text"))
    found = materialize(links(groups, texts, words, threshold))
    number = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n_links"))
    joined = components(found.filter("b is not null"), "a", "b")
    heads = (joined.join(classes, "node").groupBy("root").agg(F.min("class_id").alias("group_id")))
    joined = joined.join(heads, "root").select("node", "group_id")
    info = (classes.join(number, "node", "left").join(joined, "node", "left")
                   .select("node", "class_id", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                           F.coalesce("group_id", "class_id").alias("group_id")))
    return ident.select("doc_id", "did", "node").join(info, "node").select(
        "doc_id", "did", "node", "class_id", "n_copies", "n_links", "group_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each group of near-duplicate documents stays, unchanged: the
    one with the smallest id (of repeated rows, one)."""
    keep = (similar_groups(docs).filter("did = group_id").select("node", "did").distinct())
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.xxhash64(text).alias("node"),
                       F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64(text)).alias("did"),
                       F.struct(*docs.columns).alias("row"))
    return rows.join(keep, ["node", "did"]).dropDuplicates(["node", "did"]).select("row.*")


def op4_ngram_join(spark, sf_dir: str) -> DataFrame:
    from placekit.sources.tables import table
    return (similar_groups(table(spark, sf_dir, "documents"))
            .select("doc_id", "class_id", "n_copies", "n_links", "group_id"))
