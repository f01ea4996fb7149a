"""Benchmark decontamination by Wu-Manber multi-pattern search.

Patterns are the windows of a benchmark: every run of 13 consecutive words of
an item, or the whole item where it has fewer (but some) words.  The symbols
searched are words, the blocks of the shift tables are pairs of words.
Patterns of one length share a table: a block that occurs in no pattern lets
the search jump by the pattern length less one, a block that ends a pattern
opens its suffix bucket, and the bucket's patterns are compared word by word.

The benchmark is the stated query set.  Its texts go to the tasks as
broadcasts of at most ``max_block_bytes`` each, its windows are compiled in
the tasks, and every document is searched against every block, so a benchmark
of any size is handled.  A task keeps ``RESIDENT`` compiled blocks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placekit.llm.batches import slices
from placekit.llm.words import word_list

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 13
MAX_BLOCK_BYTES = 16 << 20
RESIDENT = 4
SHARE = 20  # contaminated: at least one word in SHARE is hit


class Searcher:
    """Wu-Manber tables over word windows; ``items`` are (item_id, utf-8 text)."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int = WINDOW):
        by_length: dict[int, dict[tuple, set]] = {}
        for item_id, text in items:
            words = word_list(text)
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if words else 0):
                by_length.setdefault(size, {}).setdefault(tuple(words[i:i + size]), set()).add(item_id)
        self.tables = [self._table(m, patterns) for m, patterns in sorted(by_length.items())]

    @staticmethod
    def _table(m: int, patterns: dict[tuple, set]):
        width = min(2, m)  # words in a block
        shift: dict = {}
        buckets: dict = {}
        for p in patterns:
            for end in range(width, m + 1):
                block = p[end - width:end] if width == 2 else p[end - 1]
                shift[block] = min(shift.get(block, m), m - end)
            buckets.setdefault(p[-2:] if width == 2 else p[0], []).append(p)
        return m, width, shift, buckets, patterns

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans (first word, end) of the occurrences, and the items found."""
        spans: list[tuple[int, int]] = []
        items: set = set()
        n = len(words)
        for m, width, shift, buckets, patterns in self.tables:
            far = m - width + 1
            get = shift.get
            i = m - 1  # last word of the window under test
            while i < n:
                block = (words[i - 1], words[i]) if width == 2 else words[i]
                step = get(block, far)
                if step:
                    i += step
                    continue
                first = i - m + 1
                found = tuple(words[first:i + 1])
                for p in buckets[block]:
                    if p[0] == found[0] and p == found:
                        spans.append((first, i + 1))
                        items |= patterns[p]
                i += 1
        return spans, items


def _covered(spans: list[tuple[int, int]]) -> int:
    total, end = 0, 0
    for a, b in sorted(spans):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


OUT = pa.schema([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64()))])


def benchmark_blocks(benchmark: DataFrame, max_block_bytes: int = MAX_BLOCK_BYTES) -> Iterator[list]:
    """The benchmark's (item_id, text) rows in blocks of bounded bytes."""
    block, size = [], 0
    rows = benchmark.select("item_id", F.col("text").cast("binary").alias("text"))
    for r in rows.toLocalIterator():
        text = bytes(r["text"] or b"")
        if block and size + len(text) > max_block_bytes:
            yield block
            block, size = [], 0
        block.append((r["item_id"], text))
        size += len(text) + 64
    if block:
        yield block


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  max_block_bytes: int = MAX_BLOCK_BYTES, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: the ``keep`` columns, ``n_words``, ``n_hit``
    (words inside any occurrence of a window), ``items`` (ids with an
    occurring window, each once, sorted as strings) and ``contaminated``
    (``n_hit > 0 and 20 * n_hit >= n_words``).

    Null and empty texts have no words and are clean.  Items without words
    have no window.  Rows of an item id that repeats count as that item; a
    null item id is searched, its hits count, and it is not listed.  Repeated
    document rows each give a row.  An empty benchmark hits nothing.  Other
    columns of ``docs`` are ignored unless named in ``keep``.
    """
    found, names = _searched(docs, benchmark, window, max_block_bytes, keep)
    return found.select(*[F.col(n).alias(c) for n, c in zip(names, keep)],
                        "n_words", "n_hit", "items", _contaminated().alias("contaminated"))


def _contaminated():
    return (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))


def _searched(docs: DataFrame, benchmark: DataFrame, window: int, max_block_bytes: int, keep) -> tuple:
    spark = docs.sparkSession
    blocks = [spark.sparkContext.broadcast(b) for b in benchmark_blocks(benchmark, max_block_bytes)]
    kept = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
                       F.col("text").cast("binary").alias("text"))
    names = [f"k{i}" for i in range(len(keep))]

    def search(batches):
        ready: dict[int, Searcher] = {}

        def searcher(k):
            if k not in ready:
                if len(ready) >= RESIDENT:
                    ready.pop(next(iter(ready)))
                ready[k] = Searcher(blocks[k].value, window)
            return ready[k]

        for batch in slices(batches):
            texts = [word_list(t) for t in batch.column("text").to_pylist()]
            spans = [[] for _ in texts]
            items = [set() for _ in texts]
            for k in range(len(blocks)):
                s = searcher(k)
                for i, words in enumerate(texts):
                    got, which = s.find(words)
                    if got:
                        spans[i] += got
                        items[i] |= which
            cols = [pa.array(map(len, texts), pa.int64()), pa.array(map(_covered, spans), pa.int64()),
                    pa.array([sorted((x for x in s if x is not None), key=str) for s in items],
                             pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + cols,
                                             names=[*names, *OUT.names])

    schema = ", ".join(f"{n} {kept.schema[n].dataType.simpleString()}" for n in names)
    return kept.mapInArrow(search, f"{schema}, n_words bigint, n_hit bigint, items array<bigint>"), names


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged."""
    found, names = _searched(docs, benchmark, WINDOW, MAX_BLOCK_BYTES, docs.columns)
    return found.filter(~_contaminated()).select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])


def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    from placekit.sources.tables import table
    found = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"),
                          table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.col("items").cast("array<string>")).cast("binary"), 256)
         .alias("items_sha256"), "contaminated")


OP7_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), patterns AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS p
  FROM (SELECT item_id, w, least(13, len(w)) AS size, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
        FROM items WHERE len(w) > 0) x
), places AS (
  SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS p
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM patterns) s WHERE len(w) >= size) x
), found AS (SELECT r, size, i, item_id FROM places JOIN patterns USING (size, p)),
hits AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS word FROM found) x GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
          FROM (SELECT DISTINCT r, item_id FROM found WHERE item_id IS NOT NULL) x GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""
