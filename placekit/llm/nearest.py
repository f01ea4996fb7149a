"""Approximate nearest neighbours by a hierarchical k-means tree.

1. Equal vectors are one class, known by its smallest id; only the smallest
   ``k + 1`` ids of a class can be among anyone's ``k`` nearest.  A vector that a
   third of all rows hold is compared once.
2. The tree is fitted by repeated k-means on the directions of at most ``SAMPLE``
   classes, the smallest by hash, and has at most ``MAX_LEAVES`` leaves: these two
   numbers bound what the driver holds and broadcasts.  Every class then goes down
   the tree to its leaf, in tasks.
3. A query walks the tree best bin first: a priority queue holds the branches
   not yet taken, by the distance of their centre; the nearest is opened next, and a
   leaf that is taken out is visited.
4. The number of visits is calibrated: for at most ``PROBES`` query classes the exact
   neighbours among all classes are known by one pass, and the visits are widened until the share of these
   neighbours that lies in visited leaves reaches ``RECALL``.  A query also goes on until its leaves hold enough
   classes for a whole answer.
5. Leaves are dealt out in blocks of about ``BLOCK`` classes, so a large leaf is many
   cells.  A query goes to every block of the leaves that it visits; blocks keep the best of theirs, and the
   best of these are the answer.

Scores are cosines in double precision, with both vectors scaled by a power of two, which is exact.

Defined results: rows with a null id, a null vector, a vector without length, or null
or non-finite components take no part.  Rows of one id are one row, the
smallest vector of them.  Vectors of different length are read as if the
shorter one went on with zeros.  With fewer than ``k`` other rows a query gets them
all; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placekit.llm.vectors import best, matrix, meet, one_row_per_id, same_width, sorted_cells, usable
from placekit.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NEAREST = 5
SAMPLE = 16384
MAX_LEAVES = 2048
LEAF = 256  # classes of a leaf, as long as MAX_LEAVES allows
BRANCH = 8
ROUNDS = 8  # of k-means at a node
PROBES = 256
RECALL = 0.97
BLOCK = 4096
SLACK = 1e-9  # of a product of unit vectors, before the exact score is taken


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by the power of two next to their largest component."""
    top = np.abs(x).max(axis=1, initial=0.0)
    return np.ldexp(x, -np.frexp(top)[1][:, None])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of one scaled vector with scaled rows; always summed in the same order."""
    return (rows * query).sum(axis=1) / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum()))


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = ROUNDS) -> np.ndarray:
    """For each row its cluster; empty clusters are left out."""
    centre = x[rng.choice(len(x), k, replace=False)]
    of = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        of = (x @ centre.T * -2 + (centre * centre).sum(axis=1)).argmin(axis=1)
        of = np.unique(of, return_inverse=True)[1]
        centre = _means(x, of)
    return of


def _means(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    order = np.argsort(of, kind="stable")
    starts = np.searchsorted(of[order], np.arange(of.max() + 1))
    return np.add.reduceat(x[order], starts) / np.bincount(of)[:, None]


class Tree:
    """Nodes with the centres of their children; node 0 is the root."""

    def __init__(self, x: np.ndarray, most: int, leaves: int, seed: int = 1):
        """Fit to unit vectors: nodes of more than ``most`` rows are split while
        there are fewer than ``leaves`` leaves."""
        rng = np.random.default_rng(seed)
        self.children: list[np.ndarray] = [np.empty(0, np.int64)]
        self.centres: list[np.ndarray] = [np.empty((0, x.shape[1]))]
        self.width = x.shape[1]
        open_nodes, count = [(-len(x), 0, np.arange(len(x)))], 1
        while open_nodes:
            size, node, rows = heapq.heappop(open_nodes)
            if -size <= most or count + BRANCH - 1 > leaves:
                break
            of = k_means(x[rows], min(BRANCH, len(rows)), rng)
            if of.max() == 0:
                continue
            self.centres[node] = _means(x[rows], of)
            self.children[node] = len(self.children) + np.arange(of.max() + 1)
            count += int(of.max())
            for c in range(of.max() + 1):
                self.children.append(np.empty(0, np.int64))
                self.centres.append(self.centres[0][:0])
                heapq.heappush(open_nodes, (-int((of == c).sum()), len(self.children) - 1, rows[of == c]))

    def fit_width(self, x: np.ndarray) -> np.ndarray:
        """Vectors as the tree sees them: longer ones lose what the sample did not have."""
        return np.pad(x, ((0, 0), (0, self.width - x.shape[1]))) if x.shape[1] < self.width else x[:, :self.width]

    def distances(self, node: int, x: np.ndarray) -> np.ndarray:
        c = self.centres[node]
        return (c * c).sum(axis=1) - 2 * (x @ c.T)

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf that unit vectors come to by the nearest centres."""
        x, leaf = self.fit_width(x), np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(self.children[node]) or not len(rows):
                leaf[rows] = node
                continue
            nearest = self.distances(node, x[rows]).argmin(axis=1)
            todo += [(int(c), rows[nearest == n]) for n, c in enumerate(self.children[node])]
        return leaf

    def visits(self, q: np.ndarray):
        """The leaves in the order in which best bin first comes to them."""
        q, queue = self.fit_width(q[None])[0], [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not len(self.children[node]):
                yield node
            else:
                for d, c in zip(self.distances(node, q).tolist(), self.children[node].tolist()):
                    heapq.heappush(queue, (d, c))


def classes(rows: DataFrame, k: int) -> DataFrame:
    """(rep, v, members) of the different vectors of ``rows`` (vec_id, v):
    the smallest id, and the ``k + 1`` smallest."""
    order = Window.partitionBy("v").orderBy("vec_id")
    first = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    return first.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("members")).select(
        F.get("members", F.lit(0)).alias("rep"), "v", "members")


def fit(cls: DataFrame, total: int, sample: int = SAMPLE, leaves: int = MAX_LEAVES, leaf: int = LEAF) -> Tree:
    """The tree over at most ``sample`` classes."""
    some = cls.select("v").orderBy(F.xxhash64(F.lit(11), "rep"), "rep").limit(sample).toArrow()
    x = unit(matrix(some.column("v")))
    wanted = min(leaves, -(-total // leaf), max(1, len(x) // BRANCH))
    return Tree(x, max(1, len(x) // wanted), leaves)


def _top(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    return rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k)


def _scored(queries: list[int], vectors: np.ndarray, batch, k: int):
    """(query, rep, leaf, score) of the best ``k`` rows of a batch for each query."""
    rows = scaled(matrix(batch.column("v")))
    vectors, rows = same_width(scaled(vectors), rows)
    near = unit(vectors) @ unit(rows).T
    reps, leaves = (batch.column(c).to_numpy() for c in ("rep", "leaf"))
    out = []
    for i, q in enumerate(queries):
        least = np.partition(near[i], len(rows) - k)[len(rows) - k] if len(rows) > k else -2.0
        at = np.flatnonzero(near[i] >= least - SLACK)
        score = cosines(vectors[i], rows[at])
        keep = best(score, reps[at], k)
        out.append((np.full(len(keep), q), reps[at[keep]], leaves[at[keep]], score[keep]))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query", "rep", "leaf", "score"])


def _condensed(batches, k: int, most: int = 1 << 18):
    """The best ``k`` rows of each query among the batches of a task.  Held rows are
    merged when there are ``most``; what is still many then goes out."""
    def merged(held):
        query, rep, leaf, score = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("query", "rep", "leaf", "score"))
        order = np.lexsort((rep, -score, query))
        q = query[order]
        new = np.concatenate(([True], q[1:] != q[:-1]))
        place = np.arange(len(q)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        order = order[place < k]
        return pa.RecordBatch.from_arrays([pa.array(c[order]) for c in (query, rep, leaf, score)], ["query", "rep", "leaf", "score"])

    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= most:
            held = [merged(held)]
            rows = held[0].num_rows
            if rows > most // 2:
                yield held[0]
                held, rows = [], 0
    if rows:
        yield merged(held)


_SCORED = "query long, rep long, leaf long, score double"


def calibrated_visits(index: DataFrame, probes: DataFrame, tree: Tree, k: int, recall: float) -> int:
    """The least number of leaf visits with which the probes' exact nearest
    classes, their own left out, are found at this rate."""
    asked = probes.select("rep", "v").toArrow()
    if not asked.num_rows:
        return 1
    ids, x = asked.column("rep").to_pylist(), matrix(asked.column("v"))
    held = index.sparkSession.sparkContext.broadcast((ids, x))
    scored = index.mapInArrow(lambda bs: _condensed((_scored(*held.value, b, k + 1) for b in bs if b.num_rows), k + 1), _SCORED)
    true = _top(scored.filter("query != rep"), k).select("query", "leaf").collect()  # k rows for each probe
    ranks = {q: {leaf: n for n, leaf in enumerate(tree.visits(u), 1)} for q, u in zip(ids, unit(x))}
    found = sorted(ranks[r["query"]][r["leaf"]] for r in true)
    return found[max(0, int(np.ceil(recall * len(found))) - 1)] if found else 1


def nearest(vectors: DataFrame, queries, k: int = NEAREST, recall: float = RECALL, sample: int = SAMPLE,
            leaves: int = MAX_LEAVES, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row of
    ``vectors`` (vec_id, v) that the condition ``queries`` on vec_id selects."""
    spark = vectors.sparkSession
    rows = vectors.filter(usable(F.col("v")) & F.exists("v", lambda x: x != 0))
    rows = materialize(one_row_per_id(rows, "v"))
    cls = materialize(classes(rows, k))
    total = cls.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = spark.sparkContext.broadcast(fit(cls, total, sample, leaves, leaf))

    def to_leaves(batches):
        for b in batches:
            if b.num_rows:
                at = tree.value.leaf_of(unit(matrix(b.column("v"))))
                yield pa.RecordBatch.from_arrays([b.column("rep"), b.column("v"), pa.array(at)], ["rep", "v", "leaf"])

    vector = vectors.schema["v"].dataType.simpleString()
    index = materialize(cls.select("rep", "v").mapInArrow(to_leaves, f"rep long, v {vector}, leaf long"))
    sizes = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}  # a row for each leaf at most
    asked = rows.filter(queries).join(cls.select("rep", "v"), "v").select("vec_id", "rep")
    asked = materialize(asked)
    asking = materialize(cls.join(asked.select("rep").distinct(), "rep").select("rep", "v"))
    probes = asking.orderBy(F.xxhash64(F.lit(12), "rep"), "rep").limit(PROBES)
    least = calibrated_visits(index, probes, tree.value, k, recall)

    def visiting(batches):
        for b in batches:
            if not b.num_rows:
                continue
            took, where = [], []
            for n, u in enumerate(unit(matrix(b.column("v")))):
                seen = 0
                for number, at in enumerate(tree.value.visits(u), 1):
                    size = sizes.get(at, 0)
                    for cell in range(-(-size // block)):
                        took.append(n)
                        where.append((at, cell))
                    seen += size
                    if number >= least and seen > k + 1:
                        break
            out = b.take(pa.array(took, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [out.column("rep"), out.column("v"), *(pa.array(c, pa.int64()) for c in zip(*where))], ["rep", "v", "leaf", "cell"])

    cells = asking.mapInArrow(visiting, f"rep long, v {vector}, leaf long, cell long")
    number = F.create_map(*[F.lit(x) for leaf_, n in sizes.items() for x in (leaf_, -(-n // block))])
    dealt = index.withColumn("cell", F.pmod(F.xxhash64("rep"), F.element_at(number, F.col("leaf"))))
    found = sorted_cells(dealt, cells, ["leaf", "cell"]).mapInArrow(
        lambda bs: _condensed(meet(bs, ["leaf", "cell"], lambda rows_, q: [_found(rows_, q, k + 1)]), k + 1), _SCORED)
    # the classes of a query's answer give their ids: at most k + 1 of k + 1 classes
    answer = (_top(found, k + 1).join(cls.select("rep", "members"), "rep")
              .groupBy("query").agg(F.flatten(F.collect_list(F.transform("members", lambda m: F.struct(
                  (-F.col("score")).alias("far"), m.alias("vec_id"))))).alias("near")))
    answer = answer.select(F.col("query").alias("rep"), F.slice(F.sort_array("near"), 1, k + 1).alias("near"))
    each = asked.join(answer, "rep").select(
        F.col("vec_id").alias("query_id"),
        F.posexplode(F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("vec_id")), 1, k)).alias("n", "x"))
    return each.select("query_id", (F.col("n") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
                       (-F.col("x.far")).alias("score"))


def _found(rows, queries, k):
    return _scored(queries.column("rep").to_pylist(), matrix(queries.column("v")), rows, k)


def op12_nearest(spark, sf_dir: str) -> DataFrame:
    """The five nearest found of the rows whose vec_id is divisible by 50."""
    from placekit.sources.tables import table
    e = table(spark, sf_dir, "embeddings")
    return nearest(e.select("vec_id", F.col("embedding").alias("v")), F.col("vec_id") % 50 == 0)
