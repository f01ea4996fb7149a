"""Toxicity scores from a factorization machine over hashed terms.

A document's terms are its words and the first four and five characters of
each (which stand for a word's inflected forms), the latter also as "at least
two (four) times", each present or not and hashed to ``2 ** DIM_BITS``
dimensions.  The machine

    y(x) = w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

learns a weight for each term and, through the factors, one for each pair of
terms that occur together.

Training uses at most ``MAX_TRAIN`` labelled rows, those with the smallest
hash of their id: a documented, bounded sample.  Their terms are counted by
Spark; the ``MAX_TERMS`` dimensions whose presence tells the labels apart
best (a likelihood-ratio statistic over ``MIN_G2``) enter the model, so a long
text's many other terms add no noise.  The model, a few hundred kB, is a
closure of the scoring job.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placekit.llm.batches import slices
from placekit.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIM_BITS = 18
MAX_TRAIN = 20_000
MAX_TERMS = 4096
MIN_G2 = 20.0
FACTORS = 8
EPOCHS = 60
PREFIXES = (4, 5)
LEVELS = (1, 2, 4)
CUT = 0.7
REMEMBERED = 400_000
_WORD = re.compile(r"\w+")


def release_tokenizer() -> None:
    """Free what tokenizing tasks left in this worker process (``bpe.tokenizer``):
    both together need more memory than a small executor has."""
    getattr(sys, "placekit_llm_bpe", {}).clear()


def _dim(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) & ((1 << DIM_BITS) - 1)


def terms_of(text: str | None) -> set[int]:
    """Dimensions of a text's terms."""
    words = words_of(text)
    out = set(map(_dim, words))
    starts: dict[str, int] = {}
    for w, c in words.items():
        for n in PREFIXES:
            if len(w) >= n:
                starts[w[:n]] = starts.get(w[:n], 0) + c
    for s, c in starts.items():
        out.update(d for least, d in zip(LEVELS, _levels(s)) if c >= least)
    return out


def _levels(start: str) -> list[int]:
    """Dimensions of "a word starts so", by the least number of such words."""
    return [_dim(f"{len(start)}{start}*{least}") for least in LEVELS]


def words_of(text: str | None) -> Counter:
    return Counter(_WORD.findall(text.lower())) if text else Counter()


@dataclass
class Model:
    """``dims``: sorted dimensions in use; ``w``, ``v``: their weights and factors."""

    dims: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        """Probability of label 1 for documents given as positions in ``dims``."""
        n = np.array([len(r) for r in rows])
        y = np.full(len(rows), self.w0)
        if n.any():
            flat = np.array([i for r in rows for i in r], np.int64)
            doc = np.repeat(np.arange(len(rows)), n)
            s = np.zeros((len(rows), self.v.shape[1]))
            np.add.at(s, doc, self.v[flat])
            y += np.bincount(doc, self.w[flat] - 0.5 * (self.v[flat] ** 2).sum(1), len(rows))
            y += 0.5 * (s ** 2).sum(1)
        return 1 / (1 + np.exp(-np.clip(y, -35, 35)))


class Terms:
    """Finds a text's terms in a model; remembers words, most of which have none."""

    def __init__(self, dims: np.ndarray):
        self.at = {d: i for i, d in enumerate(dims.tolist())}
        self.known: dict[str, tuple] = {}

    def _look_up(self, word: str) -> tuple:
        """Position of the word's own term, if any, and its starts with
        ``((least, position), ...)``; empty for most words."""
        own = self.at.get(_dim(word))
        starts = []
        for n in PREFIXES:
            if len(word) >= n:
                levels = tuple((least, self.at[d]) for least, d in zip(LEVELS, _levels(word[:n])) if d in self.at)
                if levels:
                    starts.append((word[:n], levels))
        return (own, tuple(starts)) if own is not None or starts else ()

    def __call__(self, text: str | None) -> list[int]:
        words = words_of(text)
        if len(self.known) + len(words) > REMEMBERED:
            self.known.clear()
        get = self.known.get
        out: set[int] = set()
        starts: dict[tuple, int] = {}
        for w, c in words.items():
            got = get(w)
            if got is None:
                got = self.known[w] = self._look_up(w)
            if got:
                if got[0] is not None:
                    out.add(got[0])
                for s in got[1]:
                    starts[s] = starts.get(s, 0) + c
        for (_, levels), c in starts.items():
            out.update(i for least, i in levels if c >= least)
        return sorted(out)


def fit(rows: list[list[int]], labels: np.ndarray, dims: np.ndarray, factors: int = FACTORS,
        epochs: int = EPOCHS, batch: int = 256, rate: float = 0.3, penalty: float = 1e-4) -> Model:
    """Mini-batch AdaGrad on the logistic loss; the order of rows and the first
    factors come from a fixed seed, so equal rows give an equal model."""
    rng = np.random.default_rng(7)
    k = len(dims)
    rate_1 = float(np.clip(labels.mean() if len(labels) else 0.0, 1e-3, 1 - 1e-3))
    w0, w, v = np.log(rate_1 / (1 - rate_1)), np.zeros(k), rng.normal(0, 0.02, (k, factors))
    if not len(labels) or not k:
        return Model(dims, float(w0), w, v)
    g0, gw, gv = 1e-8, np.full(k, 1e-8), np.full((k, factors), 1e-8)
    n = np.array([len(r) for r in rows])
    start = np.concatenate(([0], np.cumsum(n)))
    flat = np.array([i for r in rows for i in r], np.int64)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            idx = order[at:at + batch]
            count = n[idx]
            doc = np.repeat(np.arange(len(idx)), count)
            f = flat[np.repeat(start[idx] - np.cumsum(count) + count, count) + np.arange(count.sum())]
            vf = v[f]
            s = np.zeros((len(idx), factors))
            np.add.at(s, doc, vf)
            y = w0 + np.bincount(doc, w[f] - 0.5 * (vf ** 2).sum(1), len(idx)) + 0.5 * (s ** 2).sum(1)
            e = (1 / (1 + np.exp(-np.clip(y, -35, 35))) - labels[idx]) / len(idx)
            d0 = e.sum()
            g0 += d0 * d0
            w0 -= rate * d0 / np.sqrt(g0)
            dw = np.bincount(f, e[doc], k) + penalty * w
            gw += dw * dw
            w -= rate * dw / np.sqrt(gw)
            dv = np.zeros_like(v)
            np.add.at(dv, f, e[doc, None] * (s[doc] - vf))
            dv += penalty * v
            gv += dv * dv
            v -= rate * dv / np.sqrt(gv)
    return Model(dims, float(w0), w, v)


def _g2(pos: np.ndarray, neg: np.ndarray, n_pos: float, n_neg: float) -> np.ndarray:
    """Likelihood-ratio statistic of presence against label, for each dimension."""
    total, n = pos + neg, n_pos + n_neg

    def part(o, row, col):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(o > 0, o * np.log(o * n / (row * col)), 0.0)

    return 2 * (part(pos, total, n_pos) + part(neg, total, n_neg)
                + part(n_pos - pos, n - total, n_pos) + part(n_neg - neg, n - total, n_neg))


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Fit on the labelled rows of ``docs`` (``doc_id``, ``text``) whose label
    ``toxic`` is 0 or 1; a document labelled both ways counts as toxic.
    Without labelled rows the model scores every text alike."""
    sample = (labels.filter("toxic in (0, 1) and doc_id is not null")
                    .groupBy("doc_id").agg(F.max("toxic").alias("y"))
                    .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))
    parts = 16  # of a bounded sample

    def terms(batches):
        release_tokenizer()
        for batch in slices(batches, rows=64):
            dims = [sorted(terms_of(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.array(dims, pa.list_(pa.int32()))], names=["y", "dims"])

    picked = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("y", "text")
    rows = materialize(picked.repartition(parts).mapInArrow(terms, "y int, dims array<int>"))
    total = rows.agg(F.count("*").alias("n"), F.sum("y").alias("p")).first()
    n_pos = float(total["p"] or 0)
    n_neg = float(total["n"]) - n_pos
    if not n_pos or not n_neg:
        return fit([[]] * int(total["n"]), np.full(int(total["n"]), float(n_pos > 0)), np.empty(0, np.int64))
    # at most 2 ** DIM_BITS rows
    counts = (rows.select("y", F.explode("dims").alias("d")).groupBy("d")
                  .agg(F.sum("y").alias("pos"), F.count("*").alias("n")).filter("n > 2").toPandas())
    g2 = _g2(counts["pos"].to_numpy(float), (counts["n"] - counts["pos"]).to_numpy(float), n_pos, n_neg)
    best = np.argsort(-g2, kind="stable")[:MAX_TERMS]
    dims = np.sort(counts["d"].to_numpy(np.int64)[best[g2[best] >= MIN_G2]])

    def pick(batches):
        for batch in batches:
            at = []
            for d in batch.column("dims").to_pylist():
                d = np.array(d, np.int64)
                i = np.searchsorted(dims, d) if len(dims) else np.empty(0, np.int64)
                i = i[(i < len(dims))] if not len(d) or not len(dims) else i[(i < len(dims)) & (dims[np.minimum(i, len(dims) - 1)] == d)]
                at.append(i.tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.array(at, pa.list_(pa.int32()))], names=["y", "at"])

    train_rows = rows.mapInArrow(pick, "y int, at array<int>").collect()  # at most max_train short lists
    train_rows = sorted((r["y"], tuple(r["at"])) for r in train_rows)
    return fit([list(r[1]) for r in train_rows], np.array([r[0] for r in train_rows], float), dims)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of every row and ``score``, the probability that
    the whole text is toxic.  Null and empty texts have no terms and get the
    model's base score.  Repeated rows each give a row; other columns are
    ignored."""
    scored, names = _scored(docs, model, keep)
    return scored.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "score")


def _scored(docs: DataFrame, model: Model, keep) -> tuple[DataFrame, list[str]]:
    kept = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col("text").alias("text"))
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches):
        release_tokenizer()
        terms = Terms(model.dims)
        for batch in slices(batches):
            y = model.scores([terms(t) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(y, pa.float64())],
                                             names=[*names, "score"])

    schema = ", ".join(f"{n} {kept.schema[n].dataType.simpleString()}" for n in names)
    return kept.mapInArrow(run, f"{schema}, score double"), names


def fold(doc_id="doc_id"):
    """crc32 of the id as text, modulo 3; rows of fold 1 are held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def train_on_folds(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the labelled rows that are not held out."""
    return train(docs, labels.select("doc_id", "toxic").filter(fold() != 1))


def drop_toxic(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """The rows whose score is below ``cut``, unchanged."""
    scored, names = _scored(docs, model, docs.columns)
    return scored.filter(F.col("score") < cut).select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    from placekit.sources.tables import table
    docs = table(spark, sf_dir, "documents")
    model = train_on_folds(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))
