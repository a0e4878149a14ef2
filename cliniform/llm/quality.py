"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Every word falls into one of ``BUCKETS`` buckets and every bucket has a sparse random index vector. A
bucket's vector is the sum of the index vectors of its neighbours over the whole corpus: integer
tables of fixed size, summed per task, then over tasks in two steps. A document is pooled into the mean vector
of its words, the mean of its distinct words, and a few measures of its form. A network of two
layers is fitted to a bounded sample of labelled documents, and a temperature, fitted to labelled
documents that the network did not see, makes its scores probabilities.

Labels decide the fit only; ids, languages, sources and labels are no inputs of a score.

Defined cases: a null text is scored as an empty one, an empty one from the network's answer to zero
vectors; null labels do not count, of contradicting labels the lowest counts; with labels of one kind
only, or none, every score is the smoothed share of label 1; repeated rows get equal scores; a null id is not held out; an
empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import Memo
from .common import appended, bounded_batches, free_name, sliced, table

BUCKETS = 1 << 15
WIDTH = 64
#: Entries of an index vector, words on either side that count as neighbours.
NONZERO = 4
REACH = 2
SEED = 8
#: Most labelled documents the network is fitted to (a documented bound; all others only count in the word vectors).
TRAIN_ROWS = 20_000
HIDDEN = 32
EPOCHS = 40
BATCH = 128
#: A document is accepted from this score on.
ACCEPT = 0.3
#: Buckets per row of the shuffled tables, and sums per bucket row before the last.
BLOCK = 1024
FAN = 16

_WORDS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+").findall


def _bucket(word: str) -> int:
    """Bucket of a word: case is dropped, but words in capitals and numbers are one word each."""
    if word.isupper() and len(word) > 1:
        word = "<capitals>"
    elif word[0].isdigit():
        word = "<number>"
    return zlib.crc32(word.lower().encode()) % BUCKETS


_MEMO = Memo(_bucket, 30_000)


def coded(text: str) -> np.ndarray:
    words = _WORDS(text)
    return np.fromiter(map(_MEMO.__getitem__, words), np.int64, len(words))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of every bucket's index vector."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, WIDTH, (BUCKETS, NONZERO)), rng.choice(np.array([-1, 1]), (BUCKETS, NONZERO))


def context_table(df: DataFrame, text: str = "text") -> np.ndarray:
    """Sum of the neighbours' index vectors for every bucket, over all texts; ``BUCKETS`` x ``WIDTH``."""
    bounded_batches(df.sparkSession)
    blocks = BUCKETS // BLOCK

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        total = np.zeros(BUCKETS * WIDTH)
        for part in parts:
            for piece in sliced(part, 2 << 20):
                codes = [coded(t) for t in piece.column(0).to_pylist() if t]
                own, other = [], []
                for c in codes:
                    for reach in range(1, REACH + 1):
                        own += [c[reach:], c[:-reach]]
                        other += [c[:-reach], c[reach:]]
                if own:
                    own, other = np.concatenate(own), np.concatenate(other)
                    for k in range(NONZERO):
                        total += np.bincount(own * WIDTH + places[other, k], signs[other, k], BUCKETS * WIDTH)
        if total.any():
            yield _blocks(range(blocks), total.astype(np.int64).reshape(blocks, -1))

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for part in parts:
            for block, data in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                values = np.frombuffer(data.as_buffer(), np.int64)
                sums[block] = sums[block] + values if block in sums else values
        if sums:
            yield _blocks(sums, list(sums.values()))

    kind = "block int, data binary"
    first = df.select(F.coalesce(F.col(f"`{text}`"), F.lit(""))).mapInArrow(count, kind)
    halfway = first.repartition("block", F.pmod(F.spark_partition_id(), F.lit(FAN))).mapInArrow(add, kind)
    out = np.zeros((blocks, BLOCK * WIDTH), np.int64)
    for row in halfway.repartition("block").mapInArrow(add, kind).collect():  # at most one row per block
        out[row.block] += np.frombuffer(row.data, np.int64)
    return out.reshape(BUCKETS, WIDTH)


def _blocks(names, rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(names), pa.int32()), pa.array([np.asarray(r, np.int64).tobytes() for r in rows], pa.binary())], ["block", "data"])


def word_vectors(contexts: np.ndarray) -> np.ndarray:
    """Unit context vector of each bucket plus its own unit index vector."""
    places, signs = index_vectors()
    own = np.zeros((BUCKETS, WIDTH), np.float32)
    np.add.at(own, (np.arange(BUCKETS)[:, None], places), signs.astype(np.float32))

    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    return (unit(contexts.astype(np.float32)) + unit(own)).astype(np.float32)


#: Pooled entries: mean over words, mean over distinct words, and the form.
FEATURES = 2 * WIDTH + 4


def pooled(text: str | None, vectors: np.ndarray) -> np.ndarray:
    """A whole text as one vector."""
    out = np.zeros(FEATURES, np.float32)
    codes = coded(text or "")
    if len(codes):
        distinct, times = np.unique(codes, return_counts=True)
        rows = vectors[distinct]
        lines = text.split("\n")
        out[:WIDTH] = times.astype(np.float32) @ rows / len(codes)
        out[WIDTH:2 * WIDTH] = rows.mean(0)
        out[2 * WIDTH:] = (np.log1p(len(codes)), len(distinct) / len(codes), (codes[1:] == codes[:-1]).sum() / len(codes), len(set(lines)) / len(lines))
    return out


@dataclass
class Network:
    """Two layers over standardised inputs; ``temperature`` divides the logit."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def constant(share: float) -> Network:
    """A network that answers ``share`` to everything."""
    return Network(np.zeros(FEATURES), np.ones(FEATURES), np.zeros((FEATURES, 1)), np.zeros(1), np.zeros(1), np.array([np.log(share / (1 - share))]))


def fitted(x: np.ndarray, y: np.ndarray, held: np.ndarray) -> Network:
    """Fit the network to the rows that are not ``held`` by Adam, the temperature to those that are."""
    if len(set(y[~held].tolist())) < 2:
        return constant((y.sum() + 1) / (len(y) + 2))
    rng = np.random.default_rng(SEED)
    train, want = x[~held].astype(np.float64), y[~held].astype(np.float64)
    mean, scale = train.mean(0), train.std(0) + 1e-3
    net = Network(mean, scale, rng.normal(0, np.sqrt(2 / FEATURES), (FEATURES, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1))
    names, inputs = ("w1", "b1", "w2", "b2"), (train - mean) / scale
    first, second, step = {n: 0.0 for n in names}, {n: 0.0 for n in names}, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(inputs))
        for at in range(0, len(order), BATCH):
            rows, step = order[at:at + BATCH], step + 1
            before = inputs[rows] @ net.w1 + net.b1
            hidden = np.maximum(before, 0)
            error = (1 / (1 + np.exp(-np.clip(hidden @ net.w2 + net.b2[0], -40, 40))) - want[rows]) / len(rows)
            back = np.outer(error, net.w2) * (before > 0)
            slopes = {"w1": inputs[rows].T @ back + 1e-4 * net.w1, "b1": back.sum(0), "w2": hidden.T @ error + 1e-4 * net.w2, "b2": error.sum(keepdims=True)}
            for n, g in slopes.items():
                first[n], second[n] = 0.9 * first[n] + 0.1 * g, 0.999 * second[n] + 0.001 * g * g
                setattr(net, n, getattr(net, n) - 3e-3 * (first[n] / (1 - 0.9 ** step)) / (np.sqrt(second[n] / (1 - 0.999 ** step)) + 1e-8))
    if held.any():
        logits, truth = net.logits(x[held].astype(np.float64)), y[held]
        tried = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        losses = [np.mean(np.logaddexp(0, -np.where(truth == 1, 1, -1) * logits / t)) for t in tried]
        net.temperature = float(tried[int(np.argmin(losses))])
    return net


@dataclass
class Classifier:
    vectors: np.ndarray
    network: Network

    def score(self, df: DataFrame, text: str = "text", out: str = "quality_score") -> DataFrame:
        """Append the score of every whole text."""
        vectors, network = self.vectors, self.network

        def compute(texts: pa.Array) -> pa.Array:
            return pa.array(network.scores(np.stack([pooled(t, vectors) for t in texts.to_pylist()])), pa.float64())

        return appended(df, text, compute, T.StructType([T.StructField(out, T.DoubleType())]))


def fold(doc_id: str = "doc_id"):
    """Remainder of an id that names its fold: 0 is held out, 1 sets the temperature."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")), F.lit(5)), F.lit(2))


def trained(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", train_rows: int = TRAIN_ROWS) -> Classifier:
    """Word vectors over all texts, and a network fitted to at most ``train_rows`` labelled ones of folds 1 to 4."""
    vectors = word_vectors(context_table(docs, text))
    known = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    known = known.where(fold() != 0).groupBy("doc_id").agg(F.min("label").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(train_rows)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(sample), "doc_id")

    def compute(texts: pa.Array) -> pa.Array:
        return pa.array([pooled(t, vectors).tobytes() for t in texts.to_pylist()], pa.binary())

    features = appended(rows, "text", compute, T.StructType([T.StructField("x", T.BinaryType())]))
    got = features.select("doc_id", "label", fold().alias("fold"), "x").limit(train_rows).collect()
    got.sort(key=lambda r: (r.doc_id, r.x))
    x = np.stack([np.frombuffer(r.x, np.float32) for r in got]) if got else np.zeros((0, FEATURES), np.float32)
    y = np.array([r.label for r in got], np.int64)
    return Classifier(vectors, fitted(x, y, np.array([r.fold == 1 for r in got], bool)))


def accepted(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", accept: float = ACCEPT) -> DataFrame:
    """The documents whose score reaches ``accept``, with their own columns."""
    score = free_name(docs, "_quality_score")
    return trained(docs, labels, text, doc_id).score(docs, text, score).where(F.col(score) >= accept).drop(score)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by a classifier fitted to the folds that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = trained(docs, table(spark, sf_dir, "labels")).score(docs, out="score")
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
