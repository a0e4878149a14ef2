"""Toxicity by compression distance: which of two zstandard dictionaries makes a text's windows shorter.

One dictionary is trained on ordinary text, one on toxic text. Both classes share most of their words, and a
dictionary trained on whole toxic texts is filled with those. So the toxic samples are the words of toxic texts that hold a
*telling* run of letters: one found in far more toxic texts than the ordinary texts lead one to expect. The toxic
dictionary holds the ordinary one's content too, so that an ordinary word costs the same under both. A dictionary's content is
its samples by frequency, the most frequent last, where they cost least; the library's own trainer keeps no run
twice and so cuts most words (area under the curve on held-out texts of sf0.1: 0.88, so 0.96).

A text is cut into windows of ``WINDOW`` words; a window's gain is its length compressed with the ordinary dictionary
less its length with the toxic one. A text is told by its shares of windows whose gain reaches each threshold; the
weights of the thresholds are calibrated on labelled texts that neither dictionary has seen.

Labels decide the fit only: at most ``TRAIN_ROWS`` labelled texts, chosen by a hash of their ids; ids, languages, sources
and labels are no inputs of a score.

Defined cases: a null text is scored as an empty one, which has no windows: it gets the answer to zero gains; null
labels do not count, of contradicting labels the lowest counts; with labels of one kind only, or none, every score is the
smoothed share of label 1; repeated rows get equal scores; a null id is not held out; an empty table gives no rows;
columns named like the added one are replaced, others stay.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.stage import staged
from .common import appended, sliced, table
from .quality import fold

#: Most labelled texts that anything is fitted to (a documented bound).
TRAIN_ROWS = 20_000
WINDOW = 12
#: Bytes of a telling run; texts that must hold it; how far its count must lie from what ordinary texts lead one to expect.
RUN, TEXTS, SIGMAS, RATIO = 6, 4, 6.0, 3.5
#: Most telling runs, most words that a dictionary is trained on, times a toxic sample must be found, and bytes of each dictionary.
RUNS, WORDS, TIMES = 4000, 15_000, 3
ORDINARY_BYTES, TOXIC_BYTES = 100_000, 8192
#: Gains that count, and the most that is told apart.
THRESHOLDS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12)
GAINS = 16
#: Entries a task counts before it hands them on.
COUNTED = 500_000
ACCEPT = 0.5

_WORD = re.compile(r"[^\x20\x09-\x0D]+").findall


def words_of(text: str | None) -> list[bytes]:
    return [w.encode() for w in _WORD((text or "").lower())]


def runs_of(word: bytes) -> Iterator[bytes]:
    word = b" " + word + b" "
    return (word[n:n + RUN] for n in range(len(word) - RUN + 1))


def counted(df: DataFrame, keys) -> DataFrame:
    """(key, toxic, ordinary): sums of what ``keys`` makes of each labelled text, counted per task first."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            names = list(sums[0].keys() | sums[1].keys())
            got = pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), *[pa.array([sums[y][k] for k in names], pa.int64()) for y in (1, 0)]], ["key", "toxic", "ordinary"])
            for s in sums:
                s.clear()
            return got

        for part in parts:
            for piece in sliced(part):
                for text, label in zip(piece.column(0), piece.column(1).to_pylist()):
                    sums[label].update(keys(words_of(text.as_py()), label))
                    if len(sums[0]) + len(sums[1]) > COUNTED:
                        yield out()
        if sums[0] or sums[1]:
            yield out()

    partial = df.select("text", "label").mapInArrow(run, "key binary, toxic long, ordinary long")
    return partial.groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def telling_runs(df: DataFrame, toxic: int, ordinary: int) -> set[bytes]:
    """Runs of letters whose toxic texts are far more than the ordinary ones lead one to expect."""
    expected = F.lit(float(toxic)) * (F.col("ordinary") + 1) / F.lit(float(ordinary + 1))
    far = (F.col("toxic") - expected) / F.sqrt(expected + 1)
    found = counted(df, lambda words, _: {r for w in words for r in runs_of(w)}).where(F.col("toxic") >= TEXTS)
    kept = found.where((far >= SIGMAS) & (F.col("toxic") >= RATIO * expected)).orderBy(far.desc(), "key").limit(RUNS)
    return {bytes(r.key) for r in kept.collect()}


def trained_content(samples: list[tuple[bytes, int]], size: int) -> bytes:
    """Content of a dictionary: the most frequent samples that find room, the most frequent last."""
    body = b" " + b"  ".join(w for w, _ in reversed(samples)) + b" "
    return body[-size:] if samples else b""


@dataclass
class Distance:
    """Both dictionaries and the weights of a text's measures."""

    ordinary: bytes
    toxic: bytes
    weights: np.ndarray

    def histograms(self, texts: list[str | None]) -> np.ndarray:
        """Windows per gain (0 and less, 1, ..., ``GAINS`` - 1 and more) of every whole text."""
        # matches of at least six bytes: shorter ones say little, and cost one dictionary or the other by chance
        params = zstandard.ZstdCompressionParameters(window_log=17, hash_log=16, chain_log=16, search_log=4, min_match=6, target_length=1,
                                                     strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_checksum=0, write_dict_id=0)
        both = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(x, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=params)
                for x in (self.ordinary, self.ordinary + self.toxic)]
        out = np.zeros((len(texts), GAINS), np.int64)
        windows: list[bytes] = []
        owner: list[int] = []

        def flush() -> None:
            if windows:
                plain, toxic = (c.multi_compress_to_buffer(windows, threads=1) for c in both)
                gains = np.fromiter((len(a) - len(b) for a, b in zip(plain, toxic)), np.int64, len(windows))
                np.add.at(out, (np.array(owner), np.clip(gains, 0, GAINS - 1)), 1)
                windows.clear()
                owner.clear()

        for n, text in enumerate(texts):
            words = words_of(text)
            for at in range(0, len(words), WINDOW):
                windows.append(b" " + b" ".join(words[at:at + WINDOW]) + b" ")
                owner.append(n)
                if len(windows) == 20_000:
                    flush()
        flush()
        return out

    def scores(self, hist: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(measures(hist) @ self.weights, -30, 30)))


def measures(hist: np.ndarray) -> np.ndarray:
    """Measures of texts: roots of the shares of windows that reach each threshold, how many reach two of them, the mean gain."""
    hist = hist.astype(np.float64)
    total = np.maximum(hist.sum(1), 1)
    reach = hist[:, ::-1].cumsum(1)[:, ::-1]
    return np.stack([np.ones(len(hist)), *[np.sqrt(reach[:, t] / total) for t in THRESHOLDS], np.log1p(reach[:, 6]), np.log1p(reach[:, 9]),
                     np.sqrt(hist @ np.arange(GAINS) / total)], 1)


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Weights by Newton's method with a small penalty."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [0.1] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w - np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ w)
    return w


def constant(share: float) -> Distance:
    """Answers ``share`` to everything."""
    weights = np.zeros(len(THRESHOLDS) + 4)
    weights[0] = np.log(share / (1 - share))
    return Distance(b"", b"", weights)


def trained(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", train_rows: int = TRAIN_ROWS) -> Distance:
    """Dictionaries from labelled texts of folds 2 to 4, threshold and weights from those of fold 1."""
    known = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    known = known.where(fold() != 0).groupBy("doc_id").agg(F.min("label").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id", F.lit(12)), "doc_id").limit(train_rows)
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(sample), "doc_id").where("text is not null")
    # one row per id and text: repeats would count as more texts
    rows = staged(texts.groupBy("doc_id", "label", F.sha2(F.col("text").cast("binary"), 256).alias("_digest")).agg(F.first("text").alias("text"))
                  .select("doc_id", "label", "text", fold().alias("fold")), "toxicity_sample")
    of = {(r.fresh, r.label): r.n for r in rows.groupBy((F.col("fold") == 1).alias("fresh"), "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, ordinary = of.get((False, 1), 0), of.get((False, 0), 0)
    if not (toxic and ordinary):
        total = sum(of.values())
        return constant((sum(n for (_, y), n in of.items() if y) + 1) / (total + 2))
    # where fold 1 lacks a class, the weights must come from what the dictionaries have seen
    seen, fresh = rows.where("fold <> 1"), rows.where("fold = 1") if of.get((True, 1)) and of.get((True, 0)) else rows
    telling = telling_runs(seen, toxic, ordinary)
    words = counted(seen, lambda words, y: [w for w in words if not y or not telling.isdisjoint(runs_of(w))])
    picks = [[(bytes(r.key), r.n) for r in words.select("key", F.col(of).alias("n")).where(F.col("n") >= least).orderBy(F.col("n").desc(), "key").limit(WORDS).collect()]
             for of, least in (("ordinary", 1), ("toxic", TIMES))]
    distance = Distance(trained_content(picks[0], ORDINARY_BYTES), trained_content(picks[1], TOXIC_BYTES), np.zeros(0))

    def compute(column: pa.Array) -> pa.Array:
        return pa.array([h.tobytes() for h in distance.histograms(column.to_pylist())], pa.binary())

    got = appended(fresh, "text", compute, T.StructType([T.StructField("hist", T.BinaryType())])).select("label", "hist").collect()
    got.sort(key=lambda r: (r.label, bytes(r.hist)))
    y = np.array([r.label for r in got], np.float64)
    distance.weights = logistic(measures(np.stack([np.frombuffer(r.hist, np.int64) for r in got])), y)
    return distance


def scored(df: DataFrame, distance: Distance, text: str = "text", out: str = "toxicity") -> DataFrame:
    """Append the probability that a whole text is toxic."""
    def compute(column: pa.Array) -> pa.Array:
        return pa.array(distance.scores(distance.histograms(column.to_pylist())), pa.float64())

    return appended(df, text, compute, T.StructType([T.StructField(out, T.DoubleType())]))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by dictionaries trained on the folds that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    distance = trained(docs, table(spark, sf_dir, "labels"))
    return scored(docs, distance, out="score").select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
