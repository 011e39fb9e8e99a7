"""Quality of documents: random-indexing word vectors, pooled, then a calibrated two-layer network."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regulink.llm.common import table, text_chunks, texts
from regulink.llm.wordhash import classes_of, words_of
from regulink.session import freeze

WORDS = 1 << 13  # hashed words
WIDTH = 32  # of word vectors
POOLED = 2 * WIDTH + 3  # numbers of a document
NONZERO = 4  # of an index vector
WINDOW = 2
HIDDEN = 32
SAMPLE_ROWS = 20_000  # labelled rows that the network is fitted on, at most
CALIBRATION_SHARE = 0.2
EPOCHS, BATCH, RATE, DECAY = 40, 256, 3e-3, 1e-4

_CLASSES = classes_of(b" \t\n\r\x0b\x0c", digits=True, marks=True)


def index_vectors(seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the few non-zero elements of each word's index vector."""
    dealt = np.random.default_rng(seed)
    places = np.argsort(dealt.random((WORDS, WIDTH)), 1)[:, :NONZERO]
    return places, dealt.choice([-1.0, 1.0], (WORDS, NONZERO))


def word_codes(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashed word at each place, and the first place of each text."""
    words = words_of([v.encode("utf-8", "replace") for v in values], _CLASSES)
    return (words.hashes >> np.uint64(64 - 13)).astype(np.int64), words.first


def context_sums(codes: np.ndarray, first: np.ndarray, places: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """For each word the sum of the index vectors of its neighbours in the same text."""
    sums = np.zeros(WORDS * WIDTH)
    document = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for distance in range(1, WINDOW + 1):
        same = document[distance:] == document[:-distance]
        left, right = codes[:-distance][same], codes[distance:][same]
        for word, near in ((left, right), (right, left)):
            for k in range(NONZERO):
                sums += np.bincount(word * WIDTH + places[near, k], signs[near, k], len(sums))
    return sums


def fit_word_vectors(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Word vectors of length one from all texts: sums of the index vectors of neighbours.

    Sums are whole numbers, added up by element over all tasks; the driver gets ``WORDS`` x
    ``WIDTH`` numbers. A word without neighbours has its own index vector.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        sums = np.zeros(WORDS * WIDTH)
        for _, values, _ in text_chunks(batches):
            sums += context_sums(*word_codes(values), places, signs)
        there = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(there), pa.array(sums[there].astype(np.int64))], ["cell", "value"]
        )

    summed = texts(df, id_col, text_col).mapInArrow(count, "cell long, value long")
    found = summed.groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    vectors = np.zeros(WORDS * WIDTH)
    vectors[found.column("cell").to_numpy()] = found.column("value").to_numpy()
    vectors = vectors.reshape(WORDS, WIDTH)
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    places, signs = index_vectors()
    own = np.zeros_like(vectors)
    np.put_along_axis(own, places, signs / NONZERO**0.5, 1)
    return np.where(size > 0, vectors / np.maximum(size, 1), own).astype(np.float32)


def pool(values: list[str], vectors: np.ndarray) -> np.ndarray:
    """What the word vectors of each text come to: their mean and root mean square, how alike those
    of neighbours are, and the log of the number of words."""
    codes, first = word_codes(values)
    n = np.diff(first)
    pooled = np.zeros((len(values), POOLED), np.float32)
    some = np.flatnonzero(n)
    if len(some):
        words = vectors[codes]
        starts = first[:-1][some]
        size = n[some, None]
        pooled[some, :WIDTH] = np.add.reduceat(words, starts, 0) / size
        pooled[some, WIDTH : 2 * WIDTH] = np.sqrt(np.add.reduceat(words * words, starts, 0) / size)
        alike = np.zeros(len(codes), np.float32)
        alike[1:] = (words[1:] * words[:-1]).sum(1)
        alike[starts] = 0  # the first word of a text has none before it
        pooled[some, -3] = np.add.reduceat(alike, starts) / n[some]
        pooled[some, -2] = np.add.reduceat((alike > 0.999).astype(np.float32), starts) / n[some]
        pooled[some, -1] = np.log1p(n[some]) / 10
    return pooled


def pooled_vectors(
    df: DataFrame, vectors: np.ndarray, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, pooled`` of each row's whole text; zeros for a text without words."""
    held = df.sparkSession.sparkContext.broadcast(vectors)

    def give(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, values, _ in text_chunks(batches, 1_000_000):
            pooled = pool(values, held.value)
            flat = pa.array(pooled.ravel())
            offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * pooled.shape[1])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.ListArray.from_arrays(offsets, flat)], ["doc_id", "pooled"]
            )

    return texts(df, id_col, text_col).mapInArrow(give, "doc_id long, pooled array<float>")


@dataclass(frozen=True)
class Network:
    """Two layers; ``temperature`` divides the logit so that probabilities match frequencies."""

    middle: np.ndarray
    spread: np.ndarray
    weights: tuple[np.ndarray, ...]
    temperature: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh((x - self.middle) / self.spread @ w1 + b1) @ w2 + b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of the least log loss, by golden-section search of its logarithm."""
    loss = lambda t: float(np.logaddexp(0, -(2 * labels - 1) * logits / np.exp(t)).mean())
    low, high, part = -2.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - part * (high - low), low + part * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 3) -> Network:
    """Fit by Adam on four fifths of the rows and calibrate on the rest."""
    dealt = np.random.default_rng(seed)
    order = dealt.permutation(len(y))
    held = order[: int(CALIBRATION_SHARE * len(y))]
    fit = order[len(held) :]
    middle, spread = x[fit].mean(0), x[fit].std(0) + 1e-3
    z, t = (x[fit] - middle) / spread, y[fit].astype(float)
    w = [
        dealt.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
        dealt.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(()),
    ]
    m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for _ in range(EPOCHS):
        shuffled = dealt.permutation(len(fit))
        for begin in range(0, len(fit), BATCH):
            rows = shuffled[begin : begin + BATCH]
            h = np.tanh(z[rows] @ w[0] + w[1])
            off = (1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -30, 30))) - t[rows]) / len(rows)
            back = off[:, None] * w[2] * (1 - h * h)
            slopes = [z[rows].T @ back + DECAY * w[0], back.sum(0), h.T @ off + DECAY * w[2], off.sum()]
            step += 1
            for k, g in enumerate(slopes):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] = w[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    plain = Network(middle, spread, tuple(w), 1.0)
    if len(held) < 10:
        return plain
    return Network(middle, spread, tuple(w), calibrate(plain.logit(x[held]), y[held].astype(float)))


def fit_quality(
    pooled: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", rows: int = SAMPLE_ROWS
) -> Network | None:
    """Fit on labelled rows, of which at most ``rows`` are taken by a hash of the id.

    Rows with a null id or label teach nothing. Several texts of one id are taken by their mean, so
    each label taken is one row. There is no network when no row is labelled.
    """
    wanted = labels.where(F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")
    )
    taken = wanted.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    # at most ``rows`` rows of three numbers
    times = F.broadcast(taken.groupBy("doc_id", "label").agg(F.count(F.lit(1)).alias("times")))
    mean = F.array(*[F.avg(F.get("pooled", k)) for k in range(POOLED)]).alias("pooled")
    found = pooled.join(times, "doc_id").groupBy("doc_id", "label", "times").agg(mean)
    found = found.orderBy("doc_id", "label").toArrow()
    if not found.num_rows:
        return None
    x, n = np.array(found.column("pooled").to_pylist(), np.float64), found.column("times").to_numpy()
    return fit_network(np.repeat(x, n, 0), np.repeat(found.column("label").to_numpy(), n))


def score_quality(pooled: DataFrame, network: Network | None) -> DataFrame:
    """``doc_id, score, predicted`` of each row; without a network all score one half."""
    held = pooled.sparkSession.sparkContext.broadcast(network)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("pooled").flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.float64)
            p = held.value.probability(x) if held.value else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    scored = pooled.mapInArrow(score, "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def is_held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 3 == 1


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Word vectors and scores of all documents, the network of labels that are not held out."""
    documents = table(spark, folder, "documents")
    pooled = freeze(pooled_vectors(documents, fit_word_vectors(documents)), "pooled")
    network = fit_quality(pooled, table(spark, folder, "labels").where(~is_held_out()))
    scored = score_quality(pooled, network)
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", "predicted")
