"""A text classifier: a convolutional network over bytes, in numpy.

Every byte has a learned vector, and learned filters run over the vectors of a few
bytes in a row. A document is read whole, in chunks that overlap by a filter's
width so that no place is lost; each filter keeps its maximum per chunk. The
highest and the mean of these maxima over the chunks are combined into one
probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stewardry.llm.texts import texts_of

WIDTH = 8
VECTOR = 4
FILTERS = 16
CHUNK = 8192
# Stands for the bytes that a text shorter than a filter lacks.
NO_BYTE = 256

# The bound of the training sample: texts per label, and bytes of each text.
SAMPLE_TEXTS = 2000
SAMPLE_BYTES = 20_000
EPOCHS = 5
BATCH = 16
RATE = 0.01


@dataclass
class Network:
    vectors: np.ndarray
    filters: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, seed: int) -> Network:
        draw = np.random.default_rng(seed)

        def around_zero(*shape, size):
            return (draw.standard_normal(shape) * size).astype(np.float32)

        return cls(
            around_zero(257, VECTOR, size=1.0),
            around_zero(WIDTH * VECTOR, FILTERS, size=(WIDTH * VECTOR) ** -0.5),
            np.zeros(FILTERS, np.float32),
            around_zero(2 * FILTERS, size=0.1),
            np.zeros(1, np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.vectors, self.filters, self.shift, self.weights, self.bias]

    def maxima(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The maximum of each filter per chunk, and where it is."""
        values, places = [], []
        for at in range(0, max(1, len(symbols) - WIDTH + 1), CHUNK):
            part = self.vectors[symbols[at : at + CHUNK + WIDTH - 1]]
            n = len(part) - WIDTH + 1
            rows = np.empty((n, WIDTH * VECTOR), np.float32)
            for k in range(WIDTH):
                rows[:, k * VECTOR : (k + 1) * VECTOR] = part[k : k + n]
            out = rows @ self.filters
            best = out.argmax(axis=0)
            values.append(out[best, np.arange(FILTERS)] + self.shift)
            places.append(best + at)
        return np.stack(values), np.stack(places)

    def features(self, values: np.ndarray) -> np.ndarray:
        active = np.maximum(values, 0)
        return np.concatenate([active.max(axis=0), active.mean(axis=0)])

    def score(self, text: np.ndarray) -> float:
        values, _ = self.maxima(symbols_of(text))
        return float(_logistic(self.features(values) @ self.weights + self.bias[0]))

    def gradients(self, text: np.ndarray, label: int) -> list[np.ndarray]:
        """Of the log loss. Only the bytes at the maxima have a part in it."""
        symbols = symbols_of(text)
        values, places = self.maxima(symbols)
        inputs = self.features(values)
        error = np.float32(_logistic(inputs @ self.weights + self.bias[0]) - label)
        out = [np.zeros_like(p) for p in self.parameters()]
        out[3] += error * inputs
        out[4] += error
        chunks = len(values)
        back = np.repeat((error * self.weights[FILTERS:] / chunks)[None, :], chunks, axis=0)
        back[values.argmax(axis=0), np.arange(FILTERS)] += error * self.weights[:FILTERS]
        back *= values > 0
        out[2] += back.sum(axis=0)
        spans = symbols[places[:, :, None] + np.arange(WIDTH)]
        rows = self.vectors[spans].reshape(chunks, FILTERS, -1)
        out[1] += np.einsum("cf,cfi->if", back, rows)
        to_rows = back[:, :, None] * self.filters.T[None]
        np.add.at(out[0], spans.ravel(), to_rows.reshape(-1, VECTOR))
        return out


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def symbols_of(text: np.ndarray) -> np.ndarray:
    symbols = text.astype(np.int64)
    missing = WIDTH - len(symbols)
    return np.concatenate([symbols, np.full(missing, NO_BYTE)]) if missing > 0 else symbols


def train(texts: list[np.ndarray], labels: list[int], seed: int = 0, epochs: int = EPOCHS) -> Network:
    """Fit a network by Adam on small batches; the same for the same input."""
    network, draw = Network.start(seed), np.random.default_rng(seed)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in network.parameters()]
    step = 0
    for _ in range(epochs):
        order = draw.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            each = [network.gradients(texts[i], labels[i]) for i in batch]
            step += 1
            for parameter, (first, second), grads in zip(network.parameters(), moments, zip(*each)):
                mean = sum(grads) / len(batch)
                first += 0.1 * (mean - first)
                second += 0.001 * (mean * mean - second)
                rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                parameter -= (rate * first / (np.sqrt(second) + 1e-8)).astype(np.float32)
    return network


def sample(
    documents: DataFrame, labels: DataFrame, usable: Column, text: str, key: str, label: str
) -> tuple[list[tuple[bytes, int]], dict[int, int]]:
    """Examples to learn from, and how many usable labels there are of each value.

    For each label, the examples are the ``SAMPLE_TEXTS`` texts of at most
    ``SAMPLE_BYTES`` bytes whose keys have the least hashes.
    """
    known = labels.where(F.col(label).isNotNull() & usable).select(F.col(key).alias("_key"), F.col(label).alias("_label")).distinct()
    counts = {r["_label"]: r["count"] for r in known.where("_label IN (0, 1)").groupBy("_label").count().collect()}
    # Keys are chosen from narrow rows; only the chosen texts move, and the
    # chosen keys, which the bound keeps few, are sent to where the texts are.
    short = documents.where(F.octet_length(text) <= SAMPLE_BYTES)
    rows = short.select(F.col(key).alias("_doc")).join(known, F.col("_doc") == F.col("_key")).select("_key", "_label").distinct()
    out = []
    for value in (0, 1):
        chosen = rows.where(F.col("_label") == value).orderBy(F.xxhash64("_key"), "_key").limit(SAMPLE_TEXTS)
        texts = short.select(F.col(key).alias("_doc"), F.col(text).alias("_text")).join(
            F.broadcast(chosen), F.col("_doc") == F.col("_key")
        )
        # A key that is there twice gives one text.
        texts = texts.groupBy("_key").agg(F.min("_text").alias("_text")).orderBy("_key")
        out += [(r["_text"].encode("utf-8", "replace"), value) for r in texts.select("_text").collect()]
    return out, counts


def fit(examples: list[tuple[bytes, int]], counts: dict[int, int], seed: int = 0) -> Network | None:
    """A trained network; none if there isn't an example of either label.

    The sample may hold a larger part of one label than there is; the last bias
    puts the odds of all labels back in.
    """
    held = {value: sum(1 for _, label in examples if label == value) for value in (0, 1)}
    if not held[0] or not held[1]:
        return None
    network = train([np.frombuffer(t, np.uint8) for t, _ in examples], [label for _, label in examples], seed)
    network.bias += np.float32(np.log(counts[1] / counts[0]) - np.log(held[1] / held[0]))
    return network


def score(documents: DataFrame, network: Network | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, score`` of every whole text, from 0 to 1.

    Null texts are empty and score as such. Without a network every score is
    0.5. Every row comes back once.
    """
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [network.score(t) if network else 0.5 for t in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(scores, pa.float64())], ["key", "score"])

    return rows.mapInArrow(scored, f"key {kind}, score double").withColumnRenamed("key", key)
