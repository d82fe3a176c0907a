"""Quality classifier: averaged vectors of hashed words and character n-grams, then softmax.

Trained with numpy on a bounded sample of labelled texts. With two classes the softmax
of a mean of vectors is the logistic of a mean of numbers, one for each bucket, so scoring
looks up one number per feature.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lustra.llm.symbols import BYTE_VALUES, Chunk, Runs, chunks

U64 = np.uint64


@dataclass(frozen=True)
class Subwords:
    """What is learned and how. ``sample_rows`` bounds the labelled texts that are used.

    Small samples are gone through more often, until there were ``least_steps`` batches.
    """

    buckets_log2: int = 18
    dim: int = 8
    grams: tuple[int, ...] = (3, 4)
    again: int = 3
    epochs: int = 8
    least_steps: int = 500
    rate: float = 2.0
    batch: int = 32
    sample_rows: int = 3000
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """One weight for each bucket (vector times difference of the class rows) and the bias."""

    weights: np.ndarray
    bias: float


def _features(chunk: Chunk, spec: Subwords) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of buckets and the texts they are from, ascending: words, n-grams inside words, words said again."""
    starts, ends, doc = chunk.words()
    shift = U64(64 - spec.buckets_log2)
    words = chunk.word_values(starts, ends)
    found = [((words >> shift).astype(np.int32), doc)]
    if len(starts):
        runs = Runs(BYTE_VALUES[1][chunk.data], 1)
        for n in spec.grams:
            count = np.maximum(ends - starts - n + 1, 0)
            at = np.repeat(starts - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
            found.append(((runs.of(at, n) >> shift).astype(np.int32), np.repeat(doc, count)))
    for back in range(1, spec.again + 1):
        # n-grams of words whose first and last are equal share a bucket, whatever the word
        same = np.flatnonzero((words[back:] == words[:-back]) & (doc[back:] == doc[:-back])) + back
        found.append((np.full(len(same), back, np.int32), doc[same]))
    return found


def _bags(spec: Subwords):
    """Distinct buckets of each text and their counts."""

    def of(batches):
        for batch in batches:
            buckets, counts = [], []
            for chunk in chunks(batch.column("text"), 1 << 20):
                bucket, doc = (np.concatenate(x) for x in zip(*_features(chunk, spec)))
                keys, count = np.unique(doc.astype(np.int64) << 32 | bucket, return_counts=True)
                bounds = np.searchsorted(keys >> 32, np.arange(len(chunk) + 1))
                low = (keys & 0xFFFFFFFF).astype(np.int32)
                buckets += [low[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
                counts += [count[a:b].astype(np.int32) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("label"),
                    pa.array(buckets, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int32())),
                ],
                names=["label", "buckets", "counts"],
            )

    return of


def fit_bags(labels: np.ndarray, buckets: list[np.ndarray], counts: list[np.ndarray], spec: Subwords) -> Model:
    """Stochastic gradient descent over small batches; the rate falls to zero."""
    draw = np.random.default_rng(spec.seed)
    vectors = draw.uniform(-1 / spec.dim, 1 / spec.dim, (1 << spec.buckets_log2, spec.dim)).astype(np.float32)
    classes = np.zeros((spec.dim, 2), np.float32)
    bias = np.zeros(2, np.float32)
    full = np.array([i for i in range(len(labels)) if len(buckets[i])], np.int64)
    if not len(full) or labels.min() == labels.max():
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Model(np.zeros(1 << spec.buckets_log2, np.float32), float(np.log(share / (1 - share))))
    batches = -(-len(full) // spec.batch)
    epochs = max(spec.epochs, -(-spec.least_steps // batches))
    steps, step = epochs * batches, 0
    for _ in range(epochs):
        order = draw.permutation(full)
        for at in range(0, len(order), spec.batch):
            rows = order[at : at + spec.batch]
            rate = spec.rate * (1 - step / steps)
            step += 1
            size = np.array([len(buckets[i]) for i in rows])
            bucket = np.concatenate([buckets[i] for i in rows])
            share = np.concatenate([counts[i] / counts[i].sum() for i in rows]).astype(np.float32)
            begin = np.cumsum(size) - size
            mean = np.add.reduceat(vectors[bucket] * share[:, None], begin)
            score = mean @ classes + bias
            score -= score.max(axis=1, keepdims=True)
            error = np.exp(score)
            error /= error.sum(axis=1, keepdims=True)
            error[np.arange(len(rows)), labels[rows]] -= 1
            error /= len(rows)
            back = error @ classes.T
            classes -= rate * (mean.T @ error)
            bias -= 0.1 * rate * error.sum(axis=0)
            # few of a text's words decide, so vectors learn faster than the shared layer
            change = np.repeat(back, size, axis=0) * share[:, None] * (rate * 20)
            np.subtract.at(vectors, bucket, change)
    return Model((vectors @ (classes[:, 1] - classes[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def train(documents: DataFrame, labels: DataFrame, label: str, spec: Subwords = Subwords()) -> Model:
    """From at most ``spec.sample_rows`` labelled rows, the first by a hash of doc_id.

    ``labels`` needs doc_id and the label (0 or 1; rows with a NULL in either are left
    out), ``documents`` doc_id and text; further columns are ignored. Features of the
    sample are counted on the executors; the driver gets bucket counts. Without labelled
    rows, or with one label only, every text scores the smoothed share of ones.
    """
    chosen = labels.select("doc_id", F.col(label).cast("int").alias("label")).dropna().distinct()
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(spec.sample_rows)
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "text")
    bags = texts.mapInArrow(_bags(spec), "label int, buckets array<int>, counts array<int>").toArrow()
    buckets, counts = (
        [x.values.to_numpy() for x in bags.column(c).combine_chunks()] if bags.num_rows else []
        for c in ("buckets", "counts")
    )
    return fit_bags(np.array(bags.column("label").to_pylist(), np.int64), buckets, counts, spec)


def _scores(model, spec: Subwords):
    def of(batches):
        weights, bias = model.value.weights, model.value.bias
        for batch in batches:
            parts = []
            for chunk in chunks(batch.column("text"), 1 << 20):
                total, size = np.zeros(len(chunk)), np.zeros(len(chunk))
                for bucket, doc in _features(chunk, spec):
                    total += np.bincount(doc, weights[bucket], minlength=len(chunk))
                    size += np.bincount(doc, minlength=len(chunk))
                parts.append(1 / (1 + np.exp(-(total / np.maximum(size, 1) + bias))))
            rest = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in rest] + [pa.array(np.concatenate(parts))], names=[*rest, "score"]
            )

    return of


def score(documents: DataFrame, model: Model, spec: Subwords = Subwords()) -> DataFrame:
    """``doc_id`` and ``score`` (the chance of label 1) of every row, from its text alone.

    NULL and empty texts have no features and get the score of the bias.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(_scores(shared, spec), f"doc_id {kind}, score double")
