"""Quality scores from random-indexing word vectors and a small network.

Every word (run of letters, digits or symbols, and a pseudo-word for its shape) has a
sparse random index vector, made from its hash. A word's vector adds to it the index
vectors of its neighbours in the training texts, so words used alike get similar
vectors. A document is the mean of its word vectors; a two-layer numpy network turns it
into a logit, and a temperature fitted on rows kept back from training scales it to a
probability.

Bounds: about ``sample`` labelled rows train the model; its tables have ``BUCKETS`` x
``DIMS`` numbers. Training texts stay on the executors: the driver gets the word table
and one pooled vector per training row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle
from .sampling import draw, remainder
from .text import buffers, byte_table, hash_spans, mix, slices

SAMPLE = 8_000
BUCKETS = 1 << 15
DIMS = 40
NONZERO = 4
REACH = 2
HIDDEN = 24
EPOCHS = 60
CUT = 0.3
PART = 1 << 17  # bytes of text worked on at once: a word of it takes several rows of DIMS floats

# classes of bytes: 0 space, 1 letter, 2 digit, 3 symbol
_CLASS = np.full(256, 3, np.uint8)
_CLASS[byte_table((0x09, 0x0D), (0x20, 0x20))] = 0
_CLASS[byte_table((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))] = 1
_CLASS[byte_table((0x30, 0x39))] = 2
_UPPER = byte_table((0x41, 0x5A))


def index_vectors() -> np.ndarray:
    """One sparse random vector of +1 and -1 per bucket."""
    bucket = np.arange(BUCKETS, dtype=np.uint64)
    out = np.zeros((BUCKETS, DIMS), np.float32)
    for k in range(NONZERO):
        h = mix(bucket * np.uint64(NONZERO) + np.uint64(k + 1))
        out[np.arange(BUCKETS), (h >> np.uint64(8)) % np.uint64(DIMS)] += np.where(h & np.uint64(1), 1, -1)
    return out


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets of the words, of their shapes, and the first word of each text."""
    kind = np.zeros(len(raw) + 2, np.uint8)
    kind[1:-1] = _CLASS[raw]
    change = kind[1:] != kind[:-1]
    change[offsets] = True
    here = kind[1:-1] != 0
    starts = np.flatnonzero(change[:-1] & here)
    ends = np.flatnonzero(change[1:] & here) + 1
    first = np.searchsorted(starts, offsets)
    hashes = hash_spans(raw, starts, ends)
    # shape: class, length up to 15, capital letters (none, first, more), same word again
    upper = np.concatenate([[0], np.cumsum(_UPPER[raw])])
    capitals = np.minimum(upper[ends] - upper[starts], 2)
    again = np.zeros(len(starts), np.int64)
    again[1:] = hashes[1:] == hashes[:-1]
    again[first[first < len(starts)]] = 0
    shape = ((kind[starts + 1] * 16 + np.minimum(ends - starts, 15)) * 3 + capitals) * 2 + again
    size = np.uint64(BUCKETS)
    return (hashes % size).astype(np.int64), (mix(shape.astype(np.uint64)) % size).astype(np.int64), first


def _sums(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows of each text."""
    out = np.zeros((len(first) - 1, rows.shape[1]), np.float32)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = np.add.reduceat(rows, first[full], axis=0)
    return out


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the neighbours' index vectors of each bucket, over this task's texts."""
    index = index_vectors()
    table = np.zeros((BUCKETS, DIMS), np.float32)
    for batch in batches:
        raw, offsets = buffers(batch.column(0))
        for lo, hi in slices(offsets, PART):
            at = offsets[lo : hi + 1] - offsets[lo]
            word, shape, first = words(raw[offsets[lo] : offsets[hi]], at)
            text = np.repeat(np.arange(hi - lo), np.diff(first))
            own = index[word]
            near = index[shape]
            for step in range(1, REACH + 1):
                same = (text[step:] == text[:-step])[:, None]
                near[step:] += own[:-step] * same
                near[:-step] += own[step:] * same
            order = np.argsort(word, kind="stable")
            buckets, begin = np.unique(word[order], return_index=True)
            if len(buckets):
                table[buckets] += np.add.reduceat(near[order], begin, axis=0)
    used = np.flatnonzero(np.abs(table).sum(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.FixedSizeListArray.from_arrays(pa.array(table[used].ravel()), DIMS).cast(pa.list_(pa.float32()))],
        ["bucket", "v"],
    )


def word_vectors(texts: DataFrame) -> np.ndarray:
    """Word vectors by bucket: the index vector and the scaled context."""
    parts = texts.select("text").mapInArrow(_contexts, "bucket int, v array<float>")
    sums = parts.groupBy("bucket").agg(*(F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(DIMS))).toArrow()
    context = np.zeros((BUCKETS, DIMS), np.float32)
    if sums.num_rows:
        context[sums.column(0).to_numpy()] = np.stack([sums.column(i + 1).to_numpy() for i in range(DIMS)], axis=1)
    size = np.linalg.norm(context, axis=1, keepdims=True)
    return index_vectors() / np.float32(NONZERO**0.5) + context / np.maximum(size, 1e-6)


def pool(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector, mean shape vector and log length of each text."""
    raw, offsets = buffers(column)
    out = np.zeros((len(offsets) - 1, 2 * DIMS + 1), np.float32)
    for lo, hi in slices(offsets, PART):
        at = offsets[lo : hi + 1] - offsets[lo]
        word, shape, first = words(raw[offsets[lo] : offsets[hi]], at)
        n = np.diff(first)[:, None]
        out[lo:hi, :DIMS] = _sums(vectors[word], first) / np.maximum(n, 1)
        out[lo:hi, DIMS:-1] = _sums(vectors[shape], first) / np.maximum(n, 1)
        out[lo:hi, -1:] = np.log1p(n)
    return out


@dataclass
class Network:
    """Two layers over standardised inputs, and the temperature of their logits."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2[0]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.logits(x) / self.temperature, -30, 30)
        return 1 / (1 + np.exp(-z.astype(np.float64)))


def train(x: np.ndarray, y: np.ndarray, seed: int = 7) -> Network:
    """Fit by Adam on nine tenths of the rows, the temperature on the rest."""
    random = np.random.default_rng(seed)
    order = random.permutation(len(x))
    x, y = x[order].astype(np.float32), y[order].astype(np.float32)
    held = max(1, len(x) // 10)
    fit = slice(held, None) if len(x) > 20 else slice(None)
    net = Network(
        x[fit].mean(axis=0), x[fit].std(axis=0) + np.float32(1e-3),
        random.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32),
        np.zeros(HIDDEN, np.float32), np.zeros(1, np.float32),
    )
    base = np.clip(y[fit].mean(), 0.01, 0.99)
    net.b2[0] = np.log(base / (1 - base))
    weights = [net.w1, net.b1, net.w2, net.b2]
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    xs, ys = (x[fit] - net.mean) / net.scale, y[fit]
    step = 0
    for _ in range(EPOCHS):
        for rows in np.array_split(random.permutation(len(xs)), max(1, len(xs) // 128)):
            a, t = xs[rows], ys[rows]
            h = np.tanh(a @ net.w1 + net.b1)
            d = (1 / (1 + np.exp(-np.clip(h @ net.w2 + net.b2[0], -30, 30))) - t) / len(rows)
            back = d[:, None] * net.w2 * (1 - h * h)
            grads = [a.T @ back + 1e-4 * net.w1, back.sum(axis=0), h.T @ d, d.sum(keepdims=True)]
            step += 1
            for w, g, p, q in zip(weights, grads, m, v, strict=True):
                p += 0.1 * (g - p)
                q += 0.001 * (g * g - q)
                w -= 0.003 * (p / (1 - 0.9**step)) / (np.sqrt(q / (1 - 0.999**step)) + 1e-8)
    if len(x) > 20:
        z, t = net.logits(x[:held]).astype(np.float64), y[:held]
        grid = np.geomspace(0.5, 8, 49)
        loss = [np.mean(np.logaddexp(0, np.where(t > 0.5, -z, z) / k)) for k in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def _pooled(batches: Iterator[pa.RecordBatch], vectors: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = pool(batch.column(0), vectors.value)
        flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([flat, batch.column(1)], ["x", "y"])


Model = tuple[np.ndarray, Network] | float


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model from about ``sample`` labelled rows outside the held-out fold. With
    labels of one value only (or none) it is a constant."""
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (remainder() != 0))
        .groupBy(F.col("doc_id").alias("labelled")).agg(F.max("quality").cast("int").alias("y"))
    )
    # a bounded number of rows: broadcast, so that the texts stay where they are
    chosen = F.broadcast(draw(known, sample, "labelled"))
    texts = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.col("text").cast("string").alias("text"))
    rows = settle(texts.join(chosen, texts.doc_id == F.col("labelled")).select("text", "y"))
    vectors = word_vectors(rows)
    held = docs.sparkSession.sparkContext.broadcast(vectors)
    got = rows.mapInArrow(partial(_pooled, vectors=held), "x array<float>, y int").toArrow()
    y = got.column("y").to_numpy()
    if len(np.unique(y)) < 2:
        return float((y.sum() + 1) / (len(y) + 2)) if len(y) else 0.5
    x = np.asarray(got.column("x").combine_chunks().flatten()).reshape(len(y), -1)
    order = np.lexsort([*x.T[:4], y])  # the same rows in the same order, however they came
    return vectors, train(x[order], y[order])


def probabilities(column: pa.Array, model: Model) -> np.ndarray:
    if isinstance(model, float):
        return np.full(len(column), model)
    return model[1].probabilities(pool(column, model[0]))


def _scores(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        p = probabilities(batch.column(2), model.value)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(p), pa.array((p >= CUT).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"]
        )


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Quality of each text: ``doc_id``, ``held_out`` (its label was out of reach of the
    training), ``score`` (probability of label 1) and ``predicted`` (1 from ``CUT`` on).

    ``docs`` needs ``doc_id`` and ``text``, ``labels`` ``doc_id`` and ``quality``; only
    the text is an input of a score. One row per input row. A null text scores as an
    empty one. Rows without ``doc_id`` are scored, not trained on and not held out.
    Several labels of one document count as the highest; null labels are ignored.
    Without two label values the score is constant. An empty ``docs`` gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(
        "doc_id", F.coalesce(remainder() == 0, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text")
    ).mapInArrow(partial(_scores, model=model), f"doc_id {kind}, held_out boolean, score double, predicted int")


def _accepted(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        p = probabilities(batch.column(batch.schema.get_field_index("text")), model.value)
        yield batch.filter(pa.array(p >= CUT))


def accept(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier does not reject."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))
    return docs.mapInArrow(partial(_accepted, model=model), docs.schema)
