"""Language of texts by a bidirectional gated recurrent network over bytes.

Texts are read in windows of ``WINDOW`` bytes, every byte of every text. One gated
recurrent unit reads a window forwards, one backwards; their states at a byte give
language probabilities for that position, and a document's probabilities are the mean
over its positions. The network is trained in numpy by backpropagation through time on
excerpts of about ``sample`` documents of each language (``EXCERPT`` code points at a
hashed place of each); the driver holds these excerpts and the weights.
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

from .sampling import draw, remainder
from .text import buffers, byte_table

SAMPLE = 600
EXCERPT = 192
WINDOW = 128
HIDDEN = 8
STEPS = 300
ROWS = 256
TRAINED_WINDOW = 64
#: Windows that are read side by side.
LANES = 2048
PAD = 256
UNDETERMINED = "und"

_ASCII_LETTER = byte_table((0x41, 0x5A), (0x61, 0x7A))


@dataclass
class Gated:
    """One direction. ``table`` has the input of each byte to the update gate, the reset
    gate and the candidate (columns), ``u`` the recurrent weights to the same. Gates are
    piecewise linear: 0.5 plus their input, kept within 0 and 1."""

    table: np.ndarray
    u: np.ndarray

    def states(self, codes: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (time, hidden, lanes) over ``codes`` (time, lanes); ``keep`` gets what
        training needs."""
        n, lanes = codes.shape
        out = np.empty((n, HIDDEN, lanes), np.float32)
        inputs = np.ascontiguousarray(self.table.T)
        inputs[: 2 * HIDDEN] += 0.5
        x = np.empty((3 * HIDDEN, lanes), np.float32)
        a = np.empty_like(x)
        gates, c = x[: 2 * HIDDEN], x[2 * HIDDEN :]
        z, r, q = gates[:HIDDEN], gates[HIDDEN:], a[2 * HIDDEN :]
        h = np.zeros((HIDDEN, lanes), np.float32)
        for t in range(n):
            np.take(inputs, codes[t], axis=1, out=x, mode="clip")
            np.matmul(self.u, h, out=a)
            gates += a[: 2 * HIDDEN]
            np.minimum(gates, 1, out=gates)
            np.maximum(gates, 0, out=gates)
            r *= q
            c += r
            np.tanh(c, out=c)
            if keep is not None:
                keep.append((h, z.copy(), np.clip(inputs[HIDDEN : 2 * HIDDEN, codes[t]] + a[HIDDEN : 2 * HIDDEN], 0, 1), q.copy(), c.copy()))
            following = out[t]
            np.subtract(h, c, out=following)
            following *= z
            following += c
            h = following
        return out

    def back(self, codes: np.ndarray, kept: list, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of ``table`` and ``u`` from those of the states."""
        n, lanes = codes.shape
        inputs = np.empty((n, 3 * HIDDEN, lanes), np.float32)
        u_grad = np.zeros_like(self.u)
        dh = np.zeros((HIDDEN, lanes), np.float32)
        for t in range(n - 1, -1, -1):
            h, z, r, q, c = kept[t]
            dh = dh + grad[t]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (h - c) * ((z > 0) & (z < 1))
            dr = dc * q * ((r > 0) & (r < 1))
            inputs[t, :HIDDEN], inputs[t, HIDDEN : 2 * HIDDEN], inputs[t, 2 * HIDDEN :] = dz, dr, dc
            da = np.concatenate([dz, dr, dc * r])
            u_grad += da @ h.T
            dh = dh * z + self.u.T @ da
        table_grad = np.zeros_like(self.table)
        np.add.at(table_grad, codes.ravel(), inputs.transpose(0, 2, 1).reshape(-1, 3 * HIDDEN))
        return table_grad, u_grad


@dataclass
class Reader:
    """Both directions and the layer from their states to languages."""

    languages: list[str]
    forward: Gated
    backward: Gated
    w: np.ndarray
    b: np.ndarray

    def positions(self, codes: np.ndarray) -> np.ndarray:
        """Language probabilities (time, language, lanes) at each byte."""
        ahead = self.forward.states(codes)
        behind = self.backward.states(codes[::-1])[::-1]
        p = np.matmul(self.w[:, :HIDDEN], ahead)
        p += np.matmul(self.w[:, HIDDEN:], behind)
        p += self.b[:, None]
        return softmax(p)

    def documents(self, column: pa.Array) -> np.ndarray:
        """Mean position probabilities of each text (empty: zeros)."""
        raw, offsets = buffers(column)
        size = np.diff(offsets)
        windows = -(-size // WINDOW)
        first = np.concatenate([[0], np.cumsum(windows)])
        doc = np.repeat(np.arange(len(size)), windows)
        start = offsets[doc] + (np.arange(first[-1]) - first[doc]) * WINDOW
        length = np.minimum(offsets[doc + 1] - start, WINDOW)
        out = np.zeros((len(size), len(self.languages)))
        # windows of like length side by side, so that few are padded
        order = np.argsort(-length, kind="stable")
        step = np.arange(WINDOW)[:, None]
        for k in range(0, len(order), LANES):
            lanes = order[k : k + LANES]
            n = int(length[lanes[0]])
            codes = raw.take(start[lanes] + step[:n], mode="clip").astype(np.intp)
            there = None
            if length[lanes[-1]] < n:
                there = step[:n] < length[lanes]
                codes[~there] = PAD
            p = self.positions(codes)
            if there is not None:
                p *= there[:, None, :]
            np.add.at(out, doc[lanes], p.sum(axis=0, dtype=np.float64).T)
        return out / np.maximum(size, 1)[:, None]


def softmax(p: np.ndarray) -> np.ndarray:
    """Over languages (axis 1), in place. States are within -1 and 1, so inputs are bounded
    by the weights."""
    np.exp(p, out=p)
    p /= p.sum(axis=1, keepdims=True)
    return p


def train(texts: list[bytes], marks: list[int], languages: list[str], steps: int = STEPS, seed: int = 5) -> Reader:
    """Backpropagation through time with Adam over windows drawn from ``texts``; every
    position of a window is to have the mark of its text."""
    random = np.random.default_rng(seed)

    def unit() -> Gated:
        return Gated(
            random.normal(0, 0.3, (PAD + 1, 3 * HIDDEN)).astype(np.float32),
            random.normal(0, HIDDEN**-0.5, (3 * HIDDEN, HIDDEN)).astype(np.float32),
        )

    net = Reader(languages, unit(), unit(), random.normal(0, 0.3, (len(languages), 2 * HIDDEN)).astype(np.float32), np.zeros(len(languages), np.float32))
    weights = [net.forward.table, net.forward.u, net.backward.table, net.backward.u, net.w, net.b]
    m, v = [np.zeros_like(x) for x in weights], [np.zeros_like(x) for x in weights]
    by_mark = [np.flatnonzero(np.array(marks) == k) for k in range(len(languages))]
    for step in range(1, steps + 1):
        # as many windows of each language
        target = random.integers(0, len(languages), ROWS)
        codes = np.full((TRAINED_WINDOW, ROWS), PAD)
        for lane, k in enumerate(target):
            text = texts[by_mark[k][random.integers(len(by_mark[k]))]]
            at = random.integers(0, max(1, len(text) - TRAINED_WINDOW + 1))
            piece = text[at : at + TRAINED_WINDOW]
            codes[: len(piece), lane] = np.frombuffer(piece, np.uint8)
        there = codes != PAD
        ahead_kept: list = []
        behind_kept: list = []
        ahead = net.forward.states(codes, ahead_kept)
        behind = net.backward.states(codes[::-1], behind_kept)[::-1]
        both = np.concatenate([ahead, behind], axis=1)
        d = softmax(np.matmul(net.w, both) + net.b[:, None])
        d[:, target, np.arange(ROWS)] -= 1
        d *= there[:, None, :] / np.float32(max(1, there.sum()))
        back = np.matmul(net.w.T, d)
        grads = [
            *net.forward.back(codes, ahead_kept, back[:, :HIDDEN]),
            *net.backward.back(codes[::-1], behind_kept, back[::-1, HIDDEN:]),
            np.einsum("tkb,thb->kh", d, both, optimize=True),
            d.sum(axis=(0, 2)),
        ]
        size = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
        rate = 0.02 * min(1.0, 2.0 - 2.0 * step / (steps + 1))
        for x, g, p, q in zip(weights, grads, m, v, strict=True):
            g = g * min(1.0, 1.0 / max(size, 1e-9))
            p += 0.1 * (g - p)
            q += 0.01 * (g * g - q)
            x -= (rate * (p / (1 - 0.9**step)) / (np.sqrt(q / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net


def fit(docs: DataFrame, sample: int = SAMPLE, steps: int = STEPS) -> Reader | None:
    """The network from excerpts of about ``sample`` documents of each language outside
    the held-out fold; None where there is no document to learn from."""
    known = docs.where(
        F.col("lang").isNotNull() & (F.length("text") > 0) & F.col("doc_id").isNotNull() & (remainder() != 0)
    ).select(
        "lang", "doc_id",
        F.expr(f"substring(text, 1 + int(pmod(xxhash64(doc_id), greatest(1, length(text) - {EXCERPT} + 1))), {EXCERPT})").alias("excerpt"),
    )
    rows = sorted((r.lang, r.doc_id, r.excerpt) for r in draw(known, sample, "doc_id", per="lang").collect())
    if not rows:
        return None
    languages = sorted({r[0] for r in rows})
    number = {x: k for k, x in enumerate(languages)}
    return train([r[2].encode() for r in rows], [number[r[0]] for r in rows], languages, steps)


def _has_letter(text: pa.Scalar) -> bool:
    if not text.is_valid:
        return False
    data = text.as_buffer()
    if _ASCII_LETTER[np.frombuffer(data, np.uint8)].any():
        return True
    return any(c.isalpha() for c in text.as_py())


def _label(batches: Iterator[pa.RecordBatch], net: Broadcast) -> Iterator[pa.RecordBatch]:
    reader: Reader | None = net.value
    for batch in batches:
        column = batch.column(2)
        lettered = np.array([_has_letter(x) for x in column], bool) if reader else np.zeros(len(column), bool)
        p = reader.documents(column) if reader else np.zeros((len(column), 1))
        best = p.argmax(axis=1)
        names = [reader.languages[k] if ok else UNDETERMINED for k, ok in zip(best, lettered, strict=True)] if reader else [UNDETERMINED] * len(column)
        score = np.where(lettered, np.clip(p.max(axis=1), 0, 1), 0.0)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])


def languages(docs: DataFrame, sample: int = SAMPLE, steps: int = STEPS) -> DataFrame:
    """Language of each text: ``doc_id``, ``held_out`` (not learned from), ``lang_pred``
    and ``score`` (its mean probability over all bytes).

    ``docs`` needs ``doc_id``, ``text`` and ``lang``; only the text is an input of a
    prediction. One row per input row. A null text, one without a letter, and every text
    where nothing could be learned is ``und`` with score 0. Rows without ``doc_id`` are
    labelled, not learned from and not held out. An empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    net = docs.sparkSession.sparkContext.broadcast(fit(docs, sample, steps))
    return docs.select("doc_id", F.coalesce(remainder() == 0, F.lit(False)).alias("held_out"), "text").mapInArrow(
        partial(_label, net=net), f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )
