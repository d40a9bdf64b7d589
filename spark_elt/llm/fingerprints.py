"""Threshold-scaled sketches: a document's fingerprint keeps every shingle hash below a
fixed fraction of the hash range.

The fraction does not depend on the document, so fingerprints of texts of very unequal
length stay comparable: the kept hashes of a part are kept hashes of the whole, and the
fingerprint of a union is the union of the fingerprints (``merge``). The smallest hash
is kept even above the threshold, so that a short text has a fingerprint too; a merge
drops it again once a hash below the threshold is there.

Fingerprint text: the hashes in ascending order, 16 hex digits each, without separator.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import buffers, shingle_sets_of

FRACTION = 8
SHINGLE = 5
_LIMIT = np.uint64((1 << 64) // FRACTION)


def keep(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a sorted set of hashes."""
    return hashes[: max(1, int(np.searchsorted(hashes, _LIMIT)))]


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets, from their sketches."""
    return keep(np.union1d(a, b))


def to_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the smaller set that the larger one contains (both empty: 1,
    one empty: 0)."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def resemblance(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of the two sets (both empty: 1)."""
    if not len(a) and not len(b):
        return 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def sketches(texts: list[bytes], shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sketches of UTF-8 texts."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    return [keep(hashes) for hashes in shingle_sets_of(raw, offsets, shingle)]


def fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of each text (null: empty; an empty text: '').
    One row per input row, no shuffle."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        partial(_fingerprint, shingle=shingle), f"doc_id {kind}, fingerprint string"
    )


def _fingerprint(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = shingle_sets_of(*buffers(batch.column(1)), shingle)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([to_text(keep(h)) for h in sets], pa.string())], ["doc_id", "fingerprint"]
        )


def _starts(text: bytes) -> np.ndarray | None:
    """Byte positions of the code points; None where they are all single bytes."""
    if text.isascii():
        return None
    return np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)


def _cut(text: bytes, starts: np.ndarray | None, n: int) -> int:
    """Bytes of the first ``n`` code points."""
    if starts is None:
        return min(n, len(text))
    return int(starts[n]) if n < len(starts) else len(text)


def _blocks(batch: pa.RecordBatch, bounds: np.ndarray) -> np.ndarray:
    """The block of each row: block 0 has the largest ids, nulls are in the last one."""
    ids = batch.column(0)
    block = len(bounds) - np.searchsorted(bounds, ids.fill_null(0).to_numpy(zero_copy_only=False), "right")
    return np.where(ids.is_null().to_numpy(zero_copy_only=False), len(bounds), block)


def _ids(batches: Iterator[pa.RecordBatch], bounds: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_blocks(batch, bounds.value), pa.int32())], ["doc_id", "block"])


def _deal(batches: Iterator[pa.RecordBatch], plan: Broadcast) -> Iterator[pa.RecordBatch]:
    """Each row for its block, and the first row of a block for the block before it too."""
    bounds, heads = plan.value
    for batch in batches:
        block = _blocks(batch, bounds)
        ids = batch.column(0).to_pylist()
        at = [k for k, (b, i) in enumerate(zip(block.tolist(), ids, strict=True)) if heads[b][0] == i]
        rows = np.concatenate([np.arange(len(ids)), np.array(at, np.int64)])
        to = np.concatenate([block, np.array([heads[block[k]][1] for k in at], np.int64)])
        halo = np.arange(len(rows)) >= len(ids)
        whole = batch.take(pa.array(rows))
        yield pa.RecordBatch.from_arrays([whole.column(0), whole.column(1), pa.array(to, pa.int32()), pa.array(halo)], ["doc_id", "text", "block", "halo"])


_KINDS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, jaccard_edited double, jaccard_next double"


def _compare(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """Rows of one block in order, then its halo; the last row of a batch waits for the
    next batch."""
    waiting: tuple | None = None
    over = False
    for batch in batches:
        if over or not len(batch):
            continue
        halo = np.flatnonzero(batch.column(3).to_numpy(zero_copy_only=False))
        if len(halo):
            over = True
            batch = batch.slice(0, int(halo[0]) + 1)
        ids = batch.column(0).to_pylist()
        texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(1)]
        own = sketches(texts, shingle)
        if waiting:
            ids, texts, own = [waiting[0], *ids], [waiting[1], *texts], [waiting[2], *own]
        yield from _rows(ids, texts, own, shingle)
        waiting = ids[-1], texts[-1], own[-1]


def _rows(ids: list, texts: list[bytes], own: list[np.ndarray], shingle: int) -> Iterator[pa.RecordBatch]:
    if len(ids) < 2:
        return
    n_chars, edited = [], []
    starts = [_starts(t) for t in texts]
    for k, text in enumerate(texts[:-1]):
        n = len(text) if starts[k] is None else len(starts[k])
        follows = texts[k + 1]
        edited.append(text[: _cut(text, starts[k], n - n // 2)] + follows[: _cut(follows, starts[k + 1], n // 2)])
        n_chars.append(n)
    other = sketches(edited, shingle)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(ids[:-1], pa.int64()),
            pa.array(n_chars, pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in edited]),
            pa.array([to_text(s) for s in own[:-1]]),
            pa.array([to_text(s) for s in other]),
            pa.array([containment(a, b) for a, b in zip(own, other, strict=False)]),
            pa.array([containment(a, b) for a, b in zip(own, own[1:], strict=False)]),
            pa.array([resemblance(a, b) for a, b in zip(own, other, strict=False)]),
            pa.array([resemblance(a, b) for a, b in zip(own, own[1:], strict=False)]),
        ],
        ["doc_id", *(x.split()[0] for x in _KINDS.split(", "))],
    )


def edited_likeness(docs: DataFrame, shingle: int = SHINGLE, blocks: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they are.

    The edited text has the last ``n // 2`` of the ``n`` code points replaced by the
    first as many (or all) of the next document in descending ``doc_id`` order; after
    the last one comes the first. Returns per input row ``doc_id``, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and
    ``near_next`` (containment of the smaller sketch in the larger, 0 to 1) and the
    same as Jaccard estimates.

    A null text counts as empty (fingerprint ''; two empty ones are alike by 1). Rows
    without ``doc_id`` come last; rows of one ``doc_id`` follow each other by text. A
    single row is its own next; an empty table gives no rows.

    The texts are shuffled once, dealt by ranges of ``doc_id`` into ``blocks`` (by
    default as many as shuffle partitions, one task each); the first row of a block also
    goes to the block before it. Only the block limits and their first ids pass through
    the driver.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    limits = docs.approxQuantile("doc_id", [k / n for k in range(1, n)], 1 / (16 * n)) if n > 1 else []
    bounds = np.unique(np.array(limits, np.float64).astype(np.int64))
    n = len(bounds) + 1
    own = docs.select("doc_id").mapInArrow(partial(_ids, bounds=spark.sparkContext.broadcast(bounds)), "doc_id long, block int")
    first = sorted((r.block, r.m) for r in own.groupBy("block").agg(F.max("doc_id").alias("m")).collect())
    heads = {b: (i, first[k - 1][0]) for k, (b, i) in enumerate(first)}
    plan = spark.sparkContext.broadcast((bounds, heads))
    dealt = docs.mapInArrow(partial(_deal, plan=plan), "doc_id long, text string, block int, halo boolean")
    ordered = dealt.repartitionById(n, "block").sortWithinPartitions("halo", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text"))
    return ordered.mapInArrow(partial(_compare, shingle=shingle), f"doc_id long, {_KINDS}")
