"""Near duplicates by circulant MinHash (two permutations for all coordinates).

A document's set holds the hashes of its distinct ``shingle``-word shingles. The first
permutation scatters a hash over ``2**SLOT_BITS`` slots; the second one is a random
order of the slots, and coordinate ``j`` reads it shifted circularly by ``j``. So the
values of an element at all coordinates lie side by side, and a signature is the
column-wise minimum of such rows. Coordinates are banded (``BANDS`` x ``ROWS``; a pair
at Jaccard 0.8 shares no band with probability (1 - 0.8**4)**24 = 3e-6).

From bands to links, without all pairs of a band's bucket:

1. Equal sets are one class, represented by one row; only classes go on.
2. Buckets of two or more classes remain. Shingles that only one of the remaining
   classes has cannot be shared, so ``c`` (the others) bounds every intersection; a
   class with ``c`` below the threshold of its own size drops out.
3. In each bucket the class with the largest share ``c / n`` is the pivot; every other
   member is compared with it on full sets.
4. Members not yet in the pivot's component meet each other where their sizes and ``c``
   allow the threshold and their bit sketches (the lowest bits of ``SKETCH_BITS`` more
   coordinates) differ by no more than five standard deviations above what the
   threshold lets expect. A pair meets only in the first bucket it shares.

Links are confirmed on the full sets of 64-bit shingle hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, joined_components, settle, tidy
from .text import list_array, mix, shingle_sets

SLOT_BITS = 20
BANDS = 24
ROWS = 4
SKETCH_BITS = 2048
SEED = 20


@lru_cache(2)
def _windows(width: int, seed: int) -> np.ndarray:
    """Row ``s``: the second permutation at slot ``s`` under each circular shift."""
    order = np.random.default_rng(seed).permutation(1 << SLOT_BITS).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[: width - 1]]), width)


def signature(hashes: np.ndarray, width: int = BANDS * ROWS, seed: int = SEED) -> np.ndarray:
    """The circulant MinHash coordinates of a non-empty set of hashes."""
    windows = _windows(width, seed)
    slots = (mix(hashes ^ np.uint64(0x5851F42D4C957F2D + seed)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    step = max(1, (1 << 18) // width)
    out = windows[slots[:step]].min(axis=0)
    for i in range(step, len(slots), step):
        np.minimum(out, windows[slots[i : i + step]].min(axis=0), out=out)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each signature (rows)."""
    cells = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), cells.shape[:2])
    for row in range(ROWS):
        keys = mix(keys * np.uint64(0xFF51AFD7ED558CCD) + cells[:, :, row])
    return keys


def _digest(hashes: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        other = mix(hashes + np.uint64(0x632BE59BD9B4E019))
        return int(hashes.sum(dtype=np.uint64).astype(np.int64)), int(other.sum(dtype=np.uint64).astype(np.int64))


def _signatures(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests, kept = [], [], []
        for hashes in shingle_sets(batch.column(1), shingle):
            sizes.append(len(hashes))
            digests.append(_digest(hashes))
            if len(hashes):
                kept.append(signature(hashes))
        keys = band_keys(np.stack(kept)) if kept else np.zeros((0, BANDS), np.uint64)
        full = np.array(sizes) > 0
        ends = np.concatenate([[0], np.cumsum(full * BANDS)])
        bands = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.ravel().view(np.int64)))
        d = np.array(digests, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1]), bands],
            ["doc_id", "n", "d1", "d2", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """Sets of the rows (node, d1, d2, text) whose text has the digest they name."""
    for batch in batches:
        nodes, sets = [], []
        wanted = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
        for (node, d1, d2), hashes in zip(wanted, shingle_sets(batch.column(3), shingle), strict=True):
            if _digest(hashes) == (d1, d2):
                nodes.append(node)
                sets.append(hashes.view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), list_array(sets, pa.int64())], ["node", "hashes"])


def _bit_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows (node, hashes)."""
    for batch in batches:
        bits = [
            np.packbits((signature(np.asarray(x.values).view(np.uint64), SKETCH_BITS, SEED + 1) & 1).astype(bool)).view(np.int64)
            for x in batch.column(1)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), list_array(bits, pa.int64())], ["node", "sketch"])


def _alike(percent: int, a, b):
    """Whether two bit sketches may belong to sets at the threshold: at Jaccard j, two
    lowest bits differ with probability (1 - j) / 2."""
    q = (1 - percent / 100) / 2
    most = math.ceil(SKETCH_BITS * q + 5 * math.sqrt(SKETCH_BITS * q * (1 - q)))
    return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(SKETCH_BITS // 64)), F.lit(0)) <= most


def _first_shared(a, b):
    """The first key that two lists of band keys share."""
    return F.filter(F.zip_with(a, b, lambda x, y: F.when(x == y, x)), lambda x: x.isNotNull())[0]


def _reaches(percent: int, shared, a, b):
    """Whether ``shared`` elements of sets of ``a`` and ``b`` reach the threshold."""
    return 100 * shared >= percent * (a + b - shared)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    shared = F.size(F.array_intersect("ha", "hb"))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(_reaches(percent, shared, F.size("ha"), F.size("hb"))).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Groups of near-duplicate documents.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Two documents are
    linked if ``100 * |intersection| >= percent * |union|`` for their sets of distinct
    ``shingle``-word shingles (white-space words, A-Z lowered; with fewer words the whole
    sequence is one shingle). Returns one row per input row:

    - ``doc_id``
    - ``n_shingles``: size of the set
    - ``component_id``: smallest ``doc_id`` reachable over links
    - ``kept``: whether ``doc_id`` is that one

    A null or blank text has an empty set and no links. A row without ``doc_id`` has no
    links, ``component_id`` null and is kept. Rows that repeat a ``doc_id`` each get a
    row, linked by their texts; an empty table gives no rows. The order of rows and
    ties do not matter.
    """
    rows = settle(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(partial(_signatures, shingle=shingle), "doc_id long, n long, d1 long, d2 long, bands array<long>")
    ).withColumn("row", F.monotonically_increasing_id())
    linkable = F.col("n").isNotNull() & (F.col("n") > 0) & F.col("doc_id").isNotNull()
    classes = settle(
        rows.where(linkable).groupBy("d1", "d2", "n").agg(F.min("row").alias("node"), F.min("doc_id").alias("first_id"))
    )
    # one row per class, with the text's document and the bands
    heads = settle(
        rows.where(linkable).join(classes.select("node"), F.col("row") == F.col("node")).select("node", "doc_id", "d1", "d2", "n", "bands")
    )
    grouped = settle(_components(docs, heads, shingle, percent).join(classes.select("node", "first_id"), "node"))
    tidy(docs.sparkSession)
    groups = grouped.groupBy("root").agg(F.min("first_id").alias("group_id")).join(grouped.select("node", "root"), "root")
    named = classes.join(groups.select("node", "group_id"), "node", "left").select(
        "d1", "d2", "n", F.coalesce("group_id", "first_id").alias("component_id")
    )
    linked = rows.where(linkable).select("doc_id", "n", "d1", "d2").join(named, ["d1", "d2", "n"])
    alone = rows.where(~linkable).withColumn("component_id", F.col("doc_id"))
    out = linked.select("doc_id", "n", "component_id").union(alone.select("doc_id", "n", "component_id"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def drop_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs``, all columns, with one document of each group of near duplicates: that
    of the smallest ``doc_id``. Rows without ``doc_id`` stay; the rows of one ``doc_id``
    are one document and stay or go together."""
    kept = near_duplicates(docs, shingle, percent).where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__kept")), "left_semi")


def _components(docs: DataFrame, heads: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Components (node, root) of the links between classes; classes without a link may
    be missing."""
    banded = heads.select("node", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    buckets = settle(banded.join(shared.select("key"), "key"))
    nodes = buckets.select("node").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wanted = heads.join(nodes, "node").select("node", "doc_id", "d1", "d2")
    sets = settle(
        texts.join(wanted, "doc_id").select("node", "d1", "d2", "text")
        .mapInArrow(partial(_sets, shingle=shingle), "node long, hashes array<long>")
    )
    tidy(docs.sparkSession)
    # shingles that one class alone has
    only = (
        sets.select("node", F.explode("hashes").alias("h")).groupBy("h")
        .agg(F.min("node").alias("node"), F.max("node").alias("other")).where("node = other")
        .groupBy("node").agg(F.count("*").alias("own"))
    )
    bounds = (
        sets.select("node", F.size("hashes").alias("n")).distinct().join(only, "node", "left")
        .select("node", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("c"))
        .where(F.expr(f"100 * c >= {percent} * n"))
    )
    live = settle(buckets.join(bounds, "node"))
    pivots = live.groupBy("key").agg(
        F.max(F.struct((F.col("c") / F.col("n")).alias("s"), (-F.col("node")).alias("m"), "n", "c")).alias("p")
    ).select("key", (-F.col("p.m")).alias("b"), F.col("p.n").alias("nb"), F.col("p.c").alias("cb"))
    possible = _reaches(percent, F.least("ca", "cb"), F.col("na"), F.col("nb"))
    a = live.select("key", F.col("node").alias("a"), F.col("n").alias("na"), F.col("c").alias("ca"))
    tried = a.join(pivots, (a.key == pivots.key) & (a.a != pivots.b) & possible).select("a", "b").distinct()
    tidy(docs.sparkSession)
    # members that are not in one component
    roots = components(_confirm(tried, sets, percent))
    placed = live.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key")
    placed = placed.join(split, "key").join(pivots.select("key", F.col("b").alias("pivot")), "key").where("node <> pivot")
    placed = settle(placed.select("key", "node", "n", "c", "root"))
    tidy(docs.sparkSession)
    sketches = sets.join(placed.select("node").distinct(), "node").mapInArrow(_bit_sketches, "node long, sketch array<long>")
    more = sketches.join(heads.select("node", "bands"), "node")
    placed = placed.join(more, "node")
    a = placed.select(*(F.col(c).alias(f"{c}_a") for c in placed.columns))
    b = placed.select(*(F.col(c).alias(f"{c}_b") for c in placed.columns))
    meets = (
        (F.col("key_a") == F.col("key_b"))
        & (F.col("node_a") < F.col("node_b"))
        & (F.col("root_a") != F.col("root_b"))
        & _reaches(percent, F.least("c_a", "c_b"), F.col("n_a"), F.col("n_b"))
        & _alike(percent, F.col("sketch_a"), F.col("sketch_b"))
        & (_first_shared(F.col("bands_a"), F.col("bands_b")) == F.col("key_a"))
    )
    rest = a.join(b, meets).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    return joined_components(roots, _confirm(rest, sets, percent))
