"""Mixing sources to target weights by Pfair scheduling.

A source's documents form blocks of ``block`` documents. With weight ``w`` the ``i``-th
block (from 0) of a source is released at slot ``floor(i / w)`` and due at
``ceil((i + 1) / w)``; slots go to the released block with the earliest deadline. As the
weights add up to one, every block gets a slot within its window, so at any slot each
source is less than one block away from its target.

Weights are rounded to multiples of 1 / ``period``, so the schedule repeats after
``period`` slots. The period given is doubled until the rounding moves no source by a
whole block up to its last one: a source is less than one block from its rounded weight
and less than two from its exact one. One period is laid out once, in the driver, which
holds a row for each source and for each block of a period; the slot of any block
follows from its number by arithmetic. The numbers
of documents within a source come from a hashed order: about sqrt(n) ranges of sqrt(n)
documents each, whose sizes are added up, so that no source is sorted in one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

BLOCK = 64
PERIOD = 1_000
#: Exponent of the sources' sizes in the default weights.
TEMPERATURE = 0.7
#: Sources up to which their slots are broadcast; beyond it they are joined by source.
BROADCAST_SOURCES = 10_000
#: Ranges of all sources (about the sum of the square roots of their sizes) up to which
#: their sizes are broadcast; beyond it they are joined by source and range.
BROADCAST_RANGES = 200_000
#: Blocks of a period up to which their slots are broadcast; beyond it they are joined by source and block.
BROADCAST_SLOTS = 200_000


def rounded(weights: Mapping[str | None, float], period: int = PERIOD) -> dict[str | None, int]:
    """Slots of each source in a period: at least one, largest remainders first."""
    if any(not w > 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    period = max(period, 4 * len(weights))
    total = sum(weights.values())
    names = sorted(weights, key=lambda s: (s is None, s or ""))
    exact = {s: weights[s] / total * period for s in names}
    slots = {s: max(1, int(exact[s])) for s in names}
    while (short := period - sum(slots.values())) != 0:
        gap = sorted(names, key=lambda s: (slots[s] - exact[s]) * (1 if short > 0 else -1))
        for s in [s for s in gap if short > 0 or slots[s] > 1][: abs(short)]:
            slots[s] += 1 if short > 0 else -1
    return slots


def fitted(weights: Mapping[str | None, float], blocks: Mapping[str | None, int], period: int = PERIOD) -> dict[str | None, int]:
    """``rounded`` over a period, doubled until no source that has ``blocks`` is moved by
    a whole block from its exact weight before its blocks end."""
    total = sum(weights.values())
    while True:
        slots = rounded(weights, period)
        size = sum(slots.values())
        exact = {s: weights[s] / total * size for s in slots}
        if all(blocks.get(s, 0) * abs(n - exact[s]) < min(n, exact[s]) for s, n in slots.items() if blocks.get(s)):
            return slots
        period = 2 * size


def _laid(slots: Mapping[str | None, int]) -> Iterator[tuple[int, int, int, int, int]]:
    """One period: (rank of the source, number of the block in it, slot, release, deadline)."""
    period = sum(slots.values())
    sizes = list(slots.values())
    coming = [(0, rank, 0) for rank in range(len(sizes))]  # the next block of each source
    ready: list[tuple[int, int, int, int]] = []
    for slot in range(period):
        while coming and coming[0][0] <= slot:
            release, rank, i = coming[0]
            n = sizes[rank]
            heapq.heappush(ready, (-(-(i + 1) * period // n), rank, i, release))
            if i + 1 < n:
                heapq.heapreplace(coming, ((i + 1) * period // n, rank, i + 1))
            else:
                heapq.heappop(coming)
        deadline, rank, i, release = heapq.heappop(ready)
        yield rank, i, slot, release, deadline


def layout(slots: Mapping[str | None, int]) -> list[tuple[str | None, int, int, int, int]]:
    """One period: (source, number of the block in it, slot, release, deadline)."""
    names = list(slots)
    return [(names[rank], *rest) for rank, *rest in _laid(slots)]


def _pattern(slots: Mapping[str | None, int], blocks: Mapping[str | None, int]) -> pa.Table:
    """The layout of the blocks there are, without the slots that stay empty."""
    there = [blocks.get(s, 0) for s in slots]
    left = sum(min(n, there[k]) for k, n in enumerate(slots.values()))
    out = np.empty((5, left), np.int64)
    at = 0
    for row in _laid(slots) if left else ():
        if row[1] < there[row[0]]:
            out[:, at] = row
            at += 1
            if at == left:
                break
    return pa.table(list(out), ["__of", "__i", "__slot", "__release", "__deadline"])


def mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None, block: int = BLOCK, period: int = PERIOD, source: str = "source") -> DataFrame:
    """``docs``, all columns and rows, with their place in the mix:

    - ``mix_block``: number of the block in its source, from 0
    - ``mix_slot``: slot of the block; ordering by ``mix_slot, mix_place`` gives the mix
    - ``mix_release``, ``mix_deadline``: window of the block
    - ``mix_place``: place of the document in its block, from 0

    ``weights`` names the target share of each source (None for rows without one); by
    default it is proportional to the number of documents to the power ``TEMPERATURE``.
    ``period`` is the least length of the schedule's period.
    A source that has no weight is an error. A source that runs out leaves its later
    slots empty; nothing is repeated or dropped. Documents of a source are in the
    order of the first 40 bits of md5 of ``doc_id`` (then of ``doc_id`` and the text), so
    ties and repeated rows get places of their own. Columns of these names are replaced. An empty table gives no rows.
    """
    spark = docs.sparkSession
    digits = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 10)
    place = F.conv(digits, 16, 10).cast("long") / (1 << 40)
    counts = {r[0]: r[1] for r in docs.groupBy(F.col(source).cast("string")).agg(F.count("*")).collect()}
    if weights is None:
        weights = {s: n**TEMPERATURE for s, n in counts.items()}
    if missing := [s for s in counts if s not in weights]:
        raise ValueError(f"sources without a weight: {missing[:5]}")
    blocks = {s: -(-n // block) for s, n in counts.items()}
    slots = fitted(weights, blocks, period) if weights else {}
    names = ["mix_block", "mix_slot", "mix_release", "mix_deadline", "mix_place"]
    own = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    size = sum(slots.values())
    number_of = {s: k for k, s in enumerate(slots)}
    ranges = {s: max(1, int(counts.get(s, 0) ** 0.5)) for s in slots}
    sources = spark.createDataFrame(
        [(s, number_of[s], n, ranges[s]) for s, n in slots.items()], "__source string, __k int, __n int, __ranges int"
    )
    if len(slots) <= BROADCAST_SOURCES:
        sources = F.broadcast(sources)
    rows = docs.select(*own, place.alias("__at")).join(sources, F.col(source).cast("string").eqNullSafe(F.col("__source")))
    rows = rows.withColumn("__range", F.floor(F.col("__at") * F.col("__ranges")))
    sizes = rows.groupBy("__k", "__range").agg(F.count("*").alias("__size"))
    before = Window.partitionBy("__k").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__k", "__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    if sum(ranges.values()) <= BROADCAST_RANGES:
        offsets = F.broadcast(offsets)
    ties = [F.xxhash64("text")] if "text" in docs.columns else []
    within = Window.partitionBy("__k", "__range").orderBy("__at", "doc_id", *ties)
    placed = rows.withColumn("__number", F.row_number().over(within) - 1).join(offsets, ["__k", "__range"])
    number = F.col("__number") + F.col("__before")
    placed = placed.withColumn("__block", F.floor(number / block)).withColumn("__place", F.pmod(number, F.lit(block)))
    laid_out = _pattern(slots, blocks)
    pattern = spark.createDataFrame(laid_out)
    if laid_out.num_rows <= BROADCAST_SLOTS:
        pattern = F.broadcast(pattern)
    turn = F.floor(F.col("__block") / F.col("__n")) * size
    laid = placed.join(pattern, (F.col("__k") == F.col("__of")) & (F.pmod(F.col("__block"), F.col("__n")) == F.col("__i")))
    return laid.select(
        *own,
        F.col("__block").alias("mix_block"),
        *((turn + F.col(f"__{x}")).cast("long").alias(f"mix_{x}") for x in ("slot", "release", "deadline")),
        F.col("__place").alias("mix_place"),
    )
