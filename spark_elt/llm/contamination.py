"""Benchmark passages in documents, found by an Aho-Corasick automaton over words.

Item texts are cut into windows of ``size`` consecutive normalised words (a shorter
item is one window). One automaton holds the windows of all items as sequences of word
numbers; each document's words are numbered by their hashes and read once, and a match
gives word positions, which map to code points of the original text. Words that no
item has end every match, so only runs of known words go through the automaton.

The items are a bounded set beside the corpus: their automaton goes to the executors
as a broadcast of at most ``block_chars`` of item text. A larger set is dealt into
blocks by a hash, and the scans of the blocks follow each other in the same task.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import partial
from typing import Any

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import ALNUM, LOWER, buffers, find_words, hash_spans, slices

SIZE = 10
BLOCK_CHARS = 4_000_000

_NONE = np.zeros(0, np.int64)
_LOADED: dict[str, Windows] = {}


class Windows:
    """The automaton over the windows of ``items`` (item id, text)."""

    def __init__(self, items: list[tuple[str, str]], size: int):
        self.ids = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(self.ids)}
        texts = pa.array([t for _, t in items], pa.string())
        raw, offsets = buffers(texts)
        raw = LOWER[raw]
        starts, ends, first = find_words(raw, offsets, ALNUM)
        hashes = hash_spans(raw, starts, ends)
        self.vocabulary = np.unique(hashes)
        words = np.searchsorted(self.vocabulary, hashes)
        found: dict[tuple[int, ...], set[int]] = {}
        for k, (i, _) in enumerate(items):
            own = words[first[k] : first[k + 1]].tolist()
            for at in range(max(1, len(own) - size + 1) if own else 0):
                found.setdefault(tuple(own[at : at + size]), set()).add(number[i])
        self.shortest = min(map(len, found), default=0)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, owners in found.items():
            self.automaton.add_word(window, (len(window), tuple(owners)))
        if found:
            self.automaton.make_automaton()

    def scan(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, list[str], np.ndarray, np.ndarray]]:
        """For each text: its number of words, the merged hit ranges of word positions
        (starts and ends in turn), the items with occurring windows, and the byte
        starts and ends of its words."""
        raw, offsets = buffers(column)
        for lo, hi in slices(offsets):
            at = offsets[lo : hi + 1] - offsets[lo]
            part = LOWER[raw[offsets[lo] : offsets[hi]]]
            starts, ends, first = find_words(part, at, ALNUM)
            matches = self._matches(hash_spans(part, starts, ends), first)
            for k in range(hi - lo):
                own = slice(first[k], first[k + 1])
                spans, items = matches.get(k, (_NONE, ()))
                yield first[k + 1] - first[k], spans, [self.ids[i] for i in items], starts[own] - at[k], ends[own] - at[k]

    def _matches(self, hashes: np.ndarray, first: np.ndarray) -> dict[int, tuple[np.ndarray, set[int]]]:
        if not self.shortest or not len(hashes):
            return {}
        number = np.searchsorted(self.vocabulary, hashes)
        known = self.vocabulary[np.minimum(number, len(self.vocabulary) - 1)] == hashes
        # runs of known words within a text
        edge = np.zeros(len(known) + 1, bool)
        edge[first] = True
        before = np.concatenate([[False], known[:-1]])
        after = np.concatenate([known[1:], [False]])
        begin = np.flatnonzero(known & (~before | edge[:-1]))
        end = np.flatnonzero(known & (~after | edge[1:])) + 1
        long = end - begin >= self.shortest
        out: dict[int, tuple[list[tuple[int, int]], set[int]]] = {}
        begin, end = begin[long], end[long]
        docs = np.searchsorted(first, begin, "right") - 1
        for b, e, d in zip(begin.tolist(), end.tolist(), docs.tolist(), strict=True):
            for last, (length, owners) in self.automaton.iter(tuple(number[b:e].tolist())):
                spans, items = out.setdefault(d, ([], set()))
                stop = b + last + 1 - int(first[d])
                spans.append((stop - length, stop))
                items.update(owners)
        return {d: (merge(spans), items) for d, (spans, items) in out.items()}


def merge(spans: list[tuple[int, int]]) -> np.ndarray:
    """Disjoint ranges that cover the same positions: starts and ends in turn."""
    flat: list[int] = []
    for s, e in sorted(spans):
        if flat and s <= flat[-1]:
            flat[-1] = max(flat[-1], e)
        else:
            flat += [s, e]
    return np.array(flat, np.int64)


def _windows(items: Broadcast, size: int, name: str) -> Windows:
    if name not in _LOADED:
        if len(_LOADED) > 2:
            _LOADED.clear()
        _LOADED[name] = Windows(items.value, size)
    return _LOADED[name]


def _blocks(benchmark: DataFrame, size: int, block_chars: int) -> Iterator[Any]:
    """Loaders of the automata, each over a block of the items."""
    spark = benchmark.sparkSession
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // block_chars) or 1
    for k in range(n):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        rows = [(r.item_id, r.text) for r in block.collect()]
        yield partial(_windows, spark.sparkContext.broadcast(rows), size, uuid.uuid4().hex)


def _code_point_spans(text: bytes, spans: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> str:
    """Word ranges as ``start:end`` in code points of the text."""
    points = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    pairs = zip(starts[spans[::2]].tolist(), ends[spans[1::2] - 1].tolist(), strict=True)
    return ",".join(f"{points[s] - 1}:{points[e - 1]}" for s, e in pairs)


def _report(batches: Iterator[pa.RecordBatch], load) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, n_words, hits, items) with the hits of this block added."""
    windows = load()
    for batch in batches:
        n_words, hits, items = [], [], []
        old_hits, old_items = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        for k, (n, spans, names, _, _) in enumerate(windows.scan(batch.column(1))):
            n_words.append(n)
            if len(spans) or old_hits[k]:
                flat = [*old_hits[k], *spans.tolist()]
                hits.append(merge(list(zip(flat[::2], flat[1::2], strict=True))).tolist())
                items.append(sorted({*old_items[k], *names}))
            else:
                hits.append([])
                items.append([])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
            ["doc_id", "text", "n_words", "hits", "items"],
        )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_hit, sha, spans = [], [], []
        texts = batch.column(1)
        hit_lists, item_lists = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        for k, (hits, items) in enumerate(zip(hit_lists, item_lists, strict=True)):
            n_hit.append(sum(hits[1::2]) - sum(hits[::2]))
            sha.append(hashlib.sha256(",".join(items).encode()).hexdigest())
            if hits:
                text = texts[k].as_py().encode()
                raw = LOWER[np.frombuffer(text, np.uint8)]
                starts, ends, _ = find_words(raw, np.array([0, len(raw)]), ALNUM)
                spans.append(_code_point_spans(text, np.array(hits), starts, ends))
            else:
                spans.append("")
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(n_hit, pa.int64()), pa.array(map(len, item_lists), pa.int64()), pa.array(sha), pa.array([n > 0 for n in n_hit]), pa.array(spans, pa.string())],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_spans"],
        )


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Benchmark windows in each document.

    ``docs`` needs ``doc_id`` and ``text``, ``benchmark`` ``item_id`` and ``text``. Words
    are runs of ASCII digits and letters (A-Z lowered) and of all non-ASCII characters.
    Returns one row per input row: ``doc_id``, ``n_words``, ``n_hit`` (words inside an
    occurring window), ``n_items`` and ``items_sha256`` (items with occurring windows,
    their ids sorted as strings and joined by commas), ``contaminated`` and
    ``hit_spans`` (``start:end`` in code points of the original text, joined by commas).

    A null or empty text has no words and no hits; an item without words has no window
    and one without id counts under an empty id; rows of one item id count as one item.
    An empty benchmark leaves every document clean, an empty ``docs`` gives no rows.
    """
    out = docs.select(
        "doc_id", F.col("text").cast("string").alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<bigint>)").alias("hits"), F.expr("cast(array() as array<string>)").alias("items"),
    )
    schema = out.schema
    for load in _blocks(benchmark, size, block_chars):
        out = out.mapInArrow(partial(_report, load=load), schema)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return out.mapInArrow(
        _digest, f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, hit_spans string"
    )


def _clean(batches: Iterator[pa.RecordBatch], load) -> Iterator[pa.RecordBatch]:
    windows = load()
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("text"))
        yield batch.filter(pa.array([not len(found[1]) for found in windows.scan(column)], pa.bool_()))


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns, in which no window of ``benchmark`` occurs."""
    out = docs
    for load in _blocks(benchmark, size, block_chars):
        out = out.mapInArrow(partial(_clean, load=load), docs.schema)
    return out
