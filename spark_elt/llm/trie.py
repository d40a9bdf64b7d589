"""Prefix trie of conversations, kept as balanced parentheses in every shard.

A conversation is the path of its turns' digests, 16 bytes a turn, so the binary order of
paths is the order of a depth-first walk of the trie. Paths are range-partitioned and
sorted (equal ones by conv_id); a partition is a shard. Its nodes are written as balanced
parentheses, the first common turns of neighbours shared. Over the excess of the sequence
lies a tree of block minima (range min-max), by which ``findclose`` gives the end of every
subtree; the rank of the pairs ``()`` before it counts its leaves, and differences of
cumulative arrays over the nodes in walk order give its members and savings.

Neighbouring shards share the nodes of a spine, the common turns of the last path of one
and the first path of the next. Their parts merge by sums: a shared node counts as new in
its first shard alone, and the last conversation of a shard is a leaf there only if the next
shard does not go on with it. So members, children, leaves and savings of a node are the
sums of its shards', and its least conv_id the least of theirs.

A conversation is one row of some 24 bytes a turn while it is sorted. A shard's task holds
the digests and sizes of its partition, never texts. The conv_ids that end in one node are
digested as a stream in order, over shards where it is shared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spark_elt.session import ship_code

from .common import settle

#: Bytes of a turn's digest in a path.
WIDTH = 16
#: Parentheses of a block of the range min-max tree.
BLOCK = 64
#: Turns that a conversation may take from the first one of its group of five.
SHARED, GROUP = 9, 5
#: Shared nodes up to which their conv_ids are broadcast to their children (48 bytes each).
BROADCAST_NODES = 1 << 17
#: conv_ids in one piece of a shared node's list.
PIECE = 1 << 16


class Parentheses:
    """A balanced sequence (true: open) with its excess and a tree of block minima."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(np.where(bits, 1, -1))
        n = max(1, -(-len(bits) // BLOCK))
        leaves = 1 << (n - 1).bit_length()
        padded = np.full(leaves * BLOCK, np.iinfo(np.int64).max)
        padded[: len(bits)] = self.excess
        #: minima of the blocks at ``tree[leaves:]``, of two neighbours above them
        self.tree = np.full(2 * leaves, np.iinfo(np.int64).max)
        self.leaves = leaves
        self.tree[leaves:] = padded.reshape(leaves, BLOCK).min(axis=1)
        at = leaves
        while at > 1:
            self.tree[at // 2 : at] = self.tree[at : 2 * at].reshape(-1, 2).min(axis=1)
            at //= 2
        self.padded = padded

    def _scan(self, at: np.ndarray, stop: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """The first place from ``at`` before ``stop`` with an excess of at most ``goal``
        (-1: none); no two are further apart than a block."""
        found = np.full(len(at), -1)
        todo = np.arange(len(at))
        for step in range(BLOCK):
            todo = todo[at[todo] + step < stop[todo]]
            if not len(todo):
                break
            here = at[todo] + step
            hit = self.padded[here] <= goal[todo]
            found[todo[hit]] = here[hit]
            todo = todo[~hit]
        return found

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one."""
        goal = self.excess[opens] - 1
        ends = (opens // BLOCK + 1) * BLOCK
        out = self._scan(opens + 1, ends, goal)
        todo = np.flatnonzero(out < 0)
        # up: to the nearest block on the right whose minimum is low enough
        node = self.leaves + opens[todo] // BLOCK
        up = np.arange(len(todo))
        while len(up):
            here = node[up]
            right = (here & 1 == 0) & (self.tree[np.minimum(here + 1, len(self.tree) - 1)] <= goal[todo[up]])
            node[up] = np.where(right, here + 1, here >> 1)
            up = up[~right]
        # down: to its first such block
        down = np.flatnonzero(node < self.leaves)
        while len(down):
            left = node[down] * 2
            node[down] = np.where(self.tree[left] <= goal[todo[down]], left, left + 1)
            down = down[node[down] < self.leaves]
        begin = (node - self.leaves) * BLOCK
        out[todo] = self._scan(begin, begin + BLOCK, goal[todo])
        return out

    def leaves_before(self) -> np.ndarray:
        """For each place the pairs ``()`` that begin before it."""
        pairs = self.bits[:-1] & ~self.bits[1:]
        return np.concatenate([[0], np.cumsum(pairs), [np.count_nonzero(pairs)]])[: len(self.bits) + 1]


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common at their beginning."""
    x, y = (np.frombuffer(p[: min(len(a), len(b))], f"V{WIDTH}") for p in (a, b))
    differ = np.flatnonzero(x != y)
    return int(differ[0]) if len(differ) else len(x)


class Shard:
    """The trie of sorted ``paths`` (their conv_ids and the bytes of their turns' texts).

    ``before`` and ``after`` are the turns that the first path shares with the shard
    before and the last one with the shard after (-1: there is none)."""

    def __init__(self, ids: np.ndarray, paths: list[bytes], sizes: list, before: int = -1, after: int = -1):
        self.ids = ids
        lengths = np.array([len(p) // WIDTH for p in paths], np.int64)
        common = np.array([0, *(common_turns(a, b) for a, b in zip(paths, paths[1:]))], np.int64)
        # the root opens with the first path
        opened = lengths - common
        opened[0] += 1
        closed = np.append(lengths[:-1] - common[1:], lengths[-1] + 1)
        runs = np.stack([opened, closed], axis=1).ravel()
        bits = np.repeat(np.tile([True, False], len(paths)), runs)
        tree = Parentheses(bits)
        opens = np.flatnonzero(bits)
        close = tree.findclose(opens)
        n = len(opens)
        self.depth = tree.excess[opens] - 1
        #: nodes of each subtree follow its top in walk order
        self.stop = np.arange(n) + (close - opens + 1) // 2
        # the conversation that opened a node is the first below it
        self.owner = np.repeat(np.arange(len(paths)), opened)
        weight = np.zeros(n, np.int64)
        at = np.flatnonzero(self.depth > 0)
        weight[at] = [sizes[i][d - 1] for i, d in zip(self.owner[at].tolist(), self.depth[at].tolist())]
        # a path ends at the last node opened, or above it at an equal path's
        last = np.cumsum(opened) - 1
        equal = opened == 0
        last[equal] = -1
        ends_at = np.maximum.accumulate(last)
        ends = np.bincount(ends_at, minlength=n)
        self.begin_end = np.concatenate([[0], np.cumsum(ends)])
        self.n_convs = self.begin_end[self.stop] - self.begin_end[:-1]
        edges = np.stack([self.begin_end[:-1], self.begin_end[self.stop]], axis=1).ravel()
        padded = np.append(ids, np.iinfo(np.int64).max)
        self.least = np.minimum.reduceat(padded, edges)[::2]
        first = self.owner == 0
        old = first & (self.depth <= before)
        new = np.cumsum(np.append(0, self.n_convs * weight - np.where(old, 0, weight)))
        self.saved = new[self.stop] - new[:-1]
        rank = tree.leaves_before()
        self.n_leaves = rank[close] - rank[opens]
        # parents: the node one less deep that was opened last
        self.parent = np.full(n, -1)
        spine = np.full(int(self.depth.max()) + 1, -1) if n else np.zeros(0)
        firsts = np.flatnonzero(np.append(True, self.depth[1:] <= self.depth[:-1]))
        runs_stop = np.append(firsts[1:], n)
        for lo, hi in zip(firsts.tolist(), runs_stop.tolist()):
            d = self.depth[lo]
            spine[d : d + hi - lo] = np.arange(lo, hi)
            self.parent[lo:hi] = np.append(spine[d - 1] if d else -1, np.arange(lo, hi - 1))
        self.n_children = np.bincount(self.parent[~old & (self.parent >= 0)], minlength=n)
        # nodes on the last path: ancestors of the last node a path ends at, itself too
        on_last = np.zeros(n, bool)
        k = int(ends_at[-1])
        while k >= 0:
            on_last[k] = True
            k = int(self.parent[k])
        if lengths[-1] <= after:
            self.n_leaves = self.n_leaves - on_last
        self.shared = old | (on_last & (self.depth <= after))
        self.paths = paths

    def key(self, node: int) -> bytes:
        """A digest that names a node in all shards."""
        return hashlib.sha256(self.paths[self.owner[node]][: WIDTH * int(self.depth[node])]).digest()

    def ends(self, node: int) -> np.ndarray:
        """The conv_ids that end in a node, in order."""
        return self.ids[self.begin_end[node] : self.begin_end[node + 1]]


def _joined(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


_NODE = (
    "key binary, parent_key binary, piece long, shard int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, ends string"
)


def _shards(bounds: dict[int, tuple[int, int]]) -> Callable:
    """Nodes of each shard. Those it has alone are whole; a shared one has a key and the
    list of the conv_ids that end in it, in pieces of which the first has the counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, paths, sizes, number = [], [], [], None
        for batch in batches:
            if batch.num_rows:
                number = batch.column(3)[0].as_py()
                ids.append(batch.column(0).to_numpy(zero_copy_only=False))
                paths += batch.column(1).to_pylist()
                offsets = batch.column(2).offsets.to_numpy()
                flat = batch.column(2).values.to_numpy(zero_copy_only=False)
                sizes += [flat[a:b] for a, b in zip(offsets, offsets[1:])]
        if number is None:
            return
        shard = Shard(np.concatenate(ids), paths, sizes, *bounds[number])
        rows: list[tuple] = []
        parent = shard.parent.tolist()
        columns = zip(*(c.tolist() for c in (shard.least, shard.depth, shard.n_convs, shard.n_children, shard.n_leaves, shard.saved, shard.shared)))
        for node, (conv, depth, convs, children, leaves, saved, shared) in enumerate(columns):
            above = parent[node]
            apart = above >= 0 and bool(shard.shared[above])
            key, parent_key = shard.key(node) if shared else None, shard.key(above) if apart else None
            parent_conv = int(shard.least[above]) if above >= 0 and not apart else None
            ends = shard.ends(node)
            if shared:
                for piece in range(max(1, -(-len(ends) // PIECE))):
                    part = _joined(ends[piece * PIECE : (piece + 1) * PIECE])
                    counts = (convs, children, leaves, saved) if piece == 0 else (0, 0, 0, 0)
                    rows.append((key, parent_key, piece, number, conv, depth, parent_conv, *counts, None, part))
            else:
                digest = hashlib.sha256(_joined(ends).encode()).hexdigest()
                rows.append((None, parent_key, 0, number, conv, depth, parent_conv, convs, children, leaves, saved, digest, None))
            if len(rows) >= 4096:
                yield _batch(rows, _NODE)
        if rows:
            yield _batch(rows, _NODE)

    return run


_KINDS = {"binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "string": pa.string()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    out = pa.record_batch([pa.array(c, _KINDS[k]) for c, (_, k) in zip(zip(*rows), fields)], [n for n, _ in fields])
    rows.clear()
    return out


_DIGEST = "key binary, ends_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the lists of shared nodes, from their pieces in order."""
    key, digest, some, rows = None, None, False, []
    for batch in batches:
        for k, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key:
                if key is not None:
                    rows.append((key, digest.hexdigest()))
                key, digest, some = k, hashlib.sha256(), False
            if ends:
                digest.update((("," if some else "") + ends).encode())
                some = True
        if len(rows) >= 4096:
            yield _batch(rows, _DIGEST)
    if key is not None:
        rows.append((key, digest.hexdigest()))
    if rows:
        yield _batch(rows, _DIGEST)


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            (r["shard"], -1 if r["before"] is None else common_turns(r["before"], r["low"]), -1 if r["after"] is None else common_turns(r["high"], r["after"]))
            for r in batch.to_pylist()
        ]
        yield _batch(rows, "shard int, before int, after int")


def paths_of(sequences: DataFrame) -> DataFrame:
    """(conv_id, path, sizes) from (conv_id, turns), an array of (hex digest, size)."""
    return sequences.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: F.substring(t["digest"], 1, 2 * WIDTH)), "")).alias("path"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"),
    )


def sequences_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order (null turn first; those of one
    turn by digest), each with the SHA-256 of role and text and the bytes of the text. Null
    roles and texts are empty; rows without a conv_id belong to no conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    rows = conversations.where("conv_id is not null").select("conv_id", F.struct("turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("size")).alias("t"))
    sorted_ = F.sort_array(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(F.transform(sorted_, lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) of every conversation c after its first h turns gave way to those of
    conversation c - c % 5 (all if it has fewer, none if there is none), h being the CRC-32 of
    c's digits modulo 9."""
    own = sequences_of(conversations)
    first = own.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("of"), F.slice("turns", 1, SHARED - 1).alias("lead"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).cast("int")
    joined = own.join(first, F.col("conv_id") - F.col("conv_id") % GROUP == F.col("of"), "left")
    lead = F.coalesce(F.slice("lead", F.lit(1), h), F.slice("turns", 1, 0))
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return joined.select("conv_id", F.concat(lead, rest).alias("turns"))


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """The nodes of the trie of ``sequences`` (conv_id, turns: array of (digest, size)): conv_id
    (the least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. conv_ids are distinct. The root (depth 0) has every conversation, also those
    without turns; without conversations there is no node."""
    spark = sequences.sparkSession
    ship_code(spark)
    # stored: the shards of both passes must be the same
    laid = settle(paths_of(sequences).repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id"))
    laid = laid.withColumn("shard", F.spark_partition_id())
    ends = laid.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    # a row for each shard
    by_shard = Window.orderBy("shard")
    near = ends.select("shard", "low", "high", F.lag("high").over(by_shard).alias("before"), F.lead("low").over(by_shard).alias("after"))
    meetings = near.mapInArrow(_meetings, "shard int, before int, after int")
    bounds = {r.shard: (r.before, r.after) for r in meetings.collect()}
    nodes = settle(laid.mapInArrow(_shards(bounds), _NODE))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    spine = nodes.where("key is not null")
    merged = spine.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.min("parent_key").alias("parent_key"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    lists = spine.select("key", "ends", "shard", "piece").repartition("key").sortWithinPartitions("key", "shard", "piece")
    digests = lists.select("key", "ends").mapInArrow(_digests, _DIGEST).withColumnRenamed("key", "of")
    merged = settle(merged.join(digests, F.col("key") == F.col("of")).drop("of"))
    above = merged.select(F.col("key").alias("up"), F.col("conv_id").alias("up_conv_id"))
    if above.count() <= BROADCAST_NODES:
        above = F.broadcast(above)
    alone = nodes.where("key is null")
    parted = alone.where("parent_key is not null").unionByName(merged.withColumn("parent_conv_id", F.lit(None).cast("long")), allowMissingColumns=True)
    named = parted.join(above, F.col("parent_key") == F.col("up"), "left").withColumn("parent_conv_id", F.col("up_conv_id"))
    return alone.where("parent_key is null").select(*out).unionByName(named.select(*out))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """``prefix_trie`` of the rebuilt ``conversations`` (conv_id, turn, role, text).

    Null roles and texts are empty, a null turn comes first, rows without a conv_id are left
    out, repeated rows are turns, texts of any length are read whole, an empty table gives no
    node, and other columns are not read, whatever their names."""
    return prefix_trie(rebuilt(conversations))
