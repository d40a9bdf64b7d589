"""Prefix trie against plain prefixes, and the parentheses against a stack."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spark_elt.llm import trie
from spark_elt.llm.queries import QUERIES

from .cases import SF, rows
from .talks import crc, no_talks, talk_rows, talks


def plain(table):
    own = defaultdict(list)
    for conv, turn, role, text in table:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [r[3:] for r in sorted(t)] for c, t in own.items()}
    whole = {}
    for c, turns in own.items():
        base, h = c - (c % 5 if c >= 0 else -(-c % 5)), crc(str(c)) % 9
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return nodes(whole)


def nodes(whole):
    """Rows of all prefixes, by the definition."""
    members, ends = defaultdict(set), defaultdict(set)
    for c, turns in whole.items():
        ends[turns].add(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
    kids = defaultdict(set)
    for p in members:
        if p:
            kids[p[:-1]].add(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        own = (len(members[p]) - 1) * len(p[-1][-1].encode()) if p else 0
        saved[p] = own + sum(saved[k] for k in kids[p])
    return sorted(
        (min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]), leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p in members
    )


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


@given(st.recursive(st.just([]), lambda inner: st.lists(inner, max_size=5), max_leaves=60), st.integers(0, 200))
@settings(max_examples=200, deadline=None)
def test_findclose(shape, deep):
    def text(node):
        return "(" + "".join(map(text, node)) + ")"

    bits = "(" * deep + text(shape) + "()" * deep + ")" * deep
    stack, close, pairs = [], {}, []
    for i, c in enumerate(bits):
        if c == "(":
            stack.append(i)
        else:
            close[stack.pop()] = i
    opens = np.array(sorted(close))
    tree = trie.Parentheses(np.array([c == "(" for c in bits]))
    assert tree.findclose(opens).tolist() == [close[i] for i in sorted(close)]
    pairs = [bits[:i].count("()") + (i > 0 and bits[i - 1 : i + 1] == "()") for i in range(len(bits))]
    assert tree.leaves_before()[: len(bits)].tolist() == [p for p in pairs]


def digest(turn):
    return hashlib.sha256(turn.encode()).hexdigest()


@pytest.mark.parametrize("shards", [1, 4, 23])
def test_shards_merge(spark, shards):
    rng = np.random.default_rng(shards)
    whole = {}
    for c in range(300):
        kind = rng.integers(4)
        if kind == 0:  # a hot path, its beginnings and what goes on from it
            turns = [f"h{i}" for i in range(rng.integers(0, 9))]
        elif kind == 1:
            turns = [f"h{i}" for i in range(6)]
        else:
            turns = [f"{'ab'[rng.integers(2)]}{i}" for i in range(rng.integers(0, 6))]
        whole[int(c * 7 - 900)] = tuple(("user", t) for t in turns)
    table = spark.createDataFrame(
        [(c, [(digest(t), len(t.encode())) for _, t in turns]) for c, turns in whole.items()],
        "conv_id long, turns array<struct<digest:string,size:long>>",
    ).repartition(3)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = found(trie.prefix_trie(table))
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert got == nodes(whole)


def test_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 3)
    monkeypatch.setattr(trie, "BROADCAST_NODES", 0)
    whole = {c: (("user", "same"),) * (c % 3) for c in range(100)}
    table = spark.createDataFrame(
        [(c, [(digest(t), len(t)) for _, t in turns]) for c, turns in whole.items()], "conv_id long, turns array<struct<digest:string,size:long>>"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(trie.prefix_trie(table)) == nodes(whole)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_table(spark):
    assert found(trie.conversation_trie(talks(spark))) == plain(talk_rows())


def test_empty(spark):
    assert trie.conversation_trie(no_talks(spark)).count() == 0
    turnless = spark.createDataFrame([(4, []), (2, [])], "conv_id long, turns array<struct<digest:string,size:long>>")
    ends = hashlib.sha256(b"2,4").hexdigest()
    assert found(trie.prefix_trie(turnless)) == [(2, 0, None, 2, 0, 1, 0, ends)]


def test_query(spark):
    assert found(QUERIES["op11_prefix_trie"](spark, SF)) == plain([r[:4] for r in rows("conversations")])
