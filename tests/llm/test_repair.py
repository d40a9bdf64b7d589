"""Conversation repair against a step-by-step search and against all repairs of few rows."""

import hashlib
import heapq
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spark_elt.llm import repair
from spark_elt.llm.queries import QUERIES

from .cases import SF, rows
from .talks import crc, no_talks, talk_rows, talks

SPACE = " \t\n\x0b\x0c\r"
AFTER = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
NAME = {"u": "user", "a": "assistant"}


def plain_best(judged):
    """Cheapest (cost, audit, rows) by Dijkstra's search over (rows read, last role)."""
    queue = [(0, "", 0, "", ())]
    done = set()
    while True:
        cost, audit, at, last, out = heapq.heappop(queue)
        if at == len(judged) and last in ("", "a"):
            return cost, audit, out
        if (at, last) in done:
            continue
        done.add((at, last))
        for initial in AFTER[last]:
            if initial in NAME:
                heapq.heappush(queue, (cost + 3, audit + "I", at, initial, (*out, f"{NAME[initial]}:")))
        if at < len(judged):
            role, text, gone, truncated = judged[at]
            heapq.heappush(queue, (cost + 4, audit + "D", at + 1, last, out))
            if not gone:
                more = 3 if truncated else 0
                for initial in AFTER[last]:
                    if role[:1] == initial:
                        heapq.heappush(queue, (cost + more, audit + "K", at + 1, initial, (*out, f"{role}:{text}")))
                    if initial in NAME:
                        heapq.heappush(queue, (cost + 3 + more, audit + "R", at + 1, initial, (*out, f"{NAME[initial]}:{text}")))


def plain(table):
    """Reports of all conversations, from the contract's words."""
    talks_ = defaultdict(list)
    for conv, turn, role, text in table:
        alive = talks_[conv]
        role, text = (" " if v is None else v for v in (role, text))
        harm = crc(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}") % 20
        if harm == 0:
            continue
        if harm == 1:
            text = ""
        if harm == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if harm == 4:
            role = "user"
        alive += [(turn, role, text)] * (2 if harm == 3 else 1)
    for conv, alive in talks_.items():
        alive.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()))
        seen, judged, counts = set(), [], [0, 0, 0]
        for _, role, text in alive:
            blank, again, cut = not text.strip(SPACE), (role, text) in seen, text.rstrip(SPACE)[-1:] not in ".!?"
            seen.add((role, text))
            fault = 0 if blank else 1 if again else 2 if cut else None
            if fault is not None:
                counts[fault] += 1
            judged.append((role, text, blank or again, fault == 2))
        turns = [t for t, *_ in alive if t is not None]
        gaps = min(max(turns) - min(turns) + 1 - len(set(turns)), 2**63 - 1) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(alive, alive[1:]))
        cost, audit, out = plain_best(judged)
        yield conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def by_id(found):
    return sorted(found, key=lambda r: (r[0] is not None, r[0] or 0))


@given(st.lists(st.tuples(st.sampled_from("suat"), st.booleans(), st.booleans()), max_size=9))
@settings(max_examples=400, deadline=None)
def test_cells(given_rows):
    chart = repair.Chart()
    for initial, gone, cut in given_rows:
        chart.add(repair._row_cell(initial, gone, cut and not gone))
    assert repair.best(chart.whole()) == plain_best([(r, "", g, c and not g) for r, g, c in given_rows])[:2]


@given(st.lists(st.tuples(st.sampled_from("sua"), st.booleans()), max_size=12), st.integers(0, 12))
@settings(max_examples=200, deadline=None)
def test_spans_cut_anywhere(given_rows, cut):
    parts = [repair.Chart(), repair.Chart(), repair.Chart()]
    for i, (initial, gone) in enumerate(given_rows):
        parts[i >= cut].add(repair._row_cell(initial, gone, False))
        parts[2].add(repair._row_cell(initial, gone, False))
    assert repair.combine(parts[0].whole(), parts[1].whole()) == parts[2].whole()


@pytest.mark.parametrize("bits", [10, 1])
def test_table(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    got = by_id(tuple(r) for r in repair.repairs(talks(spark)).collect())
    assert got == by_id(plain(talk_rows()))
    assert by_id(tuple(r) for r in repair.audits(talks(spark)).collect()) == [r[:-1] for r in got]


def test_empty(spark):
    assert repair.repairs(no_talks(spark)).count() == 0
    one = spark.createDataFrame([(c, 0, "user", "Hi.") for c in range(200) if crc(f"{c}:0") % 20 == 0], "conv_id long, turn long, role string, text string")
    found = repair.repairs(one).collect()
    assert len(found) == one.count() > 0
    assert {tuple(r)[1:] for r in found} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_query(spark):
    got = by_id(tuple(r) for r in QUERIES["op13_conversation_repair"](spark, SF).collect())
    assert got == by_id(plain([r[:4] for r in rows("conversations")]))
