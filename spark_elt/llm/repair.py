"""Conversation structure repair by weighted CYK interval parsing.

The roles of a well-formed conversation read ``(s?(ua)+)?`` by their initials. A repair
keeps, reroles (to user or assistant) or deletes each row and inserts empty user and
assistant rows anywhere; its audit is the initials of its edits in order. The grammar is
in Chomsky normal form over spans of rows: a symbol ``X[p, q]`` derives the repairs of a
span that lead the role pattern from state p to state q, and ``X[p, q] -> X[p, r] X[r, q]``
are its binary rules. A span's cell holds for each symbol the least (cost, audit). Cells of
one row have the insertions before it closed in, and the insertions at the end close the
last span. Cells are combined bottom-up by span length: two neighbours of equal length make
one of double length.

Two repairs of one span with one cost are never prefixes of each other (they have the same
number of edits of rows, and each insertion costs), so the least audits of two neighbours
make the least audit of both.

Runs as follows: rows are narrowed to an initial, their faults and digests; repeats of a row
at a later turn are found by aggregation; rows are sorted within blocks of turns, and each
block gives one cell, so a conversation of any length is shared by many tasks. The cells of
a conversation's blocks, its audit and the digest of its repaired rows are each made by one
task that streams them: a SHA-256 of a text takes the text in order. No group is held in
memory but the audits of the cells.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spark_elt.session import ship_code

# Costs of edits, roles, and the characters that are blank or end a sentence.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANK = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = ".!?"
#: Turns of a block, as a power of two.
BLOCK_BITS = 10
#: The least value of a turn: turns that are null sort before it, in its block. Gaps that
#: are more than a long holds are given as the largest one.
LEAST, MOST = -(2**63), 2**63 - 1

#: States of the role pattern: nothing yet, after the system row, after a user row, after
#: an assistant row; for each the state after a row of an initial.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
STATES = range(len(NEXT))
ROLES = {"u": "user", "a": "assistant"}
#: A well-formed conversation ends before its first row or after an assistant row.
ACCEPTED = (0, 3)

Cell = dict[tuple[int, int], tuple[int, str]]


def _closure() -> Cell:
    """The least insertions (none too) that lead from one state to another."""
    found: Cell = {(p, p): (0, "") for p in STATES}
    grown = True
    while grown:
        grown = False
        for (p, r), (cost, audit) in list(found.items()):
            for initial, q in NEXT[r].items():
                new = (cost + INSERT, audit + "I")
                if initial in ROLES and ((p, q) not in found or new < found[p, q]):
                    found[p, q] = new
                    grown = True
    return found


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans: ``X[p, q] -> X[p, r] X[r, q]``."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            more = right.get((r, q))
            if more is not None:
                new = (cost + more[0], audit + more[1])
                if (p, q) not in out or new < out[p, q]:
                    out[p, q] = new
    return out


INSERTIONS = _closure()


def _row(initial: str, gone: bool, truncated: bool) -> Cell:
    """The cell of one row with the insertions before it closed in."""
    edits: Cell = {}
    for p in STATES:
        edits[p, p] = (DELETE, "D")
        if gone:
            continue
        extra = TRUNCATED if truncated else 0
        ways = [(NEXT[p][i], (REROLE + extra, "R")) for i in ROLES if i in NEXT[p]]
        if initial in NEXT[p]:
            ways.append((NEXT[p][initial], (extra, "K")))
        for q, new in ways:
            if (p, q) not in edits or new < edits[p, q]:
                edits[p, q] = new
    return combine(INSERTIONS, edits)


class Chart:
    """The cells of the rows so far: spans of falling lengths, each a power of two unless
    it was given whole; a new span joins its neighbours of no greater length."""

    def __init__(self):
        self.spans: list[tuple[int, Cell]] = []

    def add(self, cell: Cell, length: int = 1) -> None:
        while self.spans and self.spans[-1][0] <= length:
            size, before = self.spans.pop()
            cell, length = combine(before, cell), length + size
        self.spans.append((length, cell))

    def whole(self) -> Cell:
        cell: Cell = {(p, p): (0, "") for p in STATES}
        for _, after in reversed(self.spans):
            cell = combine(after, cell)
        return cell


def best(cell: Cell) -> tuple[int, str]:
    """The least (cost, audit) of a whole conversation."""
    closed = combine(cell, INSERTIONS)
    return min(closed[0, q] for q in ACCEPTED if (0, q) in closed)


# ---------------------------------------------------------------- rows and their faults


def damaged(conversations: DataFrame) -> DataFrame:
    """Every row of ``conversations`` (conv_id, turn, role, text; nulls but those of turn and
    conv_id become one blank) after the damage that its CRC-32 of ``conv_id:turn`` modulo 20
    names: 0 drops it (``alive`` is false), 1 empties its text, 2 takes out ``.``, ``!`` and
    ``?``, 3 repeats it, 4 makes its role user."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    named = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("harm"))
    harm = F.col("harm")
    return named.select(
        "conv_id", "turn",
        F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.translate("text", SENTENCE_ENDS, "")).otherwise(F.col("text")).alias("text"),
        (harm != 0).alias("alive"),
        F.explode(F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _identity() -> Column:
    """A digest of role and text."""
    return F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))


def _narrow(rows: DataFrame) -> DataFrame:
    """Rows without their texts: initial, faults of the row itself, digest of role and text."""
    end = F.substring(F.rtrim("text", F.lit(BLANK)), -1, 1)
    return rows.select(
        "conv_id", "turn", "alive",
        _identity().alias("id"),
        F.substring("role", 1, 1).alias("initial"),
        (end == "").alias("blank"),
        ((end != "") & ~end.isin(*SENTENCE_ENDS)).alias("truncated"),
    )


def _with_repeats(narrow: DataFrame) -> DataFrame:
    """``again``: whether the same role and text stand at an earlier turn. Only what stands
    at several turns is joined back; repeats at one turn are neighbours after sorting."""
    turns = narrow.where("alive").groupBy("conv_id", "id").agg(
        F.min("turn").alias("first"), F.max("turn").alias("last"), F.count("turn").alias("known"), F.count("*").alias("n")
    )
    several = turns.where("first < last or (known > 0 and known < n)").select(
        F.col("conv_id").alias("of"), F.col("id").alias("what"), F.when(F.col("known") == F.col("n"), F.col("first")).alias("first")
    )
    joined = narrow.join(several, narrow.conv_id.eqNullSafe(F.col("of")) & (narrow.id == F.col("what")), "left")
    earlier = F.col("what").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))
    return joined.select(narrow["*"], F.coalesce(earlier, F.lit(False)).alias("again"))


def _block() -> Column:
    return F.shiftright(F.coalesce(F.col("turn"), F.lit(LEAST)), BLOCK_BITS)


_BLOCK = (
    "conv_id long, block long, n long, low long, high long, turns long, blank long, duplicate long, truncated long, "
    "illegal long, first string, final string, spans array<struct<p:int,q:int,cost:long,audit:string>>"
)
_SPAN = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_LEGAL = {"su", "ua", "au"}


class _Block:
    """What is known of a block of rows while they pass by in order."""

    def __init__(self):
        self.n = self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.first = self.final = self.before = None
        self.chart = Chart()

    def row(self, turn, identity, initial, blank, truncated, again) -> None:
        duplicate = not blank and (again or self.before == (turn, identity))
        truncated = truncated and not duplicate
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.illegal += self.final is not None and self.final + initial not in _LEGAL
        self.first = initial if self.first is None else self.first
        self.final = initial
        self.before = (turn, identity)
        self.n += 1
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.chart.add(_row_cell(initial, blank or duplicate, truncated))


_ROWS: dict[tuple, Cell] = {}


def _row_cell(initial: str, gone: bool, truncated: bool) -> Cell:
    known = (initial if initial in ("s", "u", "a") else "", gone, truncated)
    if known not in _ROWS:
        _ROWS[known] = _row(*known)
    return _ROWS[known]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each block of the sorted rows (conv_id, block, turn, id, alive, …)."""
    schema = pa.schema([
        *((c, pa.int64()) for c in ("conv_id", "block", "n", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal")),
        ("first", pa.string()), ("final", pa.string()), ("spans", _SPAN),
    ])
    key, block, out = None, None, []

    def done() -> None:
        if block is not None:
            spans = [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in block.chart.whole().items()]
            out.append((*key, block.n, block.low, block.high, block.turns, block.blank, block.duplicate, block.truncated,
                        block.illegal, block.first, block.final, spans))

    def flush() -> pa.RecordBatch:
        batch = pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        out.clear()
        return batch

    for batch in batches:
        for conv, at, turn, identity, alive, initial, blank, truncated, again in zip(*(c.to_pylist() for c in batch.columns)):
            if (conv, at) != key:
                done()
                key, block = (conv, at), _Block()
            if alive:
                block.row(turn, identity, initial, blank, truncated, again)
        if len(out) >= 1024:
            yield flush()
    done()
    if out:
        yield flush()


_REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each conversation from its blocks in order."""
    kinds = [*([pa.int64()] * 7), pa.string()]
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    current: dict = {}
    out: list[tuple] = []

    def done() -> None:
        if current:
            cost, audit = best(current["chart"].whole())
            gaps = min(current["high"] - current["low"] + 1 - current["turns"], MOST) if current["turns"] else 0
            out.append((current["conv_id"], gaps, *(current[c] for c in ("blank", "duplicate", "truncated", "illegal")), cost, audit))

    def flush() -> pa.RecordBatch:
        batch = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
        out.clear()
        return batch

    for batch in batches:
        for r in batch.to_pylist():
            if not current or r["conv_id"] != current["conv_id"]:
                done()
                current = {"conv_id": r["conv_id"], "chart": Chart(), "low": None, "high": None, "turns": 0, "final": None,
                           "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
            if not r["n"]:
                continue
            for c in ("turns", "blank", "duplicate", "truncated", "illegal"):
                current[c] += r[c]
            current["illegal"] += current["final"] is not None and current["final"] + r["first"] not in _LEGAL
            current["final"] = r["final"]
            current["low"] = r["low"] if current["low"] is None else current["low"]
            current["high"] = r["high"] if r["high"] is not None else current["high"]
            current["chart"].add({(s["p"], s["q"]): (s["cost"], s["audit"]) for s in r["spans"]}, r["n"])
        if len(out) >= 1024:
            yield flush()
    done()
    if out:
        yield flush()


# ---------------------------------------------------------------- operators


def audits(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Per conversation its faults after the damage and its cheapest repair: conv_id, gaps,
    blank, duplicate, truncated, illegal, cost, audit.

    Rows are taken by turn (null first), those of one turn by the digest of role and text.
    ``rows``: the damaged rows, where they are at hand."""
    ship_code(conversations.sparkSession)
    narrow = _with_repeats(_narrow(damaged(conversations) if rows is None else rows))
    blocks = (
        narrow.select("conv_id", _block().alias("block"), "turn", "id", "alive", "initial", "blank", "truncated", "again")
        .repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "id").mapInArrow(_blocks, _BLOCK)
    )
    return blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_reports, _REPORT)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reports with the digests of the repaired rows: each conversation's report comes
    first, its rows follow."""
    names = [f.split()[0] for f in _REPORT.split(", ")]
    kinds = [*([pa.int64()] * (len(names) - 1)), pa.string(), pa.string()]
    current, out = None, []

    def done() -> None:
        if current is not None:
            current.finish()
            out.append((*current.report, current.digest.hexdigest()))

    def flush() -> pa.RecordBatch:
        batch = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [*names, "repaired_sha256"])
        out.clear()
        return batch

    for batch in batches:
        reports = zip(*(batch.column(c).to_pylist() for c in names))
        for report, role, text in zip(reports, batch.column("role").to_pylist(), batch.column("text").to_pylist()):
            if report[-1] is not None:
                done()
                current = Repaired(report)
            else:
                current.row(role, text)
        if len(out) >= 1024:
            yield flush()
    done()
    if out:
        yield flush()


class Repaired:
    """The digest of the repaired rows of a conversation whose rows pass by in order;
    its report ends with the audit."""

    def __init__(self, report: tuple):
        self.report, self.audit, self.at, self.state, self.rows = report, report[-1], 0, 0, 0
        self.digest = hashlib.sha256()

    def _add(self, role: str, text: str) -> None:
        self.state = NEXT[self.state][role[:1]]
        self.digest.update(("\n" if self.rows else "").encode() + f"{role}:{text}".encode())
        self.rows += 1

    def _expected(self) -> str:
        return next(role for initial, role in ROLES.items() if initial in NEXT[self.state])

    def finish(self) -> None:
        """The insertions that stand next in the audit."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._add(self._expected(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.finish()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._add(role if edit == "K" else self._expected(), text)


def repairs(conversations: DataFrame) -> DataFrame:
    """``audits`` with ``repaired_sha256``, the digest of the repaired ``role:text`` rows
    joined by line ends, for every conv_id of ``conversations``.

    A null role or text is one blank, a null turn comes first, a null conv_id is a
    conversation of its own; repeated rows are rows (the second is a duplicate); texts of any
    length are read whole; a conversation without a row after the damage has zeros and empty
    texts; an empty table gives no row; other columns are not read, whatever their names."""
    ship_code(conversations.sparkSession)
    rows = damaged(conversations)

    def none(kind: str) -> Column:
        return F.lit(None).cast(kind)

    reports = audits(conversations, rows).select(
        "*", none("long").alias("turn"), none("binary").alias("id"), none("string").alias("role"), none("string").alias("text")
    )
    empty = [none(kind).alias(name) for name, kind in (f.split() for f in _REPORT.split(", ")[1:])]
    live = rows.where("alive").select("conv_id", *empty, "turn", _identity().alias("id"), "role", "text")
    stream = reports.union(live).repartition("conv_id")
    stream = stream.sortWithinPartitions("conv_id", F.col("audit").desc_nulls_last(), "turn", "id")
    return stream.mapInArrow(_repaired, _REPORT + ", repaired_sha256 string")
