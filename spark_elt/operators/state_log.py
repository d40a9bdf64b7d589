"""State of nodes as a log of changes (I05–I07): what a step writes is in proportion to what
it changes, and steps of different nodes never meet.

Each node has a folder of its own. A change is a Parquet folder ``change=N`` of rows that are
put or removed; its number is claimed first, so of two writers of one node one fails. ``compact``
writes the whole state after change N as ``base=N``. A reader takes the newest committed base and
the changes after it, and per key the row of the highest number. What a base makes superfluous is
deleted only by the compaction after the next one begins, so a reader that has listed the folder
finds every file it saw, and sees one state.

``StateLog`` can stand for ``incremental.StateTable`` wherever a load or a copy takes one.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from spark_elt.functions.paths import path_literal
from spark_elt.operators.incremental import CLAIM_SECONDS, StateChanged
from spark_elt.sources import file_system

#: Changes after a base from which a write compacts its node.
COMPACT_EVERY = 32
_SEQ, _PUT = StructField("_seq", LongType()), StructField("_put", BooleanType())


class StateLog:
    """A state keyed by node path and ``keys``, stored as changes by node."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], node: str = "node_path"):
        self.spark, self.path, self.schema, self.keys, self.node = spark, path.rstrip("/"), schema, list(keys), node

    # ------------------------------------------------------------ reading

    def read(self, node_path: Sequence[str] | None = None) -> DataFrame:
        """The state, or that of one node, of which only the folder is read."""
        folders = [self._folder(node_path)] if node_path is not None else self._folders()
        paths = [p for f in folders for p in self._parts(f)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(StructType([*self.schema.fields, _SEQ, _PUT])).parquet(*paths)
        rest = [f.name for f in self.schema.fields if f.name not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest, "_put"), "_seq").alias("_r"))
        kept = newest.where("_r._put").select(*self.keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
        return kept.select(*self.schema.names)

    def version(self) -> int | None:
        """Changes so far, over all nodes; None before the first."""
        last = [self._last(f) for f in self._folders()]
        return sum(last) if last else None

    # ------------------------------------------------------------ writing

    def upsert(self, rows: DataFrame) -> None:
        """Put ``rows``, a change for each of their nodes."""
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        for node in self._nodes(rows):
            self._write(node, rows.where(F.col(self.node) == path_literal(node)), put=True)

    def delete_where(self, cond: Column) -> None:
        """Remove the rows where ``cond`` is true (not those where it is NULL)."""
        gone = self.read().where(F.coalesce(cond, F.lit(False)))
        for node in self._nodes(gone):
            self._write(node, self.read(node).where(F.coalesce(cond, F.lit(False))), put=False)

    def replace(self, rows: DataFrame) -> None:
        """Put ``rows`` and remove all others."""
        wanted = rows.select(*[F.col(k).alias(f"_w_{k}") for k in self.keys])
        other = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_w_{k}")) for k in self.keys))
        gone = self.read().join(wanted, other, "left_anti")
        for node in self._nodes(gone):
            self._write(node, self.read(node).join(wanted, other, "left_anti"), put=False)
        self.upsert(rows)

    def compact(self, node_path: Sequence[str]) -> None:
        """Write the state of a node as a new base, and delete what the last one replaced."""
        folder = self._folder(node_path)
        bases, last = self._numbers(folder, "base"), self._last(folder)
        if not last or (bases and bases[-1] == last) or file_system.exists(self.spark, f"{folder}/base={last}"):
            return
        if bases:  # readers that began before it was the newest have ended
            for kind in ("base", "change"):
                for n in self._numbers(folder, kind):
                    if n < bases[-1] or (kind == "change" and n == bases[-1]):
                        file_system.delete(self.spark, f"{folder}/{kind}={n}")
        whole = self.read(node_path).withColumn("_seq", F.lit(last).cast("long")).withColumn("_put", F.lit(True))
        whole.write.mode("errorifexists").parquet(f"{folder}/base={last}")

    def _write(self, node: Sequence[str], rows: DataFrame, put: bool) -> None:
        folder = self._folder(node)
        n = self._claim(folder)
        out = rows.withColumn("_seq", F.lit(n).cast("long")).withColumn("_put", F.lit(put))
        out.write.mode("errorifexists").parquet(f"{folder}/change={n}")
        file_system.delete(self.spark, f"{folder}/_claim-{n - 1}")
        bases = self._numbers(folder, "base")
        if n - (bases[-1] if bases else 0) >= COMPACT_EVERY:
            self.compact(node)

    def _claim(self, folder: str) -> int:
        """The number of the next change, claimed for this writer. A claim that is old and has
        no change belongs to a writer that is gone; its number is passed over."""
        n = self._last(folder) + 1
        while not file_system.create_new(self.spark, f"{folder}/_claim-{n}"):
            if file_system.age(self.spark, f"{folder}/_claim-{n}") < CLAIM_SECONDS:
                raise StateChanged(f"change {n} of {folder} is being written by another job")
            n += 1
        if self._last(folder) >= n:
            raise StateChanged(f"{folder} has changed meanwhile")
        return n

    # ------------------------------------------------------------ folders

    def _folder(self, node: Sequence[str]) -> str:
        return f"{self.path}/node={hashlib.sha256(json.dumps(list(node)).encode()).hexdigest()[:32]}"

    def _folders(self) -> list[str]:
        return [f"{self.path}/{n}" for n in file_system.children(self.spark, self.path) if n.startswith("node=")]

    def _numbers(self, folder: str, kind: str) -> list[int]:
        """Committed bases or changes of a node, oldest first."""
        names = (c for c in file_system.children(self.spark, folder) if c.startswith(f"{kind}="))
        return sorted(int(c.split("=")[1]) for c in names if file_system.committed(self.spark, f"{folder}/{c}"))

    def _last(self, folder: str) -> int:
        return max([*self._numbers(folder, "change"), *self._numbers(folder, "base")], default=0)

    def _parts(self, folder: str) -> list[str]:
        bases = self._numbers(folder, "base")
        base = bases[-1:] or [0]
        changes = [n for n in self._numbers(folder, "change") if n > base[0]]
        return [f"{folder}/base={n}" for n in bases[-1:]] + [f"{folder}/change={n}" for n in changes]

    def _nodes(self, rows: DataFrame) -> list[list[str]]:
        """Nodes of a change: as many as it speaks of, one for a step's own."""
        return [list(r[0]) for r in rows.select(self.node).distinct().collect()]
