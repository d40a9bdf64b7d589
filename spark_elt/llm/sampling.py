"""Bounded, repeatable training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: str = "doc_id") -> Column:
    """The fold of a document: crc32 of its id as text, modulo 5."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def draw(rows: DataFrame, n: int, *key: str, per: str | None = None) -> DataFrame:
    """About ``n`` rows (of each value of ``per``; all if there are fewer), chosen by a
    hash of ``key``: each row stands alone, so no group is sorted or gathered."""
    place = F.pmod(F.xxhash64(F.lit("sample"), *key), F.lit(1 << 30)) / (1 << 30)
    if per is None:
        total = rows.count()
        return rows.where(place < n / max(n, total))
    counts = rows.groupBy(per).agg(F.count("*").alias("c")).collect()
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col(per) == r[0], n / max(n, r.c)).otherwise(share)
    return rows.where(place < share)
