"""Text, status and ratio expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mask_secrets(col, masks: Sequence[str], replacement: str = "***") -> Column:
    """Replace each literal mask (not a pattern) by ``***``, in the given order."""
    c = _col(col)
    for m in masks:
        if m:
            c = F.replace(c, F.lit(m), F.lit(replacement))
    return c


def clean_message(col, masks: Sequence[str] = ()) -> Column:
    """Right-trim a log message, then mask secrets; filter ``length > 0`` afterwards
    to drop blank messages."""
    return mask_secrets(F.regexp_replace(_col(col), r"\s+$", ""), masks)


def sanitize_id(col) -> Column:
    """Node-id form of a value: lower case, ``-`` to ``_``, then drop every
    character outside ``[0-9a-z_]``."""
    return F.regexp_replace(F.replace(F.lower(_col(col).cast("string")), F.lit("-"), F.lit("_")), r"[^0-9a-z\-_]+", "")


def day_id(col) -> Column:
    """``yyyymmdd`` integer of a date or timestamp (daily partition key)."""
    return F.date_format(_col(col), "yyyyMMdd").cast("int")


def iso_timestamp(col) -> Column:
    """ISO-8601 text with microseconds, as Python's ``isoformat`` writes it
    (fraction left out when it is zero)."""
    c = _col(col)
    return F.when(
        F.date_format(c, "SSSSSS") == "000000", F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    ).otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def status_text(succeeded) -> Column:
    """NULL / true / false → unfinished / succeeded / failed."""
    s = _col(succeeded)
    return F.when(s.isNull(), F.lit("unfinished")).when(s, F.lit("succeeded")).otherwise(F.lit("failed"))


def format_labels(col) -> Column:
    """``k: 'v', k2: 'v2'`` of a string map, ordered by key."""
    entries = F.array_sort(F.map_entries(_col(col)))
    return F.coalesce(
        F.array_join(
            F.transform(entries, lambda e: F.concat(e["key"], F.lit(": '"), e["value"], F.lit("'"))), ", "
        ),
        F.lit(""),
    )


def truncate_text(col, limit: int = 2000, suffix: str = "</pre>") -> Column:
    c = _col(col)
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit(suffix))).otherwise(c)


def usage_ratio(used, total) -> Column:
    """``100 * used / total``; NULL when total is 0 or NULL."""
    return F.lit(100.0) * F.try_divide(_col(used).cast("double"), F.nullif(_col(total).cast("double"), F.lit(0.0)))
