"""Durations and time differences as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wall_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 of a wall-clock (``TIMESTAMP_NTZ``) value,
    computed from its date and time fields only, so the session time zone never
    enters (a difference across a daylight-saving gap stays exact)."""
    c = _col(ts)
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")
    secs = F.extract(F.lit("SECOND"), c)  # seconds with the fraction, decimal(8,6)
    return (
        days * F.lit(86_400_000_000)
        + F.hour(c).cast("bigint") * F.lit(3_600_000_000)
        + F.minute(c).cast("bigint") * F.lit(60_000_000)
        + (secs * 1_000_000).cast("bigint")
    )


def micros_between(start, end) -> Column:
    """``end - start`` in microseconds (wall clock)."""
    return wall_micros(end) - wall_micros(start)


def epoch_seconds(start, end) -> Column:
    """Seconds between two timestamps as double (microsecond exact); NULL if either is NULL."""
    return micros_between(start, end) / F.lit(1_000_000.0)


def format_duration(seconds) -> Column:
    """Human-readable duration: ``h:mmh`` from one hour, ``m:ssm`` from one minute,
    else seconds rounded to one decimal (ties to even) with an ``s`` suffix; NULL gives ''."""
    d = _col(seconds).cast("double")
    hours = F.floor(d / 3600)
    rest = d - hours * 3600
    minutes = F.floor(rest / 60)
    rest2 = rest - minutes * 60
    secs = F.floor(rest2)
    return (
        F.when(d.isNull(), F.lit(""))
        .when(hours != 0, F.concat(hours.cast("string"), F.lit(":"), F.lpad(minutes.cast("string"), 2, "0"), F.lit("h")))
        .when(minutes != 0, F.concat(minutes.cast("string"), F.lit(":"), F.lpad(secs.cast("string"), 2, "0"), F.lit("m")))
        .otherwise(F.concat(F.bround(rest2, 1).cast("string"), F.lit("s")))
    )


def format_duration_ms(ms) -> Column:
    """Duration given in milliseconds (browser form): adds ``ms`` and ``s.f`` forms.
    A tenth that rounds up to 10 carries into the seconds (5,960 ms gives 6.0s)."""
    m = _col(ms).cast("bigint")
    hours = F.floor(m / 3_600_000)
    r1 = m - hours * 3_600_000
    minutes = F.floor(r1 / 60_000)
    r2 = r1 - minutes * 60_000
    secs = F.floor(r2 / 1000)
    millis = r2 - secs * 1000
    tenths = secs * 10 + F.floor(millis / 100 + F.lit(0.5))
    return (
        F.when(m.isNull(), F.lit(None).cast("string"))
        .when(hours != 0, F.concat(hours.cast("string"), F.lit(":"), F.lpad(minutes.cast("string"), 2, "0"), F.lit("h")))
        .when(minutes != 0, F.concat(minutes.cast("string"), F.lit(":"), F.lpad(secs.cast("string"), 2, "0"), F.lit("m")))
        .when(secs != 0, F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("s")))
        .otherwise(F.concat(millis.cast("string"), F.lit("ms")))
    )


def format_time_difference(t1, t2) -> Column:
    """Calendar difference from ``t1`` to ``t2`` (t2 >= t1) as
    ``'Y years, M months, D days, h hours, m minutes, s seconds'`` keeping only the
    non-zero parts; seconds are always shown.

    Months are whole calendar months (day clipped to the month end, as adding
    months does), the remainder is split into days/hours/minutes/seconds."""
    a, b = _col(t1), _col(t2)
    months0 = (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))
    anchor0 = a + F.make_ym_interval(F.lit(0), months0)
    months = F.when(anchor0 > b, months0 - 1).otherwise(months0)
    anchor = a + F.make_ym_interval(F.lit(0), months)
    us = micros_between(anchor, b)
    total_s = F.floor(us / 1_000_000)
    parts = F.array(
        F.struct(F.floor(months / 12).alias("n"), F.lit("years").alias("u")),
        F.struct((months % 12).cast("bigint").alias("n"), F.lit("months").alias("u")),
        F.struct(F.floor(total_s / 86400).alias("n"), F.lit("days").alias("u")),
        F.struct(F.floor((total_s % 86400) / 3600).alias("n"), F.lit("hours").alias("u")),
        F.struct(F.floor((total_s % 3600) / 60).alias("n"), F.lit("minutes").alias("u")),
        F.struct((total_s % 60).cast("bigint").alias("n"), F.lit("seconds").alias("u")),
    )
    kept = F.filter(parts, lambda p: (p["n"] != 0) | (p["u"] == "seconds"))
    return F.array_join(F.transform(kept, lambda p: F.concat(p["n"].cast("string"), F.lit(" "), p["u"])), ", ")
