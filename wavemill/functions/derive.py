"""Derived columns of the star schema and reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def geo_key(district: Column, village: Column) -> Column:
    """NULL when either part is missing (``concat`` keeps NULLs, ``concat_ws`` would not)."""
    return F.md5(F.concat(F.lower(F.trim(district)), F.lit("|"), F.lower(F.trim(village))))


def date_key(ts: Column) -> Column:
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.day(ts)


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(60e6)


def seconds_to_minutes(c: Column) -> Column:
    return c / F.lit(60.0)


def ratio(num: Column, den: Column) -> Column:
    """NULL instead of a division by zero."""
    return num / F.nullif(den, F.lit(0))


def is_completed(status: Column) -> Column:
    return F.coalesce(status == 1, F.lit(False))


def is_consented(status: Column, consent: Column) -> Column:
    return is_completed(status) & F.coalesce(consent == 1, F.lit(False))


def status_label(status: Column) -> Column:
    out = None
    for code, label in config.STATUS_LABELS.items():
        out = F.when(status == code, label) if out is None else out.when(status == code, label)
    return out.otherwise("Missing")


def hh_size_band(size: Column) -> Column:
    return (F.when(size.isNull(), "Unknown").when(size <= 3, "1-3").when(size <= 6, "4-6")
             .when(size <= 9, "7-9").otherwise("10+"))


def head_age_band(age: Column) -> Column:
    lo, hi = config.HEAD_AGE_RANGE
    out = F.when(age.isNull() | ~age.between(lo, hi), "Unknown").when(age < 25, "15-24")
    for start in (25, 35, 45, 55):
        out = out.when(age < start + 10, f"{start}-{start + 9}")
    return out.otherwise("65+")


def row_hash(columns: Iterable[Column], digits: int = 32) -> Column:
    """Content hash of text values: equal rows, and only those, share a hash.

    Each value is written with its length, NULL with its own mark, so neither
    a NULL nor a shifted boundary can imitate other content. ``digits=16``
    gives the short 64-bit form; the default stays collision-free far beyond
    the 2^32 rows at which 64 bits do not.
    """
    # Not a lambda over an array: one is interpreted together with every expression below it. Without a test for NULL each
    # value is also computed once, as all that always runs is shared by its uses.
    parts = [F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in columns]
    return F.substring(F.md5(F.concat_ws(",", *parts)), 1, digits)
