"""Casts from export text to contract types. Bad values become NULL, never a guess."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^(?i)[+-]?inf(inity)?$"


def parse_timestamps(c: Column, formats: Sequence[str]) -> Column:
    """First pattern that fits wins; the wall-clock time does not depend on the session zone."""
    tries = [F.try_to_timestamp(F.concat(c, F.lit(" +0000")), F.lit(f"{fmt} xx")) for fmt in formats]
    instant = F.coalesce(*tries) if len(tries) > 1 else tries[0]
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant),
                           F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def to_double(c: Column) -> Column:
    # Spark also reads '1d', '1f' and 'NaN' as numbers, hence the pattern.
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def whole(d: Column) -> Column:
    """A double as integer; NULL unless it is one of 64 bits."""
    return F.when((d == F.rint(d)) & (d >= -2.0 ** 63) & (d < 2.0 ** 63), d.try_cast("bigint"))


def to_integral(c: Column) -> Column:
    """``3`` and ``3.0`` are 3; ``3.5`` is NULL. Plain digits keep all of theirs, also beyond 2^53."""
    return F.coalesce(F.regexp_replace(c, r"\.0*$", "").try_cast("bigint"), whole(to_double(c)))


def drop_point_zero(c: Column) -> Column:
    return F.regexp_replace(c, r"\.0$", "")


def cast_variable(c: Column, canonical_name: str, dtype: str, formats: Sequence[str]) -> Column:
    """One stripped export column as its contract type."""
    if dtype == "timestamp":
        return parse_timestamps(c, formats)
    if dtype == "int":
        return to_integral(c)
    if dtype == "float":
        return to_double(c)
    return drop_point_zero(c) if canonical_name == "form_version" else c
