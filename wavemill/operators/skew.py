"""Joins that stay balanced when a few keys own a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is spread over several join tasks.
HOT_ROWS = 1_000_000


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "left") -> DataFrame:
    """Equi-join in which a NULL key equals a NULL key; the left side's keys are kept."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(renamed, cond, how).drop(*[f"_right_{k}" for k in keys])


def sized_lookup(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], size: str,
                 spread: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of ``rows`` with ``lookup`` (one row per key), hot keys salted.

    ``lookup[size]`` is the number of rows that carry the key. A key above
    ``hot_rows`` gets ``size / hot_rows`` salts; every other key keeps one, so
    the lookup grows by at most rows / hot_rows entries. The list of hot keys
    has that same bound (a thousand million rows give at most a thousand
    keys), which is what allows it to be broadcast.
    """
    n = "_salts"
    lookup = lookup.withColumn(n, F.ceil(F.col(size) / F.lit(hot_rows)))
    hot = lookup.where(F.col(n) > 1).select(*keys, n)
    rows = (rows.join(F.broadcast(hot), list(keys), "left")
            .withColumn("_salt", F.when(F.col(n) > 1, F.pmod(F.xxhash64(spread), F.col(n)))
                        .otherwise(F.lit(0).cast("bigint")))
            .drop(n))
    lookup = (lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                              F.col(n) - 1)))
              .drop(n))
    return rows.join(lookup, [*keys, "_salt"]).drop("_salt")
