"""Exact interpolated medians without a whole group in one task.

``percentile``/``median`` keep every distinct value of a group in one buffer.
Here a sketch of bounded size first brackets the middle of each group: values
whose ranks lie so close to it that the sketch cannot tell. What is below the
bracket is counted, and only the values inside it, one in some ten thousand, are
merged, ranked and picked from. The sketch's error is bounded, not merely
likely, so the middle ranks are always inside and the result is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The sketch's ranks are off by one in so many at most; the bracket reaches five times as far on both sides.
_ACCURACY = 100_000
_REACH = 5 / _ACCURACY


def aggregate_with_median(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], value: str,
                          out: str) -> DataFrame:
    """``groupBy(keys).agg(aggs)`` with the exact median of ``value`` beside it.

    A NULL key is a group of its own, NULL values do not count, and a group
    without any has a NULL median.
    """
    c, v = F.col, F.col(value).cast("double")
    group = F.struct(*keys)  # one struct as key keeps NULL keys equal to themselves in the joins below
    bracket = F.percentile_approx(v, [0.5 - _REACH, 0.5 + _REACH], _ACCURACY)
    groups = df.groupBy(group.alias("_g")).agg(*aggs, F.count(v).alias("_n"), bracket.alias("_bracket"))
    bounds = groups.select("_g", "_n", c("_bracket")[0].alias("_lo"), c("_bracket")[1].alias("_hi"))
    near = (df.select(group.alias("_g"), v.alias("_v")).where("_v is not null")
            .join(bounds, "_g").where(c("_v") <= c("_hi"))
            .groupBy("_g", "_n", F.when(c("_v") >= c("_lo"), c("_v")).alias("_v"))
            .agg(F.count("*").alias("_c")))
    # NULL stands for all values below the bracket.
    ranked = near.withColumn("_upto", F.sum("_c").over(Window.partitionBy("_g").orderBy(c("_v").asc_nulls_first())))
    ranks = (F.ceil(c("_n") / 2), F.floor(c("_n") / 2) + 1)
    low, high = (F.min(F.when(c("_upto") >= r, c("_v"))) for r in ranks)
    middle = ranked.groupBy("_g").agg(((low + high) / 2).alias(out)).withColumnRenamed("_g", "_of")
    joined = groups.join(middle, c("_g") == c("_of"), "left")
    return joined.select(*[c(f"_g.{k}").alias(k) for k in keys],
                         *[x for x in groups.columns if not x.startswith("_")], out)


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """``keys`` and the median of the non-NULL ``value``; groups without a value are absent."""
    return aggregate_with_median(df.where(F.col(value).isNotNull()), keys, [], value, out)
