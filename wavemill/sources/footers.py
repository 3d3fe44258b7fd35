"""Counts and value ranges of stored tables from their Parquet footers, without reading a row.

Spark pushes count, min and max into its newer Parquet reader, which answers each file from the statistics of its
footer. That reader is a setting of a session, so these frames belong to one of their own; other frames keep
theirs. Strings and timestamps have no reliable statistics and are refused rather than scanned.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import apply_settings

#: Kinds of columns whose smallest and largest values footers hold.
RANGED = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark``, with the library's settings, that answers aggregates from footers."""
    session = apply_settings(spark.newSession())
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def footer_stats(session: SparkSession, path: str, columns: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """``n_rows`` and each column's ``min_`` and ``max_``: one row, or one for each folder of the partition columns ``by``.

    An empty table has 0 rows and NULL ranges. Where a column is NULL throughout one file, its footer holds no range and
    Spark raises when the frame is run; ``stats_row`` has a way for that.
    """
    stored = session.read.parquet(path)
    for name in columns:
        if not isinstance(stored.schema[name].dataType, RANGED):
            raise ValueError(f"footers hold no range of {name}, {stored.schema[name].dataType.simpleString()}")
    # Without any file the pushed count is NULL, which the optimizer does not expect: it would remove a coalesce.
    wanted = [F.when(F.count("*") > 0, F.count("*")).otherwise(0).alias("n_rows")]
    for name in columns:
        wanted += [F.min(name).alias(f"min_{name}"), F.max(name).alias(f"max_{name}")]
    return (stored.groupBy(*by) if by else stored).agg(*wanted)


def stats_row(session: SparkSession, path: str, columns: Sequence[str]) -> Row:
    """The one row of ``footer_stats``; read from the columns if a file's footer lacks one of their ranges."""
    try:
        return footer_stats(session, path, columns).first()
    except Exception as error:
        if "aggregatePushdown" not in str(error):  # what Spark advises to switch off, and nothing else
            raise
    reading = session.newSession()
    apply_settings(reading)
    return footer_stats(reading, path, columns).first()


def stored_counts(session: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(``table_name``, ``n_rows``) of the tables stored at ``paths``."""
    each = [footer_stats(session, path).select(F.lit(name).alias("table_name"), "n_rows")
            for name, path in paths.items()]
    if not each:
        return session.createDataFrame([], "table_name string, n_rows long")
    return reduce(DataFrame.unionByName, each)
