"""Profiling of identifiers and codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def profile_ids(df: DataFrame, column: str, by: str = "survey_cycle") -> DataFrame:
    """Missing, distinct and repeated identifiers per cycle, from one count per identifier."""
    sizes = df.groupBy(by, column).agg(F.count("*").alias("n"))
    has = F.col(column).isNotNull()
    n = F.col("n")
    total = lambda cond: F.coalesce(F.sum(F.when(cond, n)), F.lit(0))
    return (sizes.groupBy(by)
            .agg(F.sum(n).alias("rows"), total(~has).alias("null_ids"),
                 F.count(column).alias("unique_ids"),
                 total(n > 1).alias("rows_with_repeated_id"),
                 F.sum(n - 1).alias("surplus_rows")))


def panel_overlap(df: DataFrame, columns: Sequence[str], n_cycles: int,
                  by: str = "survey_cycle") -> DataFrame:
    """How many identifiers occur in every cycle, for each of several spellings of the identifier."""
    long = (df.select(by, *columns).unpivot(by, list(columns), "id_form", "id")
            .where(F.col("id").isNotNull()))
    seen = long.groupBy("id_form", "id").agg(F.count_distinct(by).alias("cycles"))
    return seen.groupBy("id_form").agg(F.count_if(F.col("cycles") == n_cycles).alias("in_all_cycles"))


def shared_columns(presence: DataFrame, cycles: Sequence[str]) -> DataFrame:
    """How many variables every cycle has."""
    everywhere = F.lit(True)
    for c in cycles:
        everywhere = everywhere & F.col(f"in_{c}")
    return presence.agg(F.count_if(everywhere).alias("shared_by_all"))


def crosstab(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Counts of ``rows`` x ``columns``: a row for each pair that occurs."""
    known = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    return known.groupBy(rows, columns).agg(F.count("*").alias("n"))


def sample_values(df: DataFrame, column: str, k: int = 3, seed: int = 1) -> DataFrame:
    """``k`` distinct non-NULL values in a seeded order; a per-partition top-k, not a sort."""
    value = F.col(f"`{column}`")
    return df.where(value.isNotNull()).select(value).distinct().orderBy(_seeded(column, seed), value).limit(k)


def sample_by(df: DataFrame, columns: Sequence[str], by: str = "survey_cycle", k: int = 3, seed: int = 1) -> DataFrame:
    """(``by``, ``column``, ``nth``, ``value``): ``k`` distinct non-NULL values of each column and group, as text.

    Which ones depends on the values and the seed alone, not on the order or partitioning of rows. Equal values are
    merged map-side, and each task ranks what it has before anything is shuffled for the final ranks, so neither
    a large group nor a commonest value gathers in one task.
    """
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns))
    long = df.select(by, F.inline(cells)).where(F.col("value").isNotNull()).distinct()
    order = Window.partitionBy(by, "column").orderBy(_seeded("value", seed), "value")
    return long.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k).select(
        by, "column", "nth", "value")


def _seeded(column: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(f"`{column}`").cast("string")))


def all_null_columns(profile: DataFrame, by: str = "survey_cycle") -> DataFrame:
    """Shape of each export: number of columns and of those without any value."""
    return profile.groupBy(by).agg(F.count("*").alias("columns"),
                                   F.count_if("all_null").alias("all_null_columns"))
