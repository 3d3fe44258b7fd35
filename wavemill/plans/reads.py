"""Filtered reads and re-aggregations of the report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import derive


def with_cycle_label(df: DataFrame, cycles: DataFrame) -> DataFrame:
    """Adds ``cycle`` (the label); one row per cycle is broadcast."""
    labels = cycles.select("survey_cycle", F.col("cycle_label").alias("cycle"))
    return df.join(F.broadcast(labels), "survey_cycle")


def in_cycle_order(df: DataFrame) -> DataFrame:
    return df.orderBy("cycle_order")


def district_choices(geography: DataFrame) -> DataFrame:
    return geography.select("district").distinct().orderBy("district")


def filtered(df: DataFrame, cycles: Sequence[str], districts: Sequence[str] | None = None,
             with_missing: bool = False) -> DataFrame:
    """Rows of the chosen cycles and districts, optionally with those whose district is missing."""
    df = df.where(F.col("survey_cycle").isin(list(cycles)))
    if districts is None:
        return df
    chosen = F.col("district").isin(list(districts))
    return df.where(chosen | (F.col("district") == "Missing")) if with_missing else df.where(chosen)


def filtered_sql(spark: SparkSession, view: str, cycles: Sequence[str],
                 districts: Sequence[str]) -> DataFrame:
    """The same read as a parameterised statement over a registered view."""
    return spark.sql(
        f"SELECT * FROM {view} WHERE array_contains(:cycles, survey_cycle) "
        "AND (array_contains(:districts, district) OR district = 'Missing')",
        args={"cycles": list(cycles), "districts": list(districts)})


def daily_submissions(operations: DataFrame) -> DataFrame:
    return (operations.groupBy("survey_cycle", "submission_date", "district")
            .agg(F.sum("submissions_raw").alias("submissions_raw")))


def ops_headline(operations: DataFrame) -> DataFrame:
    """Totals and ratios over whatever the caller filtered."""
    sums = ("submissions_raw", "submissions_deduplicated", "submissions_superseded",
            "submissions_missing_location")
    totals = operations.agg(*[F.sum(s).alias(s) for s in sums],
                            F.sum("interview_minutes_sum").alias("minutes"),
                            F.sum("interview_minutes_n").alias("n"))
    return totals.select(
        *sums[:3],
        derive.ratio(F.col("submissions_missing_location"), F.col("submissions_raw"))
        .alias("missing_location_rate"),
        derive.ratio(F.col("minutes"), F.col("n")).alias("avg_interview_minutes"))


def program_headline(summary: DataFrame) -> DataFrame:
    sums = ("households_attempted", "households_completed", "households_consented")
    totals = summary.agg(*[F.sum(s).alias(s) for s in sums])
    return totals.select(
        *sums, derive.ratio(F.col(sums[1]), F.col(sums[0])).alias("completion_rate"),
        derive.ratio(F.col(sums[2]), F.col(sums[1])).alias("consent_rate"))


def _share_of_cycle(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    # The window runs over the few categories of a cycle, not over rows.
    total = F.sum(value).over(Window.partitionBy(*by))
    return df.withColumn("share", F.col(value) / total)


def status_share(operations: DataFrame) -> DataFrame:
    totals = (operations.groupBy("survey_cycle", "interview_status_label")
              .agg(F.sum("submissions_raw").alias("submissions_raw")))
    return _share_of_cycle(totals, "submissions_raw", ["survey_cycle"])


def demographic_share(demographics: DataFrame) -> DataFrame:
    """Share of each category in its cycle and dimension."""
    totals = (demographics.groupBy("survey_cycle", "dimension", "category")
              .agg(F.sum("households").alias("households")))
    return _share_of_cycle(totals, "households", ["survey_cycle", "dimension"])


def unknown_last(df: DataFrame, column: str = "category") -> DataFrame:
    return df.orderBy(F.col(column) == "Unknown", column)


def dedup_stages(by_cycle: DataFrame) -> DataFrame:
    """Raw against deduplicated submissions, long form."""
    return (by_cycle.select("survey_cycle", F.col("submissions_raw").alias("Raw"),
                            F.col("submissions_deduplicated").alias("Deduplicated"))
            .unpivot("survey_cycle", ["Raw", "Deduplicated"], "stage", "submissions"))


def rates_long(by_cycle: DataFrame) -> DataFrame:
    """Data-capture rates in long form; undefined rates are left out."""
    names = {"duplicate_household_rate": "Duplicate household rate",
             "missing_location_rate": "Missing location rate",
             "missing_gps_rate": "Missing GPS rate"}
    return (by_cycle.select("survey_cycle", *[F.col(c).alias(n) for c, n in names.items()])
            .unpivot("survey_cycle", list(names.values()), "metric", "rate")
            .dropna(subset=["rate"]))


def district_rates(summary: DataFrame) -> DataFrame:
    """Mean completion and consent rate per district, cycle and month: a row for each that occurs."""
    return (summary.groupBy("district", "survey_cycle", "year_month")
            .agg(F.round(F.avg("completion_rate"), 3).alias("completion_rate"),
                 F.round(F.avg("consent_rate"), 3).alias("consent_rate")))


def rate_pivot(summary: DataFrame, periods: Sequence[str] | None = None) -> DataFrame:
    """The same with a column for each cycle and month, in the order given or, from a job, as they occur."""
    long = district_rates(summary).withColumn("period", F.concat_ws(" ", "survey_cycle", "year_month"))
    return (long.groupBy("district").pivot("period", list(periods) if periods else None)
            .agg(F.first("completion_rate").alias("completion_rate"), F.first("consent_rate").alias("consent_rate")))


def coverage_with_labels(coverage: DataFrame,
                         cycles: Sequence[config.Cycle] = config.CYCLES) -> DataFrame:
    pattern = F.col("cycle_pattern")
    for c in cycles:
        pattern = F.replace(pattern, F.lit(c.code), F.lit(c.label))
    return coverage.withColumn("cycle_pattern", pattern)


def households_by_cycles_seen(coverage: DataFrame) -> DataFrame:
    return coverage.groupBy("n_cycles").agg(F.sum("households").alias("households"))


def panel_size(panel: DataFrame) -> DataFrame:
    """Households of the balanced panel, counted in the first cycle shown."""
    per_cycle = panel.groupBy("cycle_order").agg(F.sum("households").alias("households"))
    return per_cycle.agg(F.coalesce(F.min_by("households", "cycle_order"), F.lit(0))
                         .alias("panel_households"))


def dq_counters(results: DataFrame) -> DataFrame:
    failing = lambda severity: F.count_if((F.col("severity") == severity) & ~F.col("passed"))
    return results.agg(F.count("*").alias("checks"), failing("warn").alias("warnings_failing"),
                       failing("error").alias("errors_failing"))


def recent_runs(runs: DataFrame, order: str = "logged_at", k: int = 20) -> DataFrame:
    """The latest runs, ties by all other columns: a per-partition top-k, then a merge of k rows each."""
    return runs.orderBy(F.desc(order), *[c for c in runs.columns if c != order]).limit(k)
