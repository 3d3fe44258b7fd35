"""Dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import derive
from ..functions.text import title_case


def dim_survey_cycle(cycles: DataFrame, submissions: DataFrame) -> DataFrame:
    """One row per configured cycle, also when nothing was submitted in it."""
    field = (submissions.groupBy("survey_cycle")
             .agg(F.min("submitted_at").alias("first"), F.max("submitted_at").alias("last")))
    return (cycles.join(F.broadcast(field), "survey_cycle", "left")  # one row per cycle
            .select("survey_cycle", "cycle_order", "cycle_label", "source_file", "form_file",
                    "choice_list_cycle", F.year("first").alias("survey_year"),
                    F.to_date("first").alias("fieldwork_start"),
                    F.to_date("last").alias("fieldwork_end")))


def dim_time(submissions: DataFrame) -> DataFrame:
    """Every day from the first to the last submission, quarantined ones included."""
    span = submissions.agg(F.to_date(F.min("submitted_at")).alias("lo"),
                           F.to_date(F.max("submitted_at")).alias("hi"))
    d = F.col("date")
    iso_day = F.weekday(d) + 1
    return (span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))
            .select(derive.date_key(d).alias("date_key"), d, F.year(d).alias("year"),
                    F.quarter(d).alias("quarter"), F.month(d).alias("month"),
                    F.date_format(d, "MMMM").alias("month_name"),
                    F.date_format(d, "yyyy-MM").alias("year_month"),
                    F.weekofyear(d).alias("iso_week"), iso_day.alias("day_of_week"),
                    F.date_format(d, "EEEE").alias("day_name"), (iso_day >= 6).alias("is_weekend")))


def _with_geo_key(kept: DataFrame) -> DataFrame:
    return kept.withColumn("geo_key", derive.geo_key(F.col("district"), F.col("village")))


def geography_name_history(kept: DataFrame) -> DataFrame:
    """Every spelling of a place in every cycle."""
    return (_with_geo_key(kept)
            .select("geo_key", "survey_cycle", "district", "subcounty", "parish", "cluster",
                    "village").distinct())


def dim_geography(kept: DataFrame, regions: DataFrame) -> DataFrame:
    """Places by (district, village); names as last seen, ties by time and then by key.

    Kept households are first merged by spelling, a map-side combined step, so
    a village with most of the households reaches the last step as few rows.
    """
    at = F.struct("cycle_order", "submitted_at", "submission_key")
    names = ("district", "subcounty", "parish", "cluster", "village")
    spelled = (_with_geo_key(kept).groupBy("geo_key", "survey_cycle", *names)
               .agg(F.max(at).alias("seen")))

    def latest(name: str):
        seen = F.when(F.col(name).isNotNull(), F.col("seen"))
        return F.max_by(title_case(F.col(name)), seen).alias(name)

    places = spelled.groupBy("geo_key").agg(
        *[latest(n) for n in names],
        F.count_distinct("survey_cycle").alias("cycles_seen"),
        F.count_distinct(F.lower("parish")).alias("parish_spellings_seen"))
    lookup = regions.select(F.lower("district").alias("_district"), "region_code", "region_name",
                            "sub_region")
    return (places.join(lookup, F.lower(places["district"]) == F.col("_district"), "left")
            .select("geo_key", "region_code", "region_name", "sub_region", *names,
                    "cycles_seen", "parish_spellings_seen"))


def dim_household(kept: DataFrame, n_cycles: int) -> DataFrame:
    """Panel membership. A household has at most one kept row per cycle, so lists stay short."""
    def first_seen(name: str):
        return F.min_by(name, F.when(F.col(name).isNotNull(), F.col("cycle_order")))

    pattern = F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("cycle_order", "survey_cycle"))),
        lambda x: x["survey_cycle"]), " + ")
    # The grain makes rows and cycles of a household the same number.
    return (kept.groupBy("household_id")
            .agg(F.min("cycle_order").alias("first_cycle_order"),
                 F.count("*").alias("n_cycles"),
                 pattern.alias("cycle_pattern"),
                 F.bool_or(F.col("survey_cycle") == config.CYCLES[0].code).alias("has_baseline"),
                 first_seen("wealth_quartile").alias("first_wealth_quartile"),
                 F.coalesce(F.max("cohort"), F.lit(config.DEFAULT_COHORT)).alias("cohort"),
                 first_seen("head_sex").alias("head_sex_first_seen"),
                 # Raw spellings, so a mere change of case counts as a move.
                 F.coalesce(F.min("district") != F.max("district"), F.lit(False))
                  .alias("moved_district"))
            .select("household_id", "first_cycle_order", "n_cycles", "cycle_pattern",
                    (F.col("n_cycles") == n_cycles).alias("in_balanced_panel"), "has_baseline",
                    "first_wealth_quartile", "cohort", "head_sex_first_seen", "moved_district"))
