"""Report tables. Counts are additive, so every roll-up of them stays right.

Facts are reduced by their own keys before any dimension is joined: the
reduction combines map-side, and what reaches a join is one row per group, so
a village, day or cycle with most of the facts weighs no more than another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import derive
from ..functions.text import title_case
from ..operators.dedupe import REJECTED, SUPERSEDED
from ..operators.median import aggregate_with_median

CYCLE_KEYS = ("survey_cycle", "cycle_order")


def rpt_field_operations(submissions: DataFrame) -> DataFrame:
    """cycle x date x district x status, over every submission (kept and quarantined)."""
    c = F.col
    at = c("submitted_at")
    unplaced = c("district").isNull() | c("subcounty").isNull() | c("parish").isNull() | c("village").isNull()
    return (submissions.select(
                *CYCLE_KEYS, derive.date_key(at).alias("date_key"),
                F.to_date(at).alias("submission_date"),
                F.coalesce(title_case(c("district")), F.lit("Missing")).alias("district"),
                derive.status_label(c("interview_status")).alias("interview_status_label"),
                "is_kept", "reject_reason", "interview_duration_sec", unplaced.alias("unplaced"))
            .groupBy(*CYCLE_KEYS, "date_key", "submission_date", "district",
                     "interview_status_label")
            .agg(F.count("*").alias("submissions_raw"),
                 F.count_if(c("is_kept")).alias("submissions_deduplicated"),
                 F.count_if(c("reject_reason") == SUPERSEDED).alias("submissions_superseded"),
                 F.count_if(c("reject_reason").isin(*REJECTED)).alias("submissions_rejected"),
                 F.count_if(c("unplaced")).alias("submissions_missing_location"),
                 derive.seconds_to_minutes(F.sum("interview_duration_sec"))
                 .alias("interview_minutes_sum"),
                 F.count("interview_duration_sec").alias("interview_minutes_n")))


def rpt_field_operations_cycle(operations: DataFrame, kept: DataFrame, submissions: DataFrame,
                               availability: DataFrame) -> DataFrame:
    """Headline rates per cycle.

    ``availability``: survey_cycle, canonical_name, available. Where GPS was
    not collected its rate is NULL, not 100 %.
    """
    sums = ("submissions_raw", "submissions_deduplicated", "submissions_superseded",
            "submissions_rejected", "submissions_missing_location")
    ops = operations.groupBy(*CYCLE_KEYS).agg(
        *[F.sum(s).alias(s) for s in sums],
        derive.ratio(F.sum("interview_minutes_sum"), F.sum("interview_minutes_n"))
        .alias("avg_interview_minutes"))
    households = aggregate_with_median(
        kept, ["survey_cycle"],
        [F.count("*").alias("households"),
         F.count_if(F.col("household_submissions") > 1).alias("households_with_duplicates")],
        "interview_duration_sec", "median_sec")
    collected = (availability.where(F.col("canonical_name") == "gps_lat")
                 .groupBy("survey_cycle").agg(F.bool_or("available").alias("collected")))
    gps = (submissions.groupBy("survey_cycle")
           .agg(F.avg(F.col("gps_lat").isNull().cast("int")).alias("rate"))
           .join(collected, "survey_cycle")
           .select("survey_cycle", F.when(F.col("collected"), F.col("rate"))
                                    .alias("missing_gps_rate")))
    raw = F.col("submissions_raw")
    return (ops.join(households, "survey_cycle").join(gps, "survey_cycle")
            .select(*CYCLE_KEYS, *sums[:4],
                    (1 - F.col("submissions_deduplicated") / raw).alias("dedup_reduction_rate"),
                    "households_with_duplicates",
                    (F.col("households_with_duplicates") / F.col("households"))
                    .alias("duplicate_household_rate"),
                    (F.col("submissions_missing_location") / raw).alias("missing_location_rate"),
                    "missing_gps_rate", "avg_interview_minutes",
                    derive.seconds_to_minutes(F.col("median_sec"))
                    .alias("median_interview_minutes")))


SUMMARY_KEYS = [*CYCLE_KEYS, "region_name", "district", "year_month"]


def _located(fact: DataFrame, geography: DataFrame, time: DataFrame) -> DataFrame:
    """Households with region, district and month; without a place or a calendar day they are not counted here."""
    c = F.col
    return (fact.select(*CYCLE_KEYS, "geo_key", "date_key", "is_completed", "is_consented",
                        F.when(c("is_consented"), c("hhip_usd_day")).alias("hhip"),
                        F.when(c("is_consented"), c("meets_target")).alias("meets"))
            .join(time.select("date_key", "year_month"), "date_key")
            .join(geography.select("geo_key", "region_name", "district"), "geo_key"))


def _program_sums() -> list:
    return [F.count("*").alias("households_attempted"), F.count_if("is_completed").alias("households_completed"),
            F.count_if("is_consented").alias("households_consented"),
            derive.ratio(F.count_if("meets"), F.count("meets")).alias("share_meeting_target")]


def _with_rates(totals: DataFrame, *more: str) -> DataFrame:
    c = F.col
    return totals.select(
        *SUMMARY_KEYS, "households_attempted", "households_completed", "households_consented",
        (c("households_completed") / c("households_attempted")).alias("completion_rate"),
        derive.ratio(c("households_consented"), c("households_completed")).alias("consent_rate"),
        *more, "share_meeting_target")


def program_counts(fact: DataFrame, geography: DataFrame, time: DataFrame) -> DataFrame:
    """The program summary without its median, for reports that only add up counts."""
    return _with_rates(_located(fact, geography, time).groupBy(*SUMMARY_KEYS).agg(*_program_sums()))


def rpt_program_summary(fact: DataFrame, geography: DataFrame, time: DataFrame) -> DataFrame:
    """cycle x region x district x month of deduplicated households."""
    totals = aggregate_with_median(_located(fact, geography, time), SUMMARY_KEYS, _program_sums(), "hhip",
                                   "median_hhip_usd_day")
    return _with_rates(totals, "median_hhip_usd_day")


def rpt_program_cycle(summary: DataFrame) -> DataFrame:
    """Roll-up per cycle with the change against the first cycle."""
    counts = ("households_attempted", "households_completed", "households_consented")
    rates = summary.groupBy(*CYCLE_KEYS).agg(*[F.sum(x).alias(x) for x in counts]).withColumns({
        "completion_rate": F.col("households_completed") / F.col("households_attempted"),
        "consent_rate": derive.ratio(F.col("households_consented"), F.col("households_completed"))})
    # One row per cycle is left, so one partition is enough.
    ordered = Window.orderBy("cycle_order")
    return rates.withColumns({
        f"{r}_change_vs_baseline": F.col(r) - F.first(r).over(ordered)
        for r in ("completion_rate", "consent_rate")})


def rpt_program_demographics(fact: DataFrame, geography: DataFrame) -> DataFrame:
    """Completed and consented households by four dimensions, in one pass over the fact."""
    dimensions = (("Head of household age", "head_age_band"),
                  ("Head of household sex", "head_sex_label"),
                  ("Household size", "hh_size_band"), ("Respondent", "respondent_label"))
    columns = [column for _, column in dimensions]
    combos = (fact.where(F.col("is_completed") & F.col("is_consented"))
              .groupBy(*CYCLE_KEYS, "geo_key", *columns).agg(F.count("*").alias("n")))
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(column).alias("category"))
                      for d, column in dimensions])
    return (combos.join(geography.select("geo_key", "district"), "geo_key")
            .select(*CYCLE_KEYS, "district", "n", F.inline(pairs))
            .groupBy(*CYCLE_KEYS, "district", "dimension", "category")
            .agg(F.sum("n").alias("households")))


def rpt_cohort_coverage(households: DataFrame) -> DataFrame:
    return (households.groupBy("n_cycles", "cycle_pattern").agg(F.count("*").alias("households"))
            .orderBy(F.desc("n_cycles"), F.desc("households")))


def _panel(fact: DataFrame, households: DataFrame, geography: DataFrame) -> DataFrame:
    """Consented interviews of households seen in every cycle, with their district."""
    panel = households.where("in_balanced_panel").select("household_id")
    return (fact.where("is_consented")
            .select(*CYCLE_KEYS, "household_id", "geo_key", "hhip_usd_day", "meets_target", "is_ultra_poor")
            .join(panel, "household_id", "left_semi").join(geography.select("geo_key", "district"), "geo_key"))


def panel_counts(fact: DataFrame, households: DataFrame, geography: DataFrame) -> DataFrame:
    """Households of the balanced panel per cycle and district, without rates and median."""
    return _panel(fact, households, geography).groupBy(*CYCLE_KEYS, "district").agg(F.count("*").alias("households"))


def rpt_panel_poverty(fact: DataFrame, households: DataFrame, geography: DataFrame) -> DataFrame:
    """Poverty of the same households in every cycle."""
    shares = [F.count("*").alias("households"),
              derive.ratio(F.count_if("meets_target"), F.count("meets_target")).alias("share_meeting_target"),
              derive.ratio(F.count_if("is_ultra_poor"), F.count("is_ultra_poor")).alias("share_ultra_poor")]
    keys = [*CYCLE_KEYS, "district"]
    return (aggregate_with_median(_panel(fact, households, geography), keys, shares, "hhip_usd_day",
                                  "median_hhip_usd_day")
            .select(*keys, "households", "median_hhip_usd_day", "share_meeting_target",
                    "share_ultra_poor"))
