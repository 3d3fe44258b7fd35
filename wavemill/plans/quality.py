"""Data-quality checks: each yields failed and total, graded info, warn or error.

Checks over the same table share one aggregate; a join is made only after the
rows are counted by its key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.casts import parse_timestamps
from ..functions.text import strip_whitespace
from ..operators.decode import decode

Check = tuple[str, str, Column, Column]


def _measures(checks: Sequence[Check]) -> list[Column]:
    """Failed and total of every check, as the columns of one aggregate."""
    return [F.coalesce(value, F.lit(0)).cast("bigint").alias(f"{letter}{i}")
            for i, (_, _, failed, total) in enumerate(checks) for letter, value in (("f", failed), ("t", total))]


def _rows(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One aggregate over ``df``, turned into one row per check."""
    rows = [F.struct(F.lit(name).alias("check"), F.lit(severity).alias("severity"),
                     F.col(f"f{i}").alias("failed"), F.col(f"t{i}").alias("total"), F.lit("").alias("detail"))
            for i, (name, severity, _, _) in enumerate(checks)]
    return df.agg(*_measures(checks)).select(F.inline(F.array(*rows)))


def observed(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, Observation]:
    """``df`` with its checks counted while it is written; to be the last step before the write.

    Tasks of the writing stage add to the counts once, when they succeed, so a lost executor does not count twice.
    """
    seen = Observation()
    return df.observe(seen, *_measures(checks)), seen


def from_observation(spark: SparkSession, checks: Sequence[Check], seen: Observation) -> DataFrame:
    """The rows of checks that were counted in a write."""
    counts = seen.get
    return config.literal_frame(
        spark, [(name, severity, counts[f"f{i}"], counts[f"t{i}"], "") for i, (name, severity, _, _) in enumerate(checks)],
        "check string, severity string, failed bigint, total bigint, detail string")


def _outside(c: Column, lo: float, hi: float) -> Column:
    return ~c.between(lo, hi)


def fact_rules() -> list[Check]:
    """The checks that look at one row of the fact at a time."""
    c, n, every = F.col, F.count_if, F.count("*")
    hhip, year = c("hhip_usd_day"), c("hhip_usd_year")
    done, agreed = c("is_completed"), c("is_consented")
    parts = reduce(lambda a, b: a + b,
                   [F.coalesce(c(p), F.lit(0)) for p in config.INCOME_PARTS])
    minutes = c("interview_duration_min")
    lo_min, hi_min = config.DURATION_MINUTES_RANGE
    reconciles = F.abs(hhip * 365 - year) > 0.01 * F.greatest(year, F.lit(1))
    return [
        ("household_id_format", "warn",
         n(~c("household_id").rlike(config.HOUSEHOLD_ID_LAYOUT)), every),
        ("hh_size_in_range", "warn",
         n(_outside(c("hh_size"), *config.HH_SIZE_RANGE) | c("hh_size").isNull()), every),
        ("hhip_not_null", "error", n(agreed & hhip.isNull()), n(agreed)),
        ("hhip_plausible_range", "warn",
         n((hhip < 0) | (hhip > config.MAX_HHIP_USD_DAY)), every),
        ("hhip_daily_reconciles_with_annual", "warn", n(year.isNotNull() & reconciles),
         n(year.isNotNull())),
        ("income_components_le_total_income", "warn",
         n(parts > c("hh_income_usd_year") * 1.01 + 1), every),
        ("interview_duration_plausible_10min_6h", "warn",
         n(done & ((minutes < lo_min) | (minutes > hi_min))), n(done)),
        ("wall_clock_start_to_end_over_6h", "info", n(c("wall_clock_minutes") > hi_min), every),
        ("head_age_plausible_15_100", "warn",
         n(agreed & (_outside(c("head_age"), *config.HEAD_AGE_RANGE) | c("head_age").isNull())),
         n(agreed)),
        ("completed_interview_has_consent_answer", "warn", n(done & c("consent").isNull()), n(done)),
    ]


def fact_checks(fact: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """``counted``: the rows of ``fact_rules``, if the write of the fact has counted them."""
    # The grain has its own narrow count, so that the other checks stay one map-side aggregate.
    sizes = fact.groupBy("household_id", "survey_cycle").agg(F.count("*").alias("n"))
    grain = _rows(sizes, [("grain_unique_household_cycle", "error", F.sum(F.col("n") - 1), F.sum("n"))])
    return grain.unionByName(_rows(fact, fact_rules()) if counted is None else counted)


def silver_rules(kept: Column | None = None) -> list[Check]:
    """The checks of kept rows; ``kept`` tells them from others of the same relation."""
    kept = F.lit(True) if kept is None else kept
    early = F.col("submitted_at") < F.col("started_at") - F.expr("interval 1 day")
    return [
        ("household_id_needed_normalisation", "info",
         F.count_if(kept & (F.col("household_id_raw") != F.col("household_id"))), F.count_if(kept)),
        ("submitted_after_started", "warn", F.count_if(kept & early), F.count_if(kept)),
    ]


def silver_checks(kept: DataFrame) -> DataFrame:
    return _rows(kept, silver_rules())


def history_checks(history: DataFrame) -> DataFrame:
    spellings = (history.groupBy("survey_cycle", "geo_key")
                 .agg(F.count_distinct(F.lower("parish")).alias("n")))
    return _rows(spellings, [("village_maps_to_one_parish_within_cycle", "warn",
                              F.count_if(F.col("n") > 1), F.count("*"))])


def geography_checks(geography: DataFrame) -> DataFrame:
    return _rows(geography, [
        ("villages_with_parish_spelling_change_across_cycles", "info",
         F.count_if(F.col("parish_spellings_seen") > 1), F.count("*")),
        ("geography_has_region", "error", F.count_if(F.col("region_code").isNull()), F.count("*")),
    ])


def unmatched(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """(failed, total) facts whose key, NULL included, is not in the dimension."""
    by_key = fact.groupBy(key).agg(F.count("*").alias("n"))
    found = dimension.select(key).distinct().withColumn("_found", F.lit(1))
    return (by_key.join(found, key, "left")
            .agg(F.coalesce(F.sum(F.when(F.col("_found").isNull(), F.col("n"))), F.lit(0))
                 .alias("failed"),
                 F.coalesce(F.sum("n"), F.lit(0)).alias("total")))


def unmatched_checks(fact: DataFrame, geography: DataFrame, time: DataFrame) -> DataFrame:
    checks = (("fact_rows_without_geography", geography, "geo_key"),
              ("fact_dates_covered_by_dim_time", time, "date_key"))
    return reduce(DataFrame.unionByName, [
        unmatched(fact, dim, key).select(F.lit(name).alias("check"),
                                         F.lit("error").alias("severity"), "failed", "total",
                                         F.lit("").alias("detail"))
        for name, dim, key in checks])


def district_checks(kept: DataFrame, lists: DataFrame) -> DataFrame:
    """Does the district code decode to the preloaded district name?"""
    pairs = kept.select("survey_cycle", "district_code", "district").distinct()
    decoded = decode(pairs, lists, [(config.DISTRICT_FIELD, "district_code", "_label", None)])
    wrong = F.coalesce(F.lower("_label"), F.lit("?")) != F.lower("district")
    return _rows(decoded, [("district_code_decodes_to_preloaded_label", "warn",
                            F.count_if(wrong), F.count("*"))])


def household_checks(households: DataFrame) -> DataFrame:
    base = F.col("has_baseline")
    return _rows(households, [
        ("households_changed_district", "info", F.count_if("moved_district"), F.count("*")),
        ("baseline_households_missing_a_follow_up_cycle", "info",
         F.count_if(base & ~F.col("in_balanced_panel")), F.count_if(base)),
    ])


def model_checks(fact: DataFrame, kept: DataFrame, history: DataFrame, geography: DataFrame,
                 time: DataFrame, households: DataFrame, lists: DataFrame,
                 fact_counted: DataFrame | None = None, kept_counted: DataFrame | None = None) -> DataFrame:
    """The 21 checks over silver and the star schema; those that the writes have counted are not counted again."""
    return reduce(DataFrame.unionByName, [
        fact_checks(fact, fact_counted), silver_checks(kept) if kept_counted is None else kept_counted,
        history_checks(history),
        geography_checks(geography), unmatched_checks(fact, geography, time),
        district_checks(kept, lists), household_checks(households)])


SOURCE_COLUMNS = ("_row_hash", "hhid_2", "hhid_2_again", "district", "pre_district",
                  "SubmissionDate")


def source_checks(bronze: DataFrame, headers: DataFrame,
                  cycles: Sequence[config.Cycle] = config.CYCLES) -> DataFrame:
    """The five checks per cycle on the untyped exports.

    ``bronze``: survey_cycle, _source_row and the text columns above, all
    cycles together. ``headers``: survey_cycle, header, position.
    """
    c = F.col
    text = strip_whitespace(c("SubmissionDate"))
    parsed = F.lit(None).cast("timestamp_ntz")
    for cycle in cycles:
        parsed = F.when(c("survey_cycle") == cycle.code,
                        parse_timestamps(text, cycle.formats)).otherwise(parsed)
    formats = F.create_map(*[F.lit(x) for cycle in cycles
                             for x in (cycle.code, " / ".join(cycle.formats))])
    rows = bronze.select(
        "survey_cycle", "_row_hash",
        (F.coalesce("hhid_2", F.lit("")) != F.coalesce("hhid_2_again", F.lit("")))
        .alias("mismatch"),
        (parsed.isNull() & c("SubmissionDate").isNotNull()).alias("unparsed"))
    # Counted per hash first: the same export row repeated without end is one entry.
    per_cycle = (rows.groupBy("survey_cycle", "_row_hash")
                 .agg(F.count("*").alias("n"), F.count_if("mismatch").alias("m"),
                      F.count_if("unparsed").alias("u"))
                 .groupBy("survey_cycle")
                 .agg(F.sum("n").alias("total"),
                      F.sum(c("n") - F.when(c("_row_hash").isNotNull(), 1).otherwise(0)).alias("same"),
                      F.sum("m").alias("mismatch"), F.sum("u").alias("unparsed")))

    def row(name, severity, failed, detail):
        return F.struct(F.concat(c("survey_cycle"), F.lit(f": {name}")).alias("check"),
                        F.lit(severity).alias("severity"), c(failed).alias("failed"),
                        c("total").alias("total"), detail.alias("detail"))

    basic = per_cycle.select(F.inline(F.array(
        row("identical rows in export (same row hash)", "info", "same", F.lit("")),
        row("hhid_2 equals hhid_2_again", "warn", "mismatch", F.lit("")),
        row("SubmissionDate parses with known formats", "error", "unparsed",
            formats[c("survey_cycle")]))))

    labels = (bronze.where(c("district").isNotNull())
              .groupBy("survey_cycle", "district", "pre_district")
              .agg(F.min("_source_row").alias("first_row"))
              .groupBy("survey_cycle", "district")
              .agg(F.count("pre_district").alias("n"),
                   F.min_by("pre_district", F.when(c("pre_district").isNotNull(), c("first_row")))
                   .alias("label")))
    codes = labels.groupBy("survey_cycle").agg(
        F.count_if(c("n") > 1).alias("failed"), F.count_if(c("n") > 0).alias("total"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("district", "label"))),
                                 lambda x: F.concat(x["district"], F.lit("="),
                                                    F.coalesce(x["label"], F.lit("")))), "; ")
        .alias("detail"))
    codes = codes.select(F.concat(c("survey_cycle"), F.lit(": district code maps to one label"))
                         .alias("check"), F.lit("warn").alias("severity"), "failed", "total",
                         "detail")

    repeated = F.when(c("header").endswith(".1"), F.struct("position", "header"))
    names = (headers.groupBy("survey_cycle")
             .agg(F.count(repeated).alias("failed"), F.count("*").alias("total"),
                  F.array_sort(F.collect_list(repeated)).alias("found"))
             .select(F.concat(c("survey_cycle"),
                              F.lit(": duplicate headers in export (numbered suffix)")).alias("check"),
                     F.lit("info").alias("severity"), "failed", "total",
                     F.array_join(c("found.header"), ", ").alias("detail")))
    return basic.unionByName(codes).unionByName(names)


def dq_results(checks: DataFrame) -> DataFrame:
    """Graded results with the share of failures and the time of the check."""
    return checks.select(
        "check", "severity", "failed", "total", "detail",
        F.round(100 * F.col("failed") / F.nullif("total", F.lit(0)), 2).alias("fail_pct"),
        (F.col("failed") == 0).alias("passed"),
        F.localtimestamp().alias("checked_at"))


class QualityGateError(RuntimeError):
    """An ``error`` check failed."""


def gate(results: DataFrame) -> None:
    """Raise when an ``error`` check failed; call it after the results are written."""
    failing = results.where((F.col("severity") == "error") & ~F.col("passed")).collect()
    if failing:
        raise QualityGateError("; ".join(f"{r['check']}: {r['failed']} of {r['total']}"
                                         for r in failing))


def row_reconciliation(bronze: DataFrame, tagged: DataFrame) -> DataFrame:
    """Rows in, kept and quarantined per cycle, and what is unaccounted for."""
    before = bronze.groupBy("survey_cycle").agg(F.count("*").alias("bronze_rows"))
    after = tagged.groupBy("survey_cycle").agg(
        F.count_if(F.col("reject_reason").isNull()).alias("kept_rows"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("quarantined_rows"))
    return (before.join(after, "survey_cycle", "left")
            .select("survey_cycle", "bronze_rows", "kept_rows", "quarantined_rows",
                    (F.col("bronze_rows") - F.col("kept_rows") - F.col("quarantined_rows"))
                    .alias("unaccounted")))


def operations_reconciliation(bronze: DataFrame, tagged: DataFrame, operations: DataFrame) -> DataFrame:
    """Per cycle: submissions that the field report counts plus blank lines, against the rows that came in."""
    before = bronze.groupBy("survey_cycle").agg(F.count("*").alias("bronze_rows"))
    blank = tagged.groupBy("survey_cycle").agg(
        F.count_if(F.col("reject_reason") == "empty_row").alias("empty_rows"))
    counted = operations.groupBy("survey_cycle").agg(F.sum("submissions_raw").alias("reported"))
    return (before.join(blank, "survey_cycle", "left").join(counted, "survey_cycle", "left")
            .select("survey_cycle", "bronze_rows", F.coalesce("empty_rows", F.lit(0)).alias("empty_rows"),
                    F.coalesce("reported", F.lit(0)).alias("reported"))
            .withColumn("unaccounted", F.col("bronze_rows") - F.col("empty_rows") - F.col("reported")))


def cycle_counts(by_cycle: DataFrame) -> DataFrame:
    return by_cycle.select(
        "survey_cycle", "submissions_raw", "submissions_deduplicated", "submissions_superseded",
        "submissions_rejected",
        F.round("duplicate_household_rate", 4).alias("duplicate_household_rate"))


def inconsistent_program_rows(summary: DataFrame) -> DataFrame:
    """Summary rows that break consented <= completed <= attempted or have a rate outside 0..1."""
    c = F.col
    return summary.where(~((c("households_consented") <= c("households_completed"))
                           & (c("households_completed") <= c("households_attempted"))
                           & c("completion_rate").between(0, 1)))
