"""The submission fact: one household per cycle, decoded and banded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import derive
from ..operators.decode import choice_conformed, decode, decode_table


def conformed_lists(choices: DataFrame, label_map: DataFrame, cycles: DataFrame) -> DataFrame:
    """The decode table for all coded fields, the district code included."""
    fields = [f for f, *_ in config.DECODED_FIELDS] + [config.DISTRICT_FIELD]
    return decode_table(choice_conformed(choices, label_map), cycles, fields)


def fct_survey_submissions(kept: DataFrame, lists: DataFrame,
                           ultra_poor: float = config.ULTRA_POOR_USD_DAY,
                           target: float = config.TARGET_USD_DAY) -> DataFrame:
    """``lists`` is the decode table."""
    labels = {code: out for _, code, out, _ in config.DECODED_FIELDS}
    return _fact(decode(kept, lists, config.DECODED_FIELDS), labels, ultra_poor, target)


def undecoded(kept: DataFrame, ultra_poor: float = config.ULTRA_POOR_USD_DAY,
              target: float = config.TARGET_USD_DAY) -> DataFrame:
    """The fact without answer labels, for reports that show none: their lists need not be joined."""
    return _fact(kept, {}, ultra_poor, target)


def _fact(df: DataFrame, labels: dict[str, str], ultra_poor: float, target: float) -> DataFrame:
    c = F.col
    per_day = c("hhip_usd_day")

    def with_label(code: str) -> list[str]:
        return [code, labels[code]] if code in labels else [code]

    return df.select(
        "household_id", "survey_cycle", "cycle_order",
        derive.geo_key(c("district"), c("village")).alias("geo_key"),
        derive.date_key(c("submitted_at")).alias("date_key"),
        "submission_key", "submitted_at", "started_at", "ended_at", "enumerator", "form_version",
        "household_submissions", "row_hash",
        "interview_status", derive.status_label(c("interview_status")).alias("interview_status_label"),
        "consent", "is_completed", "is_consented",
        derive.seconds_to_minutes(c("interview_duration_sec")).alias("interview_duration_min"),
        c("interview_minutes").alias("wall_clock_minutes"),
        "hh_size", derive.hh_size_band(c("hh_size")).alias("hh_size_band"),
        "head_age", derive.head_age_band(c("head_age")).alias("head_age_band"),
        *with_label("head_sex"), *with_label("respondent"),
        "head_education", "head_literate",
        "hhip_usd_day", "hhip_usd_ppp_day", "hhip_usd_year", "ppi_score", "wealth_quartile",
        (per_day < ultra_poor).alias("is_ultra_poor"), (per_day >= target).alias("meets_target"),
        derive.ratio(per_day, c("hh_size")).alias("hhip_usd_day_per_capita"),
        "hh_income_usd_year", "consumption_residues_usd_year", *config.INCOME_PARTS,
        "inc_vsla_profits_usd", "inc_vegetables_usd",
        "assets_usd", "livestock_asset_usd", "savings_ugx", "loan_amount_ugx", "owns_land",
        "land_owned_acres",
        *[x for code in ("roof_material", "water_source", "toilet_type", "cooking_fuel",
                         "lighting_source") for x in with_label(code)],
        "all_members_have_shoes", "water_litres_day", "satisfied_quality_of_life",
        "gps_lat", "gps_lon")


def layout(fact: DataFrame) -> DataFrame:
    """Sorted ranges by cycle and household, so file statistics prune reads of a cycle."""
    order = ["cycle_order", "household_id"]
    return fact.repartitionByRange(*order).sortWithinPartitions(*order)
