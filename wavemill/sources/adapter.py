"""A survey-shaped relation over order, customer, nation and region tables.

One order is one submission, its customer the household, the nation the
district. All rules are deterministic, so repeats, missing values, collisions
and odd spellings occur at every scale. Expressions are plain SQL; the few
that need another wording elsewhere are pairs (Spark, ANSI).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import VARIABLE_SPEC, literal_frame
from ..functions import derive, text
from ..operators import dedupe

#: Every month of the driver's orders with its cycle, as ``wave`` below has it.
PERIODS = [f"{'baseline' if year <= 1996 else 'year1' if year <= 1998 else 'year2'} {year}-{month:02d}"
           for year in range(1995, 2002) for month in range(1, 13)]

# Used by several columns below.
HELPERS: dict[str, str] = {
    "wave": ("CASE WHEN year(o_orderdate) <= 1996 THEN 0 WHEN year(o_orderdate) <= 1998 THEN 1 "
             "ELSE 2 END"),
    "base_id": ("CASE c_custkey % 3 WHEN 0 THEN concat('HHD-NAT-M-', c_custkey) "
                "WHEN 1 THEN concat('HHD-NAT-ABC-K', c_custkey) ELSE concat('HH-', c_custkey) END"),
    "hhip": ("CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 211 = 0 "
             "THEN o_totalprice / CAST(2500 AS DOUBLE) ELSE o_totalprice / CAST(100000 AS DOUBLE) END"),
}


def _income(divisor: int, every: int) -> str:
    return (f"CASE WHEN o_orderkey % {every} = 0 THEN NULL "
            f"ELSE o_totalprice / CAST({divisor} AS DOUBLE) END")


def _code(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


# name -> expression, or (Spark, ANSI) where the wording differs
COLUMNS: dict[str, str | tuple[str, str]] = {
    "survey_cycle": "CASE wave WHEN 0 THEN 'baseline' WHEN 1 THEN 'year1' ELSE 'year2' END",
    "cycle_order": "CAST(wave AS INT)",
    "source_row": "o_orderkey",
    "submission_key": ("CASE WHEN o_orderkey % 997 = 0 THEN NULL WHEN o_orderkey % 499 = 0 "
                       "THEN concat('K', o_orderkey + 1) ELSE concat('K', o_orderkey) END"),
    "household_id_raw": ("CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 7 = 0 "
                         "THEN concat(lower(base_id), ' ') ELSE base_id END"),
    "household_confirm_raw": ("CASE WHEN o_orderkey % 61 = 0 THEN NULL WHEN o_orderkey % 67 = 0 "
                              "THEN 'X' ELSE base_id END"),
    "submitted_at": "o_orderdate",
    "started_at": (
        "o_orderdate - make_dt_interval(0, 0, CAST(o_orderkey % 600 AS INT), 0) "
        "+ make_dt_interval(CASE WHEN o_orderkey % 503 = 0 THEN 3 ELSE 0 END, 0, 0, 0)",
        "o_orderdate - to_minutes(o_orderkey % 600) "
        "+ to_days(CASE WHEN o_orderkey % 503 = 0 THEN 3 ELSE 0 END)"),
    "ended_at": "o_orderdate",
    "interview_duration_sec": ("CASE WHEN o_orderkey % 19 = 0 THEN NULL "
                               "ELSE CAST(300 + o_orderkey * 7 % 25200 AS DOUBLE) END"),
    "form_version": "concat('21', o_orderkey % 4)",
    "enumerator": "concat('E', o_orderkey % 40)",
    "interview_status": _code("CASE WHEN o_orderstatus = 'P' THEN 1 + o_orderkey % 5 "
                              "WHEN o_orderkey % 89 = 0 THEN NULL ELSE 1 END"),
    "consent": _code("CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 0 "
                     "ELSE 1 END"),
    "district_code": _code("CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 59 = 0 "
                           "THEN 99 ELSE n_nationkey + 1 END"),
    "district": ("CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 23 = 0 "
                 "THEN concat(lower(n_name), ' ') ELSE n_name END"),
    "subcounty": "CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE concat('S', c_custkey % 5) END",
    "parish": ("CASE WHEN o_orderkey % 23 = 0 THEN upper(concat('Parish ', c_custkey % 9)) "
               "ELSE concat('Parish ', c_custkey % 9) END"),
    "cluster": "CASE WHEN wave = 0 THEN NULL ELSE concat('cluster-', c_custkey % 6) END",
    "village": "CASE WHEN o_orderkey % 73 = 0 THEN NULL ELSE c_mktsegment END",
    "cohort": ("CASE WHEN wave < 2 OR o_orderkey % 3 = 0 THEN NULL "
               "ELSE concat('202', c_custkey % 3) END"),
    "wealth_quartile": "CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE concat('Q', 1 + c_custkey % 4) END",
    "respondent": _code("CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE 1 + o_orderkey % 3 END"),
    "hh_size": _code("CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 307 = 0 THEN 0 "
                     "ELSE 1 + c_custkey % 12 END"),
    "head_sex": _code("1 + c_custkey % 2"),
    "head_age": _code("CASE WHEN o_orderkey % 47 = 0 THEN NULL ELSE 10 + (c_custkey * 7) % 95 END"),
    "head_education": _code("o_orderkey % 6"),
    "head_literate": _code("o_orderkey % 2"),
    "ppi_score": "CAST(o_orderkey % 100 AS DOUBLE)",
    "hhip_usd_day": "hhip",
    "hhip_usd_ppp_day": "hhip * CAST(3 AS DOUBLE)",
    "hhip_usd_year": ("CASE WHEN o_orderkey % 103 = 0 THEN NULL WHEN o_orderkey % 53 = 0 "
                      "THEN hhip * CAST(400 AS DOUBLE) ELSE hhip * CAST(365 AS DOUBLE) END"),
    "hh_income_usd_year": _income(500, 107),
    "consumption_residues_usd_year": _income(900, 109),
    "inc_seasonal_crops_usd": _income(2000, 6),
    "inc_perennial_crops_usd": _income(4000, 10),
    "inc_livestock_usd": _income(3000, 14),
    "inc_casual_labour_usd": _income(4500, 15),
    "inc_formal_employment_usd": _income(8000, 22),
    "inc_business_usd": _income(3500, 21),
    "inc_remittances_usd": _income(9000, 26),
    "inc_rent_usd": _income(7000, 33),
    "inc_vsla_profits_usd": f"CASE WHEN wave = 2 THEN {_income(9500, 34)} END",
    "inc_vegetables_usd": f"CASE WHEN wave = 2 THEN {_income(8500, 35)} END",
    "assets_usd": f"CASE WHEN wave > 0 THEN {_income(100, 38)} END",
    "livestock_asset_usd": f"CASE WHEN wave > 0 THEN {_income(300, 39)} END",
    "savings_ugx": _income(10, 46),
    "loan_amount_ugx": _income(20, 51),
    "owns_land": _code("o_orderkey % 2"),
    "land_owned_acres": "CAST(c_custkey % 20 AS DOUBLE)",
    "roof_material": _code("CASE WHEN o_orderkey % 55 = 0 THEN NULL ELSE 1 + o_orderkey % 4 END"),
    "water_source": _code("1 + o_orderkey % 5"),
    "toilet_type": _code("1 + o_orderkey % 4"),
    "cooking_fuel": _code("1 + o_orderkey % 3"),
    "lighting_source": _code("1 + o_orderkey % 4"),
    "all_members_have_shoes": _code("o_orderkey % 2"),
    "water_litres_day": "CAST(o_orderkey % 10 AS DOUBLE)",
    "satisfied_quality_of_life": _code("1 + o_orderkey % 5"),
    "gps_lat": ("CASE WHEN wave > 0 OR o_orderkey % 29 = 0 THEN NULL "
                "ELSE CAST(c_custkey % 90 AS DOUBLE) END"),
    "gps_lon": ("CASE WHEN wave > 0 OR o_orderkey % 29 = 0 THEN NULL "
                "ELSE CAST(c_custkey % 180 AS DOUBLE) END"),
}

# Answer codes and their labels, per cycle that owns a choice list.
CHOICES = tuple(
    (cycle, field, str(code), label)
    for cycle, lists in {
        "baseline": {
            "hhh_sex": ("Male", "Female"),
            "respondent": ("Head of household", "Spouse", "Other"),
            "Material_roof": ("Metal panels", "Reed/Straw", "[Slate]"),
            "Main_source_of_water_for_consumption": ("Borehole", "Spring", "River", "Rain", "Tap"),
            "Type_of_Toilet_Facility": ("Dry pit", "Tank with Flush", "None"),
            "Fuel_source_cooking": ("Firewood", "Charcoal", "Gas"),
            "Lighting_source": ("Candle", "Power Mains/Panel/Motor", "Oil Lamp"),
        },
        "year2": {
            "hhh_sex": ("Male", "Female"),
            "respondent": ("Head of household", "Spouse"),
            "Material_roof": ("Reed/Straw/Leaves", "Metal Panels", "Slate "),
            "Main_source_of_water_for_consumption": ("Tap", "Borehole", "Spring", "Rain"),
            "Type_of_Toilet_Facility": ("None", "Flush tank", "Dry pit", "Other"),
            "Fuel_source_cooking": ("Charcoal", "Firewood", "Biogas"),
            "Lighting_source": ("Power/Panel", "Oil lamp", "Candle", "Torch"),
        },
    }.items()
    for field, labels in lists.items()
    for code, label in enumerate(labels, start=1)
)
# (field, raw label, conformed label)
LABEL_MAP = (
    ("Material_roof", "Reed/Straw", "Reed/Straw/Leaves"),
    ("Material_roof", "Metal panels", "Metal Panels"),
    ("Type_of_Toilet_Facility", "Tank with Flush", "Flush tank"),
    ("Lighting_source", "Power Mains/Panel/Motor", "Power/Panel"),
    ("Lighting_source", "Oil Lamp", "Oil lamp"),
)


def _spark(expr: str | tuple[str, str]) -> str:
    return expr if isinstance(expr, str) else expr[0]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def joined(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order with its customer and nation."""
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").withColumn("o_custkey", F.col("c_custkey"))
    return (orders.join(customer, "o_custkey")
            .join(table(spark, folder, "nation"), F.expr("c_nationkey = n_nationkey")))


def hashed_columns() -> list[tuple[str, str]]:
    """Text of every contract value (Spark, ANSI) as the content hash takes it; numbers to a millionth."""
    out = []
    for name, dtype, _ in VARIABLE_SPEC:
        name = {"household_id": "household_id_raw", "household_id_confirm": "household_confirm_raw"}.get(name, name)
        if dtype == "timestamp":
            out.append((f"date_format({name}, 'yyyy-MM-dd HH:mm:ss')", f"strftime({name}, '%Y-%m-%d %H:%M:%S')"))
        elif dtype == "float":
            whole = f"CAST(floor({name} * 1000000 + CAST(0.5 AS DOUBLE)) AS BIGINT)"
            out.append((f"CAST({whole} AS STRING)", f"CAST({whole} AS VARCHAR)"))
        else:
            out.append((f"CAST({name} AS STRING)", f"CAST({name} AS VARCHAR)"))
    return out


def project(rows: DataFrame, *more: str) -> DataFrame:
    """Typed submissions with normalised household identifiers; ``more`` are columns to carry along."""
    rows = (rows.selectExpr("*", *[f"{e} AS {name}" for name, e in HELPERS.items()])
            .selectExpr(*[f"{_spark(e)} AS {name}" for name, e in COLUMNS.items()], *more))
    return rows.withColumns({
        "household_id": text.normalize_household_id(F.col("household_id_raw")),
        "household_id_confirm": text.normalize_household_id(F.col("household_confirm_raw")),
        "interview_minutes": derive.minutes_between(F.col("started_at"), F.col("ended_at")),
        "row_hash": derive.row_hash([F.expr(e) for e, _ in hashed_columns()]),
    })


def submissions(spark: SparkSession, folder: str) -> DataFrame:
    return project(joined(spark, folder))


def kept(spark: SparkSession, folder: str) -> DataFrame:
    """The deduplicated submissions.

    Winners are joined to the stored rows, and the wide contract is derived
    for them alone: what is shuffled has a dozen columns instead of seventy.
    """
    rows = joined(spark, folder)
    best = dedupe.winners(project(rows)).select(F.col(dedupe.ROW).alias("o_orderkey"),
                                                "household_submissions")
    return dedupe.with_outcome_flags(
        project(rows.join(best, "o_orderkey"), "household_submissions"))


def regions(spark: SparkSession, folder: str) -> DataFrame:
    """District to region; the last nation has none."""
    return (table(spark, folder, "nation").where("n_nationkey < 24")
            .join(table(spark, folder, "region"), F.expr("n_regionkey = r_regionkey"))
            .selectExpr("n_name AS district", "concat('R', r_regionkey) AS region_code",
                        "r_name AS region_name",
                        "concat('Sub ', n_nationkey % 3) AS sub_region"))


def choices(spark: SparkSession) -> DataFrame:
    return literal_frame(
        spark, list(CHOICES), "survey_cycle string, field string, code string, label string")


def label_map(spark: SparkSession) -> DataFrame:
    return literal_frame(
        spark, list(LABEL_MAP), "field string, raw_label string, conformed_label string")


def ansi_select() -> str:
    """The same relation without derived columns, for another SQL engine."""
    helpers = ", ".join(f"{e} AS {name}" for name, e in HELPERS.items())
    columns = ", ".join(f"{e if isinstance(e, str) else e[1]} AS {name}"
                        for name, e in COLUMNS.items())
    return (f"SELECT {columns} FROM (SELECT *, {helpers} FROM orders "
            "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)")
