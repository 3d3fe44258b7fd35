"""The library's column rules as functions of Spark SQL; the optimizer inlines them, no Python runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Name of the view that ``choice_label`` looks labels up in.
LISTS_VIEW = "wavemill_choice_lists"

FUNCTIONS = {
    "title_case": "(s STRING) RETURNS STRING RETURN initcap(trim(s))",
    "geo_key": "(district STRING, village STRING) RETURNS STRING "
               "RETURN md5(concat(lower(trim(district)), '|', lower(trim(village))))",
    "date_key": "(ts TIMESTAMP) RETURNS INT RETURN year(ts) * 10000 + month(ts) * 100 + day(ts)",
    "safe_ratio": "(num DOUBLE, den DOUBLE) RETURNS DOUBLE RETURN num / nullif(den, 0D)",
    "match_key": "(s STRING) RETURNS STRING RETURN regexp_replace(lower(s), '[^a-z0-9]', '')",
}


def register(spark: SparkSession) -> None:
    """``title_case``, ``geo_key``, ``date_key``, ``safe_ratio`` and ``match_key`` in this session."""
    for name, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")


def register_choice_label(spark: SparkSession, lists: DataFrame) -> None:
    """``choice_label(cycle, list, code)`` over ``lists`` (survey_cycle, field, code, label).

    Its subquery becomes a left join on (cycle, code) with one row a code, so it can be called on any number of rows.
    Columns of ``lists`` are renamed, so that none is taken for one of the caller's. An unknown code has no label.
    """
    lists.toDF("_in_cycle", "_in_list", "_of_code", "_label").createOrReplaceTempView(LISTS_VIEW)
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION choice_label(cycle STRING, list STRING, code STRING) RETURNS STRING "
        f"RETURN (SELECT min(_label) FROM {LISTS_VIEW} WHERE _in_cycle = cycle AND _in_list = list AND _of_code = code)")
