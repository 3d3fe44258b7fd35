"""Counts and ranges from Parquet footers; forms by their whole path."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wavemill import config
from wavemill.plans import warehouse
from wavemill.sources import footers, forms


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("footers") / "t")
    rows = spark.range(0, 1000, 1, 7).select(
        "id", (F.col("id") % 3).cast("int").alias("part"), F.expr("date_add(DATE '2024-01-01', CAST(id AS INT))").alias("day"),
        F.when(F.col("id") % 2 == 0, F.col("id") / 4).alias("x"), F.lit(None).cast("int").alias("nothing"),
        F.col("id").cast("string").alias("word"), F.lit(7).alias("Id"))
    rows.write.partitionBy("part").parquet(path)
    return path


def test_counts_and_ranges_come_from_footers(spark, stored):
    session = footers.footer_session(spark)
    df = footers.footer_stats(session, stored, ["id", "day", "x", "Id"])
    assert "PushedAggregation: [COUNT(*), MIN(id)" in plan(df)
    row = df.first().asDict()
    assert row == {"n_rows": 1000, "min_id": 0, "max_id": 999, "min_day": dt.date(2024, 1, 1),
                   "max_day": dt.date(2026, 9, 26), "min_x": 0.0, "max_x": 249.5, "min_Id": 7, "max_Id": 7}


def test_columns_without_a_range_in_a_file_are_read(spark, stored):
    session = footers.footer_session(spark)
    assert tuple(footers.stats_row(session, stored, ["id"])) == (1000, 0, 999)
    assert tuple(footers.stats_row(session, stored, ["id", "nothing"])) == (1000, 0, 999, None, None)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        footers.stats_row(session, stored + "-none", ["id"])


def test_folders_are_counted_apart(spark, stored):
    df = footers.footer_stats(footers.footer_session(spark), stored, ["id"], by=["part"])
    assert "PushedGroupBy: [part]" in plan(df)
    assert sorted(map(tuple, df.collect())) == [(0, 334, 0, 999), (1, 333, 1, 997), (2, 333, 2, 998)]


def test_what_footers_do_not_hold_is_refused(spark, stored):
    with pytest.raises(ValueError, match="word, string"):
        footers.footer_stats(footers.footer_session(spark), stored, ["word"])


def test_other_sessions_keep_their_reader(spark, stored):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    footers.footer_session(spark)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before != ""


def test_empty_and_no_tables(spark, tmp_path):
    session = footers.footer_session(spark)
    spark.range(0).write.parquet(f"{tmp_path}/none")
    assert footers.footer_stats(session, f"{tmp_path}/none", ["id"]).collect() == [(0, None, None)]
    assert footers.stored_counts(session, {}).collect() == []


def test_counts_of_a_lake(spark, tmp_path):
    lake = warehouse.Lake(spark, str(tmp_path), buckets=4)
    days = spark.range(50).selectExpr("CAST(20240101 + id AS INT) AS date_key", "CAST(id AS STRING) AS household_id",
                                      "CAST(id % 5 = 0 AS INT) AS kept")
    lake.write_by_household(days.drop("kept"), "gold", "fct_survey_submissions", ["household_id"])
    lake.write(days.limit(3), "gold", "dim_time")
    lake.write_by_household(days, "silver", "submission", ["household_id"], ["kept"])
    counts = warehouse.stored_counts(lake, ["fct_survey_submissions", "dim_time"])
    assert plan(counts).count("PushedAggregation: [COUNT(*)]") == 2
    assert sorted(map(tuple, counts.collect())) == [("dim_time", 3), ("fct_survey_submissions", 50)]
    span = warehouse.fact_days(lake)
    assert tuple(span) == (50, 20240101, 20240150)
    halves = warehouse.submission_halves(lake)
    assert "PushedAggregation" in plan(halves) and sorted(map(tuple, halves.collect())) == [(0, 40), (1, 10)]


def test_forms_called_alike_stay_apart(spark, tmp_path):
    html = '<table><tr class="entryRow"><td class="fieldCell">{}</td><td class="questionCell">?</td></tr></table>'
    paths = {}
    for cycle, field in zip((c.code for c in config.CYCLES), ("one", "two", "three")):
        (tmp_path / cycle).mkdir()
        (tmp_path / cycle / "form.html").write_text(html.format(field))
        paths[cycle] = f"{tmp_path}/{cycle}/form.html"
    rows = forms.read_cycle_forms(spark, paths).collect()
    assert {(r.survey_cycle, r.form, r.field) for r in rows} == {
        (c.code, "form.html", f) for c, f in zip(config.CYCLES, ("one", "two", "three"))} and len(rows) == 3
    shared = forms.read_cycle_forms(spark, {"a": paths["baseline"], "b": f"file:{paths['baseline']}"}).collect()
    assert sorted((r.survey_cycle, r.field) for r in shared) == [("a", "one"), ("b", "one")]
    assert forms.read_cycle_forms(spark, {}).collect() == []
