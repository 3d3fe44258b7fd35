"""Single rules on tiny frames."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from wavemill import config
from wavemill.functions import casts, derive, text
from wavemill.operators import catalog, dedupe
from wavemill.sources import exports

CYCLE = config.CYCLE_BY_CODE


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v"))).first()[0]


@pytest.mark.parametrize("code,value,expected", [
    ("baseline", "2/29/2024, 1:02:03 PM", dt.datetime(2024, 2, 29, 13, 2, 3)),
    ("baseline", "12/01/2024, 12:00:01 am", dt.datetime(2024, 12, 1, 0, 0, 1)),
    ("year1", "Jan 1, 2025 12:30:00 PM", dt.datetime(2025, 1, 1, 12, 30)),
    ("year2", "2026-12-31 23:59:58", dt.datetime(2026, 12, 31, 23, 59, 58)),
    ("year2", "2026-01-02 00:00:00.000", dt.datetime(2026, 1, 2)),
    ("year2", "2026-01-02 03:04:05.5", dt.datetime(2026, 1, 2, 3, 4, 5, 500000)),
    ("baseline", "2024-02-29 13:02:03", None),
    ("year1", "2/29/2024, 1:02:03 PM", None),
    ("year2", "2026-02-30 03:04:05", None),
    ("year2", None, None),
])
def test_timestamps_are_parsed_by_their_cycles_formats_only(spark, code, value, expected):
    got = one(spark, value, lambda c: casts.parse_timestamps(c, CYCLE[code].formats))
    assert got == expected


def test_wall_clock_time_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = one(spark, "2023-03-12 02:30:00",
                  lambda c: casts.parse_timestamps(c, CYCLE["year2"].formats).cast("string"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == "2023-03-12 02:30:00"  # this hour does not exist in that zone


@pytest.mark.parametrize("value,double,whole", [
    ("3", 3.0, 3), ("3.0", 3.0, 3), ("3.5", 3.5, None), ("-2e3", -2000.0, -2000), (".5", 0.5, None),
    ("1d", None, None), ("1f", None, None), ("NaN", None, None), ("NA", None, None), ("", None, None),
    ("0x10", None, None), ("inf", float("inf"), None), (None, None, None), ("1,000", None, None),
    ("9007199254740993", 9007199254740992.0, 9007199254740993), ("-9223372036854775808.0", -2.0 ** 63, -2 ** 63),
    ("9223372036854775808", 2.0 ** 63, None), ("12.", 12.0, 12), ("+7", 7.0, 7),
])
def test_numbers(spark, value, double, whole):
    assert one(spark, value, casts.to_double) == double
    assert one(spark, value, casts.to_integral) == whole


@pytest.mark.parametrize("value", ["x", " x", "x ", "\t x\n", "　x\x1c", "", "  ", "é ", None])
def test_strip_equals_pythons(spark, value):
    assert one(spark, value, text.strip_whitespace) == (None if value is None else value.strip())


@pytest.mark.parametrize("value,expected", [
    ("tor-x1-q", "TOR-X1-Q"), (" north 7 -\u00a0b\n", "NORTH7-B"), ("a b\tc", "ABC"), (None, None)])
def test_ids_lose_case_and_white_space(spark, value, expected):
    assert one(spark, value, text.normalize_household_id) == expected


def test_title_case(spark):
    assert one(spark, "oLD mill-LANE  d'arc ", text.title_case) == "Old Mill-lane  D'arc"


def test_header_normalisation():
    assert text.normalize_header("\tRain  fall \n(mm) ") == "Rain fall (mm)"
    assert text.normalize_header("") == "" and text.normalize_header("plot_no") == "plot_no"


def test_repeated_and_missing_headers():
    assert exports.distinct_headers([None, "a", "b", "a", "a", "a.1"]) == [
        "Unnamed: 0", "a", "b", "a.2", "a.3", "a.1"]
    assert exports.distinct_headers(["Status", "status"]) == ["Status", "status"]
    with pytest.raises(ValueError, match="collision"):
        exports.normalized_headers(["a  b", "a b"])


def test_geo_key_needs_both_parts(spark):
    df = spark.createDataFrame([("A ", " v"), ("a", "V"), (None, "v"), ("a", None)], "d string, v string")
    keys = [r[0] for r in df.select(derive.geo_key(F.col("d"), F.col("v"))).collect()]
    assert keys[0] == keys[1] is not None and keys[2:] == [None, None]


def test_row_hash_tells_null_empty_and_shifted_values_apart(spark):
    values = [("a", None), (None, "a"), ("a", ""), ("", "a"), ("ab", "c"), ("a", "bc"), (None, None),
              ("-", None), ("1:a", None)]
    df = spark.createDataFrame(values + [("ab", "c")], "x string, y string")
    hashes = [r[0] for r in df.select(derive.row_hash([F.col("x"), F.col("y")])).collect()]
    assert len(set(hashes)) == len(values) and hashes[4] == hashes[-1]
    short = df.select(derive.row_hash([F.col("x"), F.col("y")], 16)).first()[0]
    assert len(short) == 16


def test_row_hash_is_the_same_text_without_an_interpreted_lambda(spark):
    rows = [("ab", None, "\u00e9,"), (None, None, None), ("", "-", "1:a")]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    hashed = df.select("*", derive.row_hash([F.col("x"), F.col("y"), F.col("z")]).alias("h"))
    for *values, h in hashed.collect():
        text = ",".join("-" if v is None else f"{len(v)}:{v}" for v in values)
        assert h == hashlib.md5(text.encode()).hexdigest()
    assert "lambda" not in hashed._jdf.queryExecution().optimizedPlan().toString()


def test_bands_and_labels(spark):
    df = spark.createDataFrame([(None, None, None), (0, 14, 9), (3, 15, 1), (9, 64, 5), (10, 101, 2)],
                               "n bigint, age bigint, status bigint")
    got = [tuple(r) for r in df.select(derive.hh_size_band(F.col("n")), derive.head_age_band(F.col("age")),
                                       derive.status_label(F.col("status"))).collect()]
    assert got == [("Unknown", "Unknown", "Missing"), ("1-3", "Unknown", "Missing"),
                   ("1-3", "15-24", "Found"), ("7-9", "55-64", "Disability"),
                   ("10+", "Unknown", "Moved away")]


def frame(spark, rows):
    rows = [("c", i + 1, h, k, dt.datetime.fromisoformat(at) if at else None, s, c)
            for i, (h, k, at, s, c) in enumerate(rows)]
    return spark.createDataFrame(rows, "survey_cycle string, source_row bigint, household_id string, "
                                       "submission_key string, submitted_at timestamp_ntz, "
                                       "interview_status bigint, consent bigint")


def outcome(df, hot_rows=1_000_000):
    kept, lost = dedupe.split(dedupe.tag_submissions(df, hot_rows))
    return kept.collect(), lost.collect()


def test_every_row_is_kept_or_has_its_reason(spark):
    df = frame(spark, [
        ("ELM-4", "p07", "2031-02-11", 2, None), ("ELM-4", "p03", "2031-02-11", 1, 0), ("ELM-4", "p05", "2031-01-30", 1, 1),
        ("OAK-1", "p03", "2031-03-01", 1, 1), ("OAK-1", "p09", None, 1, 1), (None, None, "2031-03-02", None, 1),
        (None, "p11", None, None, None), ("ASH-9", "p12", "2031-04-04", 1, 1)])
    kept, lost = outcome(df)
    assert {(r.household_id, r.submission_key, r.is_completed, r.is_consented, r.household_submissions) for r in kept} == {
        ("ELM-4", "p03", True, False, 3), ("OAK-1", "p09", True, True, 1), ("ASH-9", "p12", True, True, 1)}
    assert {(r.source_row, r.reject_reason, r.is_completed, r.household_submissions) for r in lost} == {
        (1, "superseded_duplicate", False, 3), (3, "superseded_duplicate", True, 3),
        (4, "duplicate_submission_key", None, None), (6, "empty_row", None, None),
        (7, "missing_household_id", None, None)}


def test_order_of_preference_among_a_households_rows(spark):
    """Time, consent, completion and key decide in this order, whatever the order of the file."""
    ranked = [("ELM-4", "p9", "2031-05-02", 4, None), ("ELM-4", "p8", "2031-05-01", 1, 1), ("ELM-4", "p7", "2031-05-01", 1, 0),
              ("ELM-4", "p1", "2031-05-01", 2, 1), ("ELM-4", "p2", "2031-05-01", None, 1), ("ELM-4", "p0", None, 1, 1)]
    for skipped in range(len(ranked)):
        for rows in (ranked[skipped:], ranked[skipped:][::-1]):
            df = frame(spark, rows)
            assert [r.submission_key for r in dedupe.dedupe_latest(df).collect()] == [ranked[skipped][1]]


def test_a_key_is_a_duplicate_even_of_a_row_without_household(spark):
    kept, lost = outcome(frame(spark, [(None, "k1", "2023-08-01", 1, 1), ("H1", "k1", "2023-08-02", 1, 1)]))
    assert kept == []
    assert {(r.source_row, r.reject_reason) for r in lost} == {
        (1, "missing_household_id"), (2, "duplicate_submission_key")}


def test_kept_rows_are_checked(spark):
    df = frame(spark, [("H1", "a", "2023-08-01", 1, 1), ("H1", "b", "2023-08-01", 1, 1)])
    with pytest.raises(AssertionError, match="grain"):
        dedupe.check_kept(df)
    with pytest.raises(AssertionError, match="submitted_at"):
        dedupe.check_kept(frame(spark, [("H1", "a", None, 1, 1)]))


def test_column_kinds(spark):
    fields = spark.createDataFrame(
        [("c", "crop", "Fields", "Which crops?", 6), ("c", "plot", "Fields", "Plot name", 0),
         ("c", "rain_mm", "Weather", "Rain", 0), ("d", "soil", "Fields", "Soil", 2)],
        "survey_cycle string, field string, section string, label string, n_choices int")
    columns = spark.createDataFrame(
        [("c", n) for n in ("crop", "crop_4", "crop12", "plot7", "plot", "rain_mm", "rain_mm_", "soil", "endtime",
                            "Rain cost (USD)", "Quartile2", "7", "crop_")] + [("d", "soil_1"), ("d", "crop_1")],
        "survey_cycle string, variable string")
    got = {(r.survey_cycle, r.variable): (r.kind, r.form_field, r.section)
           for r in catalog.classify_columns(columns, fields).collect()}
    none = ("unclassified", None, None)
    assert got == {
        ("c", "crop"): ("select_question", "crop", "Fields"), ("c", "crop_4"): ("select_multiple_option", "crop", "Fields"),
        ("c", "crop12"): ("select_multiple_option", "crop", "Fields"), ("c", "plot7"): ("repeat_instance", "plot", "Fields"),
        ("c", "plot"): ("question", "plot", "Fields"), ("c", "rain_mm"): ("question", "rain_mm", "Weather"),
        ("c", "rain_mm_"): none, ("c", "soil"): none, ("c", "endtime"): ("system", None, None),
        ("c", "Rain cost (USD)"): ("derived_metric", None, None), ("c", "Quartile2"): none, ("c", "7"): none,
        ("c", "crop_"): none, ("d", "soil_1"): ("select_multiple_option", "soil", "Fields"), ("d", "crop_1"): none}


def test_resolution_prefers_exact_then_earlier_candidates(spark):
    spec = spark.createDataFrame([("v", ["A b", "C"]), ("w", ["D"]), ("x", ["E"])],
                                 "canonical_name string, candidates array<string>")
    headers = spark.createDataFrame(
        [("baseline", "a_B", 0), ("baseline", "C", 1), ("year1", "a-b", 1), ("year1", "ab.", 0),
         ("year1", "d", 2), ("year2", "E", 0)], "survey_cycle string, header string, position int")
    got = {(r.canonical_name, r.survey_cycle): (r.source, r.match) for r in catalog.resolve_variables(
        spec, headers, ["baseline", "year1", "year2"]).collect()}
    assert got[("v", "baseline")] == ("C", "exact")
    assert got[("v", "year1")] == ("ab.", "fuzzy")
    assert got[("w", "year1")] == ("d", "fuzzy")
    assert got[("x", "year2")] == ("E", "exact")
    assert got[("w", "baseline")] == ("", "missing") and len(got) == 9
