"""Operators against brute force, on data in which one key owns a large share."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from wavemill import config
from wavemill.operators import catalog, decode, dedupe, labels, profiling
from wavemill.operators.median import aggregate_with_median, exact_median
from wavemill.plans import dims, quality, reads, reports

SUBMISSION = ("survey_cycle string, source_row bigint, household_id string, submission_key string, "
              "submitted_at timestamp_ntz, interview_status bigint, consent bigint")


def skewed_submissions(n=900, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        household = "HOT" if rng.random() < 0.4 else rng.choice([None, *[f"H{k}" for k in range(60)]])
        key = "KHOT" if rng.random() < 0.3 else rng.choice([None, f"K{rng.randrange(n)}"])
        day = dt.datetime(2023, 1, 1) + dt.timedelta(days=rng.randrange(5))
        rows.append((rng.choice("ab"), i + 1, household, key, day, rng.choice([1, 1, 2, None]),
                     rng.choice([1, 0, None])))
    return rows


def brute_force(rows):
    """(row -> reason, row -> household submissions) by plain loops in file order."""
    reasons, sizes, seen, groups = {}, {}, set(), {}
    for cycle, row, household, key, at, status, consent in rows:
        if key is None:
            reasons[row] = "empty_row"
        elif household is None:
            reasons[row] = "missing_household_id"
        elif (cycle, key) in seen:
            reasons[row] = "duplicate_submission_key"
        else:
            done = status == 1
            rank = (-at.timestamp(), not (done and consent == 1), not done, key)
            groups.setdefault((cycle, household), []).append((rank, row))
        seen.add((cycle, key))
    for members in groups.values():
        members.sort()
        for place, (_, row) in enumerate(members):
            reasons[row] = "superseded_duplicate" if place else None
            sizes[row] = len(members)
    return reasons, sizes


@pytest.mark.parametrize("hot_rows", [1_000_000, 7])
def test_tagging_equals_brute_force(spark, hot_rows):
    rows = skewed_submissions()
    df = spark.createDataFrame(rows, SUBMISSION).repartition(5)
    tagged = dedupe.tag_submissions(df, hot_rows).collect()
    reasons, sizes = brute_force(rows)
    assert len(tagged) == len(rows)
    assert {r.source_row: r.reject_reason for r in tagged} == reasons
    assert {r.source_row: r.household_submissions for r in tagged if r.household_submissions} == sizes
    kept = {r.source_row for r in dedupe.dedupe_latest(df).collect()}
    assert kept == {row for row, reason in reasons.items() if reason is None}


def test_duplicate_keys(spark):
    rows = skewed_submissions()
    seen, repeated = set(), set()
    for cycle, row, _, key, *_ in rows:
        if key is not None and (cycle, key) in seen:
            repeated.add(row)
        seen.add((cycle, key))
    df = spark.createDataFrame(rows, SUBMISSION).repartition(3)
    assert {r.source_row for r in dedupe.duplicate_keys(df).collect()} == repeated


def median_cases():
    rng = random.Random(3)
    yield "mixed", [rng.uniform(-5, 5) for _ in range(801)] + [0.0] * 40
    yield "even", [rng.gauss(0, 1e6) for _ in range(1000)]
    yield "two far apart", [1e-300, 1e300]
    yield "close", [1.0 + i * 2.220446049250313e-16 for i in range(1000)]
    yield "constant", [7.25] * 999
    yield "infinite", [float("-inf"), 1.0, 2.0, float("inf"), float("inf")]
    yield "tiny", [5e-324, -5e-324, 0.0, 1.0]
    yield "wide", [10.0 ** rng.uniform(-300, 300) for _ in range(777)]


def test_median_is_exact(spark):
    cases = dict(median_cases())
    rows = [(name, v) for name, values in cases.items() for v in values]
    rows += [("mixed", None), (None, 3.0), (None, 4.0), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    got = {r.k: r.m for r in exact_median(df, ["k"], "v", "m").collect()}
    expected = {name: statistics.median(values) for name, values in cases.items()} | {None: 3.5}
    assert got == expected


def test_median_beside_other_aggregates(spark):
    rows = [("a", float(i % 17)) for i in range(300)] + [("b", 2.0), (None, 1.0), (None, 4.0), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    plain = {}
    for k, v in rows:
        plain.setdefault(k, []).extend([v] if v is not None else [])
    got = aggregate_with_median(df, ["k"], [F.count("*").alias("n"), F.max("v").alias("top")], "v", "m").collect()
    assert {r.k: r.m for r in got} == {k: statistics.median(v) if v else None for k, v in plain.items()}
    assert {r.k: (r.n, r.top) for r in got} == {"a": (300, 16.0), "b": (1, 2.0), None: (2, 4.0), "c": (1, None)}


def decode_frames(spark):
    rows = [("a", i, str(i % 3) if i % 7 else None) for i in range(50)] + [("b", 99, "1")]
    df = spark.createDataFrame([(c, i, None if x is None else int(x)) for c, i, x in rows],
                               "survey_cycle string, id bigint, code bigint")
    table = spark.createDataFrame([("a", "f", "1", "one"), ("a", "f", "2", "two"), ("a", "g", "1", "no"),
                                   ("b", "f", "2", "zwei")],
                                  "survey_cycle string, field string, code string, label string")
    return df, table


def test_decoding(spark):
    df, table = decode_frames(spark)
    wanted = [("f", "code", "label", None), ("g", "code", "other", "Unknown")]
    got = decode.decode(df, table, wanted).select("id", "label", "other").collect()
    assert len(got) == 51
    assert {(r.label, r.other) for r in got} == {("one", "no"), ("two", "Unknown"), (None, "Unknown")}


def test_decode_takes_the_smallest_label_and_the_named_cycles_list(spark):
    choices = spark.createDataFrame(
        [("year2", "f", "1", "[B]"), ("year2", "f", "1", " A "), ("year1", "f", "1", "own"),
         ("baseline", "f", "1", "raw")], "survey_cycle string, field string, code string, label string")
    mapping = spark.createDataFrame([("f", "raw", "Conformed"), ("f", None, "...")],
                                    "field string, raw_label string, conformed_label string")
    table = decode.decode_table(decode.choice_conformed(choices, mapping), config.cycles_frame(spark), ["f"])
    assert {(r.survey_cycle, r.label) for r in table.collect()} == {
        ("baseline", "Conformed"), ("year1", "A"), ("year2", "A")}


def test_profile(spark):
    df = spark.createDataFrame([("a", "x", None, "1"), ("a", "y", None, "1"), ("a", None, None, "1"),
                                ("b", "x", "z", "1")],
                               "survey_cycle string, p string, `q.r (USD)` string, s string")
    got = {(r.survey_cycle, r.variable): (r.null_rate, r.n_distinct, r.all_null)
           for r in catalog.column_profile(df, ["p", "q.r (USD)", "s"]).collect()}
    assert got == {("a", "p"): (0.3333, 2, False), ("a", "q.r (USD)"): (1.0, 0, True),
                   ("a", "s"): (0.0, 1, False), ("b", "p"): (0.0, 1, False),
                   ("b", "q.r (USD)"): (0.0, 1, False), ("b", "s"): (0.0, 1, False)}
    present = catalog.collected_columns(df, ["p", "q.r (USD)", "s"])
    assert {tuple(r) for r in present.collect()} == {k for k, v in got.items() if not v[2]}
    shape = {r.survey_cycle: (r.columns, r.all_null_columns)
             for r in profiling.all_null_columns(catalog.column_profile(df, ["p", "q.r (USD)", "s"])).collect()}
    assert shape == {"a": (3, 1), "b": (3, 0)}


def test_a_profile_counts_what_is_asked_and_is_read_once(spark):
    df = spark.createDataFrame([("baseline", "x", None), ("baseline", "x", None), ("year2", "y", "z"), (None, "y", "z"),
                                (None, None, None)], "survey_cycle string, `p q` string, s string")
    profile = catalog.column_profile(df, ["p q", "s"])
    assert {(r.survey_cycle, r.variable): tuple(r)[2:] for r in profile.collect()} == {
        ("baseline", "p q"): (0.0, 1, False), ("baseline", "s"): (1.0, 0, True), ("year2", "p q"): (0.0, 1, False),
        ("year2", "s"): (0.0, 1, False), (None, "p q"): (0.5, 1, False), (None, "s"): (0.5, 1, False)}
    fields = spark.createDataFrame([("year2", "s", "S", "L", 2)],
                                   "survey_cycle string, field string, section string, label string, n_choices int")
    variables = catalog.meta_variable(profile.where(~F.col("all_null")), fields, ["baseline", "year2"])
    shown = variables.select("survey_cycle", "variable", "kind", "null_rate", "in_baseline", "in_year2")
    assert {tuple(r) for r in shown.collect()} == {
        ("baseline", "p q", "unclassified", 0.0, True, True), ("year2", "p q", "unclassified", 0.0, True, True),
        ("year2", "s", "select_question", 0.0, False, True), (None, "p q", "unclassified", 0.5, True, True),
        (None, "s", "unclassified", 0.5, False, True)}
    # Kinds and shares of NULLs need no distinct values: no row is taken apart, and the export is scanned once.
    plan = shown._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "posexplode" not in plan and plan.count("count(p q#") == 1
    assert "posexplode" in variables._jdf.queryExecution().optimizedPlan().toString()


def test_samples_are_seeded_and_not_null(spark):
    df = spark.createDataFrame([(str(i) if i % 2 else None,) for i in range(50)], "v string")
    first = [r.v for r in profiling.sample_values(df, "v").collect()]
    assert len(first) == 3 and None not in first
    assert first == [r.v for r in profiling.sample_values(df, "v").collect()]


def test_labels_conform_to_the_latest_spelling_and_confirmed_rows_win(spark):
    rows = [(0, "baseline", "f", "1", "Bed  frame", 1), (2, "year2", "f", "1", "Bedframe", 1),
            (2, "year2", "f", "2", "bed-frame", 2), (0, "baseline", "f", "3", "Other", 3),
            (1, "year1", "f", "3", "Else", 1), (0, "baseline", "g", "1", "", 1), (1, "year1", "g", "1", "...", 1)]
    choices = spark.createDataFrame(rows, "cycle_order int, survey_cycle string, field string, code string, "
                                          "label string, position bigint")
    auto = {tuple(r) for r in labels.automatic_conform(choices).collect()}
    assert auto == {("f", "Bed  frame", "bed-frame"), ("f", "Bedframe", "bed-frame"), ("g", "", "...")}
    confirmed = spark.createDataFrame([("f", "Bedframe", "Bed"), ("f", "Else", "Other")],
                                      "field string, raw_label string, conformed_label string")
    conform = labels.label_conform(choices, confirmed)
    assert {tuple(r) for r in conform.collect()} == {
        ("f", "Bed  frame", "bed-frame"), ("f", "Bedframe", "Bed"), ("f", "Else", "Other"), ("g", "", "...")}
    review = labels.label_review(choices, conform, ["f"], ["baseline", "year1", "year2"]).collect()
    assert [tuple(r) for r in review] == [("f", "1", "bed-frame", None, "Bed")]


def test_places_without_key_form_one_row_and_never_join(spark):
    day = dt.datetime(2023, 1, 1)
    rows = [("c", 0, "K1", day, "A", "s", "p", None, "v"), ("c", 0, "K2", day, None, "s", "p", None, "v"),
            ("d", 1, "K3", day, "a ", "s", "P", "x y", "V"), ("d", 1, "K4", day, "B", None, None, None, None)]
    kept = spark.createDataFrame(rows, "survey_cycle string, cycle_order int, submission_key string, "
                                       "submitted_at timestamp_ntz, district string, subcounty string, "
                                       "parish string, cluster string, village string")
    regions = spark.createDataFrame([("a", "R", "Region", "Sub")],
                                    "district string, region_code string, region_name string, sub_region string")
    places = {r.geo_key: r for r in dims.dim_geography(kept, regions).collect()}
    assert len(places) == 2
    known = next(p for k, p in places.items() if k)
    assert (known.district, known.cluster, known.parish, known.cycles_seen, known.parish_spellings_seen,
            known.region_code) == ("A", "X Y", "P", 2, 1, "R")
    fact = spark.createDataFrame([(None,), (known.geo_key,)], "geo_key string")
    assert tuple(quality.unmatched(fact, dims.dim_geography(kept, regions), "geo_key").first()) == (1, 2)


def test_gate_and_grading(spark):
    checks = spark.createDataFrame([("a", "error", 0, 5, ""), ("b", "warn", 1, 3, ""), ("c", "info", 0, 0, "")],
                                   "check string, severity string, failed bigint, total bigint, detail string")
    results = quality.dq_results(checks)
    got = {r["check"]: (r.fail_pct, r.passed) for r in results.collect()}
    assert got == {"a": (0.0, True), "b": (33.33, False), "c": (None, True)}
    quality.gate(results)
    assert tuple(reads.dq_counters(results).first()) == (3, 1, 0)
    with pytest.raises(quality.QualityGateError, match="a: 2 of 5"):
        quality.gate(results.withColumns({"failed": F.lit(2), "passed": F.lit(False)}))


def test_parameterised_read_and_orders(spark):
    df = spark.createDataFrame([("a", "X", 1), ("a", "Missing", 2), ("b", "X", 3), ("a", "Y", 4)],
                               "survey_cycle string, district string, n int")
    df.createOrReplaceTempView("ops_view")
    got = {r.n for r in reads.filtered_sql(spark, "ops_view", ["a"], ["X"]).collect()}
    assert got == {1, 2} == {r.n for r in reads.filtered(df, ["a"], ["X"], True).collect()}
    assert {r.n for r in reads.filtered(df, ["a"], ["X"]).collect()} == {1}
    cats = spark.createDataFrame([("Unknown",), ("b",), ("a",)], "category string")
    assert [r.category for r in reads.unknown_last(cats).collect()] == ["a", "b", "Unknown"]
    labelled = reads.in_cycle_order(reads.with_cycle_label(
        config.cycles_frame(spark).select("survey_cycle", "cycle_order"), config.cycles_frame(spark)))
    assert [r.cycle for r in labelled.collect()] == ["Baseline", "Year 1", "Year 2"]


def test_one_group_with_half_of_the_values_has_its_median(spark):
    df = spark.range(400_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise((F.col("id") % 50).cast("string"))
                                    .alias("k"), (F.col("id") * 7919 % 400_009 / 8).alias("v"))
    expected = {}
    for r in df.collect():
        expected.setdefault(r.k, []).append(r.v)
    got = {r.k: r.m for r in exact_median(df, ["k"], "v", "m").collect()}
    assert got == {k: statistics.median(v) for k, v in expected.items()}


def test_building_a_query_runs_no_job(spark):
    from wavemill.queries import model

    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "building only")
    try:
        for name in model.QUERIES:
            model.build(name)(spark, "/root/testdata/sf0.001")
        # Reading a table's schema is one small job a file at most; nothing else may run.
        ran = [j for j in status.getJobIdsForGroup("plans") if sum(
            status.getStageInfo(k).numTasks for k in status.getJobInfo(j).stageIds if status.getStageInfo(k)) > 1]
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert not ran


def test_entries_without_a_code_decode_nothing(spark):
    table = spark.createDataFrame([("a", "f", "1", "one"), ("a", "f", None, "none"), ("b", "f", "1", "uno")],
                                  "survey_cycle string, field string, code string, label string")
    rows = spark.createDataFrame([("a", 1), ("a", None), ("a", 2), ("b", 1), (None, 1)], "survey_cycle string, c bigint")
    got = decode.decode(rows, table, [("f", "c", "plain", None), ("f", "c", "named", "?")]).collect()
    assert sorted(((r.survey_cycle, r.c, r.plain, r.named) for r in got), key=str) == sorted(
        [("a", 1, "one", "one"), ("a", None, None, "?"), ("a", 2, None, "?"), ("b", 1, "uno", "uno"),
         (None, 1, None, "?")], key=str)
