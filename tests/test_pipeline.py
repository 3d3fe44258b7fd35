"""Files in, tables out: exports, forms, landing, sinks, the batch run and the stream."""

import csv
import hashlib
import os
import shutil

import pytest
from fixtures import headers, rows, write_exports, write_forms
from pyspark.sql import functions as F

from wavemill import config, sinks
from wavemill.operators import catalog, dedupe, harmonize, labels
from wavemill.plans import quality, reads, warehouse
from wavemill.sources import exports, forms, landing
from wavemill.streaming import bronze_stream

CODES = [c.code for c in config.CYCLES]


@pytest.fixture(scope="module")
def data(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("data"))
    write_exports(folder)
    write_forms(folder)
    return folder


@pytest.fixture(scope="module")
def variable_map(spark, data):
    found = {c.code: exports.normalized_headers(exports.raw_headers(spark, f"{data}/{c.export}"))
             for c in config.CYCLES}
    spec = config.variable_spec_frame(spark)
    resolved = catalog.resolve_variables(spec, exports.headers_frame(spark, found), CODES)
    return catalog.draft_variable_map(spec, resolved, CODES)


@pytest.fixture(scope="module")
def built(spark, data, variable_map, tmp_path_factory):
    lake = warehouse.Lake(spark, str(tmp_path_factory.mktemp("lake")))
    label_map = spark.createDataFrame(
        [("Material_roof", "iron sheets", "Iron Sheets"), ("x", "", "...")],
        "field string, raw_label string, conformed_label string")
    results = warehouse.build_all(lake, data, variable_map, label_map, config.regions_frame(spark))
    return lake, {r["check"]: r for r in results.collect()}


# ---------------------------------------------------------------- exports

def test_export_keeps_headers_text_and_order(spark, data):
    df = exports.read_export(spark, f"{data}/03_year_two.csv")
    own = [c for c in df.columns if not c.startswith("_source")]
    assert own == [*headers("year2"), "Status", "Total Savings (Ugx).1", "hhmem_1", "hhmem_2",
                   "Loan_from_97", "never"]
    got = df.orderBy("_source_row").select("_source_row", "KEY", "enumerator", "`Status`", "status",
                                           "`Total Savings (Ugx)`", "`Total Savings (Ugx).1`",
                                           "hhid_2", "never", "_source_file").collect()
    assert [r._source_row for r in got] == list(range(1, 8))
    assert [r.KEY for r in got] == [x["KEY"] for x in rows("year2")]
    assert got[0].enumerator == "NA" and got[1].enumerator == 'says "hi",\nthen leaves'
    assert (got[0]["Status"], got[0]["status"]) == ("org", "1")
    assert (got[0]["Total Savings (Ugx)"], got[0]["Total Savings (Ugx).1"]) == ("1000", "999")
    assert got[4].hhid_2 is None and got[0].never is None
    assert got[0]._source_file == "03_year_two.csv"


def test_rows_are_numbered_in_file_order_across_splits_and_files(spark, tmp_path):
    expected = []
    for part in range(3):
        with open(tmp_path / f"part{part}.csv", "w") as f:
            f.write("k,v\n")
            for i in range(400 * (3 - part)):
                f.write(f"{part}-{i},{'x' * 50}\n")
                expected.append(f"{part}-{i}")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        df = exports.read_export(spark, str(tmp_path), multiline=False)
        assert df.rdd.getNumPartitions() > 3
        got = df.select("_source_row", "k").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert [k for _, k in sorted(map(tuple, got))] == expected
    assert sorted(r._source_row for r in got) == list(range(1, len(expected) + 1))


def test_header_collision_is_an_error(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a  b,a b\n1,2\n")
    with pytest.raises(ValueError, match="collision"):
        exports.read_export(spark, str(tmp_path / "x.csv"))


def test_missing_mapped_column_is_an_error(spark):
    df = spark.createDataFrame([("1",)], "x string")
    with pytest.raises(KeyError, match="nope"):
        harmonize.harmonize(df, [("v", "int", "nope")], config.CYCLES[0], {})


def test_variable_map_file(spark, tmp_path):
    path = tmp_path / "vm.csv"
    path.write_text('canonical_name,dtype,baseline,year1,year2,notes\na,int,X,,"Y, Z",\nb,string,,,W,"n"\n')
    vm = harmonize.load_variable_map(spark, str(path))
    assert harmonize.contract_rows(vm, "year2") == [("a", "int", "Y, Z"), ("b", "string", "W")]
    assert harmonize.contract_rows(vm, "year1") == [("a", "int", None), ("b", "string", None)]
    path.write_text("canonical_name,dtype,baseline\na,int,X\na,int,Y\n")
    with pytest.raises(ValueError, match="repeats"):
        harmonize.load_variable_map(spark, str(path))


def test_drafted_map_finds_every_header(variable_map):
    got = {r.canonical_name: r for r in variable_map.collect()}
    assert len(got) == 57
    assert got["cluster"].baseline == "Pre_cluster" and got["cluster"].year1 == "pre_cluster"
    assert got["consumption_residues_usd_year"].baseline == "Consumption (USD)"
    assert got["consumption_residues_usd_year"].year2 == "Consumption + Residues(USD)"
    assert got["inc_rent_usd"].year1 == "Rent Income (Property & Land) USD"
    assert got["cohort"].baseline == "" and got["gps_lat"].year2 == ""
    assert got["savings_ugx"].year1 == "Total Savings (Ugx)"


# ---------------------------------------------------------------- forms

def test_form_parser(spark, data):
    parsed = forms.read_forms(spark, [f"{data}/{c.form}" for c in config.CYCLES])
    got = {r.field: r for r in parsed.where(F.col("form") == config.CYCLES[0].form).collect()}
    assert list(got) == ["hhid_2", "district", "hhh_sex", "respondent", "Material_roof", "hhmem", "Loan_from"]
    assert [got[f].position for f in got] == list(range(7))
    assert got["hhid_2"].section == "Household  group" and got["hhmem"].section == "Housing"
    assert got["hhid_2"].label == "Household? please & thanks" and got["hhid_2"].choices == []
    assert [tuple(c) for c in got["district"].choices] == [("1", "Kanungu"), ("2", "Mitooma")]
    assert [tuple(c) for c in got["respondent"].choices] == [("1", "[Head] of household"), ("2", "Spouse")]


def test_forms_to_label_conform(spark, data):
    parsed = forms.read_forms(spark, [f"{data}/{c.form}" for c in config.CYCLES])
    cycles = config.cycles_frame(spark)
    parsed = parsed.join(cycles.select(F.col("form_file").alias("form"), "survey_cycle"), "form")
    choices = labels.load_choices(parsed, cycles)
    conform = labels.label_conform(choices, config.rewordings_frame(spark))
    got = {tuple(r) for r in conform.collect()}
    assert ("Material_roof", "iron sheets", "Iron Sheets") in got
    assert ("Material_roof", "Thatch/Tins", "Thatch/Tins/Grass") in got
    decoded = [f for f, *_ in config.DECODED_FIELDS] + [config.DISTRICT_FIELD]
    assert labels.label_review(choices, conform, decoded, CODES).count() == 0


# ---------------------------------------------------------------- landing and sinks

def test_landing_skips_known_content_and_follows_reverts(spark, tmp_path):
    file = tmp_path / "a.csv"
    manifest = str(tmp_path / "manifest")
    sources = spark.createDataFrame([("c", "data", str(file))], "survey_cycle string, kind string, path string")

    def land(text):
        file.write_text(text)
        entry = landing.land(spark, sources, manifest).first()
        current = landing.latest_versions(landing.read_manifest(spark, manifest)).first()
        digest = hashlib.sha256(text.encode()).hexdigest()
        assert entry.sha256 == current.sha256 == digest and entry.bytes == len(text)
        return entry.status

    assert land("one") == "landed"
    assert land("one") == "unchanged"
    assert land("two" * 700_000) == "landed"
    assert land("one") == "unchanged"
    known = landing.read_manifest(spark, manifest)
    assert landing.new_files(known, known).count() == 0


def test_files_of_one_name_in_two_folders_keep_their_own_content(spark, tmp_path):
    for folder in "ab":
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.csv").write_text(folder * 10)
    sources = spark.createDataFrame([(c, "data", f"{tmp_path}/{c}/x.csv") for c in "ab"],
                                    "survey_cycle string, kind string, path string")
    got = {r.survey_cycle: (r.sha256, r.file, r.bytes) for r in landing.fingerprints(spark, sources).collect()}
    assert got == {c: (hashlib.sha256((c * 10).encode()).hexdigest(), "x.csv", 10) for c in "ab"}


def test_nested_and_unclosed_elements_of_a_form(spark):
    nested = ("<p>" * 3000 + "<table><tr class=entryRow><td class=fieldCell>f<td class=questionCell>q<td>"
              "<table><tr><td>1<td>1<td>one<tr><td colspan=3><table><tr><td>2<td>5<td>five</table></table></table>")
    df = spark.createDataFrame([("n", nested), ("e", ""), ("x", None)], "form string, html string")
    row, = forms.parse_forms(df).collect()
    assert (row.field, row.label) == ("f", "q")
    assert [tuple(c) for c in row.choices].count(("5", "five")) == 1
    assert ("1", "one") in [tuple(c) for c in row.choices]


def test_sinks(spark, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "once")
    assert sinks.write_once(df, path) and not sinks.write_once(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3
    os.remove(f"{path}/_SUCCESS")  # what a failed write leaves behind
    assert sinks.write_once(spark.range(9), path) and spark.read.parquet(path).count() == 9
    draft = str(tmp_path / "draft")
    sinks.write_draft_csv(df, draft)
    with pytest.raises(Exception, match="exists"):
        sinks.write_draft_csv(df, draft)
    sinks.write_draft_csv(spark.range(5), draft, force=True)
    assert spark.read.csv(draft, header=True).count() == 5
    history = str(tmp_path / "runs")
    for i in range(3):
        sinks.append_runs(spark, [(f"r{i}", "t", "success", 1, 0.5, "")], history)
    assert reads.recent_runs(spark.read.parquet(history), k=2).count() == 2
    laid = sinks.write_layout(spark.range(50).withColumn("k", 50 - F.col("id")), str(tmp_path / "l"), ["k"])
    assert laid.count() == 50
    sinks.register_view(laid, "laid_view")
    assert spark.sql("SELECT count(*) FROM laid_view").first()[0] == 50


# ---------------------------------------------------------------- batch run

def test_bronze_is_text_with_lineage_and_written_once(spark, data, built):
    lake, _ = built
    paths = warehouse.build_bronze(lake)
    stored = {p: sorted(map(tuple, spark.read.parquet(p).select("_row_hash", "_ingested_at").collect()), key=str)
              for p in paths.values()}
    assert warehouse.build_bronze(lake) == paths
    for path, rows_before in stored.items():
        again = spark.read.parquet(path).select("_row_hash", "_ingested_at").collect()
        assert sorted(map(tuple, again), key=str) == rows_before
    for code, path in paths.items():
        df = spark.read.parquet(path)
        assert {"_survey_cycle", "_source_file", "_source_sha256", "_source_row", "_row_hash",
                "_ingested_at"} <= set(df.columns)
        assert {t for n, t in df.dtypes if n != "_source_row"} == {"string"}
        assert df.count() == len(rows(code))
    narrow = exports.read_bronze(spark, paths["year2"], ["KEY", "HH Income (USD)"])
    assert "ReadSchema: struct<KEY:string,HH Income (USD):string>" in narrow._jdf.queryExecution().toString()
    year1 = spark.read.parquet(paths["year1"])
    assert year1.count() - year1.select("_row_hash").distinct().count() == 1  # the two left-over lines


def test_silver(built):
    lake, _ = built
    stored = lake.table("silver", "submission")
    lost = {(r.survey_cycle, r.reject_reason, r.submission_key) for r in
            stored.where("kept = 0").collect()}
    expected = {(c, reason, f"{p}{n}") for c, p in (("baseline", "b"), ("year1", "y"), ("year2", "z"))
                for reason, n in (("superseded_duplicate", 1), ("missing_household_id", 5),
                                  ("duplicate_submission_key", 5))}
    assert lost == expected | {("year1", "empty_row", None)}
    kept = {(r.survey_cycle, r.household_id): r for r in stored.where("kept = 1").collect()}
    latest = kept["year1", "KAN-KAY-BUJ-K0001"]
    assert (latest.hh_size, latest.household_submissions, latest.interview_minutes) == (5, 2, 60.0)
    assert latest.form_version == "2101" and latest.gps_lat is None
    assert kept["baseline", "MIT-NYA-M-U11019"].household_id_raw != "MIT-NYA-M-U11019"
    refused = kept["year2", "KAN-KAY-BUJ-K0007"]
    assert (refused.is_completed, refused.is_consented, refused.head_age) == (True, False, None)
    total = sum(len(rows(c)) for c in CODES)
    assert stored.count() == total
    assert quality.row_reconciliation(lake.table("silver", "typed"), stored).agg(F.sum("unaccounted")).first()[0] == 0


def test_gold(built):
    lake, _ = built
    fact = lake.table("gold", "fct_survey_submissions")
    got = {(r.survey_cycle, r.household_id): r for r in fact.collect()}
    assert len(got) == fact.count() == 11
    assert {r.roof_material_label for r in got.values()} == {"Iron Sheets"}
    assert {r.respondent_label for r in got.values()} == {"Head of household"}
    assert got["baseline", "KAN-KAY-BUJ-K0002"].geo_key == got["baseline", "KAN-KAY-BUJ-K0001"].geo_key
    geography = lake.table("gold", "dim_geography").collect()
    assert {(g.district, g.village, g.region_name, g.cycles_seen) for g in geography} == {
        ("Kanungu", "Kyeshero", "Western", 3), ("Mitooma", "Nyakizinga", "Western", 3)}
    households = {r.household_id: r for r in lake.table("gold", "dim_household").collect()}
    assert households["KAN-KAY-BUJ-K0001"].cycle_pattern == "baseline + year1 + year2"
    assert households["KAN-KAY-BUJ-K0007"].cycle_pattern == "baseline + year2"
    assert households["KAN-KAY-BUJ-K0001"].cohort == "2022"
    cycle = {r.survey_cycle: r for r in lake.table("gold", "rpt_field_operations_cycle").collect()}
    assert cycle["baseline"].missing_gps_rate == 0.0 and cycle["year1"].missing_gps_rate is None
    assert cycle["year1"].submissions_raw == 6 and cycle["year1"].submissions_rejected == 2
    program = {r.survey_cycle: r for r in lake.table("gold", "rpt_program_cycle").collect()}
    assert program["baseline"].consent_rate == 0.75 and program["year1"].consent_rate_change_vs_baseline == 0.25
    assert quality.inconsistent_program_rows(lake.table("gold", "rpt_program_summary")).count() == 0
    panel = lake.table("gold", "rpt_panel_poverty")
    assert reads.panel_size(panel).first()[0] == 3
    drift = [tuple(r) for r in lake.table("gold", "dq_schema_drift").collect()]
    assert {d[:2] for d in drift} == {("baseline", "year1"), ("year1", "year2")}
    tables = {name: lake.table("gold", name) for name in warehouse.REQUIRED}
    assert warehouse.missing_tables(tables) == set() and warehouse.missing_tables({}) == set(warehouse.REQUIRED)
    assert warehouse.row_counts(tables)["fct_survey_submissions"] == 11
    stored = lake.table("silver", "submission")
    operations = lake.table("gold", "rpt_field_operations")
    counted = quality.operations_reconciliation(lake.table("silver", "typed"), stored, operations).collect()
    assert len(counted) == 3 and all(r.unaccounted == 0 for r in counted)
    for view in ("stg_all_submissions", "rpt_field_operations_cycle", "rpt_program_cycle"):
        assert lake.spark.sql(f"SELECT count(*) FROM {view}").first()[0] > 0
    runs = lake.table("gold", "ops_pipeline_runs").collect()
    assert {(r.task, r.status) for r in runs} == {
        (t, "success") for t in ("raw", "bronze", "catalog", "silver", "warehouse", "quality")}


def test_catalog(built):
    lake, _ = built
    variables = {(r.survey_cycle, r.variable): r for r in lake.table("meta", "meta_variable").collect()}
    assert variables["year2", "Loan_from_97"].kind == "select_multiple_option"
    assert variables["year2", "hhmem_2"].kind == "repeat_instance" and variables["year2", "hhmem_2"].all_null
    assert variables["year2", "Total Savings (Ugx).1"].kind == "derived_metric"
    assert variables["baseline", "GPS-Latitude"].in_baseline and not variables["baseline", "GPS-Latitude"].in_year2
    silver = {(r.canonical_name, r.survey_cycle): r for r in lake.table("meta", "meta_silver_variable").collect()}
    assert len(silver) == 57 * 3
    assert silver["roof_material", "year1"].label == "Roof? please & thanks"
    assert not silver["gps_lat", "year1"].available and silver["gps_lat", "baseline"].available


def test_quality(built):
    _, checks = built
    assert len(checks) == 36
    failed = {k: (r.failed, r.total) for k, r in checks.items() if r.failed}
    assert failed["year1: identical rows in export (same row hash)"] == (1, 8)
    assert failed["baseline_households_missing_a_follow_up_cycle"] == (1, 4)
    assert checks["district_code_decodes_to_preloaded_label"].failed == 0
    assert checks["year1: district code maps to one label"]["detail"] == "7.0=Kanungu; 8.0=Mitooma"
    assert not [k for k, r in checks.items() if r.severity == "error" and r.failed]


def test_checks_counted_by_the_writes_equal_those_of_a_scan(built):
    lake, checks = built
    fact, stored = lake.table("gold", "fct_survey_submissions"), lake.table("silver", "submission")
    kept = stored.where("kept = 1").drop("kept", "reject_reason")
    assert set(lake.counted) == {"submission", "fct_survey_submissions"}
    for scanned, counted in ((quality.fact_checks(fact), quality.fact_checks(fact, lake.counted["fct_survey_submissions"])),
                             (quality.silver_checks(kept), lake.counted["submission"])):
        assert sorted(map(tuple, scanned.collect())) == sorted(map(tuple, counted.collect()))
        for r in counted.collect():
            assert (checks[r.check].failed, checks[r.check].total) == (r.failed, r.total)


def test_a_failing_error_check_stops_the_run_after_its_results_are_stored(spark, data, variable_map, tmp_path):
    broken = str(tmp_path / "data")
    shutil.copytree(data, broken)
    lines = list(csv.reader(open(f"{broken}/03_year_two.csv", newline="")))
    at = lines[0].index("SubmissionDate")
    key = lines[0].index("KEY")
    next(r for r in lines if r[key] == "z5")[at] = "yesterday"  # a row that is rejected anyway
    with open(f"{broken}/03_year_two.csv", "w", newline="") as f:
        csv.writer(f).writerows(lines)
    lake = warehouse.Lake(spark, str(tmp_path / "lake"))
    empty = spark.createDataFrame([], "field string, raw_label string, conformed_label string")
    with pytest.raises(quality.QualityGateError, match="year2: SubmissionDate"):
        warehouse.build_all(lake, broken, variable_map, empty, config.regions_frame(spark))
    assert lake.table("gold", "dq_results").count() == 36
    assert {r.status for r in lake.table("gold", "ops_pipeline_runs").where("task = 'quality'").collect()} == {"failed"}


# ---------------------------------------------------------------- stream

def test_stream_takes_each_file_once(spark, data, tmp_path):
    folder, bronze, checkpoint = (str(tmp_path / n) for n in ("in", "bronze", "checkpoint"))
    os.makedirs(folder)
    names = exports.normalized_headers(exports.raw_headers(spark, f"{data}/03_year_two.csv"))

    def take():
        bronze_stream.ingest_new_files(spark, folder, names, "year2", bronze, checkpoint).awaitTermination()
        df = spark.read.parquet(bronze)
        return df.count(), df.agg(F.count_distinct("_source_row"), F.max("_source_row")).first()

    shutil.copy(f"{data}/03_year_two.csv", f"{folder}/a.csv")
    assert take() == (7, (7, 7))
    assert take() == (7, (7, 7))
    shutil.copy(f"{data}/03_year_two.csv", f"{folder}/b.csv")
    assert take() == (14, (14, 14))
    digest = hashlib.sha256(open(f"{folder}/a.csv", "rb").read()).hexdigest()
    assert {r[0] for r in spark.read.parquet(bronze).select("_source_sha256").distinct().collect()} == {digest}
    # The batch job then settles what the repeated file brought in.
    spec = [(n, d, h) for n, d, h in harmonize_contract(names)]
    typed = harmonize.harmonize(spark.read.parquet(bronze), spec, config.CYCLE_BY_CODE["year2"])
    kept, lost = dedupe.split(dedupe.tag_submissions(typed))
    assert kept.count() == 4 and lost.count() == 10


def harmonize_contract(names):
    available = set(names)
    return [(n, d, next((h for h in hs if h in available), None)) for n, d, hs in config.VARIABLE_SPEC]
