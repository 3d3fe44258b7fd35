"""The registered queries: each builds one result over the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import casts, derive, sql, text
from ..operators import catalog, dedupe, decode, harmonize, labels, profiling
from ..operators.median import exact_median
from ..plans import dims, facts, quality, reads, reports
from ..sinks import shared_folder
from ..sources import adapter, forms
from ..streaming import silver_stream

CODES = [c.code for c in config.CYCLES]

# Text values that must and must not pass as numbers; {k} is the order key.
NUMBER_TEXT = ("CASE o_orderkey % 9 WHEN 0 THEN CAST(o_orderkey AS STRING) "
               "WHEN 1 THEN concat(o_orderkey, '.0') WHEN 2 THEN concat(o_orderkey, '.5') "
               "WHEN 3 THEN concat(o_orderkey, 'd') WHEN 4 THEN 'NaN' "
               "WHEN 5 THEN concat(' ', o_orderkey, char(160)) WHEN 6 THEN 'NA' "
               "WHEN 7 THEN concat('-', o_orderkey, 'e1') END")

# Export columns without a contract variable, to be classified from the form.
EXTRA_COLUMNS = {
    "hhmem_1": "o_orderkey % 5", "hhmem2": "o_orderkey % 7", "Loan_from_97": "o_orderkey % 2",
    "Other asset (UGX)": "o_orderkey % 11", "mystery": "o_orderkey % 13",
}
# Form fields of every cycle: (field, section, label, number of choices).
FORM_FIELDS = (
    ("hhid_2", "Identification", "Household", 0), ("status", "Identification", "Found?", 5),
    ("hhmem", "Members", "Member name", 0), ("Loan_from", "Finance", "Lender", 4),
    ("hh_size", "Members", "How many?", 0), ("hhh_sex", "Members", "Sex of the head", 2),
    ("Material_roof", "Housing", "Roof", 4), ("pre_cohort", None, "Cohort", 0),
)


class Survey:
    """Relations of the survey over one folder, built on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return adapter.table(self.spark, self.folder, name)

    @cached_property
    def cycles(self) -> DataFrame:
        return config.cycles_frame(self.spark)

    @cached_property
    def submissions(self) -> DataFrame:
        return adapter.submissions(self.spark, self.folder)

    @cached_property
    def tagged(self) -> DataFrame:
        return dedupe.tag_submissions(self.submissions)

    @cached_property
    def kept(self) -> DataFrame:
        return adapter.kept(self.spark, self.folder)

    @cached_property
    def all(self) -> DataFrame:
        return dedupe.all_submissions_from_tagged(self.tagged)

    @cached_property
    def regions(self) -> DataFrame:
        return adapter.regions(self.spark, self.folder)

    @cached_property
    def time(self) -> DataFrame:
        return dims.dim_time(self.dated)

    @cached_property
    def dated(self) -> DataFrame:
        """Every submission: a row is one as soon as it has a key, whatever becomes of it."""
        return self.submissions.where(F.col("submission_key").isNotNull())

    @cached_property
    def history(self) -> DataFrame:
        return dims.geography_name_history(self.kept)

    @cached_property
    def geography(self) -> DataFrame:
        return dims.dim_geography(self.kept, self.regions)

    @cached_property
    def households(self) -> DataFrame:
        return dims.dim_household(self.kept, len(CODES))

    @cached_property
    def lists(self) -> DataFrame:
        district = (self.table("nation")
                    .select(F.explode(F.array(F.lit("baseline"), F.lit("year2")))
                            .alias("survey_cycle"),
                            F.lit(config.DISTRICT_FIELD).alias("field"),
                            (F.col("n_nationkey") + 1).cast("string").alias("code"),
                            F.col("n_name").alias("label")))
        return facts.conformed_lists(adapter.choices(self.spark).unionByName(district),
                                     adapter.label_map(self.spark), self.cycles)

    @cached_property
    def fact(self) -> DataFrame:
        return facts.fct_survey_submissions(self.kept, self.lists)

    @cached_property
    def undecoded(self) -> DataFrame:
        return facts.undecoded(self.kept)

    @cached_property
    def operations(self) -> DataFrame:
        return reports.rpt_field_operations(self.all)

    @cached_property
    def operations_cycle(self) -> DataFrame:
        gps = catalog.collected_columns(self.exports, ["GPS-Latitude"]).select(
            "survey_cycle", F.lit(True).alias("available"))
        availability = (self.cycles.join(F.broadcast(gps), "survey_cycle", "left")
                        .select("survey_cycle", F.lit("gps_lat").alias("canonical_name"),
                                F.coalesce("available", F.lit(False)).alias("available")))
        return reports.rpt_field_operations_cycle(self.operations, self.kept, self.all,
                                                  availability)

    @cached_property
    def summary(self) -> DataFrame:
        return reports.rpt_program_summary(self.undecoded, self.geography, self.time)

    @cached_property
    def program_counts(self) -> DataFrame:
        return reports.program_counts(self.undecoded, self.geography, self.time)

    @cached_property
    def demographics(self) -> DataFrame:
        return reports.rpt_program_demographics(self.fact, self.geography)

    @cached_property
    def coverage(self) -> DataFrame:
        return reports.rpt_cohort_coverage(self.households)

    @cached_property
    def panel(self) -> DataFrame:
        return reports.rpt_panel_poverty(self.undecoded, self.households, self.geography)

    # -- the untyped exports -------------------------------------------------

    @cached_property
    def exports(self) -> DataFrame:
        """All cycles as text under the export headers, in each cycle's own notation."""
        year1 = F.col("survey_cycle") == "year1"
        raw = {"household_id": "household_id_raw", "household_id_confirm": "household_confirm_raw"}
        columns = []
        for name, dtype, headers in config.VARIABLE_SPEC:
            c = F.col(raw.get(name, name))
            if dtype == "timestamp":
                fraction = F.when(F.minute(c) % 2 == 0, ".000000").otherwise("")
                c = (F.when(year1, F.date_format(c, "MMM d, yyyy h:mm:ss a"))
                      .when(F.col("survey_cycle") == "baseline",
                            F.date_format(c, "M/d/yyyy, h:mm:ss a"))
                      .otherwise(F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), fraction)))
            elif dtype == "int":
                c = F.when(year1, F.concat(c.cast("string"), F.lit(".0"))).otherwise(c.cast("string"))
            else:
                c = c.cast("string")
            columns.append(c.alias(headers[0]))
        extra = [F.expr(e.replace("o_orderkey", "source_row")).cast("string").alias(n)
                 for n, e in EXTRA_COLUMNS.items()]
        return self.submissions.select("survey_cycle", F.col("source_row").alias("_source_row"),
                                       *columns, *extra)

    @cached_property
    def answers(self) -> DataFrame:
        """The exports' cells before they are written as text, which none of them loses or gains by."""
        raw = {"household_id": "household_id_raw", "household_id_confirm": "household_confirm_raw"}
        return self.submissions.select(
            "survey_cycle", *[F.col(raw.get(name, name)).alias(headers[0]) for name, _, headers in config.VARIABLE_SPEC],
            *[F.expr(e.replace("o_orderkey", "source_row")).alias(n) for n, e in EXTRA_COLUMNS.items()])

    @property
    def export_columns(self) -> list[str]:
        return [c for c in self.exports.columns if c not in ("survey_cycle", "_source_row")]

    @cached_property
    def profile(self) -> DataFrame:
        return catalog.column_profile(self.exports, self.export_columns)

    @cached_property
    def collected(self) -> DataFrame:
        """The variables a cycle collected: those with any value."""
        return catalog.collected_columns(self.exports, self.export_columns)

    @cached_property
    def form_fields(self) -> DataFrame:
        rows = [(c, *f) for c in CODES for f in FORM_FIELDS]
        return config.literal_frame(
            self.spark, rows, "survey_cycle string, field string, section string, label string, n_choices int")

    @cached_property
    def variables(self) -> DataFrame:
        return catalog.meta_variable(self.profile.where(~F.col("all_null")), self.form_fields, CODES)

    @cached_property
    def resolved(self) -> DataFrame:
        """Contract variables against headers spelled differently in each cycle."""
        v = F.col("variable")
        spelled = (F.when(F.col("survey_cycle") == "year1", F.upper(v))
                    .when(F.col("survey_cycle") == "baseline", F.regexp_replace(v, " ", ""))
                    .otherwise(v))
        # The second spelling of a header comes earlier or later in the export, as its length has it.
        headers = self.collected.select("survey_cycle", F.explode(F.array(
            F.struct(spelled.alias("header"), F.lit(1).alias("position")),
            F.struct(F.concat(F.lit("_"), spelled).alias("header"), (F.length(v) % 3).alias("position")))).alias("h")
            ).select("survey_cycle", "h.header", "h.position")
        return catalog.resolve_variables(config.variable_spec_frame(self.spark), headers, CODES)

    @cached_property
    def variable_map(self) -> DataFrame:
        return catalog.draft_variable_map(config.variable_spec_frame(self.spark), self.resolved,
                                          CODES)

    @cached_property
    def part_choices(self) -> DataFrame:
        """Parts as form choices: brand = field, size = code, name in varying spellings = label."""
        spelled = F.expr("CASE p_partkey % 5 WHEN 0 THEN upper(p_name) "
                         "WHEN 1 THEN concat('[', p_name, '] ') "
                         "WHEN 2 THEN replace(p_name, ' ', '-') ELSE p_name END")
        order = (F.col("p_partkey") % 3).cast("int")
        return self.table("part").select(
            order.alias("cycle_order"),
            F.element_at(F.array(*[F.lit(c) for c in CODES]), order + 1).alias("survey_cycle"),
            F.col("p_brand").alias("field"), F.col("p_size").cast("string").alias("code"),
            spelled.alias("raw_label"), text.clean_label(spelled).alias("label"),
            F.col("p_partkey").alias("position"))

    @cached_property
    def part_conform(self) -> DataFrame:
        confirmed = config.literal_frame(
            self.spark, [("Brand#1", "red widget", "Widget (red)"), ("Brand#2", "SMALL RING", "Ring, small")],
            "field string, raw_label string, conformed_label string")
        return labels.label_conform(self.part_choices, confirmed)

    @cached_property
    def parsed_forms(self) -> DataFrame:
        """Printable forms made of parts: a hundred parts to a form, so forms stay small."""
        row = F.expr(
            "concat(CASE WHEN p_partkey % 10 = 0 THEN concat('<tr class=\"entryRow\"><td colspan=3> "
            "<b>Section ', p_partkey div 10, '</b></td></tr>') ELSE '' END, "
            "'<tr class=\"entryRow odd\"><td class=\"fieldCell\">field_', p_partkey, "
            "CASE WHEN p_partkey % 4 = 0 THEN ' <i>(required)</i>' ELSE '' END, '</td>', "
            "'<td class=\"questionCell\">', p_name, '<br>', p_type, ' &amp; more</td><td>', "
            "CASE WHEN p_partkey % 3 = 0 THEN '' ELSE concat('<table><tr><td>1</td><td>', p_size, "
            "'</td><td>', p_brand, '</td></tr><tr><td>2</td><td></td><td>skip</td></tr></table>') END, "
            "'</td></tr>')")
        documents = (self.table("part").withColumn("row", row)
                     .groupBy(F.expr("p_partkey div 100").alias("n"))
                     .agg(F.array_sort(F.collect_list(F.struct("p_partkey", "row"))).alias("rows"))
                     .select(F.concat(F.lit("form_"), "n").alias("form"),
                             F.concat(F.lit("<html><body><table>"), F.array_join("rows.row", "\n"),
                                      F.lit("</table></body></html>")).alias("html")))
        return forms.parse_forms(documents)

    @cached_property
    def bronze(self) -> DataFrame:
        own = self.export_columns
        # Every seventh row is exported twice, so that identical rows occur; they are doubled behind the hash, which reads
        # every column, so that only what a consumer asks for is doubled and each row is hashed once.
        twice = F.explode(F.when(F.col("_source_row") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        return self.exports.select(
            "survey_cycle", "_source_row", *[F.col(harmonize.quoted(c)) for c in own],
            derive.row_hash([F.col(harmonize.quoted(c)) for c in own]).alias("_row_hash")).withColumn(
            "_copy", twice).drop("_copy")

    @cached_property
    def checks(self) -> DataFrame:
        headers = catalog.collected_columns(self.answers, self.export_columns).select(
            "survey_cycle", F.col("variable").alias("header"), F.lit(0).alias("position"))
        repeated = (headers.where(F.col("header").like("%(Ugx)"))
                    .withColumn("header", F.concat("header", F.lit(".1"))))
        source = quality.source_checks(self.bronze, headers.unionByName(repeated))
        return source.unionByName(quality.model_checks(
            self.undecoded, self.kept, self.history, self.geography, self.time, self.households,
            self.lists))

    @cached_property
    def dq(self) -> DataFrame:
        return quality.dq_results(self.checks)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Results of floating-point sums and interpolation, to nine decimals."""
    return df.withColumns({c: F.round(c, 9) for c in columns})


def _parse_timestamps(s: Survey) -> DataFrame:
    out = None
    for cycle in config.CYCLES:
        parsed = casts.parse_timestamps(text.strip_whitespace(F.col("starttime")), cycle.formats)
        # The notation of another cycle must not be guessed.
        hit = F.when(F.col("survey_cycle") == cycle.code, parsed)
        out = hit if out is None else F.coalesce(out, hit)
    foreign = F.when(F.col("_source_row") % 10 == 0, F.lit("2020-06-30 10:00:00"))
    df = s.exports.select("survey_cycle", "_source_row", "starttime").withColumn(
        "starttime", F.coalesce(foreign, F.concat(F.lit(" "), "starttime")))
    return df.select(F.col("_source_row").alias("source_row"), out.alias("parsed"))


def _numbers(s: Survey) -> DataFrame:
    return s.table("orders").select("o_orderkey",
                                    text.strip_whitespace(F.expr(NUMBER_TEXT)).alias("t"))


def _normalize_ids(s: Survey) -> DataFrame:
    odd = F.expr("concat(household_id_raw, CASE WHEN source_row % 5 = 0 THEN concat(char(160), char(9)) "
                 "ELSE '' END)")
    return s.submissions.select("source_row", text.normalize_household_id(odd).alias("household_id"))


def _harmonize(s: Survey) -> DataFrame:
    off = ("cohort", "gps_lat", "gps_lon", "cluster")  # what the second cycle did not collect
    contracts = {c.code: [(n, d, None if n in off and c.code == "year1" else h[0]) for n, d, h in config.VARIABLE_SPEC]
                 for c in config.CYCLES}
    return harmonize.harmonize_together(s.exports, contracts, config.CYCLES,
                                        {"_source_row": "source_row"}).drop("household_id_raw")


def _title_case(s: Survey) -> DataFrame:
    return s.table("part").select(
        "p_partkey",
        text.title_case(F.expr("concat('  ', p_type, '  o''', p_name, '-', lower(p_brand), ' ')"))
        .alias("title"))


def _sql_functions(s: Survey) -> DataFrame:
    """Titles, place keys and answers' labels of all submissions, in SQL alone."""
    sql.register(s.spark)
    sql.register_choice_label(s.spark, s.lists.select("survey_cycle", "field", "code", "label"))
    labelled = ", ".join(
        f"coalesce(choice_label(survey_cycle, '{field}', CAST({code} AS STRING)), {repr(default) if default else 'NULL'}) "
        f"AS {name}" for field, code, name, default in config.DECODED_FIELDS)
    return s.spark.sql("SELECT source_row, title_case(district) AS district, geo_key(district, village) AS geo_key, "
                       f"{labelled} FROM {{subs}}", subs=s.submissions)


def _dedupe(s: Survey) -> DataFrame:
    return dedupe.dedupe_latest(s.submissions).select(
        "survey_cycle", "source_row", "household_id", "submission_key", "submitted_at",
        "is_completed", "is_consented", "household_submissions")


def _incremental_silver(s: Survey) -> DataFrame:
    """Silver after two arrivals: nine tenths of the rows, then the rest as late rows of every cycle."""
    path = shared_folder(s.spark)
    late = F.col("source_row") > F.lit((s.submissions.agg(F.max("source_row")).first()[0] or 0) * 9 // 10)
    silver_stream.upsert(s.submissions.where(~late), path)
    silver_stream.upsert(s.submissions.where(late), path)
    return silver_stream.read_silver(s.spark, path).select(
        "survey_cycle", "source_row", "is_completed", "is_consented", "household_submissions", "reject_reason")


QUERIES: dict[str, Callable[[Survey], DataFrame]] = {
    # casts and text
    "parse_timestamps": _parse_timestamps,
    "cast_numeric": lambda s: _numbers(s).select("o_orderkey", casts.to_double(F.col("t")).alias("number")),
    "cast_integral": lambda s: _numbers(s).select("o_orderkey", casts.to_integral(F.col("t")).alias("number")),
    "normalize_household_id": _normalize_ids,
    "harmonize_contract": _harmonize,
    "geo_key": lambda s: s.submissions.select(
        "source_row", derive.geo_key(F.col("district"), F.col("village")).alias("geo_key")),
    "title_case": _title_case,
    "sql_functions": _sql_functions,
    "status_labels": lambda s: s.submissions.select(
        "source_row", derive.status_label(F.col("interview_status")).alias("interview_status_label")),
    "demographic_bands": lambda s: s.submissions.select(
        "source_row", derive.hh_size_band(F.col("hh_size")).alias("hh_size_band"),
        derive.head_age_band(F.col("head_age")).alias("head_age_band")),
    "label_keys": lambda s: s.part_choices.select(
        "position", "label", text.match_key(F.col("label")).alias("label_key")),
    # silver
    "quarantine_reasons": lambda s: s.tagged.select(
        "survey_cycle", "source_row", "is_completed", "is_consented", "household_submissions",
        "reject_reason"),
    "incremental_silver": _incremental_silver,
    "duplicate_keys": lambda s: dedupe.duplicate_keys(s.submissions).select(
        "survey_cycle", "source_row", "submission_key"),
    "dedupe_latest": _dedupe,
    "household_submissions": lambda s: dedupe.household_groups(
        dedupe.accepted_rows(s.submissions)).select("survey_cycle", "household_id",
                                                     "household_submissions"),
    "all_submissions": lambda s: s.all,
    "row_reconciliation": lambda s: quality.row_reconciliation(s.submissions, s.tagged),
    "operations_reconciliation": lambda s: quality.operations_reconciliation(s.submissions, s.tagged, s.operations),
    "quarantine_summary": lambda s: dedupe.quarantine_summary(dedupe.split(s.tagged)[1]),
    "panel_overlap": lambda s: profiling.panel_overlap(
        s.submissions.select("survey_cycle", F.col("household_id_raw").alias("raw"),
                             F.col("household_id").alias("normalised")),
        ["raw", "normalised"], len(CODES)),
    "sample_values": lambda s: profiling.sample_by(s.submissions, ["household_id_raw", "district", "district_code"]),
    "profile_ids": lambda s: profiling.profile_ids(s.submissions, "household_id_raw"),
    "district_crosstab": lambda s: profiling.crosstab(
        s.submissions.withColumn("district", F.upper(F.trim("district"))),
        "district_code", "district"),
    # dimensions, decoding, fact
    "dim_survey_cycle": lambda s: dims.dim_survey_cycle(s.cycles, s.dated),
    "dim_time": lambda s: s.time,
    "geography_name_history": lambda s: s.history,
    "dim_geography": lambda s: s.geography,
    "dim_household": lambda s: s.households,
    "choice_conformed": lambda s: decode.choice_conformed(
        s.part_choices.select("survey_cycle", "field", "code", F.col("raw_label").alias("label")),
        s.part_conform),
    "choice_decode": lambda s: decode.decode(s.submissions, s.lists, config.DECODED_FIELDS).select(
        "source_row", *[out for _, _, out, _ in config.DECODED_FIELDS]),
    "fct_survey_submissions": lambda s: s.fact,
    # reports
    "rpt_field_operations": lambda s: s.operations,
    "rpt_field_operations_cycle": lambda s: _rounded(
        s.operations_cycle, "avg_interview_minutes", "median_interview_minutes"),
    "rpt_program_summary": lambda s: _rounded(s.summary, "median_hhip_usd_day"),
    "rpt_program_cycle": lambda s: reports.rpt_program_cycle(s.program_counts),
    "rpt_program_demographics": lambda s: s.demographics,
    "rpt_cohort_coverage": lambda s: s.coverage,
    "rpt_panel_poverty": lambda s: _rounded(s.panel, "median_hhip_usd_day"),
    "income_median": lambda s: _rounded(exact_median(
        s.submissions, ["survey_cycle", "interview_status"], "hh_income_usd_year",
        "median_income"), "median_income"),
    # reads of the reports
    "filtered_field_ops": lambda s: reads.filtered(
        s.operations, ["baseline", "year2"], ["Nation_1", "Nation_2", "Nation_20"], True),
    "daily_submissions": lambda s: reads.daily_submissions(s.operations),
    "ops_headline": lambda s: _rounded(reads.ops_headline(s.operations), "avg_interview_minutes"),
    "program_headline": lambda s: reads.program_headline(s.program_counts),
    "status_share": lambda s: reads.status_share(s.operations),
    "demographic_share": lambda s: reads.demographic_share(s.demographics),
    "dedup_stages": lambda s: reads.dedup_stages(s.operations_cycle),
    "rates_long": lambda s: reads.rates_long(s.operations_cycle),
    "rate_pivot": lambda s: reads.district_rates(s.program_counts),
    "rate_pivot_wide": lambda s: reads.rate_pivot(s.program_counts, adapter.PERIODS),
    "coverage_labels": lambda s: reads.coverage_with_labels(s.coverage),
    "households_by_cycles_seen": lambda s: reads.households_by_cycles_seen(s.coverage),
    "panel_size": lambda s: reads.panel_size(reports.panel_counts(s.undecoded, s.households, s.geography)),
    "district_choices": lambda s: reads.district_choices(s.geography),
    "recent_runs": lambda s: reads.recent_runs(
        s.table("events").select("event_id", "event_type", F.col("ts").alias("logged_at"))),
    # quality
    "dq_results": lambda s: s.dq.drop("checked_at"),
    "dq_counters": lambda s: reads.dq_counters(s.dq),
    "dq_unmatched": lambda s: quality.unmatched(s.undecoded, s.geography, "geo_key"),
    "cycle_counts": lambda s: quality.cycle_counts(s.operations_cycle),
    # catalog
    "column_profile": lambda s: s.profile,
    "classify_columns": lambda s: s.variables.select(
        "survey_cycle", "variable", "kind", "form_field", "section", "label"),
    "columns_by_kind": lambda s: catalog.columns_by_kind(
        catalog.classify_columns(s.profile, s.form_fields)),
    "variable_presence": lambda s: catalog.variable_presence(s.collected, CODES),
    "shared_columns": lambda s: profiling.shared_columns(
        catalog.variable_presence(s.collected, CODES), CODES),
    "schema_drift": lambda s: catalog.schema_drift(s.collected, CODES),
    "resolve_variables": lambda s: s.resolved,
    "silver_variable_catalog": lambda s: catalog.silver_variable_catalog(
        s.variable_map, s.variables, CODES),
    "label_conform_auto": lambda s: labels.automatic_conform(s.part_choices),
    "label_conform": lambda s: s.part_conform,
    "label_review": lambda s: labels.label_review(s.part_choices, s.part_conform, None, CODES),
    "labels_per_code": lambda s: labels.distinct_labels_per_code(
        s.part_choices.select("position", "field", "code", "label")),
    "form_fields": lambda s: s.parsed_forms.select(
        "form", "position", "field", "section", "label", F.size("choices").alias("n_choices")),
    "form_choices": lambda s: s.parsed_forms.select("form", "field", F.inline("choices")),
}


def build(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return QUERIES[name](Survey(spark, folder))

    run.__name__ = name
    return run
