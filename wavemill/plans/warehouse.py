"""The batch run: exports and forms in, a lake of tables out.

Every stage writes its tables and the next reads them back, so lineage stays
short, consumers read only their columns, and a rerun skips exports whose
content is known.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .. import config, sinks
from ..operators import catalog, dedupe, harmonize
from ..sources import exports, footers, forms, landing
from . import dims, facts, quality, reports


@dataclass
class Lake:
    """Paths below one root, and the cycles kept there."""

    spark: SparkSession
    root: str
    cycles: Sequence[config.Cycle] = config.CYCLES
    #: Rows of checks that this run's writes have counted, by the table written.
    counted: dict[str, DataFrame] = field(default_factory=dict)
    #: Buckets by household of silver, fact and households, the same for all; from the rows of silver where not given.
    buckets: int | None = None

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def table(self, layer: str, name: str) -> DataFrame:
        return sinks.read_table(self.spark, self.path(layer, name))

    def write_by_household(self, df: DataFrame, layer: str, name: str, order: Sequence[str],
                           partition_by: Sequence[str] = ()) -> DataFrame:
        return sinks.write_buckets(df, self.path(layer, name), dedupe.HOUSEHOLD, order, self.buckets, partition_by)

    def write(self, df: DataFrame, layer: str, name: str) -> DataFrame:
        return sinks.write_table(df, self.path(layer, name))

    @property
    def manifest(self) -> str:
        return self.path("raw", "manifest")

    def version(self, kind: str) -> dict[str, tuple[str, str]]:
        """Per cycle the current (sha256, path) of its export or form."""
        rows = landing.latest_versions(landing.read_manifest(self.spark, self.manifest)).where(
            F.col("kind") == kind).collect()
        return {r.survey_cycle: (r.sha256, r.path) for r in rows}


def land_sources(lake: Lake, folder: str) -> DataFrame:
    """Record the current version of every export and form."""
    rows = [(c.code, kind, f"{folder}/{name}") for c in lake.cycles
            for kind, name in (("data", c.export), ("form", c.form))]
    sources = config.literal_frame(lake.spark, rows, "survey_cycle string, kind string, path string")
    return landing.land(lake.spark, sources, lake.manifest)


def build_bronze(lake: Lake, multiline: bool = True) -> dict[str, str]:
    """One dataset per cycle and version, written once. Returns the current path per cycle."""
    current = lake.version("data")
    out = {}
    for cycle in lake.cycles:
        sha, path = current[cycle.code]
        target = exports.bronze_path(lake.root, cycle.code, sha)
        if not sinks.is_committed(lake.spark, target):
            rows = exports.read_export(lake.spark, path, multiline)
            sinks.write_once(exports.with_lineage(rows, cycle.code, sha), target)
        out[cycle.code] = target
    return out


def build_catalog(lake: Lake, bronze: dict[str, str], vm: DataFrame) -> None:
    """Form fields, choice lists, variables and the silver variable catalog."""
    spark, codes = lake.spark, [c.code for c in lake.cycles]
    current = {cycle: path for cycle, (_, path) in lake.version("form").items()}
    parsed = lake.write(forms.read_cycle_forms(spark, current), "meta", "parsed_form")
    fields = lake.write(forms.form_fields(parsed), "meta", "meta_form_field")
    lake.write(forms.choice_list(parsed), "meta", "meta_choice_list")
    profiles = []
    for code in codes:
        df = spark.read.parquet(bronze[code])
        own = [c for c in df.columns if not c.startswith("_")]
        profiles.append(catalog.column_profile(
            df.withColumnRenamed("_survey_cycle", "survey_cycle"), own))
    variables = lake.write(
        catalog.meta_variable(reduce(DataFrame.unionByName, profiles), fields, codes),
        "meta", "meta_variable")
    lake.write(catalog.silver_variable_catalog(vm, variables, codes), "meta",
               "meta_silver_variable")


def build_silver(lake: Lake, bronze: dict[str, str], vm: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed rows of all cycles, deduplicated in one job; kept and quarantined rows."""
    typed = []
    for cycle in lake.cycles:
        contract = harmonize.contract_rows(vm, cycle.code)
        typed.append(harmonize.harmonize(lake.spark.read.parquet(bronze[cycle.code]), contract, cycle))
    rows = lake.write(reduce(DataFrame.unionByName, typed), "silver", "typed")
    lake.buckets = lake.buckets or sinks.bucket_number(rows.count())
    # Both halves in one write; as partitions they are read apart without a scan of the other.
    tagged = dedupe.tag_submissions(rows).withColumn(
        "kept", F.when(F.col("reject_reason").isNull(), 1).otherwise(0))
    rules = quality.silver_rules(F.col("kept") == 1)
    tagged, seen = quality.observed(sinks.in_buckets(tagged, dedupe.HOUSEHOLD, lake.buckets), rules)
    stored = lake.write_by_household(tagged, "silver", "submission", [dedupe.HOUSEHOLD], ["kept"])
    lake.counted["submission"] = quality.from_observation(lake.spark, rules, seen)
    kept = stored.where("kept = 1").drop("kept", "reject_reason")
    dedupe.check_kept(kept)
    return kept, stored.where("kept = 0").drop("kept")


def build_gold(lake: Lake, kept: DataFrame, quarantine: DataFrame, label_map: DataFrame,
               regions: DataFrame) -> dict[str, DataFrame]:
    """Star schema and report tables."""
    cycles = config.cycles_frame(lake.spark, tuple(lake.cycles))
    submissions = dedupe.all_submissions(kept, quarantine)
    gold: dict[str, DataFrame] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        gold[name] = lake.write(df, "gold", name)
        return gold[name]

    lists = put("meta_choice_decode", facts.conformed_lists(
        lake.table("meta", "meta_choice_list"), label_map, cycles))
    put("dim_survey_cycle", dims.dim_survey_cycle(cycles, submissions))
    days = put("dim_time", dims.dim_time(submissions))
    put("dim_geography_name_history", dims.geography_name_history(kept))
    places = put("dim_geography", dims.dim_geography(kept, regions))
    # By household like silver: where these are joined or grouped by household nothing is shuffled. Kept rows have one
    # household a cycle, so no bucket is heavy; in a bucket the fact lies by cycle, which reads of a cycle skip by.
    lake.buckets = lake.buckets or sinks.bucket_number(kept.count())
    households = gold["dim_household"] = lake.write_by_household(
        dims.dim_household(kept, len(lake.cycles)), "gold", "dim_household", [dedupe.HOUSEHOLD])
    laid, seen = quality.observed(sinks.in_buckets(
        facts.fct_survey_submissions(kept, lists), dedupe.HOUSEHOLD, lake.buckets), quality.fact_rules())
    fact = gold["fct_survey_submissions"] = lake.write_by_household(
        laid, "gold", "fct_survey_submissions", ["cycle_order", dedupe.HOUSEHOLD])
    lake.counted["fct_survey_submissions"] = quality.from_observation(lake.spark, quality.fact_rules(), seen)
    operations = put("rpt_field_operations", reports.rpt_field_operations(submissions))
    put("rpt_field_operations_cycle", reports.rpt_field_operations_cycle(
        operations, kept, submissions, lake.table("meta", "meta_silver_variable")))
    summary = put("rpt_program_summary", reports.rpt_program_summary(fact, places, days))
    put("rpt_program_cycle", reports.rpt_program_cycle(summary))
    put("rpt_program_demographics", reports.rpt_program_demographics(fact, places))
    put("rpt_cohort_coverage", reports.rpt_cohort_coverage(households))
    put("rpt_panel_poverty", reports.rpt_panel_poverty(fact, households, places))
    # What SQL users ask by name besides the tables.
    sinks.register_view(submissions, "stg_all_submissions")
    sinks.register_view(gold["rpt_field_operations_cycle"], "rpt_field_operations_cycle")
    sinks.register_view(gold["rpt_program_cycle"], "rpt_program_cycle")
    return gold


def run_quality(lake: Lake, bronze: dict[str, str], kept: DataFrame, quarantine: DataFrame,
                gold: dict[str, DataFrame]) -> DataFrame:
    """All checks and the quality tables; raises afterwards when an error check failed."""
    codes = [c.code for c in lake.cycles]
    headers, parts = {}, []
    for code in codes:
        df = lake.spark.read.parquet(bronze[code])
        headers[code] = df.columns
        parts.append(df.select(F.lit(code).alias("survey_cycle"), "_source_row",
                               *quality.SOURCE_COLUMNS))
    checks = quality.source_checks(reduce(DataFrame.unionByName, parts),
                                   exports.headers_frame(lake.spark, headers), lake.cycles)
    checks = checks.unionByName(quality.model_checks(
        gold["fct_survey_submissions"], kept, gold["dim_geography_name_history"],
        gold["dim_geography"], gold["dim_time"], gold["dim_household"],
        gold["meta_choice_decode"], lake.counted.get("fct_survey_submissions"), lake.counted.get("submission")))
    results = lake.write(quality.dq_results(checks), "gold", "dq_results")
    variables = lake.table("meta", "meta_variable")
    lake.write(catalog.schema_drift(variables, codes), "gold", "dq_schema_drift")
    lake.write(catalog.columns_by_kind(variables), "gold", "dq_columns_by_kind")
    lake.write(dedupe.quarantine_summary(quarantine), "gold", "dq_quarantine")
    lake.write(quality.cycle_counts(gold["rpt_field_operations_cycle"]), "gold", "dq_cycle_counts")
    quality.gate(results)
    return results


REQUIRED = ("fct_survey_submissions", "dim_geography", "dim_time", "dim_survey_cycle",
            "dim_household", "rpt_field_operations", "rpt_program_summary")


def missing_tables(gold: dict[str, DataFrame]) -> set[str]:
    return set(REQUIRED) - gold.keys()


def row_counts(gold: dict[str, DataFrame]) -> dict[str, int]:
    """Rows per required table."""
    return {name: gold[name].count() for name in REQUIRED}


def stored_counts(lake: Lake, names: Sequence[str] = REQUIRED, layer: str = "gold") -> DataFrame:
    """(``table_name``, ``n_rows``) of stored tables, from their footers alone."""
    return footers.stored_counts(footers.footer_session(lake.spark), {n: lake.path(layer, n) for n in names})


def fact_days(lake: Lake) -> Row:
    """The fact's ``n_rows``, and its first and last day as ``min_date_key`` and ``max_date_key``, from footers."""
    return footers.stats_row(footers.footer_session(lake.spark), lake.path("gold", "fct_survey_submissions"),
                             ["date_key"])


def submission_halves(lake: Lake) -> DataFrame:
    """(``kept``, ``n_rows``): rows kept (1) and quarantined (0), from the footers of silver's two folders."""
    return footers.footer_stats(footers.footer_session(lake.spark), lake.path("silver", "submission"), by=["kept"])


def build_all(lake: Lake, folder: str, vm: DataFrame, label_map: DataFrame,
              regions: DataFrame, multiline: bool = True) -> DataFrame:
    """Run every stage once; the history of runs is appended whatever happens."""
    run, history = uuid.uuid4().hex[:12], []

    def stage(name, work):
        start, status, output = time.time(), "success", ""
        try:
            return work()
        except Exception as error:
            status, output = "failed", repr(error)
            raise
        finally:
            history.append((run, name, status, 1, round(time.time() - start, 2), output))

    try:
        stage("raw", lambda: land_sources(lake, folder))
        bronze = stage("bronze", lambda: build_bronze(lake, multiline))
        stage("catalog", lambda: build_catalog(lake, bronze, vm))
        kept, quarantine = stage("silver", lambda: build_silver(lake, bronze, vm))
        gold = stage("warehouse", lambda: build_gold(lake, kept, quarantine, label_map, regions))
        return stage("quality", lambda: run_quality(lake, bronze, kept, quarantine, gold))
    finally:
        sinks.append_runs(lake.spark, history, lake.path("gold", "ops_pipeline_runs"))
