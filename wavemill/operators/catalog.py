"""Variable catalog: what every export column is, holds and feeds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.text import column_base, match_key
from .harmonize import quoted


#: Columns whose values one aggregate counts; wider exports are read in several, each with its own columns only.
COLUMNS_A_PASS = 500


def _value_counts(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """(cycle, variable, rows, filled) of every (cycle, column), ``filled`` without NULLs.

    One count a column is aggregated where the rows lie and only a row a cycle is unpivoted, so no row is multiplied
    by the number of its columns.
    """
    found = []
    for at in range(0, len(columns), COLUMNS_A_PASS):
        some = columns[at:at + COLUMNS_A_PASS]
        wide = df.groupBy(by).agg(F.count("*").alias("rows"),
                                  *[F.count(F.col(quoted(c))).alias(f"c{i}") for i, c in enumerate(some)])
        # Never empty; naming it keeps the aggregate the same for every consumer, so that one pass serves them all.
        wide = wide.where(F.col("rows") > 0)
        each = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"c{i}").alias("filled")) for i, c in enumerate(some)])
        found.append(wide.select(by, "rows", F.inline(each)).select(by, "variable", "rows", "filled"))
    return reduce(DataFrame.unionByName, found)


def column_profile(df: DataFrame, columns: Sequence[str], by: str = "survey_cycle",
                   digits: int = 4) -> DataFrame:
    """null_rate, n_distinct and all_null of every (cycle, column).

    NULLs are counted by one wide aggregate. Distinct values are counted from wide to long, as a distinct count per
    column in one ``agg`` would hold all of them in one plan node: they are deduplicated by (cycle, column, value)
    before any column's values meet, so neither a wide nor a constant column weighs on one task. Columns go by their
    position there, which is shorter than their names. The join is a left one on what the right side is grouped by:
    a consumer that shows no ``n_distinct`` does not pay for it.
    """
    values = F.array(*[F.col(quoted(c)).cast("string") for c in columns])
    long = df.select(F.col(by), F.posexplode(values).alias("_at", "_value")).where(F.col("_value").isNotNull())
    # A struct, so that rows without a cycle meet their counts too.
    distinct = (long.distinct()
                .groupBy(F.struct(by).alias("_by"), F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("_at") + 1)
                         .alias("_variable"))
                .agg(F.count("*").alias("n_distinct")))
    nulls = F.col("rows") - F.col("filled")
    return (_value_counts(df, columns, by)
            .join(distinct, (F.struct(by) == F.col("_by")) & (F.col("variable") == F.col("_variable")), "left")
            .select(by, "variable", F.round(nulls / F.col("rows"), digits).alias("null_rate"),
                    F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"), (F.col("filled") == 0).alias("all_null")))


def collected_columns(df: DataFrame, columns: Sequence[str], by: str = "survey_cycle") -> DataFrame:
    """(cycle, variable) of every column that holds any value in the cycle."""
    return _value_counts(df, columns, by).where(F.col("filled") > 0).select(by, "variable")


def _is_system(c: Column) -> Column:
    return c.isin(*config.SYSTEM_COLUMNS)


def classify_columns(columns: DataFrame, form_fields: DataFrame) -> DataFrame:
    """Kind of every (survey_cycle, variable), first rule wins, with the form field behind it.

    ``form_fields``: survey_cycle, field, section, label, n_choices. Column
    and field names are metadata, a few thousand rows per cycle.
    """
    own = form_fields.select(
        "survey_cycle", F.col("field").alias("variable"), F.col("section").alias("_s1"),
        F.col("label").alias("_l1"), F.col("n_choices").alias("_n1"))
    base = form_fields.select(
        "survey_cycle", F.col("field").alias("_base"), F.col("section").alias("_s2"),
        F.col("label").alias("_l2"), F.col("n_choices").alias("_n2"))
    v = F.col("variable")
    df = (columns.withColumn("_base", column_base(v, config.NUMBERED_COLUMN_PATTERN))
          .join(own, ["survey_cycle", "variable"], "left")
          .join(base, ["survey_cycle", "_base"], "left"))
    kind = (F.when(_is_system(v), "system")
             .when(F.col("_n1") > 0, "select_question")
             .when(F.col("_n1") == 0, "question")
             .when(F.col("_n2") > 0, "select_multiple_option")
             .when(F.col("_n2") == 0, "repeat_instance")
             .when(v.rlike(config.DERIVED_METRIC_PATTERN), "derived_metric")
             .otherwise("unclassified"))
    by_base = F.col("kind").isin("select_multiple_option", "repeat_instance")
    return (df.withColumn("kind", kind)
            .withColumns({
                "form_field": F.when(by_base, F.col("_base"))
                               .otherwise(F.when(F.col("_n1").isNotNull(), v)),
                "section": F.when(by_base, F.col("_s2")).otherwise(F.col("_s1")),
                "label": F.when(by_base, F.col("_l2")).otherwise(F.col("_l1"))})
            .drop("_base", "_s1", "_l1", "_n1", "_s2", "_l2", "_n2"))


def variable_presence(variables: DataFrame, cycles: Sequence[str]) -> DataFrame:
    """``in_<cycle>`` flags per variable."""
    return variables.groupBy("variable").agg(*[
        F.bool_or(F.col("survey_cycle") == c).alias(f"in_{c}") for c in cycles])


def meta_variable(profile: DataFrame, form_fields: DataFrame, cycles: Sequence[str]) -> DataFrame:
    """Profile, kind and presence of every exported column; lineage columns are left out."""
    # Flags over a variable's own rows, one a cycle: joined to itself, the profile would be read twice.
    same = Window.partitionBy("variable")
    exported = profile.where(~F.col("variable").startswith("_")).withColumns({
        f"in_{c}": F.bool_or(F.col("survey_cycle") == c).over(same) for c in cycles})
    return (classify_columns(exported, form_fields)
            .select("survey_cycle", "variable", "kind", "form_field", "section", "label",
                    "null_rate", "n_distinct", "all_null", *[f"in_{c}" for c in cycles]))


def columns_by_kind(variables: DataFrame) -> DataFrame:
    return (variables.groupBy("survey_cycle", "kind")
            .agg(F.count("*").alias("columns"),
                 F.sum(F.col("all_null").cast("bigint")).alias("all_null")))


def variable_map_long(vm: DataFrame, cycles: Sequence[str]) -> DataFrame:
    """One row per canonical variable and cycle."""
    return (vm.unpivot(["canonical_name", "dtype", "notes"], list(cycles),
                       "survey_cycle", "source_column")
            .withColumn("source_column", F.nullif("source_column", F.lit(""))))


def silver_variable_catalog(vm: DataFrame, variables: DataFrame,
                            cycles: Sequence[str]) -> DataFrame:
    """Which source column feeds each silver variable in each cycle, and what it means."""
    described = variables.select(
        "survey_cycle", F.col("variable").alias("source_column"), "kind", "section", "label",
        "null_rate")
    return (variable_map_long(vm, cycles)
            .join(described, ["survey_cycle", "source_column"], "left")
            .select("canonical_name", "dtype", "notes", "survey_cycle", "source_column", "kind",
                    "section", "label", "null_rate",
                    F.col("source_column").isNotNull().alias("available")))


def schema_drift(variables: DataFrame, cycles: Sequence[str]) -> DataFrame:
    """Columns added, removed and kept from each cycle to the next."""
    presence = variable_presence(variables, cycles)
    pairs = list(zip(cycles, cycles[1:]))
    counts = []
    for i, (a, b) in enumerate(pairs):
        before, after = F.col(f"in_{a}"), F.col(f"in_{b}")
        counts += [F.count_if(~before & after).alias(f"a{i}"),
                   F.count_if(before & ~after).alias(f"r{i}"),
                   F.count_if(before & after).alias(f"k{i}")]
    steps = F.array(*[
        F.struct(F.lit(a).alias("from_cycle"), F.lit(b).alias("to_cycle"),
                 F.col(f"a{i}").alias("added"), F.col(f"r{i}").alias("removed"),
                 F.col(f"k{i}").alias("kept"))
        for i, (a, b) in enumerate(pairs)])
    return presence.agg(*counts).select(F.inline(steps))


def resolve_variables(spec: DataFrame, headers: DataFrame, cycles: Sequence[str]) -> DataFrame:
    """Best header per canonical variable and cycle: (canonical_name, survey_cycle, source, match).

    ``spec``: canonical_name, candidates (in order of preference).
    ``headers``: survey_cycle, header, position. An exact hit on any candidate
    beats a hit that ignores case and punctuation; among those the earlier
    candidate, then the earlier header.
    """
    wanted = spec.select("canonical_name", F.posexplode("candidates").alias("candidate_pos",
                                                                           "candidate"))
    wanted = wanted.withColumn("_key", match_key(F.col("candidate")))
    seen = headers.withColumn("_key", match_key(F.col("header")))
    hits = (wanted.join(seen, "_key")
            .withColumn("fuzzy", F.col("candidate") != F.col("header"))
            .groupBy("canonical_name", "survey_cycle")
            .agg(F.min(F.struct("fuzzy", "candidate_pos", "position", "header")).alias("hit")))
    grid = spec.select("canonical_name",
                       F.explode(F.array(*[F.lit(c) for c in cycles])).alias("survey_cycle"))
    return (grid.join(hits, ["canonical_name", "survey_cycle"], "left")
            .select("canonical_name", "survey_cycle",
                    F.coalesce("hit.header", F.lit("")).alias("source"),
                    F.when(F.col("hit").isNull(), "missing").when(F.col("hit.fuzzy"), "fuzzy")
                     .otherwise("exact").alias("match")))


def draft_variable_map(spec: DataFrame, resolved: DataFrame, cycles: Sequence[str]) -> DataFrame:
    """The resolved sources as a variable map, one column per cycle."""
    wide = (resolved.groupBy("canonical_name").pivot("survey_cycle", list(cycles))
            .agg(F.first("source")))
    return (spec.select("canonical_name", "dtype", "notes").join(wide, "canonical_name")
            .select("canonical_name", "dtype", *cycles, "notes"))
