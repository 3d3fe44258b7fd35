"""Conforming answer labels that differ between cycles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_label, match_key


def load_choices(forms: DataFrame, cycles: DataFrame) -> DataFrame:
    """(cycle_order, survey_cycle, field, code, label, position) from parsed forms, labels cleaned."""
    return (forms.select("survey_cycle", "field", F.col("position").alias("_p"),
                         F.posexplode("choices").alias("_i", "_c"))
            .join(F.broadcast(cycles.select("survey_cycle", "cycle_order")), "survey_cycle")
            .select("cycle_order", "survey_cycle", "field", F.col("_c.code").alias("code"),
                    clean_label(F.col("_c.label")).alias("label"),
                    (F.col("_p") * 1_000_000 + F.col("_i")).alias("position")))


def automatic_conform(choices: DataFrame) -> DataFrame:
    """(field, raw_label, conformed_label) for labels equal up to case and punctuation.

    ``choices``: cycle_order, field, label, position. The spelling seen last
    (latest cycle, then latest position) wins. Equal labels are merged before
    anything else, so a popular label costs one row per partition.
    """
    spellings = (choices.where(F.col("label").isNotNull())
                 .groupBy("field", "label")
                 .agg(F.max(F.struct("cycle_order", "position")).alias("seen"))
                 .withColumn("key", match_key(F.col("label"))))
    latest = (spellings.groupBy("field", "key")
              .agg(F.max_by("label", "seen").alias("conformed_label")))
    return (spellings.join(latest, ["field", "key"])
            .where(F.col("label") != F.col("conformed_label"))
            .select("field", F.col("label").alias("raw_label"), "conformed_label"))


def label_conform(choices: DataFrame, confirmed: DataFrame) -> DataFrame:
    """Automatic rows plus rewordings a person confirmed; the confirmed ones win."""
    both = (confirmed.withColumn("priority", F.lit(0))
            .unionByName(automatic_conform(choices).withColumn("priority", F.lit(1))))
    return (both.groupBy("field", "raw_label")
            .agg(F.min_by("conformed_label", "priority").alias("conformed_label")))


def label_review(choices: DataFrame, conform: DataFrame, fields: Sequence[str] | None,
                 cycles: Sequence[str]) -> DataFrame:
    """Codes whose final label still differs, one column per cycle.

    ``fields`` limits the report to the fields that are decoded downstream.
    The first label of a cycle is its lowest position.
    """
    if fields is not None:
        choices = choices.where(F.col("field").isin(list(fields)))
    # Equal answers are merged first, so a popular label is one row a code.
    choices = choices.groupBy("survey_cycle", "field", "code", "label").agg(F.min("position").alias("position"))
    final = (choices.join(conform.select("field", F.col("raw_label").alias("label"),
                                         "conformed_label"), ["field", "label"], "left")
             .withColumn("final", F.coalesce("conformed_label", "label")))
    per_cycle = [F.min_by(F.when(F.col("survey_cycle") == c, F.col("final")),
                          F.when(F.col("survey_cycle") == c, F.col("position"))).alias(c)
                 for c in cycles]
    return (final.groupBy("field", "code")
            .agg(F.count_distinct("final").alias("_n"), *per_cycle)
            .where("_n > 1").drop("_n"))


def distinct_labels_per_code(choices: DataFrame) -> DataFrame:
    """Every choice row with the number of different labels its (field, code) has."""
    counts = choices.groupBy("field", "code").agg(F.count_distinct("label").alias("n_labels"))
    return choices.join(counts, ["field", "code"])
