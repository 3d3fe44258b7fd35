"""Choice lists: one spelling per concept, and codes to labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_label


def choice_conformed(choices: DataFrame, label_map: DataFrame) -> DataFrame:
    """``choices`` (survey_cycle, field, code, label) with the conformed label beside the raw one.

    The label map is unique per (field, raw label): Spark broadcasts a short one and splits a frequent
    label's rows where it shuffles.
    """
    cleaned = choices.withColumn("raw_clean", clean_label(F.col("label")))
    mapping = label_map.select("field", F.col("raw_label").alias("raw_clean"), "conformed_label")
    return (cleaned.join(mapping, ["field", "raw_clean"], "left")
            .select("survey_cycle", "field", "code", F.col("label").alias("raw_label"),
                    F.coalesce("conformed_label", "raw_clean").alias("label")))


def decode_table(conformed: DataFrame, cycles: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(survey_cycle, field, code, label): the lists each cycle decodes with, smallest label first.

    Entries without a code or a label decode nothing. ``cycles`` names for every cycle the one whose lists apply (``choices_from``).
    """
    lists = (conformed.where(F.col("field").isin(list(fields)) & F.col("label").isNotNull()
                             & F.col("code").isNotNull())
             .groupBy(F.col("survey_cycle").alias("choices_from"), "field", "code")
             .agg(F.min("label").alias("label")))
    return (cycles.select("survey_cycle", "choices_from").join(lists, "choices_from")
            .select("survey_cycle", "field", "code", "label"))


def decode(df: DataFrame, table: DataFrame, wanted: Sequence[tuple[str, str, str, str | None]]) -> DataFrame:
    """Add label columns to ``df``; ``wanted`` is (field, code column, label column, default).

    Each field is a left join on (cycle, code) with its part of the list, which has one label a code. Whether
    a list is broadcast, or a cycle's commonest answer split, is left to Spark.
    """
    known = table.where(F.col("code").isNotNull())
    for field, code, out, default in wanted:
        lookup = known.where(F.col("field") == field).select(
            F.col("survey_cycle").alias("_cycle"), F.col("code").alias("_code"), F.col("label").alias(f"_{out}"))
        same = (F.col("survey_cycle") == F.col("_cycle")) & (F.col(code).cast("string") == F.col("_code"))
        label = F.coalesce(f"_{out}", F.lit(default)) if default else F.col(f"_{out}")
        df = df.join(lookup, same, "left").withColumn(out, label).drop("_cycle", "_code", f"_{out}")
    return df
