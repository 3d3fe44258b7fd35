"""Export columns -> typed contract columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SPARK_TYPES, Cycle
from ..functions import derive
from ..functions.casts import cast_variable
from ..functions.text import normalize_household_id, strip_whitespace

LINEAGE = ("_source_row", "_row_hash", "_ingested_at")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def load_variable_map(spark: SparkSession, path: str) -> DataFrame:
    """The contract: canonical_name, dtype, one source header per cycle (blank = not collected), notes."""
    vm = spark.read.csv(path, header=True, escape='"', multiLine=True)
    return check_variable_map(vm)


def check_variable_map(vm: DataFrame) -> DataFrame:
    doubled = vm.groupBy("canonical_name").count().where("count > 1").collect()
    if doubled:
        raise ValueError(f"variable map repeats {[r.canonical_name for r in doubled]}")
    return vm


def contract_rows(vm: DataFrame, cycle: str) -> list[tuple[str, str, str | None]]:
    """(canonical name, dtype, source header) of one cycle: the contract is config, a few dozen rows."""
    return [(r["canonical_name"], r["dtype"], r[cycle] or None) for r in vm.collect()]


def harmonize_together(rows: DataFrame, contracts: Mapping[str, list[tuple[str, str, str | None]]],
                       cycles: Sequence[Cycle], lineage: Mapping[str, str]) -> DataFrame:
    """The rows of several cycles that lie in one relation, a branch for each cycle with its own headers and formats.

    A choice by cycle in every column would make one projection too large to compile; a branch reads only its cycle's
    rows and its mapped columns. ``contracts`` has each cycle's contract, all with the same names in the same order.
    """
    absent = {s for c in cycles for _, _, s in contracts[c.code] if s} - set(rows.columns)
    if absent:
        raise KeyError(f"mapped source columns not found: {sorted(absent)}")
    return reduce(DataFrame.unionByName, [
        harmonize(rows.where(F.col("survey_cycle") == c.code), contracts[c.code], c, lineage) for c in cycles])


def harmonize(bronze: DataFrame, contract: list[tuple[str, str, str | None]],
              cycle: Cycle, lineage: Mapping[str, str] | None = None) -> DataFrame:
    """Pick, strip, cast and rename; only mapped columns are read.

    ``lineage`` maps bronze lineage columns to output names.
    """
    lineage = lineage or {"_source_row": "source_row", "_row_hash": "row_hash",
                          "_ingested_at": "ingested_at"}
    available = set(bronze.columns)
    absent = {name: src for name, _, src in contract if src and src not in available}
    if absent:
        raise KeyError(f"{cycle.code}: mapped source columns not found: {absent}")

    # One step per select: each looks at the value before it more than once.
    stripped = bronze.select(
        *[F.col(quoted(c)).alias(out) for c, out in lineage.items()],
        *[strip_whitespace(F.col(quoted(src))).alias(name) for name, _, src in contract if src])
    parsed = stripped.select(
        *lineage.values(),
        *[cast_variable(F.col(name), name, dtype, cycle.formats).alias(name)
          for name, dtype, src in contract if src])
    typed = parsed.select(
        F.lit(cycle.code).alias("survey_cycle"), F.lit(cycle.order).alias("cycle_order"),
        *lineage.values(),
        *[(F.col(name) if src else F.lit(None).cast(SPARK_TYPES[dtype])).alias(name)
          for name, dtype, src in contract])
    return _derived(typed)


def _derived(typed: DataFrame) -> DataFrame:
    return typed.withColumns({
        "interview_minutes": derive.minutes_between(F.col("started_at"), F.col("ended_at")),
        "household_id_raw": F.col("household_id"),
        "household_id": normalize_household_id(F.col("household_id")),
        "household_id_confirm": normalize_household_id(F.col("household_id_confirm")),
    })
