"""Late rows into silver: they are added to the table, and only the parts that they touch are judged again.

Silver is stored by cycle and by a hash of the household: the rows in one table, and beside it, in parts of the same
name, a narrow one with the verdicts of those that pass rejection. Rows that arrive later come later in file order, so
they never take a submission key from an earlier row, and a household's verdicts depend on its own rows alone. So a batch
adds its rows, asks the stored keys of its cycles which of its own are used, judges the households of the parts it falls
into anew from the few columns that verdicts hang on, and replaces those parts' verdicts; every other file stays as it
is. Whole rows are shuffled, sorted and written once, however often their verdicts change. A reader joins the two. The
result is that of a full run over all rows.

A part's verdicts say up to which row it is judged. Rows beyond that, left by a call that failed, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import config
from ..operators import dedupe
from ..operators.dedupe import BEST, CYCLE, HOUSEHOLD, KEY, ROW
from ..operators.harmonize import harmonize
from ..session import small_methods
from ..sinks import path_exists
from . import bronze_stream

#: Parts of a cycle; a household has one. Rows without a household have their own part, -1.
PARTS = 64
PART = "household_part"
#: What is stored of a verdict, besides its part. A row without counts says up to which source row a part is judged.
VERDICT_FIELDS = (
    T.StructField(CYCLE, T.StringType()), T.StructField(ROW, T.LongType()),
    T.StructField("is_completed", T.BooleanType()), T.StructField("is_consented", T.BooleanType()),
    T.StructField("household_submissions", T.LongType()), T.StructField(BEST, T.BooleanType()))


def with_part(df: DataFrame, parts: int = PARTS) -> DataFrame:
    return df.withColumn(PART, F.when(F.col(HOUSEHOLD).isNull(), -1).otherwise(
        F.pmod(F.xxhash64(HOUSEHOLD), F.lit(parts))).cast("int"))


def verdicts_path(path: str) -> str:
    """Where the verdicts on the rows of ``path`` are stored."""
    return path.rstrip("/") + "_verdicts"


def _write(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    # A part is a file or two; one that a household without end makes heavy is split again by the adaptive plan.
    with small_methods(df.sparkSession):
        (df.hint("rebalance", CYCLE, PART).write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .partitionBy(CYCLE, PART).parquet(path))


def _within(parts: Sequence[tuple[str, int]]) -> Column:
    """The stored parts of a list, as a condition on the partition columns that prunes folders."""
    by_cycle: dict[str, list[int]] = {}
    for cycle, part in parts:
        by_cycle.setdefault(cycle, []).append(part)
    return reduce(lambda a, b: a | b, [(F.col(CYCLE) == c) & F.col(PART).isin(found) for c, found in by_cycle.items()],
                  F.lit(False))


def _stored_verdicts(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([*VERDICT_FIELDS, T.StructField(PART, T.IntegerType())])
    return spark.read.schema(schema).parquet(verdicts_path(path))


def _verdicts(spark: SparkSession, path: str) -> DataFrame:
    """The verdicts on rows, without what is said of parts."""
    return _stored_verdicts(spark, path).where(F.col("household_submissions").isNotNull()).drop(PART)


def _stored_rows(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """All stored rows, and whether each is ``_judged``."""
    # At most one entry a part.
    limits = F.broadcast(_stored_verdicts(spark, path).where(F.col("household_submissions").isNull())
                         .select(CYCLE, PART, F.struct(F.col(ROW).alias("row")).alias("_limit")))
    judged = F.col("_limit").isNotNull() & (F.col(ROW).isNull() | F.coalesce(F.col(ROW) <= F.col("_limit.row"), F.lit(False)))
    return (spark.read.schema(schema).parquet(path).join(limits, [CYCLE, PART], "left")
            .withColumn("_judged", judged).drop("_limit"))


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """All judged rows with their verdicts; a cycle's name is text, whatever it looks like."""
    fields = spark.read.parquet(path).schema.fields
    named = T.StructType([T.StructField(f.name, T.StringType()) if f.name == CYCLE else f for f in fields])
    rows = _stored_rows(spark, named, path).where("_judged").drop(PART, "_judged")
    return dedupe.with_verdicts(rows, _verdicts(spark, path))


def upsert(rows: DataFrame, path: str, parts: int = PARTS) -> list[tuple[str, int]]:
    """Take typed rows that come after all stored ones of their cycles; returns the (cycle, part)s written.

    Rows that an earlier, failed call already stored are replaced, so a batch may be repeated. The list of parts has
    at most ``parts`` + 1 entries a cycle of the batch.
    """
    spark = rows.sparkSession
    rows = with_part(rows, parts)
    touched = [tuple(r) for r in rows.groupBy(CYCLE, PART).agg(F.min(ROW), F.max(ROW)).collect()]
    if not touched:
        return []
    own = [(cycle, part) for cycle, part, _, _ in touched]
    firsts = {cycle: min(f for c, _, f, _ in touched if c == cycle) for cycle, _ in own}

    def of_cycles(test: Callable[[int], Column]) -> Column:
        return reduce(lambda a, b: a | b, [(F.col(CYCLE) == c) & test(f) for c, f in firsts.items()])

    earlier = of_cycles(lambda f: F.col(ROW) < f)
    follows = path_exists(spark, verdicts_path(path))
    if follows:
        stays = F.col("_judged") & F.coalesce(earlier, F.lit(False))
        here = _stored_rows(spark, rows.schema, path).where(_within(own))
        if here.where(~stays).limit(1).count():
            _write(here.where(stays).drop("_judged").unionByName(rows), path)
        else:
            _write(rows, path, "append")
    else:
        if path_exists(spark, path) and spark.read.schema(rows.schema).parquet(path).where(earlier).limit(1).count():
            raise ValueError(f"{path} holds earlier rows without verdicts")
        _write(rows, path)

    arrived = of_cycles(lambda f: F.col(ROW).isNull() | (F.col(ROW) >= f))
    accepted = dedupe.accepted_rows(spark.read.schema(rows.schema).parquet(path).where(_within(own) & arrived))
    if follows:
        before = _stored_rows(spark, rows.schema, path).where(F.col("_judged") & earlier).where(F.col(KEY).isNotNull())
        # Accepted once, accepted for good: of the stored rows the first use of every key is known.
        passed = _verdicts(spark, path).where(F.col(BEST).isNotNull()).select(CYCLE, ROW)
        standing = dedupe.with_outcome_flags(
            before.where(_within(own) & F.col(HOUSEHOLD).isNotNull()).join(passed, [CYCLE, ROW]))
        accepted = standing.select(*accepted.columns).unionByName(
            accepted.join(before.select(CYCLE, KEY), [CYCLE, KEY], "left_anti"))
    limits = config.literal_frame(spark, [(c, p, last) for c, p, _, last in touched], f"{CYCLE} string, {PART} int, {ROW} long")
    found = with_part(dedupe.verdicts(accepted), parts).drop(HOUSEHOLD)
    _write(found.unionByName(limits, allowMissingColumns=True), verdicts_path(path))
    return own


def stream_to_silver(spark: SparkSession, folder: str, headers: Sequence[str], cycle: config.Cycle,
                     contract: list[tuple[str, str, str | None]], bronze: str, silver: str, checkpoint: str,
                     multiline: bool = True, parts: int = PARTS) -> StreamingQuery:
    """Take the new export files of a cycle into bronze and their rows into silver, and stop."""
    def settle(landed: DataFrame) -> None:
        upsert(harmonize(landed, contract, cycle), silver, parts)

    return bronze_stream.ingest_new_files(spark, folder, headers, cycle.code, bronze, checkpoint, multiline, settle)
