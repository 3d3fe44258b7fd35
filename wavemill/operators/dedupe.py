"""Latest submission per household and cycle; everything else gets a reason.

Nothing here gathers a whole household, key or cycle in one task. Winners are
found by aggregates that combine map-side, and rows learn their verdict by a
join on (cycle, source row), which is unique, so a household or a repeated key
with a third of all rows does not make a heavy partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import derive
from .skew import HOT_ROWS, sized_lookup

CYCLE, ROW, KEY, HOUSEHOLD = "survey_cycle", "source_row", "submission_key", "household_id"
#: Of a verdict: whether its row is its household's best.
BEST = "_best"

EMPTY_ROW = "empty_row"
MISSING_HOUSEHOLD = "missing_household_id"
DUPLICATE_KEY = "duplicate_submission_key"
SUPERSEDED = "superseded_duplicate"
REJECTED = (MISSING_HOUSEHOLD, DUPLICATE_KEY)


def with_outcome_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "is_completed": derive.is_completed(F.col("interview_status")),
        "is_consented": derive.is_consented(F.col("interview_status"), F.col("consent")),
    })


def _preference() -> Column:
    """Smallest is best: latest, then consented, completed, lowest key; no time comes last."""
    at = F.col("submitted_at")
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                              at.cast("timestamp_ntz"))
    return F.struct(at.isNull().alias("undated"), (-micros).alias("age"),
                    (~F.col("is_consented")).alias("unconsented"),
                    (~F.col("is_completed")).alias("uncompleted"),
                    F.col(KEY).alias("key"), F.col(ROW).alias("row"))


def first_per_key(df: DataFrame) -> DataFrame:
    """The first row in file order of every (cycle, submission key), narrow columns only."""
    carried = [ROW, HOUSEHOLD, "submitted_at", "interview_status", "consent"]
    return (df.where(F.col(KEY).isNotNull())
            .groupBy(CYCLE, KEY)
            .agg(F.min_by(F.struct(*carried), F.col(ROW)).alias("f"))
            .select(CYCLE, KEY, *[F.col(f"f.{c}") for c in carried]))


def accepted_rows(df: DataFrame) -> DataFrame:
    """Rows that pass rejection: key and household present, first use of the key."""
    return with_outcome_flags(first_per_key(df).where(F.col(HOUSEHOLD).isNotNull()))


def household_groups(accepted: DataFrame) -> DataFrame:
    """One row per (cycle, household): its best row and how often it was submitted."""
    return (accepted.groupBy(CYCLE, HOUSEHOLD)
            .agg(F.min(_preference()).alias("best"), F.count("*").alias("household_submissions"))
            .select(CYCLE, HOUSEHOLD, F.col("best.row").alias("best_row"), "household_submissions")
            # Never NULL; naming it keeps the aggregate the same for every consumer, so that one
            # shuffle serves them all.
            .where(F.col("best_row").isNotNull()))


def winners(df: DataFrame) -> DataFrame:
    """(cycle, source row, household_submissions) of the rows to keep; reads narrow columns only."""
    return (household_groups(accepted_rows(df))
            .select(CYCLE, F.col("best_row").alias(ROW), "household_submissions"))


def dedupe_latest(df: DataFrame) -> DataFrame:
    """The kept rows: one per household and cycle, with outcome flags and the group size."""
    return with_outcome_flags(df.join(winners(df), [CYCLE, ROW]))


def verdicts(accepted: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(cycle, source row, household) of rows that pass rejection: flags, group size and whether each is the best."""
    members = sized_lookup(
        accepted.select(CYCLE, ROW, HOUSEHOLD, "is_completed", "is_consented"),
        household_groups(accepted), [CYCLE, HOUSEHOLD], "household_submissions",
        F.col(ROW), hot_rows)
    return members.select(CYCLE, ROW, HOUSEHOLD, "is_completed", "is_consented", "household_submissions",
                          (F.col(ROW) == F.col("best_row")).alias(BEST))


def with_verdicts(df: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Every row of ``df`` with its verdict, and the reason of those that are not kept."""
    # What a row's own columns decide is settled first: a narrow result then takes neither through the join.
    own = F.when(F.col(KEY).isNull(), EMPTY_ROW).when(F.col(HOUSEHOLD).isNull(), MISSING_HOUSEHOLD)
    later = F.when(F.col(BEST).isNull(), DUPLICATE_KEY).when(~F.col(BEST), SUPERSEDED)
    return (df.withColumn("_own_reason", own).join(verdicts.drop(HOUSEHOLD), [CYCLE, ROW], "left")
            .withColumn("reject_reason", F.coalesce(F.col("_own_reason"), later)).drop("_own_reason", BEST))


def tag_submissions(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every input row plus flags, ``household_submissions`` and ``reject_reason``.

    Kept rows have no reason. Rows rejected before deduplication have NULL
    flags; superseded rows carry theirs.
    """
    return with_verdicts(df, verdicts(accepted_rows(df), hot_rows))


def split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantine) out of tagged rows."""
    kept = tagged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return kept, tagged.where(F.col("reject_reason").isNotNull())


SUBMISSION_COLUMNS = (
    "survey_cycle", "cycle_order", "submission_key", "household_id", "submitted_at",
    "interview_status", "consent", "interview_duration_sec", "district", "subcounty", "parish",
    "village", "gps_lat",
)


def all_submissions(kept: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Kept and quarantined rows together; blank export lines are not submissions."""
    kept = kept.select(*SUBMISSION_COLUMNS, F.lit(True).alias("is_kept"),
                       F.lit(None).cast("string").alias("reject_reason"))
    lost = (quarantine.where(F.col("reject_reason") != EMPTY_ROW)
            .select(*SUBMISSION_COLUMNS, F.lit(False).alias("is_kept"), "reject_reason"))
    return kept.unionByName(lost)


def all_submissions_from_tagged(tagged: DataFrame) -> DataFrame:
    """The same relation in one pass, for callers that hold the tagged rows."""
    return (tagged.where(F.coalesce(F.col("reject_reason"), F.lit("")) != EMPTY_ROW)
            .select(*SUBMISSION_COLUMNS, F.col("reject_reason").isNull().alias("is_kept"),
                    "reject_reason"))


def duplicate_keys(df: DataFrame) -> DataFrame:
    """Rows that repeat a submission key of their cycle after its first row in file order."""
    firsts = (df.where(F.col(KEY).isNotNull()).groupBy(CYCLE, KEY).agg(F.min(ROW).alias(ROW)))
    # (cycle, key, row) is unique, so a key repeated without end still spreads.
    return df.where(F.col(KEY).isNotNull()).join(firsts, [CYCLE, KEY, ROW], "left_anti")


def quarantine_summary(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy(CYCLE, "reject_reason").agg(F.count("*").alias("rows"))


def check_kept(kept: DataFrame) -> None:
    """Raise when the household x cycle grain or the timestamps of kept rows are broken."""
    doubled = kept.groupBy(CYCLE, HOUSEHOLD).count().where("count > 1")
    if doubled.limit(1).count():
        raise AssertionError("grain violated: more than one kept row per household and cycle")
    if kept.where(F.col("submitted_at").isNull()).limit(1).count():
        raise AssertionError("kept rows without submitted_at: check the cycle's formats")
