"""Late rows: the stored table after any sequence of arrivals equals a full run, and untouched files stay."""

import os
import random
import shutil

import pytest
from pyspark.sql import functions as F
from test_pipeline import harmonize_contract

from fixtures import write_exports
from wavemill import config
from wavemill.operators import dedupe, harmonize
from wavemill.sources import exports
from wavemill.streaming import silver_stream

SCHEMA = ("survey_cycle string, source_row long, submission_key string, household_id string, submitted_at timestamp_ntz, "
          "interview_status int, consent int, village string")


def arrivals(seed, n):
    rnd = random.Random(seed)
    start = __import__("datetime").datetime(2024, 1, 1)
    step = __import__("datetime").timedelta(minutes=1)
    rows = []
    for i in range(1, n + 1):
        key = rnd.choice([None, f"k{rnd.randrange(n)}", f"k{i + n}", f"k{i + n}"])
        household = rnd.choice([None, f"h{rnd.randrange(n // 4)}", f"h{rnd.randrange(n // 4)}", "hot"])
        rows.append((rnd.choice(["2020", "year1"]), i, key, household, rnd.choice([None, start + step * rnd.randrange(50)]),
                     rnd.choice([None, 1, 2]), rnd.choice([None, 0, 1]), f"v{i}"))
    return rows


def files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("seed, cuts", [(1, (60, 61, 200)), (2, (5, 150)), (3, ())])
def test_any_arrivals_equal_a_full_run(spark, tmp_path, seed, cuts):
    rows, path = arrivals(seed, 240), str(tmp_path / "silver")
    whole = spark.createDataFrame(rows, SCHEMA)
    for low, high in zip((0, *cuts), (*cuts, len(rows)), strict=True):
        part = spark.createDataFrame(rows[low:high], SCHEMA)
        silver_stream.upsert(part, path, parts=8)
        silver_stream.upsert(part, path, parts=8)  # a batch that is repeated after a failure
    names = sorted(silver_stream.read_silver(spark, path).columns)
    want = dedupe.tag_submissions(whole).select(*names).collect()
    assert sorted(map(str, silver_stream.read_silver(spark, path).select(*names).collect())) == sorted(map(str, want))
    assert silver_stream.upsert(whole.limit(0), path) == []


def test_only_touched_parts_are_written(spark, tmp_path):
    rows, path = arrivals(4, 300), str(tmp_path / "silver")
    silver_stream.upsert(spark.createDataFrame(rows, SCHEMA), path, parts=16)
    before = files(path)
    late = [("year1", 301, "new-1", "h3", None, 1, 1, "v"), ("year1", 302, "new-2", None, None, 1, 1, "v")]
    written = silver_stream.upsert(spark.createDataFrame(late, SCHEMA), path, parts=16)
    after = files(path)
    assert {c for c, _ in written} == {"year1"} and len(written) == 2
    folders = {f"survey_cycle={c}/household_part={p}" for c, p in written}
    assert {os.path.dirname(f) for f in after.keys() ^ before.keys()} <= folders
    assert all(after[f] == before[f] for f in before if os.path.dirname(f) not in folders)
    assert len(before) > 16 and silver_stream.read_silver(spark, path).count() == 302


def same_as_full_run(spark, path, rows):
    names = sorted(silver_stream.read_silver(spark, path).columns)
    want = dedupe.tag_submissions(spark.createDataFrame(rows, SCHEMA)).select(*names).collect()
    return sorted(map(str, silver_stream.read_silver(spark, path).select(*names).collect())) == sorted(map(str, want))


def test_stored_rows_are_not_written_again_when_verdicts_change(spark, tmp_path):
    rows, path = arrivals(5, 240), str(tmp_path / "silver")
    silver_stream.upsert(spark.createDataFrame(rows[:180], SCHEMA), path, parts=4)
    before, limit = files(path), spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    written = silver_stream.upsert(spark.createDataFrame(rows[180:], SCHEMA), path, parts=4)
    after = files(path)
    assert len(written) == 10 and len(after) > len(before)  # every part gets rows
    assert all(after[f] == before[f] for f in before)
    assert same_as_full_run(spark, path, rows)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == limit


@pytest.mark.parametrize("repeated", [True, False])
def test_rows_of_a_failed_call_are_not_read(spark, tmp_path, monkeypatch, repeated):
    rows, path = arrivals(6, 240), str(tmp_path / "silver")

    def fail(accepted):
        raise RuntimeError("lost")

    for low, high in ((0, 100), (100, 170)):
        with monkeypatch.context() as m, pytest.raises(RuntimeError):
            m.setattr(dedupe, "verdicts", fail)
            silver_stream.upsert(spark.createDataFrame(rows[low:high], SCHEMA), path, parts=4)
        if low:
            assert same_as_full_run(spark, path, rows[:low])
        if repeated or not low:
            silver_stream.upsert(spark.createDataFrame(rows[low:high], SCHEMA), path, parts=4)
    silver_stream.upsert(spark.createDataFrame(rows[170:], SCHEMA), path, parts=4)
    assert same_as_full_run(spark, path, rows if repeated else rows[:100] + rows[170:])


def test_a_table_without_verdicts_is_refused(spark, tmp_path):
    rows, path = arrivals(7, 20), str(tmp_path / "silver")
    silver_stream.with_part(spark.createDataFrame(rows[:10], SCHEMA)).write.partitionBy(
        "survey_cycle", "household_part").parquet(path)
    with pytest.raises(ValueError, match="without verdicts"):
        silver_stream.upsert(spark.createDataFrame(rows[10:], SCHEMA), path)


def test_stream_from_files_to_silver(spark, tmp_path):
    data, folder, bronze, silver = (str(tmp_path / n) for n in ("data", "in", "bronze", "silver"))
    os.makedirs(data), os.makedirs(folder)
    write_exports(data)
    names = exports.normalized_headers(exports.raw_headers(spark, f"{data}/03_year_two.csv"))
    contract, cycle = harmonize_contract(names), config.CYCLE_BY_CODE["year2"]

    def take():
        silver_stream.stream_to_silver(spark, folder, names, cycle, contract, bronze, silver,
                                       str(tmp_path / "checkpoint")).awaitTermination()

    for file in ("a.csv", "b.csv"):
        shutil.copy(f"{data}/03_year_two.csv", f"{folder}/{file}")
        take()
        take()
        stored = silver_stream.read_silver(spark, silver)
        typed = harmonize.harmonize(spark.read.parquet(bronze), contract, cycle)
        want = dedupe.tag_submissions(typed)
        names_ = sorted(want.columns)
        assert sorted(map(str, stored.select(*names_).collect())) == sorted(map(str, want.select(*names_).collect()))
    assert stored.where(F.col("reject_reason").isNull()).count() == 4 and stored.count() == 14
