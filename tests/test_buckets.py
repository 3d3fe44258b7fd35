"""Tables in buckets of a key: no shuffle on it, any session, keys that are very common."""

import pytest
from pyspark.sql import functions as F

from wavemill import config, sinks
from wavemill.plans import dims, reports, warehouse
from wavemill.session import apply_settings


def exchanges(df):
    """The keys of each shuffle in the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


@pytest.fixture()
def lake(spark, tmp_path):
    """A kept table, a fact and households of 500 households in three cycles, stored in buckets."""
    lake = warehouse.Lake(spark, str(tmp_path), buckets=8)
    codes = [c.code for c in config.CYCLES]
    rows = spark.range(1500).select(
        F.concat(F.lit("H"), F.expr("id div 3")).alias("household_id"),
        F.get(F.array(*map(F.lit, codes)), (F.col("id") % 3).cast("int")).alias("survey_cycle"),
        (F.col("id") % 3).cast("int").alias("cycle_order"), F.lit("A").alias("district"), F.lit("q1").alias("wealth_quartile"),
        F.lit(None).cast("string").alias("cohort"), F.lit("f").alias("head_sex"), F.lit(True).alias("is_consented"),
        F.concat(F.lit("g"), F.col("id") % 7).alias("geo_key"), F.rand(3).alias("hhip_usd_day"),
        (F.col("id") % 2 == 0).alias("meets_target"), (F.col("id") % 5 == 0).alias("is_ultra_poor"))
    for layer, name in (("silver", "kept"), ("gold", "fact")):
        lake.write_by_household(sinks.in_buckets(rows, "household_id", 8), layer, name, ["household_id"])
    lake.write_by_household(dims.dim_household(lake.table("silver", "kept"), 3), "gold", "dim_household", ["household_id"])
    return lake


def test_nothing_is_shuffled_by_household(spark, lake):
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        households = dims.dim_household(lake.table("silver", "kept"), 3)
        assert exchanges(households) == [] and households.count() == 500
        places = spark.createDataFrame([(f"g{i}", "A") for i in range(7)], "geo_key string, district string")
        panel = reports.rpt_panel_poverty(lake.table("gold", "fact"), lake.table("gold", "dim_household"), places)
        keys = exchanges(panel)
        assert keys and not [k for k in keys if "household_id" in k]
        by_path = dims.dim_household(spark.read.parquet(lake.path("silver", "kept")), 3)
        assert len(exchanges(by_path)) == 1
        assert sorted(map(tuple, by_path.collect())) == sorted(map(tuple, households.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def test_one_file_a_bucket_and_replaced_whole(spark, lake):
    table = lake.table("gold", "fact")
    assert len(table.inputFiles()) == 8
    again = lake.write_by_household(sinks.in_buckets(table.limit(10).repartition(3), "household_id", 8), "gold", "copy",
                                    ["household_id"])
    assert again.count() == 10
    again = lake.write_by_household(sinks.in_buckets(table, "household_id", 8), "gold", "copy", ["household_id"])
    assert again.count() == 1500 == spark.read.parquet(lake.path("gold", "copy")).count()


def test_another_session_reads_buckets_too(spark, lake):
    path = lake.path("silver", "halves")
    rows = lake.table("silver", "kept").withColumn("kept", F.col("cycle_order") % 2)
    sinks.write_buckets(rows, path, "household_id", ["household_id"], 8, ["kept"])
    spark.sql(f"DROP TABLE {sinks.table_name(spark, path)}")  # external: its files stay
    other = apply_settings(spark.newSession())
    read = sinks.read_table(other, path)
    assert read.count() == 1500 and read.where("kept = 1").count() == 500
    assert exchanges(read.groupBy("household_id").count()) == []
    assert sorted(read.columns) == sorted(rows.columns)


def test_a_household_with_most_rows_and_rows_without_one(spark, tmp_path):
    rows = spark.range(20000).select("id", F.when(F.col("id") % 4 == 0, None).when(F.col("id") % 4 < 3, "hot").otherwise(
        F.col("id").cast("string")).alias("household_id"))
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    try:
        stored = sinks.write_buckets(sinks.in_buckets(rows, "household_id", 4), str(tmp_path / "t"), "household_id",
                                     ["household_id"], 4)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert len(stored.inputFiles()) > 4  # the hot bucket came from several tasks
    got = {r["household_id"]: r["count"] for r in stored.groupBy("household_id").count().collect()}
    assert got["hot"] == 10000 and got[None] == 5000 and len(got) == 5002


def test_empty_table_and_numbers(spark, tmp_path):
    empty = spark.createDataFrame([], "household_id string, x int")
    assert sinks.write_buckets(empty, str(tmp_path / "e"), "household_id", ["x"], 4).count() == 0
    assert sinks.read_table(spark, str(tmp_path / "e")).columns == ["household_id", "x"]
    assert [sinks.bucket_number(n) for n in (0, 1, 8_000_000, 8_000_001, 10**12)] == [4, 4, 4, 8, 2**19]
