"""SQL functions against the columns of the library; samples that do not depend on partitioning."""

from pyspark.sql import functions as F

from wavemill.functions import derive, sql, text
from wavemill.operators import profiling


def test_functions_equal_the_columns(spark):
    sql.register(spark)
    df = spark.createDataFrame(
        [(" oLD mill ", "Öst-END", "2023-11-05 23:59:59", 3.0, 0.0), (None, "x", None, 1.0, 4.0), ("", "", None, None, 2.0)],
        "d string, v string, t string, a double, b double").withColumn("t", F.to_timestamp("t"))
    want = df.select(text.title_case(F.col("d")), derive.geo_key(F.col("d"), F.col("v")), derive.date_key(F.col("t")),
                     derive.ratio(F.col("a"), F.col("b")), text.match_key(F.col("v"))).collect()
    got = spark.sql("SELECT title_case(d), geo_key(d, v), date_key(t), safe_ratio(a, b), match_key(v) FROM {df}", df=df)
    assert list(map(tuple, got.collect())) == list(map(tuple, want))
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


def test_labels_are_looked_up_by_joins(spark):
    lists = spark.createDataFrame(
        [("y1", "roof", "1", "Iron"), ("y1", "roof", "1", "Aluminium"), ("y2", "roof", "1", "Tile"), ("y1", "fuel", "1", "Gas"),
         ("y1", "roof", None, "Nothing")], "survey_cycle string, field string, code string, label string")
    sql.register_choice_label(spark, lists)
    rows = [(i, c, k) for i, (c, k) in enumerate([("y1", 1), ("y2", 1), ("y2", 2), ("y1", None), (None, 1), ("y1", 1)])]
    df = spark.createDataFrame(rows, "id int, survey_cycle string, code int")
    out = spark.sql("SELECT id, choice_label(survey_cycle, 'roof', CAST(code AS STRING)) AS label, survey_cycle AS field, "
                    "choice_label('y1', 'fuel', CAST(code AS STRING)) AS label2 FROM {df}", df=df)
    assert {r.id: (r.label, r.label2) for r in out.collect()} == {
        0: ("Aluminium", "Gas"), 1: ("Tile", "Gas"), 2: (None, None), 3: (None, None), 4: (None, "Gas"),
        5: ("Aluminium", "Gas")}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftOuter") >= 2 and "scalar-subquery" not in plan


def test_samples_do_not_depend_on_partitioning(spark):
    rows = [(c, str(i % 40) if i % 3 else None, i) for i in range(600) for c in ("a", "b")] + [("c", None, None)]
    df = spark.createDataFrame(rows, "survey_cycle string, `p.q (x)` string, n int")
    wanted = {tuple(r) for r in profiling.sample_by(df, ["p.q (x)", "n"], k=4).collect()}
    assert {(g, c) for g, c, _, _ in wanted} == {(g, c) for g in "ab" for c in ("p.q (x)", "n")}
    assert len(wanted) == 16 and {n for _, _, n, _ in wanted} == {1, 2, 3, 4}
    assert wanted == {tuple(r) for r in profiling.sample_by(df.repartition(7, "n"), ["p.q (x)", "n"], k=4).collect()}
    assert wanted != {tuple(r) for r in profiling.sample_by(df, ["p.q (x)", "n"], k=4, seed=2).collect()}
    one = [r[0] for r in profiling.sample_values(df, "p.q (x)").collect()]
    assert one == [r[0] for r in profiling.sample_values(df.repartition(5, "n"), "p.q (x)").collect()]
