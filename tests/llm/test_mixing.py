"""Mixing: targets against repeated resharing, taken words against a walk over blocks, native plans."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from wavemill.llm import mixing


def slow_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        target = {s: 2.0 * sizes[s] if s in full else rest * weight[s] / share for s in names}
        over = {s for s in names if s not in full and target[s] > 2 * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(i * 37 % 400)) + " \n", s)
            for i in range(300) for s in [("big", "mid", None, "Öl", "a", "tiny")[min(i % 9, 5)]]]
    rows += [(900, None, "mid"), (901, "", "empty"), (902, " one\ttwo\n", "solo"), (902, " one\ttwo\n", "solo"),
             (None, "no id", "solo")]
    return spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, source string, n_chars long")


def test_targets_and_taken(spark, docs):
    rows = mixing.mix(docs, block_words=8).collect()
    assert len(rows) == docs.count()  # equal rows are documents each
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"] and (r["shard"] is None) == (r["taken"] == 0)
    want = slow_targets(dict(sizes))
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 16, s
    again = mixing.mix(docs.repartition(7), block_words=8).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_slots_are_permutations_and_meet_the_quotas(spark, docs):
    sources = mixing.targets(mixing.sized(docs))
    quota = {r["src"]: r for r in mixing.quotas(sources, 1).collect()}
    rows = mixing.slots(sources, 1, shard_slots=500).collect()
    assert Counter(r["src"] for r in rows) == Counter({s: r["quota"] for s, r in quota.items()})
    assert max(Counter((r["src"], r["epoch"], r["block"]) for r in rows).values()) == 1
    assert max(Counter((r["src"], r["slot"]) for r in rows).values()) == 1
    for r in rows:
        assert 0 <= r["block"] < quota[r["src"]]["blocks"] and r["slot"] < quota[r["src"]]["quota"]
        assert r["epoch"] == r["slot"] // quota[r["src"]]["blocks"]


def broadcast_rows(df):
    """The most rows that one broadcast of the plan held, as it ran."""
    df.collect()
    most, left = 0, [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        kind = node.getClass().getSimpleName()
        if kind == "BroadcastExchangeExec":
            most = max(most, node.metrics().apply("numOutputRows").value())
        if kind == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            left.append(node.plan())
        else:
            left += [node.children().apply(i) for i in range(node.children().size())]
    return most


def test_slots_are_not_broadcast(spark, docs):
    sources = mixing.cut(mixing.targets(mixing.sized(docs)))
    drawn = mixing.slots(sources, 1, shard_slots=4096)
    shards = drawn.select("shard", "src").distinct().count()
    assert drawn.count() > 50_000 and broadcast_rows(drawn) <= shards < 1000


def test_mixed_documents_broadcast_no_slots(spark, docs):
    assert broadcast_rows(mixing.mixed_documents(docs, block_words=1)) < 1000


def test_shards_draw_multinomial_counts(spark, docs):
    quota = mixing.quotas(mixing.targets(mixing.sized(docs)), 1)
    of = {r["src"]: r["quota"] for r in quota.collect()}
    total = sum(of.values())
    drawn = {(r["shard"], r["src"]): r["n_slots"] for r in mixing.drawn_counts(quota, shard_slots=500).collect()}
    shards = range(-(-total // 500))
    for k in shards:
        assert sum(drawn.get((k, s), 0) for s in of) == min(500, total - 500 * k)
    full = shards[:-1]
    chi = sum((drawn.get((k, s), 0) - 500 * q / total) ** 2 / (500 * q / total) for k in full for s, q in of.items())
    freedom = len(full) * (len(of) - 1)
    assert freedom / 2 < chi < 2 * freedom  # neither more even than a draw nor less
    counts = {(r["shard"], r["src"]): r["n_blocks"] for r in
              mixing.shard_counts(mixing.slots(mixing.targets(mixing.sized(docs)), 1, shard_slots=500)).collect()}
    moved = sum(abs(counts.get(c, 0) - drawn.get(c, 0)) for c in {*counts, *drawn})
    assert moved == sum(abs(q - sum(drawn.get((k, s), 0) for k in shards)) for s, q in of.items())


@pytest.mark.parametrize("n", [1, 2, 3, 64, 1000, 999_983])
def test_permutations_of_any_length(spark, n):
    i = F.col("id")
    rows = spark.range(n).select(i, mixing._permuted(i, F.lit(n), F.lit(7)).alias("to"))
    moved = rows.agg(F.countDistinct("to").alias("d"), F.min("to").alias("a"), F.max("to").alias("b"),
                     F.corr("id", "to").alias("c")).first()
    assert (moved["d"], moved["a"], moved["b"]) == (n, 0, n - 1)
    assert n < 1000 or abs(moved["c"]) < 0.1


def test_many_equal_rows(spark):
    same = spark.range(5000).selectExpr("7L AS doc_id", "'a b c' AS text", "'s' AS source", "0L AS n_chars")
    rows = mixing.mix(same, block_words=4).groupBy("size", "source_size").agg(
        F.count("*").alias("n"), F.sum("taken").alias("taken"), F.max("taken").alias("most")).collect()
    assert [(r["size"], r["source_size"], r["n"]) for r in rows] == [(3, 15000, 5000)]
    assert abs(rows[0]["taken"] - 22500) <= 4 and rows[0]["most"] <= 6
    words = mixing.mixed_documents(same, block_words=4).select(F.sum(F.size(F.split(F.trim("text"), " ")))).first()[0]
    assert words == rows[0]["taken"]


def test_mixed_texts_have_the_words_taken(spark, docs):
    taken = Counter()
    for r in mixing.mix(docs, block_words=8).collect():
        taken[r["doc_id"]] += r["taken"]
    words = Counter()
    whole = {(r["doc_id"], w) for r in docs.collect() for w in (r["text"] or "").split()}
    out = mixing.mixed_documents(docs, block_words=8)
    assert out.columns == docs.columns
    for r in out.collect():
        words[r["doc_id"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
        assert all((r["doc_id"], w) in whole for w in r["text"].split())
    assert +words == +taken


def test_empty_table(spark, docs):
    none = docs.limit(0)
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    blank = docs.where("doc_id = 900")
    assert [(r["target"], r["taken"]) for r in mixing.mix(blank).collect()] == [(0.0, 0)]


def test_no_python_in_the_plan(spark, docs):
    plan = mixing.mixed_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
