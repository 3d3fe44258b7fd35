"""Columns of the caller that are called like an operator's own: carried, unchanged, no crash."""

import pytest
from pyspark.sql import functions as F

from wavemill.llm import line_runs, mixing, quality, simhash_ball

OURS = ["_doc", "_drops", "doc", "h1", "_id", "_mark", "_of", "_spans", "_words", "mark", "size", "bucket", "first", "Upper",
        "stops", "distinct", "ended", "dup_lines", "loud", "with_letter", "_word_length", "_symbols", "_lines", "fingerprint_",
        "_key", "_none", "epoch", "block"]
RUNS = {
    "line_runs": line_runs.drop_repeated_lines,
    "quality": quality.judged,
    "mixing": mixing.mixed_documents,
    "simhash": lambda df: simhash_ball.keep_one(df, radius=2, words=3),
}


@pytest.mark.parametrize("name", RUNS)
def test_own_names_are_the_callers(spark, name):
    texts = ["one two three four five six\nseven", None, "", "one two three four five six\nseven", "a b c " * 40]
    rows = [(i, t, f"s{i % 2}") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    wide = docs.select("*", *(F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in OURS))
    plain, got = RUNS[name](docs).collect(), RUNS[name](wide)
    assert set(OURS) <= set(got.columns)
    rows = got.collect()
    assert all(r[c] == f"{c}-{r['doc_id']}" for r in rows for c in OURS)
    names = [c for c in got.columns if c not in OURS]
    assert sorted((tuple(r[c] for c in names) for r in rows), key=repr) == sorted(map(tuple, plain), key=repr)
