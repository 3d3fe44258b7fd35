"""Line deduplication against a direct count."""

import random
import re
from collections import defaultdict

import pytest

from wavemill.llm import line_runs


def slow(rows, min_chars=20, min_docs=3):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return re.sub("[A-Z]", lambda m: m[0].lower(), line)

    held = defaultdict(list)
    for i, t in rows:
        if i is not None:
            for k in {key(x) for x in (t or "").split("\n")}:
                if len(k) >= min_chars:
                    held[k].append(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(held[key(x)]) < min_docs or i == max(held[key(x)])]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


@pytest.mark.parametrize("batches", [1, 5])
def test_lines(spark, batches):
    rnd = random.Random(batches)
    pool = ["A line of twenty char", "a LINE of twenty char\r", "  é" * 9, "Ünïcödé lïne of twénty", "short", "", "x" * 500,
            "x" * 499 + "X"] + [f"filler line number {i % 7} of many" for i in range(20)]
    rows = [(i * 7 % 101, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 6)))) for i in range(60)]
    rows += [(500, None), (501, ""), (502, "\n"), (None, "A line of twenty char"), (7, rows[3][1]), (7, rows[3][1])]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, n_lines int")
    got = line_runs.drop_repeated_lines(df, batches=batches)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    found = [(r["doc_id"], r["text"] or "", r["n_lines"], r["n_dropped"]) for r in got.collect()]
    assert sorted(found, key=str) == sorted(slow(rows), key=str)


def test_empty_and_all_null(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert line_runs.drop_repeated_lines(df).count() == 0
    df = spark.createDataFrame([(None, None)], "doc_id long, text string")
    assert [tuple(r) for r in line_runs.drop_repeated_lines(df).collect()] == [(None, None, 1, 0)]
