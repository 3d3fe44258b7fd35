"""Substring deduplication against a direct look-up of every window."""

import random
import re

import pytest
from pyspark.sql import functions as F

from wavemill.llm import substring
from wavemill.llm.shared import table


def slow(rows, window):
    seen, out = set(), []
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for p in range(len(words) - window + 1):
            w = tuple(words[p:p + window])
            if w in seen:
                gone.update(range(p, p + window))
            seen.add(w)
        out.append((i, len(words), len(gone), " ".join(w for p, w in enumerate(words) if p not in gone)))
    return out


def found(df):
    return [(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect()]


@pytest.mark.parametrize("window", [4, 20])
def test_random_documents(spark, window):
    rnd = random.Random(window)
    passages = [[f"p{k}w{i}" for i in range(rnd.randint(window - 2, 3 * window))] for k in range(6)]
    rows = []
    for i in range(80):
        words = []
        for _ in range(rnd.randint(0, 5)):
            words += rnd.choice(passages)[rnd.randint(0, 3):] if rnd.random() < 0.6 else [
                f"r{rnd.randrange(9999)}" for _ in range(rnd.randint(0, 30))]
        rows.append((i * 13 - 200, rnd.choice([" ", "\n", " \t"]).join(words)))
    rows += [(2000, "a " * 90), (2001, "a " * 45 + "b"), (2002, "x y " * 40), (2003, None), (2004, ""),
             (2005, " ".join(f"é{i}" for i in range(30)) * 2), (None, " ".join(passages[0] * 2))]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, kept string")
    got = substring.drop_repeats(df, window=window)
    assert got.columns == ["doc_id", "kept", "n_words", "n_removed"]
    rows.sort(key=lambda r: (r[0] is None, r[0]))
    assert sorted(found(got), key=str) == sorted(slow(rows, window), key=str)


def test_repeated_rows_and_ids(spark):
    text = " ".join(f"w{i}" for i in range(25))
    df = spark.createDataFrame([(1, text), (1, text), (1, text + " more"), (0, "w1 w2")], "doc_id long, text string")
    got = sorted(found(substring.drop_repeats(df)), key=str)
    assert [r[0] for r in got] == [0, 1, 1, 1] and sorted(r[2] for r in got) == [0, 0, 25, 25]
    assert found(substring.drop_repeats(df.limit(0))) == []
    with pytest.raises(ValueError):
        substring.drop_repeats(df, window=7)


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = substring.drop_repeats(docs.select("doc_id", F.col("text")))
    assert sorted(found(got)) == sorted(slow(rows, 20))
