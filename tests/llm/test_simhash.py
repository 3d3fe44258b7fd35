"""Fingerprints and components against all pairs, on small texts."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from wavemill.llm import simhash_ball
from wavemill.llm.components import roots


def slow_fingerprint(text, words=3):
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not ws:
        return 0
    shingles = [" ".join(ws[i:i + words]) for i in range(len(ws) - words + 1)] or [" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def closure(nodes, near):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if near(a, b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {n: find(n) for n in nodes}


def test_fingerprints_and_components(spark):
    rnd = random.Random(3)
    base = [" ".join(rnd.choice("ab cd ef Gh éé İ xyz".split()) for _ in range(rnd.randint(0, 60))) for _ in range(25)]
    texts = [None, "", " \n", "one", "One two", "a b c\x0bd", *base]
    for t in base:
        ws = t.split(" ")
        texts += [t, t.upper()] + [" ".join(ws[:k] + ["new"] + ws[k + 1:]) for k in (1, len(ws) - 1)]
    texts += [base[0]] * 40
    rows = [(i * 3 + 5, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = {r["doc_id"]: r for r in simhash_ball.components(df).collect()}
    prints = {i: slow_fingerprint(t) for i, t, _ in rows}
    assert {i: r["fingerprint"] % (1 << 64) for i, r in got.items()} == prints
    want = closure([r[0] for r in rows], lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert {i: r["component_id"] for i, r in got.items()} == want


def test_links_of_close_fingerprints_form_chains(spark):
    marks = [0, 1, 3, 7, 15, -(1 << 63), -1, -2, 0x5555 << 40, (0x5555 << 40) ^ 3, (0x5555 << 40) ^ (7 << 20)]
    df = spark.createDataFrame([(m,) for m in marks], "fingerprint long")
    links = [(r["a"], r["b"]) for r in simhash_ball.links(df).collect()]
    full = 1 << 64
    assert all(((a ^ b) % full).bit_count() <= 2 for a, b in links)
    found = {r["node"]: r["root"] for r in roots(spark.createDataFrame(links, "a long, b long")).collect()}
    want = closure(marks, lambda a, b: ((a ^ b) % full).bit_count() <= 2)
    for a in marks:
        for b in marks:
            assert (found.get(a, a) == found.get(b, b)) == (want[a] == want[b])
    with pytest.raises(ValueError):
        simhash_ball.links(df, 3)


def test_long_chain_contracts(spark):
    links = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["root"] for r in roots(links).collect()} == {0}


def test_one_of_each_group_stays(spark):
    rows = [(3, "same text here now", 1), (1, "same text here now", 2), (None, "same text here now", 3), (2, "other", 4),
            (None, "no id at all", 5), (None, "no id at all", 5), (4, "twice the same row", 6), (4, "twice the same row", 6),
            (1, "found nowhere else", 7)]
    df = spark.createDataFrame([(*r, 0, 0, 0, 0) for r in rows],
                               "doc_id long, text string, fingerprint int, none int, mark int, number int, number_ int")
    kept = simhash_ball.keep_one(df)
    assert kept.dtypes == df.dtypes
    assert sorted(r["fingerprint"] for r in kept.collect()) == [2, 4, 5, 6, 7]
    empty = df.limit(0)
    assert simhash_ball.keep_one(empty).count() == 0 and simhash_ball.components(empty).count() == 0
