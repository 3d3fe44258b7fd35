"""Collocations against counting every phrase of every piece, with packs of a few texts; tiles against plain counts."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wavemill.llm import collocations


def slow(rows, least, top, absorbed=80):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts.update((lang, *words[i:i + n]) for n in (1, 2, 3, 4) for i in range(len(words) - n + 1))
    candidates = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    found = []
    for (lang, *words), a in candidates.items():
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, *words[:k]], counts[lang, *words[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        inside = any(len(q) > len(words) + 1 and q[0] == lang and 100 * n >= absorbed * a
                     and any(list(q[1 + i:1 + i + len(words)]) == words for i in range(len(q) - len(words)))
                     for q, n in candidates.items())
        if not inside:
            found.append((lang, -score, -a, " ".join(words).encode(), left, right))
    out, place = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        place[lang] += 1
        if place[lang] <= top:
            out.append((lang, place[lang], phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def rows_of(rnd, n):
    words = ["new", "York", "city", "of", "the", "a", "a", "ba", "É", "日本", "x y", "\x00z", "New"]
    parts = words + [".", ", ", "\n", "\t", "  ", " new york city ", "! "]
    return [(rnd.choice(["en", "en", "de", None, "und"]), " ".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))))
            for _ in range(n)]


@pytest.mark.parametrize("pack_bytes, slot_pairs, slot_packs", [(1, 100, 7), (3000, 1 << 20, 100_000), (8 << 20, 500, 1)])
def test_phrases_equal_plain_counts(spark, monkeypatch, pack_bytes, slot_pairs, slot_packs):
    monkeypatch.setattr(collocations, "SLOT_PAIRS", slot_pairs)
    monkeypatch.setattr(collocations, "SLOT_PACKS", slot_packs)
    rows = rows_of(random.Random(3), 150) + [("en", None), (None, ""), ("fr", "a a a a a a"), ("fr", ". , \n")]
    rows += rows[:20]
    df = spark.createDataFrame([(*r, 5) for r in rows], "lang string, text string, score int")
    for least, top in ((5, 10_000), (3, 7)):
        got = collocations.collocations(df, least=least, top=top, pack_bytes=pack_bytes)
        assert sorted(map(tuple, got.collect())) == sorted(slow(rows, least, top))


def test_empty_tables_and_rare_words(spark):
    df = spark.createDataFrame([("en", "one two three")], "lang string, text string")
    assert collocations.collocations(df).count() == 0
    assert collocations.collocations(df.limit(0)).count() == 0
    assert [tuple(r) for r in collocations.collocations(df, least=1).collect()] == [
        ("en", 1, "one two three", 1, 1, 1, 3, 1_000_000)]


def test_tiles_count_what_plain_counting_does():
    rnd = np.random.default_rng(4)
    for n, high in ((0, 1), (1, 5), (60_000, 40), (60_000, 900), (60_000, 200_000)):
        left, right = ((rnd.zipf(1.2, n) - 1) % high for _ in range(2))
        lefts, rights, times, place = collocations.tiled_counts(left, right)
        want = Counter(zip(left.tolist(), right.tolist(), strict=True))
        assert dict(zip(zip(lefts.tolist(), rights.tolist(), strict=True), times.tolist(), strict=True)) == want
        assert len(lefts) == len(want) and (lefts[place] == left).all() and (rights[place] == right).all()


def test_tiles_take_little_memory():
    rnd = np.random.default_rng(5)
    left, right = ((rnd.zipf(1.2, 1 << 20) % 90_000).astype(np.int64) for _ in range(2))
    tracemalloc.start()
    collocations.tiled_counts(left, right)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak <= 56 * len(left)


def test_files_of_long_rows_have_small_row_groups_and_pages(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(collocations, "shared_folder", lambda spark: str(tmp_path / "packs"))
    rows = spark.range(0, 60, 1, 1).selectExpr(
        "id", "transform(sequence(1, 250000), x -> CAST(xxhash64(id, x) % 1000000007 AS int)) AS ids")  # a megabyte each
    collocations._written(rows)
    file, = (tmp_path / "packs").glob("*.parquet")
    found = pq.ParquetFile(file).metadata
    sizes = [found.row_group(i).total_byte_size for i in range(found.num_row_groups)]
    assert found.num_rows == 60 and max(sizes) <= 32 << 20


def test_no_files_of_packs_stay(spark, monkeypatch, tmp_path):
    made = []
    monkeypatch.setattr(collocations, "shared_folder", lambda spark: made.append(tmp_path / f"{len(made)}") or str(made[-1]))
    df = spark.createDataFrame([("en", "one two three four")] * 5, "lang string, text string")
    assert collocations.collocations(df, least=5).count() == 1
    assert len(made) == 7 and not [f for f in made if f.exists()]


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 4 * 10**15 + 1, 4 * 10**15 + 3, 9 * 10**15 + 7
    df = spark.createDataFrame([([left, a], [right, a], a)], "heads array<long>, tails array<long>, a long")
    row = df.select(collocations.weakest_cut(2).alias("c")).select("c.*").first()
    assert tuple(row) == (2_000_000 * a // (left + right), 1, left, right)


def test_ranks_are_dense_and_by_frequency(spark):
    df = spark.range(500).select(F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("lang"),
                                 (F.col("id") * 7919 % 101).alias("a"), F.col("id").cast("string").alias("word"))
    rows = collocations._ranked(df.repartition(5), F.col("word")).collect()
    for lang in "xy":
        mine = sorted((r for r in rows if r["lang"] == lang), key=lambda r: (-r["a"], r["word"]))
        assert [r["id"] for r in mine] == list(range(len(mine)))
