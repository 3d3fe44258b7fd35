"""Encoding against the tokenizer library itself, with pieces so small that every join is exercised."""

import random
import time

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from wavemill.llm import bpe

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
TEXTS = [
    None, "", " ", "Hello   world's  foo<|endoftext|>bar", "<|startoftext|>", "ÉÀ é é ΣΑΣ İstanbul 日本語 ﬁ ՘꟎",
    "a" * 5000, "ab" * 999 + "'s 12" + "xyz" * 700, "!?" * 400, "nothing\x00here​­", "don't we'll",
    "supercalifragilistic" * 60 + "é" * 77, "the quick\nbrown\tfox " * 50, "the quick\nbrown\tfox " * 50,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("leaf", [3, 40, bpe.LEAF_CHARS])
def test_ids_and_text_equal_the_library(spark, library, leaf):
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in enumerate(TEXTS)],
                               "id long, text string, decoded string, _key string, key int")
    rows = {r["id"]: r for r in bpe.encode(df, PATH, leaf_chars=leaf, decoded=True).collect()}
    assert len(rows) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert list(rows[i]["token_ids"]) == ids, t
        assert rows[i]["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_joins_of_random_runs_are_exact(library):
    code, rnd = bpe.codec(PATH), random.Random(5)
    for _ in range(300):
        run = "".join(rnd.choice(["a", "b", "the", "ing", "lo", "an", "é", "aa"]) for _ in range(rnd.randint(2, 120)))
        pieces = bpe.halves(run, rnd.randint(1, 9))
        ids = [code.leaf(p, i + 1 == len(pieces)) for i, p in enumerate(pieces)]
        assert code.tree(ids) == library.encode(run, add_special_tokens=False).ids


def test_empty_table_and_no_columns_besides(spark):
    df = spark.createDataFrame([], "text string")
    assert bpe.decode(bpe.encode(df, PATH), PATH).agg(F.count("*")).first()[0] == 0


def test_long_runs_are_found_in_one_pass(spark, library):
    run = ("ab" * 8000 + " ") * 125  # two megabytes of runs that are just too short to be divided
    df = spark.createDataFrame([(1, run), (2, "a" * 20_000)], "id long, text string")
    start = time.perf_counter()
    got = {r["id"]: list(r["token_ids"]) for r in bpe.encode(df, PATH).collect()}
    assert time.perf_counter() - start < 30
    assert got == {1: library.encode(run, add_special_tokens=False).ids, 2: library.encode("a" * 20_000, add_special_tokens=False).ids}
