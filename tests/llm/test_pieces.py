"""Distinct-chunk encoding against the library: every text, short sections, a table that is always full."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from wavemill.llm import piece_table

PATH = str(public_tokenizers.path("piece_bpe_32k.model"))
PARTS = [" ", "  ", "▁", "\n", "\t", "a", "the", "ing", "\x00", "é", "日", "​", "🙂", "\x1c", ".", "<0x0A>", "<s>", "</s>",
         "<unk>", "　", "\x85", "0", "12", " " * 17]
TEXTS = [None, "", " ", "  ", "▁", "x ", " x", "a" * 3000, "word " * 900, "the cat\x1fsat on\xa0it", "word " * 900]


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PATH)


def odd_texts(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 30))) for _ in range(n)]


def test_chunks_equal_the_library(library, monkeypatch):
    texts = odd_texts(3000)
    want = library.encode(texts, num_threads=1)
    for cache, section in ((200_000, 1 << 20), (0, 1 << 20), (200_000, 7)):
        monkeypatch.setattr(piece_table, "CACHE_CHUNKS", cache)
        monkeypatch.setattr(piece_table, "SECTION_CHARS", section)
        model = piece_table.Pieces(PATH)
        assert model.separable
        got = [x for i in range(0, len(texts), 100) for x in model.encode(texts[i:i + 100])]
        assert [memoryview(x).cast("i").tolist() for x in got] == want


def test_whole_texts_where_chunks_hang_together(library):
    model = piece_table.Pieces(PATH)
    model.separable = False
    texts = odd_texts(200, 2)
    assert [memoryview(x).cast("i").tolist() for x in model.encode(texts)] == library.encode(texts, num_threads=1)


def test_rows_and_clashing_columns(spark, library):
    texts = [*TEXTS, *odd_texts(300, 3)]
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in enumerate(texts)], "id long, text string, decoded string, token_ids int")
    rows = {r["id"]: r for r in piece_table.encode(df, PATH, decoded=True).collect()}
    again = {r["id"]: r["decoded"] for r in piece_table.decode(piece_table.encode(df, PATH), PATH).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        ids = library.encode(t or "")
        assert list(rows[i]["token_ids"]) == ids
        assert rows[i]["decoded"] == library.decode(ids) == again[i]


def test_unknown_ids_and_empty_tables(spark, library):
    df = spark.createDataFrame([(None,), ([],), ([-1, 450, None, 99_999],)], "token_ids array<int>")
    assert sorted(r["decoded"] for r in piece_table.decode(df, PATH).collect()) == ["", "", library.decode([450])]
    empty = spark.createDataFrame([], "text string")
    assert piece_table.encode(empty, PATH, decoded=True).agg(F.count("*")).first()[0] == 0
