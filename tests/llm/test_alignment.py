"""Alignment against direct search in the ends of both tokenizations, with packs of a few texts."""

import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from wavemill.llm import alignment

A, B = str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))
PARTS = [" ", "  ", "▁", "\n", "\t", "a", "the", "ing", "\x00", "é", "日本", "​", "🙂", "\x1c", "\x1d", ".", "<|endoftext|>",
         "<s>", "'s", "'ll", " ", "　", "\x85", "0", "12", "!?", "\r\n", " over", " token"]
TEXTS = [None, "", " ", "hello world", "hello world", "a▁b", "x" * 2000, "the cat sat on the mat. " * 60, "\n\n\n", "naïve café 日本語"]


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def odd_texts(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 30))) for _ in range(n)]


def slow(libraries, text):
    """(ids of a, ids of b, their ends) or nothing for a text that is spelt otherwise."""
    a, b = libraries
    want = b" " + (text or "").encode()
    letters = alignment.byte_of_letters()
    found = a.encode(" " + (text or ""), add_special_tokens=False)
    ai, spelt_a = found.ids, [bytes(letters[x] for x in a.id_to_token(i)) for i in found.ids]
    bi = b.encode(text or "")
    spelt_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in ((i, b.id_to_piece(i)) for i in bi)]
    if not text or b"".join(spelt_a) != want or b"".join(spelt_b) != want:
        return [], [], [], []
    return ai, bi, np.cumsum([len(x) for x in spelt_a]).tolist(), np.cumsum([len(x) for x in spelt_b]).tolist()


def slow_groups(libraries, text):
    ai, bi, a_ends, b_ends = slow(libraries, text)
    cuts = [(a_ends.index(e), b_ends.index(e)) for e in sorted(set(a_ends) & set(b_ends))]
    befores = [(-1, -1), *cuts]
    spelt = ";".join(f"{','.join(map(str, ai[p + 1:i + 1]))}|{','.join(map(str, bi[q + 1:j + 1]))}"
                     for (p, q), (i, j) in zip(befores, cuts, strict=False))
    return ai, bi, cuts, spelt


def test_galloping_equals_binary_search():
    rnd = random.Random(1)
    for _ in range(400):
        many = np.cumsum([rnd.choice([1, 1, 2, 9, 50]) for _ in range(rnd.randint(0, 300))]).astype(np.int64)
        few = np.cumsum([rnd.choice([1, 3, 400]) for _ in range(rnd.randint(0, 60))]).astype(np.int64)
        start = np.array([rnd.randrange(len(many)) for _ in few], np.int64) if len(many) else np.zeros(len(few), np.int64)
        assert (alignment.gallop(few, many, start) == np.searchsorted(many, few)).all()


def test_chunks_equal_the_library(libraries):
    texts = odd_texts(5000) + ["don't we'll 'S's 12ab_c-d", "!" * 500, "ab" * 90, "A" * 64, " " * 700 + "x", "é" * 300]
    got, like = alignment.ByteLevel(A).encode(texts)
    assert all(like)
    want = libraries[0].encode_batch([" " + t for t in texts], add_special_tokens=False)
    assert [memoryview(x).cast("i").tolist() for x in got] == [e.ids for e in want]


def test_groups_and_overlaps(spark, libraries):
    texts = [*TEXTS, *odd_texts(300, 2)]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "id long, text string, a_ids int")
    rows = {r["id"]: r for r in alignment.align(df, A, B).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        r, (ai, bi, a_ends, b_ends) = rows[i], slow(libraries, t)
        cuts = slow_groups(libraries, t)[2]
        assert (list(r["a_ids"]), list(r["b_ids"])) == (ai, bi)
        assert list(zip(r["a_ends"], r["b_ends"], strict=True)) == cuts
        for place, (start, end) in enumerate(zip([0, *a_ends], a_ends, strict=False)):
            over = [j for j, (p, q) in enumerate(zip([0, *b_ends], b_ends, strict=False)) if p < end and q > start]
            assert (r["first_overlap"][place], r["last_overlap"][place]) == (over[0], over[-1])


@pytest.mark.parametrize("pack_bytes", [1, 400, 8 << 20])
def test_link_counts(spark, libraries, pack_bytes):
    from hashlib import sha256

    texts = [*TEXTS, *odd_texts(200, 3)]
    each = [slow_groups(libraries, t) for t in texts]
    total = Counter((ai[i], bi[j]) for ai, bi, cuts, _ in each for i, j in cuts)
    top = defaultdict(int)
    for (_, b), n in total.items():
        top[b] = max(top[b], n)
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, pack int, n_best int")
    got = {r["doc_id"]: r for r in alignment.link_counts(df, A, B, pack_bytes=pack_bytes).collect()}
    assert len(got) == len(texts)
    for i, (ai, bi, cuts, spelt) in enumerate(each):
        pairs = [(ai[p], bi[q]) for p, q in cuts]
        r = got[i]
        assert [r[c] for c in ("n_a", "n_b", "n_groups", "n_links")] == [len(ai), len(bi), len(cuts), len(cuts)]
        assert r["count_sum"] == sum(total[p] for p in pairs)
        assert r["n_best"] == sum(total[p] == top[p[1]] for p in pairs)
        assert r["groups_sha256"] == (sha256(spelt.encode()).hexdigest() if spelt else "")
    assert alignment.link_counts(df.limit(0), A, B).count() == 0 == alignment.align(df.limit(0), A, B).count()
