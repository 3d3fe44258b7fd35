"""Token counts, quality rules and licence scans against direct versions."""

import itertools
import math
import random
import re
from collections import Counter

import public_tokenizers

from wavemill.llm import licenses, quality, token_trie

PIECES = str(public_tokenizers.path("piece_bpe_32k.model"))
ODD = [None, "", " \n\t", "x", "İ ſ ß", "日本語 テキスト", "a" * 3000, "word " * 700, "the cat\x1fsat \x85 on\xa0it", "🙂🙂 \x00"]


def best_segmentation(model, word):
    """By trying every way to cut a short word."""
    marked = token_trie.MARK + word
    best = None
    for cuts in itertools.product((0, 1), repeat=len(marked) - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(marked)]
        parts = [marked[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        if any(len(p) > 1 and p not in model.pieces for p in parts):
            continue
        score = sum(model.pieces.get(p, token_trie.BYTE_SCORE * len(p.encode())) for p in parts)
        n = sum(1 if p in model.pieces else len(p.encode()) for p in parts)
        if best is None or (score, -n) > (best[1] + 1e-9, -best[0]):
            best = (n, score)
    return best


def test_trie_scores_equal_the_best_of_all_segmentations():
    model = token_trie.unigram(PIECES)
    rnd = random.Random(2)
    words = {"".join(rnd.choice("theanigé日") for _ in range(rnd.randint(1, 9))) for _ in range(120)} | {"then", "thens"}
    found = model.segment(words)
    for w in words:
        n, score = best_segmentation(model, w)
        assert math.isclose(found[w][1], score, rel_tol=1e-9), w
        assert found[w][0] == n
    assert model.segment(["then"])["then"] == found["then"]


class Counted(dict):
    asked = 0

    def get(self, key, default=None):
        self.asked += 1
        return super().get(key, default)


def test_a_node_asks_for_no_more_than_what_ends_a_piece():
    model = token_trie.Unigram(PIECES)
    model.endings = Counted(model.endings)
    pieces = set(model.pieces)
    endings = {p[i:] for p in pieces for i in range(len(p))}
    for word in ("qzqzqzxjxj" * 20, "日本語テキスト" * 20, "internationalisation", "x"):
        marked = token_trie.MARK + word
        fits = sum(marked[a:b] in endings for b in range(1, len(marked) + 1) for a in range(max(0, b - 40), b))
        model.endings.asked = 0
        model.segment([word])
        assert fits <= model.endings.asked <= fits + len(marked)


def test_long_words_are_not_remembered():
    model = token_trie.Unigram(PIECES)
    words = {"short", "long" * 100}
    model.learn(words)
    assert set(model.tokens) == set(model.scores) == words
    model.forget_long(words)
    assert set(model.tokens) == set(model.scores) == {"short"}


def test_token_counts_of_rows(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*ODD, ODD[3]])], "id long, text string, n_tokens int")
    rows = token_trie.token_counts(df, PIECES).orderBy("id").collect()
    model = token_trie.unigram(PIECES)
    for r, t in zip(rows, [*ODD, ODD[3]], strict=True):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        each = [model.segment([w])[w] for w in words]
        assert (r["n_words"], r["n_tokens"]) == (len(words), sum(n for n, _ in each))
        assert math.isclose(r["log_prob"], sum(s for _, s in each), abs_tol=1e-6)
    assert token_trie.token_counts(df.limit(0), PIECES).count() == 0


def slow_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in (i, i + 1, i + 2)}
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:i])
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)]


def test_quality_counts_and_verdicts(spark):
    rnd = random.Random(4)
    good = [" ".join(rnd.choice("the a of and we saw some large green house near old river they walked".split())
                     for _ in range(90)) + f" item{i}.\nIt was item{i} of them." for i in range(60)]
    junk = ["BUY!! " * 80, "### $$$ %%% " * 40, ("same line again here\n" * 30), "x1 | y2 | " * 60]
    texts = [*ODD, *good, *junk, "a b a b a b", "a b c a b c d", "l\n\nl\n \n \nl", "a\x1fb a\x1fb"]
    df = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "id long, text string, kept boolean")
    rows = {r["id"]: r for r in quality.judged(df).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        r = rows[i]
        assert [r[c] for c in quality.COUNTS] == slow_counts(t or ""), t
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert 0 <= r["quality"] <= 1 and not (r["kept"] and r["base_failed"])
        if t in good:
            assert r["kept"], (t, r)
        if t in junk:
            assert not r["kept"], t
    assert quality.judged(df.limit(0)).count() == 0


def test_estimated_accuracies_are_found_again():
    rnd = random.Random(8)
    right = [0.95, 0.9, 0.85, 0.7, 0.6]
    patterns, truth = Counter(), {}
    for _ in range(20_000):
        good = rnd.random() < 0.8
        votes = tuple(0 if rnd.random() < 0.3 else (1 if good == (rnd.random() < a) else -1) for a in right)
        patterns[votes] += 1
        truth.setdefault(votes, []).append(good)
    prior, weights = quality.estimate(list(patterns.items()))
    assert abs(1 / (1 + math.exp(-prior)) - 0.8) < 0.05
    for a, w in zip(right, weights, strict=True):
        assert abs(w[1] - math.log(a / (1 - a))) < 0.5 and abs(w[-1] + math.log(a / (1 - a))) < 0.5 and abs(w[0]) < 0.2
    assert quality.estimate([]) == (0.0, [])


def slow_base(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    at = [(i, label) for p, label in phrases.items() for i in range(len(words)) if tuple(words[i:i + len(p)]) == p]
    return len(words), sorted(i for i, _ in at), sorted({label for _, label in at})


def test_licences(spark):
    noise = " ".join(f"n{i}" for i in range(40))
    texts = [*ODD, "MIT License mit-license", "the MIT. License", "GENERAL public/license é", "under licensed 2.0 version",
             f"{noise}\nReleased under the MIT License.", f"Licensed under CC BY-NC 4.0. {noise}", "All rights reserved.",
             f"{noise} This work is licensed under the GNU General Public License, version 3. {noise}",
             "Licensed under the Apache Licence, Version 2.0", "Licensed under the Apache License, Version 2.0!",
             "all of the rights are reserved by none", "Licensed under the Apache License, Version 9.0"]
    df = spark.createDataFrame([(i, t, 0.3) for i, t in enumerate(texts)], "id long, text string, score double")
    rows = licenses.scanned(df).orderBy("id").collect()
    for r, t in zip(rows, texts, strict=True):
        n, at, base = slow_base(t or "")
        assert (r["n_words"], r["base_places"], r["base_labels"]) == (n, at, base), t
        assert set(base) <= set(r["labels"]) == set(sorted(r["labels"])) and 0 <= r["score"] <= 1
    found = {t: r["labels"] for r, t in zip(rows, texts, strict=True)}
    assert found[f"Licensed under CC BY-NC 4.0. {noise}"] == ["cc-by-nc"]
    assert found["All rights reserved."] == ["proprietary"]
    assert found["all of the rights are reserved by none"] == [] == found["under licensed 2.0 version"]
    assert found["Licensed under the Apache Licence, Version 2.0"] == []
    assert licenses.scanned(df.limit(0)).count() == 0


def test_notices_beside_others_are_found():
    found = licenses.templates()
    for idf in ({w: 1.0 for t in found for w in t.words}, {w: 0.5 + len(w) for t in found for w in t.words}):
        index = licenses.Index(idf)
        alone = [index.scan(list(t.words)).keys() for t in found]
        assert all(t.label in labels for t, labels in zip(found, alone, strict=True))
        for a, x in zip(found, alone, strict=True):
            for b, y in zip(found, alone, strict=True):
                assert x | y <= index.scan([*a.words, b"noise", *b.words]).keys()
        everything = [w for t in found for w in (*t.words, b"noise")]
        assert index.scan(everything).keys() == {t.label for t in found}


def test_padded_lines_end_where_their_words_do():
    ended = quality._SHARES.index("ended")
    for text in ("A line." + " " * 30, "A line.\u00a0\t" + " " * 9 + "\nAnother!" + " " * 8):
        assert quality.measures(text)[1][ended] == 1.0
    assert quality.measures("A. line" + " " * 30)[1][ended] == 0.0
