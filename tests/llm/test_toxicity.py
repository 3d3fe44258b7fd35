"""The automaton against edit distances, contexts of hits, held-out accuracy."""

import random
import zlib

import pytest

from wavemill.llm import toxicity
from wavemill.llm.shared import table


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
    return row[-1]


def test_automaton_finds_what_edit_distances_find():
    rnd = random.Random(1)
    terms = ["vile", "rotter", "scoundrel", "scounds", "öchtz*", "abab", "ababab"]
    automaton = toxicity.Automaton(terms)
    words = {"".join(rnd.choice("abco") for _ in range(rnd.randint(0, 8))) for _ in range(300)}
    for t in terms:
        t = t.removesuffix("*")
        for _ in range(150):
            w = list(t)
            for _ in range(rnd.randint(0, 3)):
                k = rnd.randrange(len(w) + 1)
                w[k:k + rnd.randint(0, 1)] = [rnd.choice("aeos")] * rnd.randint(0, 1)
            words.add("".join(w))
    for w in words:
        near = [(distance(w, t), t) for t in terms if not t.endswith("*") and distance(w, t) <= toxicity.edits(t)]
        near += [(0, t) for t in terms if t.endswith("*") and w.startswith(t[:-1])]
        want = min(near, default=None)
        assert automaton.match(w) == ((want[1], want[0]) if want else None), w


def test_quotation_and_address():
    scorer = toxicity.Scorer(toxicity.Lexicon({"rotter": (4.0, 5.0, 6.0)}, frozenset({"potter"}), (-3, 2, .1, 1, 1)))
    plain, terms = scorer.features("what a rotter he is")
    quoted, _ = scorer.features("the word rotter is old")
    marked, _ = scorer.features("it reads “a rotter” in print")
    aimed, _ = scorer.features("you utter rotter")
    missed, _ = scorer.features("a rottter indeed")
    assert terms == ["rotter"] and plain[0] > 0 and quoted[0] == marked[0] == 0 and quoted[1] > 0 and marked[1] > 0
    assert aimed[2] > 0 and scorer.score(aimed) > scorer.score(plain) > scorer.score(quoted)
    assert 0 < missed[0] < plain[0]
    assert scorer.features("a potter")[0] == [0, 0, 0, 0] == scorer.features("")[0]
    assert scorer.features("rotter rotter")[0][0] == 5.0


def test_words_with_digits_and_signs():
    assert list(toxicity.spelt("st*pid,")) == ["st", "pid", "st*pid"]
    assert list(toxicity.spelt("(id1ot!)")) == ["id", "ot", "id1ot"]
    assert list(toxicity.spelt("word.")) == ["word"] and list(toxicity.spelt("2023-11-05")) == []
    assert list(toxicity.spelt("")) == [] and list(toxicity.spelt("a1" * 30)) == ["a"] * 30
    scorer = toxicity.Scorer(toxicity.Lexicon({t: (4.0, 5.0, 6.0) for t in ("idiot", "stupid", "scum")}))
    for word, term in (("id1ot", "idiot"), ("st*pid", "stupid"), ("stup1d!", "stupid"), ("scumm", "scum"), ("scom", "scum")):
        assert scorer.features(f"such a {word} here")[1] == [term], word
    assert scorer.features("the sum of 17 items, a b1 and st")[1] == ["scum"]  # one edit; clean texts tell of such words
    guarded = toxicity.Scorer(toxicity.Lexicon({"scum": (4.0, 5.0, 6.0)}, frozenset({"sum"})))
    assert guarded.features("the sum of 17 items")[1] == []


def test_a_fit_does_not_depend_on_partitioning(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    once = toxicity.fit(docs, labels)
    again = toxicity.fit(docs.unionByName(docs).repartition(7, "text"), labels.repartition(3))
    assert once.terms and once == again


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    lexicon = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, lexicon).select("doc_id", "score", "predicted", toxicity.is_held_out("doc_id")
                                                .alias("held_out")).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    toxic, clean = ([r for r in held if r["toxic"] == t] for t in (1, 0))
    assert sum(r["predicted"] for r in toxic) >= 0.9 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.03 * len(clean)
    rank = [(a["score"] > b["score"]) + (a["score"] == b["score"]) / 2 for a in toxic for b in clean]
    assert sum(rank) / len(rank) > 0.95


@pytest.mark.parametrize("kinds", [(), (0,), (1,)])
def test_without_both_labels_nothing_is_toxic(spark, kinds):
    docs = spark.createDataFrame([(i, "some words here", 0.5) for i in range(9)] + [(None, None, 0.1), (50, "", 0.1)],
                                 "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, k) for i in range(9) for k in kinds] + [(None, 1)], "doc_id long, toxic int")
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(rows) == 11 and all(r["predicted"] == 0 and 0 <= r["score"] < 0.1 for r in rows)
    assert toxicity.score(docs.limit(0), toxicity.Lexicon()).count() == 0
    assert toxicity.clean_rows(docs, toxicity.Lexicon()).columns == docs.columns
