"""The registered queries and the pipeline over whole small tables, against direct versions of their contracts."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from compare import compare, duck
from pyspark.sql import functions as F
from test_alignment import slow_groups
from test_lines import slow as slow_lines
from test_mixing import slow_targets
from test_simhash import closure, slow_fingerprint
from test_small_ops import slow_base, slow_counts
from test_substring import slow as slow_repeats

import __spark_entry__ as entry
import corpus_pipeline
from wavemill.llm import queries, toxicity
from wavemill.llm.shared import table

FOLDER = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    rows = table(spark, FOLDER, "documents").orderBy("doc_id").collect()
    return {r["doc_id"]: r for r in rows}


@pytest.fixture(scope="module")
def texts(docs):
    return {i: r["text"] for i, r in docs.items()}


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path(queries.WORD_TOKENIZER))


def result(spark, name):
    rows = queries.QUERIES[name](spark, FOLDER).collect()
    return {r["doc_id"]: r for r in rows} if "doc_id" in rows[0].asDict() else rows


def test_every_operator_is_registered_once():
    numbers = Counter(re.match(r"op(\d+)_", n)[1] for n in queries.QUERIES)
    assert numbers == {str(n): 1 for n in range(1, 14)}
    assert queries.QUERIES.keys() | {"pipeline"} <= entry.queries().keys()
    assert queries.ORACLE.keys() <= queries.QUERIES.keys()


@pytest.mark.parametrize("name", queries.ORACLE)
def test_sql_counterparts(spark, name):
    assert compare(spark, duck(FOLDER), queries.QUERIES[name], queries.ORACLE[name], FOLDER) == ""


def test_op1(spark, texts):
    got = result(spark, "op1_token_trie")
    assert {i: r["n_words"] for i, r in got.items()} == {i: len(t.encode().split()) for i, t in texts.items()}
    assert all(r["n_tokens"] >= r["n_words"] for r in got.values())


def test_op2(spark, texts, library):
    got = result(spark, "op2_bpe")
    for i, t in texts.items():
        ids = library.encode(t, add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == sha(" ".join(map(str, ids)))
        assert got[i]["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))


def test_op3(spark, texts):
    got = result(spark, "op3_line_runs")
    for i, kept, n, gone in slow_lines(list(texts.items())):
        assert (got[i]["n_lines"], got[i]["n_dropped"], got[i]["kept_sha256"]) == (n, gone, sha(kept))


def test_op4(spark, texts):
    got = result(spark, "op4_toxicity")
    assert got.keys() == texts.keys()
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in got.values())


def test_op5(spark, texts):
    got = result(spark, "op5_simhash")
    prints = {i: slow_fingerprint(t) for i, t in texts.items()}
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == prints
    assert all(re.fullmatch("[0-9a-f]{16}", r["fingerprint"]) for r in got.values())
    want = closure(sorted(texts), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert {i: r["component_id"] for i, r in got.items()} == want


def test_op6(spark, texts):
    for i, r in result(spark, "op6_quality").items():
        want = slow_counts(texts[i])
        assert [r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]] == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_op7(spark, texts):
    for i, r in result(spark, "op7_licenses").items():
        n, at, base = slow_base(texts[i])
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (n, len(at), ",".join(base))
        assert (r["first_word"], r["last_word"]) == ((min(at), max(at)) if at else (None, None))
        labels = r["labels"].split(",") if r["labels"] else []
        assert set(base) <= set(labels) and labels == sorted(set(labels))


def test_op8(spark, texts):
    got = result(spark, "op8_substring")
    for i, n, gone, kept in slow_repeats(sorted(texts.items()), 20):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (n, gone, sha(kept))


def test_op9(spark, docs):
    got = result(spark, "op9_mix")
    sizes, taken = Counter(), Counter()
    for i, r in got.items():
        assert r["size"] == len(docs[i]["text"].encode().split()) and 0 <= r["taken"] <= 2 * r["size"]
        sizes[docs[i]["source"]] += r["size"]
        taken[docs[i]["source"]] += r["taken"]
    want = slow_targets(dict(sizes))
    for i, r in got.items():
        assert r["source_size"] == sizes[docs[i]["source"]] and abs(r["target"] - want[docs[i]["source"]]) < 1e-6
    assert all(abs(taken[s] - want[s]) <= 128 for s in want)


def test_op10(spark):
    rows = result(spark, "op10_pivots")
    per = defaultdict(list)
    for r in rows:
        per[r["query_id"]].append(r["rank"])
    assert all(i % 50 == 0 and sorted(ranks) == [1, 2, 3, 4, 5] for i, ranks in per.items())


def test_op11(spark, texts):
    got = result(spark, "op11_alignment")
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(queries.tokenizer_path(queries.BYTE_TOKENIZER))
    a.encode_special_tokens = True
    both = (a, SentencePieceProcessor(model_file=queries.tokenizer_path(queries.PIECES)))
    each = {i: slow_groups(both, t) for i, t in texts.items()}
    total = Counter((x[p], y[q]) for x, y, cuts, _ in each.values() for p, q in cuts)
    top = Counter()
    for (_, y), n in total.items():
        top[y] = max(top[y], n)
    for i, (x, y, cuts, spelt) in each.items():
        links = [(x[p], y[q]) for p, q in cuts]
        assert [got[i][c] for c in ("n_a", "n_b", "n_groups", "n_links")] == [len(x), len(y), len(cuts), len(cuts)]
        assert got[i]["count_sum"] == sum(total[p] for p in links)
        assert got[i]["n_best"] == sum(total[p] == top[p[1]] for p in links)
        assert got[i]["groups_sha256"] == (sha(spelt) if spelt else "")


def test_op12(spark, texts):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=queries.tokenizer_path(queries.PIECES))
    got = result(spark, "op12_piece_table")
    for i, t in texts.items():
        ids = library.encode(t)
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(ids), sha(",".join(map(str, ids))))
        assert got[i]["decoded_sha256"] == sha(library.decode(ids))


def test_pipeline_stage_by_stage(spark, tmp_path, library):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "encoding"]
    raw = table(spark, FOLDER, "documents")
    kept, stages = raw, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept, FOLDER).write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        stages[name] = kept.collect()
        if name != "encoding":
            assert kept.dtypes == raw.dtypes
    lexicon = toxicity.fit(raw, table(spark, FOLDER, "labels"))
    scorer = toxicity.Scorer(lexicon)
    clean = {r for r in raw.collect() if scorer.score(scorer.features(r["text"])[0]) < 0.7}
    assert set(stages["toxicity"]) == clean
    lines = {i: t for i, t, _, _ in slow_lines([(r["doc_id"], r["text"]) for r in clean])}
    assert {r["doc_id"]: r["text"] for r in stages["line_dedup"]} == lines
    prints = {i: slow_fingerprint(t) for i, t in lines.items()}
    groups = closure(sorted(lines), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert sorted(r["doc_id"] for r in stages["near_dedup"]) == sorted(set(groups.values()))
    sizes, taken = Counter(), Counter()
    for r in stages["near_dedup"]:
        sizes[r["source"]] += len(r["text"].split())
    each = Counter()
    for r in stages["mixing"]:
        taken[r["source"]] += len(r["text"].split())
        each[r["doc_id"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert all(abs(taken[s] - t) <= 128 for s, t in slow_targets(dict(sizes)).items())
    assert all(n <= 2 * len(lines[i].split()) for i, n in each.items())
    encoded = sorted((r["doc_id"], r["ids_sha256"], r["decoded_sha256"], tuple(r["token_ids"])) for r in stages["encoding"])
    want = []
    for r in stages["mixing"]:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        want.append((r["doc_id"], sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)), tuple(ids)))
    assert encoded == sorted(want)
    assert corpus_pipeline.run(spark, FOLDER).agg(F.count("*")).first()[0] == len(want)
