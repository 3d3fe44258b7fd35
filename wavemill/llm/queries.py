"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavemill.llm import (
    alignment, bpe, collocations, licenses, line_runs, mixing, piece_table, pivot_index, quality, simhash_ball, substring,
    token_trie, toxicity)
from wavemill.llm.shared import table

#: The public tokenizer of the encoding query, a file name in the installed tokenizer folder.
WORD_TOKENIZER = "word_bpe_49k.json"
#: The public vocabulary whose pieces are counted.
PIECES = "piece_bpe_32k.model"
#: The public byte-level tokenizer that is aligned with those pieces.
BYTE_TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_token_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, tokens and log-probability of every text in a unigram model."""
    return token_trie.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(PIECES))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again: counts and digests of both."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = tokenizer_path(WORD_TOKENIZER)
    return bpe.encode(docs, path, decoded=True).select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of three documents or more stay in the one with the largest id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_runs.drop_repeated_lines(docs, min_chars=20, min_docs=3).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learned from the labels of rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, lexicon, threshold=0.7).select(
        "doc_id", toxicity.is_held_out("doc_id").alias("held_out"), "score", "predicted",
        F.array_join("toxic_terms", " ").alias("terms"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of three-word shingles, linked at two bits or fewer, with their components."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_ball.components(docs, radius=2, words=3).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text, the base rules, and the verdict of the rules' estimated accuracies."""
    return quality.judged(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", *quality.COUNTS, "base_failed", "kept", "quality")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every text."""
    places = F.col("base_places")
    return licenses.scanned(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"), F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"), F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that no earlier repeat of 20 words or more covers."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.drop_repeats(docs, window=20).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes, and its source's target."""
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op10_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest others found for every vector whose id is divisible by 50."""
    return pivot_index.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"),
                              lambda i: i % 50 == 0, k=5)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers over every text, and how common its links are in the corpus."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.link_counts(docs, tokenizer_path(BYTE_TOKENIZER), tokenizer_path(PIECES))


def op12_piece_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded into pieces and decoded again: counts and digests of both."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_table.encode(docs, tokenizer_path(PIECES), decoded=True).select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 phrases of two to four words that hold together best, in every language."""
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    return collocations.collocations(docs, least=30, longest=4, top=2000, absorbed=80)


QUERIES = {f.__name__: f for f in (
    op1_token_trie, op2_bpe, op3_line_runs, op4_toxicity, op5_simhash, op6_quality, op7_licenses, op8_substring, op9_mix,
    op10_pivots, op11_alignment, op12_piece_table, op13_collocations)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _grams(words: int) -> str:
    return (f"SELECT lang, {words} AS size, unnest(list_transform(range(1, len(words) - {words} + 2), "
            f"lambda i: array_to_string(words[i:i + {words - 1}], ' '))) AS phrase FROM pieces WHERE len(words) >= {words}")


ORACLE: dict[str, str] = {
    "op3_line_runs": f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM split
), keyed AS (
  SELECT *, translate(trim(line, {_BLANKS}), '{_UPPER}', '{_LOWER}') AS key FROM lines
), common AS (
  SELECT key, max(doc_id) AS holder FROM (SELECT DISTINCT doc_id, key FROM keyed WHERE length(key) >= 20)
  GROUP BY key HAVING count(*) >= 3
), judged AS (
  SELECT k.*, coalesce(c.holder <> k.doc_id, false) AS gone FROM keyed k LEFT JOIN common c USING (key)
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op13_collocations": f"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS low FROM documents
), cut AS (
  SELECT lang, unnest(string_split_regex(low, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts
), pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]'), lambda x: x <> '') AS words FROM cut
), f AS (
  SELECT lang, size, phrase, count(*) AS n
  FROM ({" UNION ALL ".join(map(_grams, range(1, 5)))}) GROUP BY lang, size, phrase
), totals AS (
  SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS words FROM f WHERE size >= 2 AND n >= 30
), cuts AS (
  SELECT c.*, k, array_to_string(words[1:k], ' ') AS head, array_to_string(words[k + 1:size], ' ') AS tail
  FROM candidates c, (VALUES (1), (2), (3)) v(k) WHERE k < size
), scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.k, h.n AS l, t.n AS r,
    CAST(CAST(c.a AS HUGEINT) * 2000000 // (h.n + t.n) AS BIGINT) AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = c.head JOIN f t ON t.lang = c.lang AND t.phrase = c.tail
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_parts AS (
  SELECT c.lang, c.a, array_to_string(words[i:i + s - 1], ' ') AS phrase
  FROM candidates c, (VALUES (2), (3)) v(s), (VALUES (1), (2), (3)) u(i) WHERE s < size AND i + s - 1 <= size
), covered AS (
  SELECT lang, phrase, max(a) AS over FROM inner_parts GROUP BY lang, phrase
), kept AS (
  SELECT w.* FROM weakest w LEFT JOIN covered c USING (lang, phrase)
  WHERE c.over IS NULL OR 100 * CAST(c.over AS HUGEINT) < 80 * CAST(w.a AS HUGEINT)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000""",
}
