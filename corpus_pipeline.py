"""A training corpus from raw documents: toxicity, line dedup, near-dedup, mixing, encoding.

Every stage takes what its predecessor kept, as Parquet in the folder that driver and executors share, and all
but the last return the columns of ``documents``. The toxicity model learns from the labelled rows among the
documents that it is given; the other stages need no table besides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavemill.llm import bpe, line_runs, mixing, simhash_ball, toxicity
from wavemill.llm.queries import WORD_TOKENIZER, tokenizer_path
from wavemill.llm.shared import drop_folder, shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go."""
    return toxicity.clean_rows(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of three documents or more stay in the one with the largest id; lengths are counted anew."""
    kept = line_runs.drop_repeated_lines(docs, min_chars=20, min_docs=3)
    return kept.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of fingerprints of three-word shingles, linked at two bits, the smallest id stays."""
    return simhash_ball.keep_one(docs, radius=2, words=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row for each time that a document is gone through."""
    return mixing.mixed_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, their number, and digests of the ids and of their decoding."""
    rows = bpe.encode(docs.select("doc_id", "source", "lang", "text"), tokenizer_path(WORD_TOKENIZER), decoded=True)
    return rows.select(
        "doc_id", "source", "lang", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("near_dedup", drop_near_copies),
          ("mixing", mix_sources), ("encoding", encode_texts)]

#: None: SQL expresses neither the learned scores nor fingerprints and encodings; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark)
    done = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if done:
            drop_folder(spark, done)
        done = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
