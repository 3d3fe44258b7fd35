"""Content digests of files, also of those that no cell of a table can hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Files up to this size are hashed as a whole: what Spark's reader for binary files can put into one cell.
WHOLE_BYTES = 2**31 - 2**16
#: Hashes that make one of the next level, and levels: enough for 6.9e10 lines under one top row of 4,096.
FANOUT, LEVELS = 4096, 3


def content_digests(spark: SparkSession, paths: Sequence[str], whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """(``path``, ``bytes``, ``sha256``) of every file.

    Files of at most ``whole_bytes`` get the SHA-256 of their bytes. Larger ones are read in splits, each line is
    hashed where it lies, and lines' hashes are hashed in groups of ``FANOUT`` by their number in the file, level
    by level; the digest is that of the top level and the file's size. So it is the same however the file was
    split, and changes with any byte, line order or missing last line break. Which of the two a file gets depends
    on its own size alone. A line has to fit into a cell. Empty files have no row, as Spark's readers pass them over.
    """
    sizes = spark.read.format("binaryFile").load(list(paths))  # contents are read only where they are asked for
    small = sizes.where(F.col("length") <= whole_bytes).select(
        "path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    large = sizes.where(F.col("length") > whole_bytes).select("path", F.col("length").alias("bytes"))
    names = [r.path for r in large.select("path").collect()]  # of the files that the caller named
    if not names:
        return small
    tree = tree_digests(spark, names)
    return small.unionByName(large.join(tree, "path").select(
        "path", "bytes", F.sha2(F.concat_ws(":", F.col("bytes").cast("string"), "top"), 256).alias("sha256")))


def tree_digests(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(``path``, ``top``): the top of the tree of hashes over each file's lines."""
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.sha2(F.col("value").cast("binary"), 256).alias("hash"))
    # Lines are in order inside a block of a file; the counts of the blocks before it say where it starts.
    blocks = lines.groupBy("path", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("path", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rows = lines.join(blocks, ["path", "block"]).select(
        "path", (F.col("before") + F.col("at") - F.col("first")).alias("n"), "hash")
    for _ in range(LEVELS):
        listed = F.array_sort(F.collect_list(F.struct("n", "hash")))
        rows = rows.groupBy("path", F.floor(F.col("n") / FANOUT).alias("up")).agg(
            F.sha2(F.array_join(F.transform(listed, lambda x: x["hash"]), ""), 256).alias("hash")).select(
            "path", F.col("up").alias("n"), "hash")
    listed = F.array_sort(F.collect_list(F.struct("n", "hash")))
    return rows.groupBy("path").agg(
        F.sha2(F.array_join(F.transform(listed, lambda x: x["hash"]), ""), 256).alias("top"))
