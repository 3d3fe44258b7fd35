"""Line deduplication with levelled sorted runs of line hashes.

Documents come in batches, those with the largest ids first. A batch's lines become 128-bit hashes of their
keys, reduced to one row a hash and sorted. A merge anti-join with the runs that are there finds the hashes
nobody has had: they form a new run with the document that holds them, the rest are counts for older hashes.
Runs of a level are merged into one of the next as soon as there are ``FANOUT``, so a hash that is looked up
meets a number of runs that grows with the logarithm of the batches. What occurs in enough documents is then
dropped from all but the one that holds it.

Rows: a NULL or empty text is one empty line; rows are documents of their own, also if they share an id, and
of those with the largest id all keep their lines; a row without an id keeps its lines and does not count; an
empty table gives an empty table. Other columns stay; ``n_lines`` and ``n_dropped`` are replaced if present.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavemill.llm.shared import cut, drop_folder, fresh, raw_texts, shared_folder, slices

#: Runs of one level that are merged into one of the next.
FANOUT = 2
#: Batches that a whole table is taken in.
BATCHES = 3
_STRIP = b" \t\n\x0b\x0c\r"
_KEY = ["h1", "h2"]


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key, or None if the key is too short to be looked at."""
    from xxhash import xxh3_128_digest

    key = line.strip(_STRIP).lower()  # of bytes: A-Z only
    if len(key) < min_chars or not key.isascii() and len(key.decode()) < min_chars:
        return None
    return xxh3_128_digest(key)


def line_hashes(df: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """(``h1``, ``h2``, ``doc``): each row's distinct line hashes."""
    kind = df.schema[doc_id].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            hashes, counts = [], []
            for whole in raw_texts(batch.column(text)):
                found = {line_hash(line, min_chars) for line in whole.split(b"\n")} - {None}
                hashes += found
                counts.append(len(found))
            both = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            rows = np.repeat(np.arange(batch.num_rows), counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1]), batch.column(doc_id).take(pa.array(rows))],
                ["h1", "h2", "doc"])

    fields = [T.StructField(k, T.LongType()) for k in _KEY] + [T.StructField("doc", kind)]
    return df.select(doc_id, text).where(F.col(doc_id).isNotNull()).mapInArrow(run, T.StructType(fields))


class LineRuns:
    """The sorted runs of all batches so far, as tables in one shared folder.

    A run's rows with ``fresh`` are hashes that no earlier run has; the others only add to a count.
    """

    SCHEMA = "h1 long, h2 long, n long, holder long, fresh boolean"

    def __init__(self, spark: SparkSession, folder: str, fanout: int = FANOUT):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.levels: list[list[str]] = [[]]
        self.written: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        path = f"{self.folder}/run-{len(self.written):05d}"
        self.written.append(path)
        rows.sortWithinPartitions("fresh", *_KEY).write.partitionBy("fresh").parquet(path)
        return path

    def _read(self, paths: list[str]) -> DataFrame:
        tables = [self.spark.read.schema(self.SCHEMA).parquet(p) for p in paths]
        return reduce(DataFrame.unionByName, tables)

    def add(self, batch: DataFrame) -> None:
        """Take in a batch of (``h1``, ``h2``, ``doc``) whose ids lie below those of all earlier batches."""
        own = batch.groupBy(*_KEY).agg(F.count("*").alias("n"), F.max("doc").cast("long").alias("holder"))
        runs = [p for level in self.levels for p in level]
        if runs:  # one merge join tells both sides of the anti-join apart
            known = self._read(runs).where("fresh").select(*_KEY, F.lit(True).alias("known"))
            own = own.join(known.hint("merge"), _KEY, "left").select(*own.columns, F.isnull("known").alias("fresh"))
        else:
            own = own.withColumn("fresh", F.lit(True))
        self.levels[0].append(self._write(own))
        self._compact()

    def _compact(self) -> None:
        for i, level in enumerate(self.levels):
            if len(level) >= self.fanout:
                if i + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[i + 1].append(self._write(self._read(level).where("fresh").repartition(*_KEY)))
                for path in level:
                    drop_folder(self.spark, f"{path}/fresh=true")
                self.levels[i] = []

    def frequent(self, min_docs: int) -> DataFrame:
        """(``h1``, ``h2``, ``holder``) of the hashes that at least ``min_docs`` documents have."""
        if not self.written:
            return self.spark.createDataFrame([], "h1 long, h2 long, holder long")
        rows = self._read(self.written)
        return rows.groupBy(*_KEY).agg(F.sum("n").alias("n"), F.max("holder").alias("holder")).where(
            F.col("n") >= min_docs).select(*_KEY, "holder")


def drop_repeated_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 20,
                        min_docs: int = 3, batches: int = BATCHES) -> DataFrame:
    """``df`` with the lines dropped from its text, and ``n_lines`` (before) and ``n_dropped`` beside it."""
    spark = df.sparkSession
    df = df.drop("n_lines", "n_dropped")
    folder = shared_folder(spark)
    line_hashes(df, doc_id, text, min_chars).write.parquet(f"{folder}/lines")
    lines = spark.read.parquet(f"{folder}/lines")
    runs = LineRuns(spark, folder)
    ends = lines.agg(F.percentile_approx("doc", [i / batches for i in range(1, batches)])).first()[0] or []
    upper = None
    for end in [*sorted(set(ends), reverse=True), None]:
        within = F.lit(True) if upper is None else F.col("doc") <= upper
        runs.add(lines.where(within if end is None else within & (F.col("doc") > end)))
        upper = end
    common = cut(runs.frequent(min_docs))  # a table of its own, so that a hot line's join can be split
    dropped = lines.join(common, _KEY).where("doc <> holder")
    listed = cut(dropped.groupBy("doc").agg(F.flatten(F.collect_list(F.array(*_KEY))).alias("_drops")))
    drop_folder(spark, folder)  # all that is needed of it has been written
    name, drops = fresh(df, "_doc", "_drops")
    marked = df.join(listed.toDF(name, drops), F.col(doc_id) == F.col(name), "left").drop(name)
    return _apply(marked, df.schema, text, min_chars, drops)


def _apply(df: DataFrame, schema: T.StructType, text: str, min_chars: int, listed: str) -> DataFrame:
    """Drop each row's lines whose hash is ``listed``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            texts, before, gone = batch.column(text).to_pylist(), [], []
            for i, drops in enumerate(batch.column(listed).to_pylist()):
                whole = (texts[i] or "").encode()
                before.append(whole.count(b"\n") + 1)
                gone.append(0)
                if drops:
                    hashes = {h.tobytes() for h in np.array(drops, "<i8").reshape(-1, 2)}
                    kept = [x for x in whole.split(b"\n") if line_hash(x, min_chars) not in hashes]
                    gone[i] = before[i] - len(kept)
                    texts[i] = b"\n".join(kept).decode()
            new = {text: pa.array(texts, pa.string()), "n_lines": pa.array(before, pa.int64()),
                   "n_dropped": pa.array(gone, pa.int64())}
            names = [*schema.names, "n_lines", "n_dropped"]
            yield pa.RecordBatch.from_arrays([new[n] if n in new else batch.column(n) for n in names], names)

    return df.mapInArrow(run, T.StructType([*schema, T.StructField("n_lines", T.LongType()),
                                            T.StructField("n_dropped", T.LongType())]))
