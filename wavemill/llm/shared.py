"""What several of the operators use: tables, the shared folder, small Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the text contracts: blank and the control characters from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"
#: Bytes of text that a Python task turns into one batch of results.
BATCH_BYTES = 2 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors share: under ``spark.checkpoint.dir``, else the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_stages"
    return f"{base.rstrip('/')}/wavemill-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` as checkpointed files: its lineage ends here and a lost executor costs no recomputation."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` and no other of them is called so, whatever the case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``BATCH_BYTES`` of ``text``; a longer row is a batch of its own."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > BATCH_BYTES:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each row; NULL as the empty text."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]
