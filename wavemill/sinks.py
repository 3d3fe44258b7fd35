"""Where results go. Commits are Spark's own: a path without a commit mark counts as absent."""

from __future__ import annotations

import hashlib
import json
import math
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import literal_frame


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below ``spark.checkpoint.dir``, else below the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_stages"
    return f"{base.rstrip('/')}/wavemill-{uuid.uuid4().hex}"


def is_committed(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_SUCCESS")


def write_once(df: DataFrame, path: str) -> bool:
    """Write unless this version is there already; the leftovers of a failed write are replaced."""
    if is_committed(df.sparkSession, path):
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Replace a table and read it back, which also ends the lineage of what follows."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_layout(df: DataFrame, path: str, order: list[str]) -> DataFrame:
    """Replace a table stored in sorted ranges, so reads of a range skip most files."""
    return write_table(df.repartitionByRange(*order).sortWithinPartitions(*order), path)


#: Rows that a bucket of a table is meant to hold.
BUCKET_ROWS = 2_000_000
#: What a bucketed table keeps beside its files, so that other sessions can read it by buckets too.
_BUCKETS = "_buckets"


def bucket_number(rows: int) -> int:
    """Buckets of a table of so many rows, a power of two and 4 at least."""
    return 1 << max(2, math.ceil(math.log2(max(1.0, rows / BUCKET_ROWS))))


def table_name(spark: SparkSession, path: str) -> str:
    """What a table stored at ``path`` is called in the catalog: tables of two lakes never share a name."""
    whole = qualified(spark, path)
    return f"{whole.rstrip('/').split('/')[-1]}_{hashlib.sha256(whole.encode()).hexdigest()[:12]}"


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme and authority, as Spark's readers report it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def in_buckets(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` with each bucket's rows together; one whose key is very common is split over tasks by the adaptive plan."""
    return df.hint("rebalance", buckets, key)


def write_buckets(df: DataFrame, path: str, key: str, order: Sequence[str], buckets: int,
                  partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace a table stored in buckets of ``key``: joins and aggregates on it need no shuffle when it is read.

    Rows are written where they lie, so ``df`` should come from ``in_buckets`` or have been grouped by ``key`` over
    bucketed tables; otherwise each task writes a file into every bucket.
    """
    spark = df.sparkSession
    name, whole = table_name(spark, path), qualified(spark, path)
    writer = (df.write.mode("overwrite").format("parquet").option("path", whole)
              .bucketBy(buckets, key).sortBy(*order))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    spec = {"key": key, "order": list(order), "buckets": buckets, "partition_by": list(partition_by),
            "schema": spark.table(name).schema.json()}
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{whole}/{_BUCKETS}")
    out = mark.getFileSystem(spark._jsc.hadoopConfiguration()).create(mark, True)
    out.write(bytearray(json.dumps(spec).encode()))
    out.close()
    return spark.table(name)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table, by its buckets if it was written in buckets, in whatever session."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_BUCKETS}")
    if not path_exists(spark, str(mark)):
        return spark.read.parquet(path)
    name = table_name(spark, path)
    if not spark.catalog.tableExists(name):
        stream = mark.getFileSystem(spark._jsc.hadoopConfiguration()).open(mark)
        spec = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
        _attach(spark, name, qualified(spark, path), spec)
    return spark.table(name)


def _attach(spark: SparkSession, name: str, path: str, spec: dict) -> None:
    """Tell this session's catalog of a bucketed table that another one has written."""
    fields = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(spec["schema"]).toDDL()
    quoted = lambda names: ", ".join(f"`{n}`" for n in names)
    parts = f"PARTITIONED BY ({quoted(spec['partition_by'])})" if spec["partition_by"] else ""
    spark.sql(f"CREATE TABLE `{name}` ({fields}) USING parquet {parts} CLUSTERED BY (`{spec['key']}`) "
              f"SORTED BY ({quoted(spec['order'])}) INTO {spec['buckets']} BUCKETS LOCATION '{path}'")
    if parts:
        spark.catalog.recoverPartitions(name)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


RUN_SCHEMA = ("run_id string, task string, status string, attempt int, seconds double, "
              "output string")


def append_runs(spark: SparkSession, rows: list[tuple], path: str) -> None:
    """Run metrics: one row per finished task, never rewritten."""
    (literal_frame(spark, rows, RUN_SCHEMA).withColumn("logged_at", F.current_timestamp())
     .coalesce(1).write.mode("append").parquet(path))


def append_manifest(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("append").json(path)


def write_draft_csv(df: DataFrame, path: str, force: bool = False) -> None:
    """A mapping for a person to review: a config-sized file that is not replaced unasked."""
    mode = "overwrite" if force else "errorifexists"
    df.coalesce(1).write.mode(mode).csv(path, header=True, escape='"')
