"""Which source files are new: content fingerprints against a stored manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import literal_frame
from ..sinks import append_manifest, path_exists
from .digest import content_digests

MANIFEST_SCHEMA = ("survey_cycle string, kind string, file string, path string, sha256 string, "
                   "bytes bigint, status string, seen_at timestamp")


def plain_path(path: Column) -> Column:
    """A path without scheme and authority, as both a caller and the file system may write them."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/)", "")


def fingerprints(spark: SparkSession, sources: DataFrame) -> DataFrame:
    """``sources``: survey_cycle, kind, path. Adds file, bytes and sha256; files belong to their whole path.

    Files are opened and hashed by Spark's own readers, so any file system that they know will do, and files of
    any size. The list of sources is configuration: two files a cycle.
    """
    paths = [r.path for r in sources.select("path").distinct().collect()]
    hashed = (content_digests(spark, paths)
              .select(plain_path(F.col("path")).alias("_path"), "path", "bytes", "sha256",
                      F.element_at(F.split("path", "/"), -1).alias("file")))
    wanted = sources.select("survey_cycle", "kind", plain_path(F.col("path")).alias("_path"))
    return hashed.join(wanted, "_path").select("survey_cycle", "kind", "file", "path", "sha256", "bytes")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return literal_frame(spark, [], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).json(path)


def land(spark: SparkSession, sources: DataFrame, manifest: str) -> DataFrame:
    """Record every file seen now as ``landed`` or ``unchanged``; returns this run's entries."""
    current = fingerprints(spark, sources)
    known = (read_manifest(spark, manifest).select("survey_cycle", "kind", "sha256").distinct()
             .withColumn("_known", F.lit(True)))
    entries = (current.join(known, ["survey_cycle", "kind", "sha256"], "left")
               .withColumns({"status": F.when(F.col("_known"), "unchanged").otherwise("landed"),
                             "seen_at": F.current_timestamp()})
               .select(*[f.split()[0] for f in MANIFEST_SCHEMA.split(", ")]))
    # Two files per cycle, as configured: fixed here, so that hashing and clock are not asked twice.
    entries = spark.createDataFrame(entries.toArrow(), entries.schema)
    append_manifest(entries, manifest)
    return entries


def new_files(entries: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose content no earlier manifest entry has."""
    return entries.join(manifest, ["survey_cycle", "kind", "sha256"], "left_anti")


def latest_versions(manifest: DataFrame) -> DataFrame:
    """The version each cycle and kind currently points at: the one seen last."""
    return (manifest.groupBy("survey_cycle", "kind")
            .agg(F.max_by(F.struct("sha256", "path", "file"), "seen_at").alias("v"))
            .select("survey_cycle", "kind", "v.sha256", "v.path", "v.file"))
