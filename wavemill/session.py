"""Spark session settings the jobs rely on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Export headers may differ only in case (``Status`` beside ``status``).
    "spark.sql.caseSensitive": "true",
    # HotSpot does not compile methods above 8,000 bytes. Projections of a wide contract exceed
    # that when fused into one method and run 4x faster outside whole-stage code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


# Can only be set when the session is made.
STATIC_SETTINGS = {
    # Call-site capture on every column expression triples the time to build a wide plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the run-time settings on a session that already exists."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """For the actions inside, the limit of ``SETTINGS`` on generated methods, whatever session the caller brings."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, SETTINGS[name])
    try:
        yield
    finally:
        spark.conf.set(name, before)


def get_session(app: str = "wavemill", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **STATIC_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
