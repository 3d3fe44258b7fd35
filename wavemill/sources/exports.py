"""Wide CSV exports to bronze: text only, headers as they are, every row numbered."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions import derive
from ..functions.text import normalize_header
from ..operators.harmonize import quoted

CSV_OPTIONS = {"escape": '"', "quote": '"', "mode": "PERMISSIVE", "maxColumns": "200000",
        "maxCharsPerColumn": "-1"}


def distinct_headers(names: Sequence[str | None]) -> list[str]:
    """Repeated headers get ``.1``, ``.2`` ...; a missing one is ``Unnamed: <position>``."""
    named = [n if n else f"Unnamed: {i}" for i, n in enumerate(names)]
    taken, uses, out = set(named), Counter(), []
    for name in named:
        if uses[name]:
            number = uses[name]
            while f"{name}.{number}" in taken:
                number += 1
            uses[name] = number + 1
            name = f"{name}.{number}"
            taken.add(name)
        uses[name] += 1
        out.append(name)
    return out


def normalized_headers(names: Sequence[str]) -> list[str]:
    """White space collapsed; two headers that become equal are an error."""
    out = [normalize_header(n) for n in names]
    clashes = [n for n, k in Counter(out).items() if k > 1]
    if clashes:
        raise ValueError(f"header normalisation collision {clashes}")
    return out


def raw_headers(spark: SparkSession, path: str) -> list[str]:
    """The header record, read by the same CSV reader as the rows (cells may span lines)."""
    first = spark.read.options(**CSV_OPTIONS, multiLine=True, header=False).csv(path).head()
    if first is None:
        raise ValueError(f"no header in {path}")
    return distinct_headers(list(first))


def with_source_row(df: DataFrame, offset: int = 0) -> DataFrame:
    """Add ``_source_row``: 1..N in file order, files in path order.

    Rows are numbered inside their file block, where they are read in order;
    counts per block give each block its start. A window sees one row per
    block, never per record, and splitting large files is allowed.
    """
    located = df.select("*", F.col("_metadata.file_path").alias("_path"),
                        F.col("_metadata.file_block_start").alias("_block"),
                        F.monotonically_increasing_id().alias("_pos"))
    blocks = (located.groupBy("_path", "_block")
              .agg(F.min("_pos").alias("_first"), F.count("*").alias("_n")))
    before = F.sum("_n").over(Window.orderBy("_path", "_block")) - F.col("_n")
    blocks = blocks.withColumn("_before", before).drop("_n")
    return (located.join(blocks, ["_path", "_block"])
            .withColumn("_source_row",
                        F.col("_before") + F.col("_pos") - F.col("_first") + 1 + offset)
            .drop("_path", "_block", "_pos", "_first", "_before"))


def export_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_export(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Text columns under their normalised headers plus ``_source_row`` and ``_source_file``.

    Only the empty cell is NULL; ``NA`` stays text. ``multiline=False`` lets
    Spark split files whose cells never contain line breaks.
    """
    unique = raw_headers(spark, path)
    names = normalized_headers([n for n in unique if n != config.INDEX_COLUMN])
    columns = iter(names)
    stored = [n if n == config.INDEX_COLUMN else next(columns) for n in unique]
    df = (spark.read.schema(export_schema(stored))
          .options(**CSV_OPTIONS, multiLine=multiline, header=True).csv(path))
    df = df.select("*", F.col("_metadata.file_name").alias("_source_file"), "_metadata")
    return with_source_row(df).drop("_metadata", config.INDEX_COLUMN)


FILE_HASH = "_file_sha256"


def with_lineage(export: DataFrame, cycle: str, sha256: str | None = None) -> DataFrame:
    """Lineage columns in front, content hash over the export's own columns.

    Rows of several files carry their file's hash themselves, as ``FILE_HASH``.
    """
    own = [c for c in export.columns if c not in ("_source_row", "_source_file", FILE_HASH)]
    sha = F.col(FILE_HASH) if sha256 is None else F.lit(sha256)
    return export.select(
        F.lit(cycle).alias("_survey_cycle"), "_source_file", sha.alias("_source_sha256"),
        F.col("_source_row").cast("bigint").alias("_source_row"),
        derive.row_hash([F.col(quoted(c)) for c in own]).alias("_row_hash"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("_ingested_at"),
        *[F.col(quoted(c)) for c in own])


def bronze_path(lake: str, cycle: str, sha256: str) -> str:
    return f"{lake}/bronze/cycle={cycle}/v={sha256[:12]}"


def read_bronze(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*[F.col(quoted(c)) for c in columns])


def headers_frame(spark: SparkSession, headers: dict[str, Sequence[str]]) -> DataFrame:
    """(survey_cycle, header, position) of every export."""
    rows = [(cycle, name, i) for cycle, names in headers.items() for i, name in enumerate(names)]
    return config.literal_frame(
        spark, rows, "survey_cycle string, header string, position int")
