"""New export files into bronze, each exactly once.

"Latest submission wins" needs the whole history of a cycle, so no state is
kept in the stream: it only lands rows. What they change in silver is settled
by ``silver_stream``, which is called with every batch that has landed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import config
from ..sinks import path_exists
from ..sources.digest import content_digests
from ..sources.exports import CSV_OPTIONS, FILE_HASH, export_schema, with_lineage, with_source_row
from ..sources.landing import plain_path


def ingest_new_files(spark: SparkSession, folder: str, headers: Sequence[str], cycle: str,
                     bronze: str, checkpoint: str, multiline: bool = True,
                     then: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Take whatever files are new in ``folder`` and stop.

    ``headers`` are the normalised headers of the export. Each batch owns the
    directory ``batch=<id>`` and replaces it when it is replayed after a
    failure, so no file is taken twice or lost. How far rows are numbered is
    kept beside it, a line a batch, so earlier rows are not read again.
    ``then`` is given the rows of every batch as they were landed.
    """
    numbers = f"{bronze}_numbers"
    stream = (spark.readStream.schema(export_schema(headers))
              .options(**CSV_OPTIONS, multiLine=multiline, header=True).csv(folder)
              .select("*", F.col("_metadata.file_name").alias("_source_file"), "_metadata"))

    def land(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        files = [r[0] for r in batch.select("_metadata.file_path").distinct().collect()]  # of this batch
        if not files:
            return
        offset = 0
        if path_exists(session, numbers):
            earlier = session.read.schema("last long, batch long").parquet(numbers).where(F.col("batch") < batch_id)
            offset = earlier.agg(F.max("last")).first()[0] or 0
        hashed = content_digests(session, files).select(
            plain_path(F.col("path")).alias("_hashed"), F.col("sha256").alias(FILE_HASH))
        rows = with_source_row(batch, offset)
        rows = rows.join(hashed, plain_path(F.col("_metadata.file_path")) == F.col("_hashed")).drop(
            "_metadata", "_hashed", config.INDEX_COLUMN)
        target = f"{bronze}/batch={batch_id}"
        with_lineage(rows, cycle).write.mode("overwrite").parquet(target)
        last = session.read.parquet(target).agg(F.max("_source_row").alias("last"))
        last.write.mode("overwrite").parquet(f"{numbers}/batch={batch_id}")
        if then:
            then(session.read.parquet(target))

    return (stream.writeStream.foreachBatch(land).trigger(availableNow=True)
            .option("checkpointLocation", checkpoint).start())
