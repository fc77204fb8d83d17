"""Incremental landing of files dropped into a folder (K2 as a stream).

New CSV files in ``src`` are picked up by the file source, each micro-batch is landed as
its own run (``batch-<id>``) through the same guarded writer as batch loads, and the
stream stops once everything available is processed (``availableNow``). The run id is a
function of the batch id, so a batch replayed after a failure overwrites its own run
instead of duplicating rows; the checkpoint lives in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meridian.session import fresh_path
from meridian.sinks import landing


def land_micro_batch(root: str, asset: str):
    def _write(batch: DataFrame, batch_id: int) -> None:
        landing.land(batch, root, asset, f"batch-{batch_id:06d}")

    return _write


def land_csv_stream(spark: SparkSession, src: str, schema: str, root: str, asset: str,
                    checkpoint: str | None = None, max_files_per_trigger: int | None = None) -> None:
    """Land every CSV file under ``src`` (declared ``schema``) as runs of ``asset`` and return.

    As in a batch load, a value that does not fit its declared type, a record with another number of fields and
    a micro-batch of files without rows fail the stream; nothing of that batch is landed and the checkpoint
    stays before it.
    """
    reader = spark.readStream.schema(schema).option("header", True).option("escape", '"').option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(src)
    query = (
        stream.writeStream.foreachBatch(land_micro_batch(root, asset))
        .option("checkpointLocation", checkpoint or fresh_path(spark, f"ckpt-{asset}"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
