"""Incremental staging load as a Structured Streaming job over landed raw files.

The batch variant (``operators.incremental``) selects new raw rows by the
``_sdc_extracted_at`` high watermark. Here the file source itself tracks
which landed files were processed (in the checkpoint), and each micro-batch
is modelled and upserted by key with ``foreachBatch``. Run it with
``availableNow`` as a scheduled job or with a processing-time trigger as a
continuous one. Files may land in any order: of a row in the table and a row of the batch with the same key the
first by ``order``, the model's own order, stays, so the table equals a full build of the files seen so far. A
replayed micro-batch merges the same rows again, which changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from commitlake.operators.incremental import VersionedTable, stored
from commitlake.sources.schemas import ENVELOPE


def stream_upsert(spark: SparkSession, source_dir: str, model: Callable[[DataFrame], DataFrame],
                  table: VersionedTable, keys: list[str], checkpoint: str, order: list[Column], fmt: str = "parquet",
                  available_now: bool = True, processing_time: str | None = None):
    """Start the stream; with ``available_now`` it processes every unseen file, then stops and
    returns the table's newest version. Otherwise the running query is returned."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        staged = model(batch)
        first = not table.versions()
        if not first or table.cluster_by:              # read several times: by a merge, or by the sampling of a range sort
            staged = stored(staged, spark, f"stream-{batch_id}")
        if first:
            table.write(staged)
        else:
            table.merge(staged, keys, order)

    stream = spark.readStream.schema(ENVELOPE).format(fmt).load(source_dir)
    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if available_now:
        writer.trigger(availableNow=True).start().awaitTermination()
        return table.read()
    return writer.trigger(processingTime=processing_time or "1 minute").start()
