"""Refresh on arrival of new source files (Structured Streaming instead of a cron poll).

A file-source stream over the movements folder acts as the trigger: every
micro-batch means "new movement files arrived", and ``foreachBatch`` runs the
staleness check and, if needed, the rebuild + publish on the whole tables.
The stream's checkpoint records which files were seen, so a restarted driver
continues where it stopped; the refresh itself is idempotent (an up-to-date
table is left alone), so a replayed batch is harmless.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.refresh import RefreshResult, refresh
from ..session import work_path
from ..sources.tables import Sources


def start_refresh_stream(spark: SparkSession, movements_path: str, load_sources: Callable[[], Sources],
                         root: str, interval: str | None = "1 hour", available_now: bool = False,
                         checkpoint: str | None = None,
                         on_result: Callable[[int, RefreshResult], None] | None = None,
                         **build_options) -> StreamingQuery:
    """Start the stream; ``interval`` is the processing-time trigger (``available_now``
    processes what is there and stops, for batch-style runs and tests)."""
    schema = spark.read.parquet(movements_path).schema
    arrivals = spark.readStream.schema(schema).parquet(movements_path).select("container_number")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        result = refresh(spark, load_sources(), root, **build_options)
        if on_result is not None:
            on_result(batch_id, result)

    writer = (arrivals.writeStream.foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint or work_path(spark, "streams", "refresh")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
