"""Incremental work as Structured Streaming: new files in, idempotent upserts out, one run over what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sessions import SESSION, dirty_sessions, whole_sessions
from ..plans.pipeline import Pipeline
from ..sources.store import Table


def publish_available(landing: Table, serving: Table, pipeline: Pipeline, checkpoint: str, clock) -> None:
    """Process all sessions that have rows in files not seen before, and stop (Trigger.AvailableNow).

    A micro-batch gives dirty keys only; whole sessions are read from the buckets of their jobs. Rewritten buckets are
    new files, so their sessions are dirty again, and publishing them again changes nothing but the publish time; a
    batch that is repeated after a failure does the same.
    """

    def handle(batch: DataFrame, _: int) -> None:
        keys = dirty_sessions(batch.select(*SESSION))
        rows = whole_sessions(landing.read(landing.buckets_of(keys)), keys).drop("bucket")
        serving.upsert(pipeline.process(rows).records(), clock(), everywhere=False)

    stream = landing.spark.readStream.table(landing.name)
    stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def buffered_append(stream: DataFrame, table: Table, checkpoint: str, now_ms) -> None:
    """Append a stream's rows in micro-batches, each one append to the table."""

    def handle(batch: DataFrame, _: int) -> None:
        table.append(batch, now_ms())

    stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def late_rows(changes: DataFrame, committed: DataFrame) -> DataFrame:
    """Rows at or before their bucket's committed time that arrive only now: what an incremental run would miss."""
    return changes.join(F.broadcast(committed.select("bucket", "committed_until_ms")), "bucket").where("source_updated_at <= committed_until_ms")
