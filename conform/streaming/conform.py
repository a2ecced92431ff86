"""Conform as a stream: whatever load reaches the raw tables, by batch or by stream, is conformed by the jobs' own code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.context import RunContext
from conform.plans.jobs import Layout, pipe_conform
from conform.sources.tables import _folders
from conform.spec import SourceSpec
from conform.streaming.ingest import FILE_SCHEMA


def touched_batches(files: DataFrame) -> list[tuple[str, str]]:
    """(batch_date, raw table) pairs of new files, oldest batch first; at most one for each batch and table."""
    part = F.regexp_extract("path", r"/([^/]+)/utility_id=[^/]+/batch_date=([^/]+)/", 2).alias("day")
    table = F.regexp_extract("path", r"/([^/]+)/utility_id=[^/]+/batch_date=([^/]+)/", 1).alias("name")
    return sorted(tuple(r) for r in files.select(part, table).where("day <> ''").distinct().collect())


def stream_conform(spark: SparkSession, specs: Sequence[SourceSpec], layout: Layout, checkpoint: str, ctx: RunContext,
                   max_files_per_trigger: int = 10_000) -> dict:
    """Conform every batch that got new raw files since the last run, then stop.

    The stream carries the names of the raw tables' files, not their rows: a feeder's capacity is an aggregate over its whole batch, so
    a batch that gained a micro-batch is conformed again as a whole by ``pipe_conform``, as if it had been dropped at once.
    Batches go oldest first with ``only_newer``, so one that comes late or again doesn't overwrite newer rows. An upsert
    of the same rows changes nothing, so an epoch that is replayed after a failure, or a stream that starts over
    with a new checkpoint, ends in the same tables. A source takes part once all its datasets have a raw table.
    """
    pattern = f"{layout.raw.rstrip('/')}/*/utility_id=*/batch_date=*/load=*"
    files = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("maxFilesPerTrigger", str(max_files_per_trigger))
             .load(pattern).select("path"))
    done: list[str] = []

    def _write(df: DataFrame, epoch_id: int):
        there = set(_folders(spark, layout.raw))
        ready = {f"{s.source_id}_{ds}": s for s in specs for ds in s.datasets if all(f"{s.source_id}_{x}" in there for x in s.datasets)}
        by_day: dict[str, dict[str, SourceSpec]] = {}
        for day, name in touched_batches(df):
            if name in ready:
                by_day.setdefault(day, {})[ready[name].source_id] = ready[name]
        for day, own in sorted(by_day.items()):
            batch = RunContext.for_batch(day, ctx.pipeline_run_id, ctx.ingestion_ts)
            pipe_conform(spark, [s for s in specs if s.source_id in own], layout, batch, only_newer=True)
            done.append(day)

    q = files.writeStream.foreachBatch(_write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return {"batches": done}
