"""Incremental file ingest into the raw tables (Structured Streaming, run to completion)."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from conform.context import RunContext, audit_stamp
from conform.operators.quality import Check, staged_with_checks
from conform.sources.csv import csv_load
from conform.sources.tables import STREAM, load_batch

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def stream_ingest(
    spark: SparkSession,
    landing_dir: str,
    columns: Sequence[str] | None,
    source_id: str,
    table_path: str,
    checkpoint: str,
    ctx: RunContext,
    multiline: bool = False,
    max_files_per_trigger: int = 1000,
    checks: Sequence[Check] = (),
) -> dict:
    """Ingest files that arrived in ``landing_dir`` since the last run, then stop.

    The stream carries file names (their contents aren't read by it); each micro-batch reads its files as the
    batch path does, each under the names in its own header. With ``columns`` a file that lacks one of them stops
    the run. Same rows, columns and layout as the batch path, so both may fill the same raw table, in any order.

    The checkpoint records which files were read, so each file is ingested exactly once; a run with no new
    files writes nothing. ``availableNow`` processes the backlog in micro-batches of at most
    ``max_files_per_trigger`` files and ends. Each micro-batch is a load of its own, named by the stream's id
    and the epoch: one that is re-run after a failure replaces its own earlier attempt, and a stream that
    starts over with a new checkpoint doesn't touch what an earlier one wrote.

    ``checks`` are counted while a micro-batch is staged and settled before its load is written: rows that a ``drop`` check
    rejects stay out, and a failing ``fail`` check stops the run with no load left and the checkpoint not advanced, so the
    next run reads the same files again. The result holds the reports of all micro-batches.
    """
    files = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
             .option("maxFilesPerTrigger", str(max_files_per_trigger)).load(landing_dir).select("path"))
    batches: list[int] = []
    reports: list[dict] = []

    def _write(df: DataFrame, epoch_id: int):
        paths = sorted(r.path for r in df.collect())              # at most max_files_per_trigger names
        if not paths:
            return
        stream_id = json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first().value)["id"]

        def write(rows: DataFrame) -> None:
            rows = audit_stamp(rows, ctx)
            if checks:
                rows, report = staged_with_checks(rows, checks, "stream", table_path)
                reports.extend({"epoch": epoch_id, **r} for r in report)
            load_batch(rows, table_path, source_id, ctx.batch_date, f"{stream_id}-{epoch_id}", kind=STREAM)

        csv_load(spark, paths, write, multiline, columns, source_id)
        batches.append(epoch_id)

    q = (files.writeStream.foreachBatch(_write)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return {"micro_batches": len(batches), "checks": reports}
