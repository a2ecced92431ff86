"""Conform by a stream over the raw tables: the batch chain's result, whatever is replayed."""

from __future__ import annotations

from conform.context import RunContext
from conform.plans.jobs import Layout, pipe_conform, pipe_raw
from conform.sources.tables import read_table
from conform.spec import UTILITY1, UTILITY2
from conform.streaming import stream_conform
from conform.streaming.conform import touched_batches

from conftest import DROP, write_drop

TABLES = ("dim_feeder", "fact_der")


def content(spark, layout):
    return {t: sorted((tuple(sorted(r.asDict().items(), key=lambda x: x[0])) for r in read_table(spark, layout.conformed_table(t)).collect()), key=str) for t in TABLES}


def test_stream_equals_the_batch_chain_and_replays_change_nothing(spark, tmp_path):
    ctx = RunContext.for_batch("2026-04-01", "run-a")
    landing = write_drop(tmp_path / "landing", DROP)
    batch, stream = (Layout(f"{tmp_path}/{n}/raw", f"{tmp_path}/{n}/conformed", f"{tmp_path}/{n}/serving", fact_buckets=2) for n in ("batch", "stream"))
    pipe_raw(spark, [UTILITY1, UTILITY2], landing, batch, ctx)
    pipe_conform(spark, [UTILITY1, UTILITY2], batch, ctx)
    pipe_raw(spark, [UTILITY1, UTILITY2], landing, stream, ctx)
    run = lambda ckpt: stream_conform(spark, [UTILITY1, UTILITY2], stream, f"{tmp_path}/{ckpt}", ctx)["batches"]
    assert run("c1") == ["2026-04-01"]
    want = content(spark, batch)
    assert content(spark, stream) == want and len(want["fact_der"]) == 10
    assert run("c1") == []                                            # nothing new
    assert run("c2") == ["2026-04-01"] and content(spark, stream) == want   # all epochs once more


def test_a_source_waits_for_all_its_datasets(spark, tmp_path):
    ctx = RunContext.for_batch("2026-04-01", "run-a")
    layout = Layout(f"{tmp_path}/raw", f"{tmp_path}/conformed", f"{tmp_path}/serving", fact_buckets=2)
    landing = write_drop(tmp_path / "landing", DROP)
    pipe_raw(spark, [UTILITY2], landing, layout, ctx)
    assert stream_conform(spark, [UTILITY1, UTILITY2], layout, f"{tmp_path}/c", ctx)["batches"] == ["2026-04-01"]
    assert {r.utility_id for r in read_table(spark, layout.conformed_table("fact_der")).collect()} == {"utility2"}


def test_names_of_files_tell_the_batches(spark):
    names = ["s3a://lake/raw/u_a/utility_id=u/batch_date=2026-04-01/load=x/part-0.parquet", "/raw/u_a/utility_id=u/batch_date=2026-04-01/load=y/part-0.parquet",
             "/raw/u_b/utility_id=u%3A1/batch_date=2026-03-01/load=y/part-0.parquet", "/raw/u_b/_SUCCESS"]
    assert touched_batches(spark.createDataFrame([(n,) for n in names], "path string")) == [("2026-03-01", "u_b"), ("2026-04-01", "u_a")]
