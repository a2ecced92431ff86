"""Run context and audit columns."""

from __future__ import annotations

from datetime import date, datetime

import pytest

from conform.context import RunContext, audit_stamp


def test_audit_columns_constant(spark):
    ctx = RunContext("run-1", date(2026, 4, 1), datetime(2026, 4, 1, 6, 0))
    df = audit_stamp(spark.createDataFrame([(1,), (2,)], "x int"), ctx)
    rows = df.collect()
    assert {"pipeline_run_id", "batch_date", "ingestion_ts"} <= set(df.columns)
    assert df.select("pipeline_run_id").distinct().count() == 1
    assert {(r.pipeline_run_id, r.batch_date, r.ingestion_ts) for r in rows} == {
        ("run-1", date(2026, 4, 1), datetime(2026, 4, 1, 6, 0))}


def test_context_defaults_and_immutability():
    a, b = RunContext(), RunContext()
    assert a.pipeline_run_id != b.pipeline_run_id
    with pytest.raises(Exception):
        a.pipeline_run_id = "x"   # frozen
    assert RunContext.for_batch("2026-03-01").batch_date == date(2026, 3, 1)
    assert isinstance(RunContext.for_batch("").batch_date, date)


def test_keep_batch_date(spark):
    ctx = RunContext("r", date(2026, 4, 1))
    df = spark.createDataFrame([(date(2025, 1, 1),)], "batch_date date")
    assert audit_stamp(df, ctx, keep_batch_date=True).first().batch_date == date(2025, 1, 1)
    assert audit_stamp(df, ctx).first().batch_date == date(2026, 4, 1)


def test_unknown_source_is_an_error():
    from conform.spec import specs_for
    with pytest.raises(KeyError):
        specs_for(["utility1", "utility9"])
