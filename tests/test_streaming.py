"""Incremental ingest: each file once, re-runs without new files write nothing, no duplicates."""

from __future__ import annotations

from datetime import date

import pytest

from conform.context import RunContext
from conform.operators.quality import Check
from conform.sources.tables import batch_scan, load_batch
from conform.streaming import stream_ingest

from conftest import U2_CIRCUITS, write_drop

COLS = ["Master_CDF", "feeder_voltage", "feeder_max_hc", "feeder_min_hc", "feeder_dg_connected_since_refresh",
        "hca_refresh_date", "color", "shape_length"]


def test_stream_ingest_exactly_once(spark, tmp_path):
    land = tmp_path / "land"
    table, ckpt = str(tmp_path / "raw"), str(tmp_path / "ckpt")
    ctx = RunContext("run-s", date(2026, 4, 1))
    write_drop(land, {"a.csv": "\ufeff" + U2_CIRCUITS})
    assert stream_ingest(spark, str(land), COLS, "utility2", table, ckpt, ctx)["micro_batches"] == 1
    assert spark.read.parquet(table).count() == 2
    assert stream_ingest(spark, str(land), COLS, "utility2", table, ckpt, ctx)["micro_batches"] == 0
    write_drop(land, {"b.csv": U2_CIRCUITS.replace("F_", "G_")})
    stream_ingest(spark, str(land), COLS, "utility2", table, ckpt, ctx)
    df = spark.read.parquet(table)
    assert df.count() == 4 and df.select("Master_CDF").distinct().count() == 4
    assert {r.utility_id for r in df.collect()} == {"utility2"}
    assert all(r.source_file.endswith((".csv")) for r in df.collect())


def test_stream_columns_from_header(spark, tmp_path):
    land = tmp_path / "land2"
    write_drop(land, {"a.csv": "\ufeff" + U2_CIRCUITS})
    ctx = RunContext("run-s", date(2026, 4, 1))
    stream_ingest(spark, str(land), None, "utility2", str(tmp_path / "raw2"), str(tmp_path / "ckpt2"), ctx)
    df = spark.read.parquet(str(tmp_path / "raw2"))
    assert "Master_CDF" in df.columns and df.count() == 2


def test_header_order_is_respected_and_missing_columns_stop(spark, tmp_path):
    land = tmp_path / "land3"
    write_drop(land, {"a.csv": "id,cap\n1,10\n", "b.csv": "\ufeffcap,id\n20,2\n", "c.csv": ""})
    ctx = RunContext("run-s", date(2026, 4, 1))
    table = str(tmp_path / "raw3")
    assert stream_ingest(spark, str(land), ["id", "cap"], "u", table, str(tmp_path / "ck3"), ctx)["micro_batches"] == 1
    assert sorted((r.id, r["cap"]) for r in spark.read.parquet(table).collect()) == [("1", "10"), ("2", "20")]
    write_drop(land, {"d.csv": "id,other\n3,30\n"})
    with pytest.raises(Exception, match="lacks the columns"):
        stream_ingest(spark, str(land), ["id", "cap"], "u", table, str(tmp_path / "ck3"), ctx)


def test_new_checkpoint_keeps_what_an_earlier_stream_wrote(spark, tmp_path):
    ctx = RunContext("run-s", date(2026, 4, 1))
    table = str(tmp_path / "raw4")
    for i in range(2):
        land = tmp_path / f"land4-{i}"
        write_drop(land, {"a.csv": f"id\nx{i}\n"})
        stream_ingest(spark, str(land), None, "u", table, str(tmp_path / f"ck4-{i}"), ctx)
    assert sorted(r.id for r in spark.read.parquet(table).collect()) == ["x0", "x1"]


def test_stream_and_drop_of_one_batch_in_any_order(spark, tmp_path):
    """A drop replaces earlier drops only: streamed rows stay, and the stream wouldn't read their files again."""
    ctx, table, land = RunContext("run-s", date(2026, 4, 1)), str(tmp_path / "raw5"), tmp_path / "land5"

    def stream(name):
        write_drop(land, {f"{name}.csv": f"id\n{name}\n"})
        return stream_ingest(spark, str(land), ["id"], "u", table, str(tmp_path / "ck5"), ctx)["micro_batches"]

    def drop(*ids):
        rows = spark.createDataFrame([(i, "u", ctx.batch_date) for i in ids], "id string, utility_id string, batch_date date")
        load_batch(rows, table, "u", ctx.batch_date, "run")

    assert stream("s1") == 1
    drop("d1", "d2")
    assert stream("s2") == 1
    drop("d3")
    assert sorted(r.id for r in batch_scan(spark, table, ctx.batch_date).select("id").collect()) == ["d3", "s1", "s2"]


def test_a_failing_check_leaves_no_load_and_the_files_unread(spark, tmp_path):
    ctx, table, land, ckpt = RunContext("run-s", date(2026, 4, 1)), str(tmp_path / "raw6"), tmp_path / "land6", str(tmp_path / "ck6")
    write_drop(land, {"a.csv": "id,n\n1,5\n2,-1\n"})

    def run(severity):
        return stream_ingest(spark, str(land), ["id", "n"], "u", table, ckpt, ctx, checks=[Check("positive", "CAST(n AS INT) > 0", severity)])

    for _ in range(2):
        with pytest.raises(Exception, match="check positive .fail. rejects 1 of 2 rows"):
            run("fail")
        assert not (tmp_path / "raw6").exists()
    out = run("drop")
    assert out["micro_batches"] == 1 and [r["failed_rows"] for r in out["checks"]] == [1]
    assert [r.id for r in spark.read.parquet(table).collect()] == ["1"]
    assert run("fail") == {"micro_batches": 0, "checks": []}
