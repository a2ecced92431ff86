"""Whole chain on source-shaped CSV drops: raw → conform → serve, expected rows."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from conform.context import RunContext
from conform.operators.serve import q_capacity_over, q_feeder_ders
from conform.plans.jobs import pipe_conform, pipe_raw, run_all
from conform.sources.tables import read_table
from conform.spec import UTILITY1, UTILITY2

from conftest import U2_CIRCUITS, write_drop, DROP

CTX = RunContext("run-a", date(2026, 4, 1))
SPECS = [UTILITY1, UTILITY2]


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def _text_rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


DETAILS = [
    ("utility1", "7.5", "Wind", 12.5, "installed", "501", False, False),       # circuit of two feeders: the smaller
    ("utility1", "007", "Solar", 3.0, "installed", "601", False, True),        # known feeder, no voltage
    ("utility1", "7", "Hybrid", 60.0, "installed", "502", False, False),       # flagged; a feeder id sent directly
    ("utility1", "12E3", "Unknown", None, "installed", None, True, True),
    ("utility1", "7", "Hydro", 900.0, "planned", "502", False, False),         # by its circuit
    ("utility1", "A-1", "Hybrid", 40.0, "planned", None, True, True),          # two kinds
    ("utility2", "41", "Solar", 3.3, "installed", "F_2", False, True),
    ("utility2", "42", "Wind", 10.0, "installed", "F_9", False, True),         # a feeder that no drop describes
    ("utility2", "Q-5", "Storage", 75.0, "planned", "F_1", False, False),
    ("utility2", "Q-6", "Solar", 4.5, "planned", None, True, True),            # the text null is no feeder
]


def test_full_chain(spark, landing, layout):
    out = run_all(spark, SPECS, landing, layout, CTX)
    assert out["raw"] == {"utility1_circuits": 5, "utility1_install_der": 4, "utility1_planned_der": 2,
                          "utility2_circuits": 2, "utility2_install_der": 2, "utility2_planned_der": 2}
    raw_u2 = spark.read.parquet(layout.raw_table("utility2", "install_der"))
    assert "DER_ID" in raw_u2.columns and not any(c.startswith("\ufeff") for c in raw_u2.columns)
    assert dict(raw_u2.dtypes)["DER_NAMEPLATE_RATING"] == "string"     # raw keeps text
    assert raw_u2.where("DER_ID = '41'").first().SERVICE_STREET_ADDRESS == "1 Mill Lane\nrear yard"

    dim = read_table(spark, layout.conformed_table("dim_feeder"))
    assert _rows(dim.withColumn("ts", F.col("last_refresh_date").cast("timestamp_ntz").cast("string")),
                 "utility_id", "feeder_id", "max_hosting_capacity", "min_hosting_capacity", "ts", "voltage_kv") == [
        ("utility1", "501", 2.25, 0.3, "2023-03-05 00:00:00", 7.2),
        ("utility1", "502", 8.5, 0.75, "2023-03-05 00:00:00", 12.47),
        ("utility1", "601", 4.0, None, "2023-03-05 00:00:00", None),
        ("utility2", "F_1", 0.4, 0.0, "2023-02-01 00:00:00", 13.8),
        ("utility2", "F_2", 6.5, 1.5, "2023-02-01 00:00:00", None),
    ]
    bridge = read_table(spark, layout.conformed_table("bridge_utility1"))
    assert _rows(bridge, "circuit_id", "feeder_id") == [("77", "601"), ("78", "502"), ("CK-10", "501"), ("CK-10", "502")]

    details = read_table(spark, layout.serving_table("feeder_der_details"))
    got = _text_rows(details, "utility_id", "der_id", "der_type", "capacity_kw", "status", "feeder_id",
                     "feeder_id_unresolved", "feeder_data_missing")
    assert got == sorted(DETAILS, key=str)

    dq = read_table(spark, layout.serving_table("data_quality"))
    assert _text_rows(dq.withColumn("d", F.col("last_refresh_date").cast("date").cast("string")),
                      "utility_id", "dataset", "status", "total_rows", "null_feeder_id_count",
                      "unresolved_feeder_id_count", "d") == sorted([
        ("utility1", "circuits", None, 3, 0, 0, "2023-03-05"),
        ("utility2", "circuits", None, 2, 0, 0, "2023-02-01"),
        ("utility1", "der", "installed", 4, 1, 1, None),
        ("utility1", "der", "planned", 2, 1, 1, None),
        ("utility2", "der", "installed", 2, 0, 0, None),
        ("utility2", "der", "planned", 2, 1, 1, None),
    ], key=str)

    cap = read_table(spark, layout.serving_table("feeder_capacity"))
    assert sorted(r.feeder_id for r in q_capacity_over(cap, 2.25).collect()) == ["502", "601", "F_2"]
    ders = [(r.status, r.der_type, r.der_id) for r in q_feeder_ders(details, "502", "utility1").collect()]
    assert ders == [("installed", "Hybrid", "7"), ("planned", "Hydro", "7")]          # in the listing's order
    assert q_feeder_ders(details, "502", "utility2").count() == 0

    for t in (layout.conformed_table("dim_feeder"), layout.conformed_table("fact_der"),
              layout.serving_table("feeder_capacity")):
        cols = read_table(spark, t).columns
        assert {"pipeline_run_id", "batch_date", "ingestion_ts"} <= set(cols)
    assert {r.pipeline_run_id for r in read_table(spark, layout.conformed_table("fact_der")).collect()} == {"run-a"}


def test_bare_null_tokens_variant(spark, landing, layout):
    """With the empty text as the only null token, the text null is a feeder id like any other."""
    run_all(spark, [UTILITY1.with_null_tokens(("",)), UTILITY2.with_null_tokens(("",))], landing, layout, CTX)
    r = read_table(spark, layout.serving_table("feeder_der_details")).where("der_id = 'Q-6'").first()
    assert (r.feeder_id, r.feeder_id_unresolved, r.feeder_data_missing) == ("null", False, True)
    dq = read_table(spark, layout.serving_table("data_quality"))
    p = dq.where("utility_id = 'utility2' AND status = 'planned'").first()
    assert (p.null_feeder_id_count, p.unresolved_feeder_id_count) == (0, 0)


def test_rerun_is_idempotent(spark, landing, layout):
    run_all(spark, SPECS, landing, layout, CTX)
    first = {t: read_table(spark, layout.conformed_table(t)).count() for t in ("dim_feeder", "fact_der")}
    raw_first = spark.read.parquet(layout.raw_table("utility1", "circuits")).count()
    run_all(spark, SPECS, landing, layout, CTX)
    second = {t: read_table(spark, layout.conformed_table(t)).count() for t in ("dim_feeder", "fact_der")}
    assert first == second == {"dim_feeder": 5, "fact_der": 10}
    assert spark.read.parquet(layout.raw_table("utility1", "circuits")).count() == raw_first == 5   # replaced, not appended


def test_second_batch_and_backfill(spark, tmp_path, landing, layout):
    run_all(spark, SPECS, landing, layout, CTX)
    changed = U2_CIRCUITS.replace("F_1,13.8,0.4", "F_1,13.8,0.9").replace("F_2,,6.5,1.5,0,2023/01/31", "F_3,4.2,9,0,0,2023/04/30")
    may = write_drop(tmp_path / "may", {**DROP, "utility2_circuits.csv": changed})
    ctx_may = RunContext("run-b", date(2026, 5, 1))
    run_all(spark, SPECS, may, layout, ctx_may)

    def capacities():
        return {r.feeder_id: r.max_hosting_capacity for r in read_table(spark, layout.conformed_table("dim_feeder")).collect()}

    # changed, new, and gone from the drop but kept
    assert {k: v for k, v in capacities().items() if k.startswith("F_")} == {"F_1": 0.9, "F_2": 6.5, "F_3": 9.0}
    # both raw batches are kept side by side
    assert spark.read.parquet(layout.raw_table("utility2", "circuits")).select("batch_date").distinct().count() == 2

    # re-sent older batch: by default it overwrites newer state; only_newer guards against it
    pipe_conform(spark, SPECS, layout, CTX, only_newer=True)
    assert capacities()["F_1"] == 0.9
    pipe_conform(spark, SPECS, layout, CTX)
    assert capacities()["F_1"] == 0.4


def test_missing_source_file_fails(spark, tmp_path, layout):
    empty = write_drop(tmp_path / "empty", {"utility1_circuits.csv": DROP["utility1_circuits.csv"]})
    with pytest.raises(Exception):
        pipe_raw(spark, SPECS, empty, layout, CTX)


def test_fail_check_stops_before_publish(spark, tmp_path, layout):
    bad = DROP["utility2_install_der.csv"].replace("42,null", ",null")           # a DER without id
    folder = write_drop(tmp_path / "bad", {**DROP, "utility2_install_der.csv": bad})
    pipe_raw(spark, SPECS, folder, layout, CTX)
    from conform.operators.quality import CheckFailed
    with pytest.raises(CheckFailed, match="der_id_not_null"):
        pipe_conform(spark, SPECS, layout, CTX)
    assert read_table(spark, layout.conformed_table("fact_der")) is None
