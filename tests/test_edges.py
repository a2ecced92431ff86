"""Edge inputs."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.errors import AnalysisException

from conform.context import RunContext
from conform.operators.dedup import latest_per_key
from conform.operators.quality import schema_drift
from conform.operators.serve import feeder_details
from conform.plans.jobs import pipe_conform, pipe_raw
from conform.spec import UTILITY1, UTILITY2

from conftest import DROP, write_drop


def test_duplicate_keys_with_and_without_ties(spark):
    df = spark.createDataFrame([
        ("a", 2, "x"), ("a", 1, "z"),          # newer batch wins although "z" > "x"
        ("b", 1, "p"), ("b", 1, "q"),          # tie on the order column: greatest remaining value wins
        ("c", 1, "s"), ("c", 1, "s"),          # exact duplicates collapse
    ], "k string, batch_date int, v string")
    got = sorted(map(tuple, latest_per_key(df, ["k"], ["batch_date"]).collect()))
    assert got == [("a", 2, "x"), ("b", 1, "q"), ("c", 1, "s")]


def test_feeder_found_but_without_voltage(spark):
    fact = spark.createDataFrame([("u", "F1", "d1"), ("u", "F2", "d2"), ("u", None, "d3")],
                                 "utility_id string, feeder_id string, der_id string")
    dim = spark.createDataFrame([("u", "F1", None, None)],
                                "utility_id string, feeder_id string, voltage_kv double, last_refresh_date timestamp")
    got = {r.der_id: (r.feeder_matched, r.feeder_data_missing) for r in feeder_details(fact, dim).collect()}
    assert got == {"d1": (True, True), "d2": (False, True), "d3": (False, True)}


def test_renamed_column_is_reported_and_stops_conform(spark, tmp_path, layout):
    renamed = DROP["utility2_circuits.csv"].replace("feeder_max_hc", "max_hc_feeder")
    landing = write_drop(tmp_path / "renamed", {**DROP, "utility2_circuits.csv": renamed})
    ctx = RunContext("run-r", date(2026, 4, 1))
    pipe_raw(spark, [UTILITY1, UTILITY2], landing, layout, ctx)
    raw = spark.read.parquet(layout.raw_table("utility2", "circuits"))
    drift = {r.column_name: r.present for r in schema_drift(raw, {"Master_CDF": "string",
                                                                   "feeder_max_hc": "double"}).collect()}
    assert drift == {"Master_CDF": True, "feeder_max_hc": False}
    with pytest.raises(AnalysisException):       # never fabricate a missing mapped column
        pipe_conform(spark, [UTILITY1, UTILITY2], layout, ctx)
