"""Look-ups and the latest row per key: what is shuffled and sorted for them."""

from __future__ import annotations

from pyspark.sql import functions as F

from conform.operators.dedup import latest_per_key
from conform.operators.joins import left_lookup
from conform.operators.serve import feeder_details
from conform.plans import registry as r

from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_without_a_key_meet_no_text_of_the_lookup(spark):
    rows = spark.createDataFrame([(1, None), (2, "a"), (3, "\u0001x")], "id int, ref string")
    stand_in = rows.select(F.concat(F.lit("\u0001"), F.xxhash64("id", "ref").cast("string"))).first()[0]
    lookup = spark.createDataFrame([(stand_in, 9), ("a", 8), ("\u0001x", 7)], "k string, v int")
    out = left_lookup(rows, "ref", lookup, "k")
    assert out.columns == ["id", "ref", "v"]
    assert sorted(tuple(x) for x in out.collect()) == [(1, None, None), (2, "a", 8), (3, "\u0001x", 7)]


def test_lookup_shuffles_one_copy_of_the_keys(spark):
    rows = spark.createDataFrame([("u", "1", 5)], "u string, f string, n int")
    lookup = spark.createDataFrame([("u", "1", 2.0)], "u string, f string, kv double")
    out = left_lookup(rows, ["u", "f"], lookup.hint("merge"), ["u", "f"])
    assert "concat" not in plan(out)
    assert [tuple(x) for x in out.collect()] == [("u", "1", 5, 2.0)]


def test_rows_are_sorted_by_the_id_before_the_source(spark):
    rows = spark.createDataFrame([("u", "1", 5), ("u", "1", 6), ("u", None, 1)], "utility_id string, der_id string, n int")
    out = latest_per_key(rows, ["utility_id", "der_id"], [])
    assert "SortAggregate(key=[der_id" in plan(out) and out.columns == rows.columns
    assert sorted(map(tuple, out.collect()), key=str) == [("u", "1", 6), ("u", None, 1)]


def test_joins_of_measured_sizes_do_not_sort(spark):
    r.fact_latest(spark, SF_SMALL)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = feeder_details(r.fact_latest(spark, SF_SMALL), r.dim_latest(spark, SF_SMALL))
        out.collect()
        assert plan(out).split("Initial Plan")[0].count("ShuffledHashJoin") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
