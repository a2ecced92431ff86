"""Hot keys: a third of the rows share one id, a third have none. Results stay exact and whole,
and no single shuffle partition receives the NULL-keyed rows wholesale."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conform.operators.dedup import latest_per_key
from conform.operators.joins import left_lookup
from conform.operators.merge import scd2_from_history
from conform.operators.serve import feeder_details

N = 30000


@pytest.fixture
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}   # keep the shuffle partitions visible
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def skewed(spark):
    ref = (F.when(F.col("id") % 3 == 0, F.lit("HOT"))
           .when(F.col("id") % 3 == 1, F.lit(None).cast("string"))
           .otherwise(F.concat(F.lit("K"), F.col("id").cast("string"))))
    return spark.range(N).select(F.col("id"), ref.alias("ref"))


def test_null_keys_spread_across_partitions(spark, no_broadcast):
    rows = skewed(spark)
    lookup = spark.range(0, N, 2).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("k"),
                                         F.lit("hit").alias("v")) \
        .unionByName(spark.createDataFrame([("HOT", "hot")], "k string, v string"))
    out = left_lookup(rows, "ref", lookup, "k")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert out.count() == N                                      # one row out per row in
    per_part = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(per_part) < 0.5 * N                               # NULLs did not pile onto the hot partition
    got = {r.ref: r.v for r in out.where("ref = 'HOT' OR ref IS NULL").dropDuplicates(["ref"]).collect()}
    assert got == {"HOT": "hot", None: None}


def test_details_keep_unkeyed_rows(spark, no_broadcast):
    fact = skewed(spark).select(F.lit("u").alias("utility_id"), F.col("ref").alias("feeder_id"), "id")
    dim = spark.createDataFrame([("u", "HOT", 1.0, None)],
                                "utility_id string, feeder_id string, voltage_kv double, last_refresh_date timestamp")
    out = feeder_details(fact, dim)
    assert out.count() == N
    agg = out.groupBy("feeder_matched", "feeder_data_missing").count().collect()
    assert {(r.feeder_matched, r.feeder_data_missing): r["count"] for r in agg} == {(True, False): N // 3,
                                                                                    (False, True): N - N // 3}


def test_latest_on_hot_key(spark):
    df = skewed(spark).select(F.coalesce("ref", F.lit("NONE")).alias("k"), (F.col("id") % 97).alias("v"), "id")
    got = {r.k: (r.v, r.id) for r in latest_per_key(df, ["k"], ["v"]).collect()}
    w = Window.partitionBy("k").orderBy(F.col("v").desc(), F.col("id").desc())
    ref = {r.k: (r.v, r.id) for r in df.withColumn("rn", F.row_number().over(w)).where("rn = 1").collect()}
    assert got == ref


def test_scd2_hot_key_matches_plain_window(spark):
    # one key with 20k changes spread over 400 days, plus small keys
    h = spark.range(20000).select(
        (F.when(F.col("id") < 15000, F.lit(0)).otherwise(F.col("id") % 50 + 1)).alias("k"),
        ((F.col("id") * 7) % 3).cast("string").alias("s"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 400).cast("int")).alias("ts"),
        F.col("id").alias("tb"))
    def key(t):
        return tuple((x is None, str(x)) for x in t)

    got = sorted((tuple(r) for r in scd2_from_history(h, ["k"], ["s"], "ts", ["tb"]).collect()), key=key)
    w = Window.partitionBy("k").orderBy("ts", "tb")
    starts = h.withColumn("p", F.lag("s").over(w)).where(F.col("p").isNull() | ~F.col("s").eqNullSafe(F.col("p")))
    w2 = Window.partitionBy("k").orderBy("ts", "tb")
    ref = starts.select("k", "s", F.col("ts").alias("f"), F.lead("ts").over(w2).alias("t")) \
        .select("k", "s", "f", "t", F.col("t").isNull())
    assert got == sorted((tuple(r) for r in ref.collect()), key=key)


def test_scd2_numeric_effective_column_with_a_hot_key(spark):
    """Each row of the hot key has its own number: the ranges, not the values, bound what a window sees."""
    h = spark.range(12000).select(F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id")).alias("k"),
                                  (F.col("id") % 4 < 2).cast("string").alias("s"), (F.col("id") * 1.5).alias("ts"))
    out = scd2_from_history(h, ["k"], ["s"], "ts")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(k#" in plan and "_b#" in plan        # windows are per (key, range)
    w = Window.partitionBy("k").orderBy("ts")
    starts = h.withColumn("p", F.lag("s").over(w)).where(F.col("p").isNull() | (F.col("s") != F.col("p")))
    want = starts.select("k", "s", "ts", F.lead("ts").over(w).alias("t"))
    assert sorted((tuple(r)[:4] for r in out.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_latest_row_by_aggregate_and_by_window(spark, capsys):
    """Both ways pick the same rows: ties in the order, NULL keys and values, NaN; and both reduce a hot key before the shuffle."""
    n = F.col("id")
    df = spark.range(4000).select(
        F.when(n % 3 == 0, 7).when(n % 50 == 1, None).otherwise(n % 400).alias("k"), F.when(n % 5 > 0, n % 4).alias("batch_date"),
        F.when(n % 11 > 0, F.when(n % 13 == 0, F.lit(float("nan"))).otherwise((n * 7919) % 1000 / 3)).alias("x"), (n * 31 % 17).cast("string").alias("y"))
    key = lambda r: str(tuple(r))
    got = [sorted(latest_per_key(df, ["k"], ["batch_date"], wide=w).collect(), key=key) for w in (False, True)]
    assert list(map(key, got[0])) == list(map(key, got[1])) and len(got[0]) == len(df.select("k").distinct().collect())
    latest_per_key(df, ["k"], ["batch_date"], wide=True).explain()
    plan = capsys.readouterr().out
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below
    wide = df.select("*", *[F.lit(i).alias(f"c{i}") for i in range(40)])
    latest_per_key(wide, ["k"]).explain()
    assert "Window" in capsys.readouterr().out
