"""Written bytes: loads without a shuffle, packed tables and drops."""

from __future__ import annotations

import glob
import os
import time

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conform.context import RunContext
from conform.operators.dedup import latest_per_key
from conform.operators.serve import feeder_details
from conform.plans import registry as r
from conform.plans.jobs import DETAILS_CLUSTER, pipe_conform, pipe_raw, pipe_serve, run_all
from conform.session import DROP_SHUFFLES, dropped_shuffles, scratch_root
from conform.sources import tables
from conform.sources.keyed import bucket_of
from conform.sources.tables import batch_scan, load_batch, partition_replace, publish, read_table
from conform.spec import UTILITY1, UTILITY2

from conftest import SF_SMALL


def test_a_load_is_written_as_its_tasks_read_it(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = spark.range(300).repartition(3).withColumns({"utility_id": F.lit("007"), "batch_date": F.lit("2024-01-01").cast("date")})
    assert load_batch(df, path, "007", "2024-01-01", "run")["rows"] == 300
    assert len(glob.glob(f"{path}/utility_id=007/batch_date=2024-01-01/load=*/*.parquet")) == 3    # a shuffle would leave one
    back = batch_scan(spark, path, batch_date="2024-01-01", source_id="007")
    assert back.count() == 300 and dict(back.dtypes)["utility_id"] == "string"


def test_tables_and_drops_are_packed(spark, tmp_path):
    at = publish(spark.range(1000), str(tmp_path / "t"))["path"]
    f = glob.glob(f"{at}/*.parquet")[0]
    assert pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD"
    r.write_landing(spark, SF_SMALL, str(tmp_path / "landing"))
    names = [n for _, _, ns in os.walk(tmp_path / "landing") for n in ns if n.startswith("part-")]
    assert names and all(n.endswith(".csv.gz") for n in names)


def der_rows(spark):
    """4,000 rows of two sources; a third of the ids twice, some without one."""
    one = spark.range(2000).select((F.col("id") % 1500).cast("string").alias("d"), F.col("id").alias("n")) \
        .withColumn("d", F.when(F.col("n") % 400 != 3, F.col("d")))
    return one.withColumn("u", F.lit("a")).unionByName(one.withColumn("u", F.lit("b")))


def test_latest_rows_in_ranges_take_one_shuffle_and_no_sort_before_it(spark):
    rows, keys = der_rows(spark), ("u", "d")
    out = latest_per_key(rows.withColumn("b", bucket_of(keys, 4)), keys, ["n"], ranges=("u", "b"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count(" Sort ") == 1 and plan.index(" Sort ") < plan.index("Exchange ")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        placed = out.select("u", "b", F.spark_partition_id().alias("p")).distinct().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    parts = {p: sorted((x.u, x.b) for x in placed if x.p == p) for p in {x.p for x in placed}}
    order = sorted({(x.u, x.b) for x in placed})
    assert len(parts) == 8 and all(p == order[order.index(p[0]):][:len(p)] for p in parts.values())    # neighbours only
    assert sorted(map(str, out.select("u", "d", "n").collect())) == sorted(map(str, latest_per_key(rows, keys, ["n"]).select("u", "d", "n").collect()))


def test_rows_that_lie_together_are_written_where_they_are_read(spark, tmp_path):
    df = spark.range(300).repartition(3).withColumn("u", F.lit("a"))
    assert partition_replace(df, str(tmp_path / "t"), ["u"], together=True)["rows"] == 300
    assert len(glob.glob(str(tmp_path / "t/u=a/*.parquet"))) == 3    # a shuffle would leave one


def test_a_load_of_one_task_is_cut_into_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "FILE_ROWS", 100)
    path = str(tmp_path / "raw")
    df = spark.range(300).coalesce(1).withColumns({"utility_id": F.lit("a"), "batch_date": F.lit("2024-01-01").cast("date")})
    assert load_batch(df, path, "a", "2024-01-01", "run")["rows"] == 300
    assert len(glob.glob(f"{path}/utility_id=a/batch_date=2024-01-01/load=*/*.parquet")) == 3
    assert batch_scan(spark, path).count() == 300


def test_ders_without_a_feeder_are_not_shuffled(spark):
    fact = spark.createDataFrame([("a", "1", "x"), ("a", "1", "x"), ("a", None, "y"), (None, "1", "z"), ("b", "9", "w")], "utility_id string, feeder_id string, der_id string")
    dim = spark.createDataFrame([("a", "1", 2.5, "d1"), ("b", "1", None, "d2")], "utility_id string, feeder_id string, voltage_kv double, last_refresh_date string")
    out = feeder_details(fact, dim.hint("merge"), stored=True)
    assert "_spread" not in out._jdf.queryExecution().analyzed().toString().split("Join")[0] and out.schema == feeder_details(fact, dim).schema
    assert sorted(map(str, out.collect())) == sorted(map(str, feeder_details(fact, dim).collect()))
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join") == 1 and text.startswith("Union")


def test_serving_stores_no_copy_of_the_details(spark, landing, layout):
    ctx, specs = RunContext.for_batch("2024-01-01", "run"), [UTILITY1, UTILITY2]
    pipe_raw(spark, specs, landing, layout, ctx)
    pipe_conform(spark, specs, layout, ctx)
    kept = f"{scratch_root(spark).removeprefix('file:')}/conform/materialised-*"
    before = set(glob.glob(kept))
    rows = pipe_serve(spark, layout, ctx)["feeder_der_details"]
    assert set(glob.glob(kept)) == before
    details = read_table(spark, layout.serving_table("feeder_der_details"))
    assert details.count() == rows == read_table(spark, layout.conformed_table("fact_der")).count()
    assert details.select(*DETAILS_CLUSTER).distinct().count() == rows


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if "/shuffle_" in f}


def test_jobs_drop_their_shuffles_and_staged_rows(spark, landing, layout):
    ctx, specs = RunContext.for_batch("2024-01-01", "run"), [UTILITY1, UTILITY2]
    staged = f"{scratch_root(spark).removeprefix('file:')}/conform/stage-*"
    pipe_raw(spark, specs, landing, layout, ctx)
    before, kept, own = shuffle_files(spark), set(glob.glob(staged)), spark.conf.get(DROP_SHUFFLES)
    for _ in range(2):
        out = pipe_conform(spark, specs, layout, ctx)
        assert out["fact_der"] == read_table(spark, layout.conformed_table("fact_der")).count() > 0
        assert pipe_serve(spark, layout, ctx)["feeder_der_details"] == out["fact_der"]
    assert set(glob.glob(staged)) == kept and spark.conf.get(DROP_SHUFFLES) == own
    until = time.time() + 20    # removal is asynchronous
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    # the counts above are queries outside the jobs: each shuffles one number a task
    assert sum(os.path.getsize(f) for f in left if f.endswith(".data") and os.path.exists(f)) < 2000


def test_the_shuffle_setting_comes_back_after_a_failure(spark):
    own = spark.conf.get(DROP_SHUFFLES)
    try:
        with dropped_shuffles(spark):
            assert spark.conf.get(DROP_SHUFFLES) == "true"
            raise KeyError
    except KeyError:
        assert spark.conf.get(DROP_SHUFFLES) == own
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        with dropped_shuffles(spark):
            pass
        assert spark.conf.get(DROP_SHUFFLES) == "true"
    finally:
        spark.conf.unset(DROP_SHUFFLES)


def test_a_landing_is_cleared_of_the_specs_drops_only_if_asked(spark, landing, layout):
    ctx, other = RunContext.for_batch("2024-01-01", "run"), os.path.join(landing, "notes.txt")
    with open(other, "w") as f:
        f.write("x")
    there = set(os.listdir(landing))
    kept = run_all(spark, [UTILITY1, UTILITY2], landing, layout, ctx)
    assert set(os.listdir(landing)) == there
    cleared = run_all(spark, [UTILITY1, UTILITY2], landing, layout, ctx, clear_landing=True)
    assert [n for n in os.listdir(landing) if not n.startswith(".")] == ["notes.txt"]
    assert cleared["raw"] == kept["raw"] and cleared["serve"] == kept["serve"]
