"""Table writers: snapshot versions, crash leftovers, replace-by-batch, observed metrics, third source."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from conform.context import RunContext
from conform.plans.jobs import pipe_conform, pipe_raw
from conform.operators.merge import upsert
from conform.session import scratch_root
from conform.sources.csv import csv_load, csv_scan
from conform.sources.tables import (
    LOAD_COL,
    RAW_PARTITIONS,
    STREAM,
    batch_scan,
    clustered_write,
    load_batch,
    partition_replace,
    publish,
    read_table,
    snapshot_versions,
    superseded,
    write_observed,
)
from conform.spec import DerDataset, SourceSpec, UTILITY1, UTILITY2

from conftest import DROP, write_drop


def test_incomplete_version_is_ignored(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(3), path)
    # a job that died mid-write leaves a version folder without the commit marker
    broken = os.path.join(path, "v9999999999999-dead00")
    os.makedirs(broken)
    with open(os.path.join(broken, "part-00000.parquet"), "wb") as f:
        f.write(b"not parquet")
    assert read_table(spark, path).count() == 3
    assert len(snapshot_versions(spark, path)) == 1


def test_table_rebuilt_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(3), path)
    cur = read_table(spark, path)
    publish(cur.union(spark.range(10, 12)), path)          # reads the current version, writes the next
    assert read_table(spark, path).count() == 5


def test_partition_replace_keeps_other_batches(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = spark.range(10).select("id", F.when(F.col("id") < 5, F.lit("2026-01-01")).otherwise(F.lit("2026-02-01"))
                                  .cast("date").alias("batch_date"), F.lit("u").alias("utility_id"))
    assert partition_replace(rows, path)["rows"] == 10
    again = rows.where("batch_date = DATE'2026-02-01' AND id > 7")
    assert partition_replace(again, path)["rows"] == 2
    got = sorted(r.id for r in spark.read.parquet(path).collect())
    assert got == [0, 1, 2, 3, 4, 8, 9]


def test_observed_metrics_without_second_scan(spark, tmp_path):
    path = str(tmp_path / "m")
    sc = spark.sparkContext
    sc.setJobGroup("observed-write", "w")
    m = write_observed(spark.range(100), lambda d: d.write.parquet(path), "m",
                       extra=[F.max("id").alias("max_id")])
    sc.setJobGroup("", "")
    assert m == {"rows": 100, "max_id": 99}
    assert len(sc.statusTracker().getJobIdsForGroup("observed-write")) == 1


UTILITY3_CSV = """code,kv,cap_mw,refreshed
S_1,13.2,2.5,2022-11-01 00:00:00
S_2,4.8,0.5,2022-11-01 00:00:00
"""
UTILITY3_DER = """id,rating,feeder,kind
a1,10,S_1,Wind
a2,20,S_9,Solar
"""


def test_third_source_by_spec_only(spark, tmp_path, layout):
    spec3 = SourceSpec(source_id="utility3", feeder_id="code", max_hc="cap_mw", voltage="kv",
                       refresh_date="refreshed",
                       der=(("installed", DerDataset("install_der", der_id="id", nameplate="rating",
                                                     feeder_id="feeder", der_type="kind")),))
    files = {**DROP, "utility3_circuits.csv": UTILITY3_CSV, "utility3_install_der.csv": UTILITY3_DER}
    landing = write_drop(tmp_path / "landing3", files)
    ctx = RunContext("run-3", date(2026, 4, 1))
    pipe_raw(spark, [UTILITY1, UTILITY2, spec3], landing, layout, ctx)
    pipe_conform(spark, [UTILITY1, UTILITY2, spec3], layout, ctx)
    dim = read_table(spark, layout.conformed_table("dim_feeder")).where("utility_id = 'utility3'")
    assert sorted((r.feeder_id, r.max_hosting_capacity) for r in dim.collect()) == [("S_1", 2.5), ("S_2", 0.5)]
    fact = read_table(spark, layout.conformed_table("fact_der")).where("utility_id = 'utility3'")
    assert sorted((r.der_id, r.der_type, r.feeder_id) for r in fact.collect()) == [("a1", "Wind", "S_1"),
                                                                                   ("a2", "Solar", "S_9")]
    assert read_table(spark, layout.conformed_table("fact_der")).count() == 12


def test_clustered_publish_counts_rows_once(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") % 7).cast("string").alias("u"), F.rand(1).alias("c"))
    assert publish(df, str(tmp_path / "a"), ("u",), cluster_cols="c")["rows"] == 5000
    assert publish(df, str(tmp_path / "b"), ("u",), cluster_cols="c", materialise=True)["rows"] == 5000


def test_versions_without_marker_are_an_error_not_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_table(spark, path) is None                 # nothing was ever written
    publish(spark.range(3), path)
    os.remove(os.path.join(path, snapshot_versions(spark, path)[0], "_COMPLETE"))
    with pytest.raises(RuntimeError, match="no complete version"):
        upsert(read_table(spark, path), spark.range(1), ["id"])


def test_old_versions_are_removed(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(5):
        publish(spark.range(i), path, keep=2)
    assert len(snapshot_versions(spark, path)) == 2 and read_table(spark, path).count() == 4


def test_scan_limits_on_absent_columns_are_errors(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    for limit in ({"batch_date": "2026-01-01"}, {"run_id": "r"}, {"source_id": "u"}):
        with pytest.raises(ValueError, match="no column"):
            batch_scan(spark, path, **limit)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf(dict):
        def get(self, k, d=None):
            return dict.get(self, k, d)

    class Cluster:
        conf = Conf({"spark.master": "spark://host:7077"})

        class sparkContext:  # noqa: N801
            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Cluster())


def test_loads_replace_a_batch_whole(spark, tmp_path):
    path, day = str(tmp_path / "raw"), date(2026, 4, 1)

    def rows(*ids, d=day):
        return spark.createDataFrame([(i,) for i in ids], "id long").select("id", F.lit("u").alias("utility_id"), F.lit(d).alias("batch_date"))

    def there():
        return sorted(r.id for r in spark.read.parquet(path).collect())

    load_batch(rows(1, 2), path, "u", day, "run-1")
    load_batch(rows(9, d=date(2026, 5, 1)), path, "u", date(2026, 5, 1), "run-1")
    load_batch(rows(3), path, "u", day, "x-0", kind=STREAM)
    assert there() == [1, 2, 3, 9]
    load_batch(rows(4), path, "u", day, "run-2")                 # a re-send: the batch's earlier drops go, the stream stays
    assert there() == [3, 4, 9]
    load_batch(rows(4, 5), path, "u", day, "run-2")              # the same run again
    load_batch(rows(6), path, "u", day, "x-0", kind=STREAM)      # a replayed micro-batch
    load_batch(rows(7), path, "u", day, "x-1", kind=STREAM)
    assert there() == [4, 5, 6, 7, 9]
    load_batch(rows(1).where("id > 1"), path, "u", day, "run-3")  # an empty re-send clears the drop
    assert there() == [6, 7, 9]


@pytest.mark.parametrize("source", ["u:1", "50% a/b", "007", "ü 'x'\"#"])
def test_a_source_id_with_any_signs_is_not_doubled(spark, tmp_path, source):
    path, day = str(tmp_path / "raw"), date(2026, 4, 1)
    for run in ("run:1", "run 2"):
        load_batch(spark.range(2).select("id", F.lit(source).alias("utility_id"), F.lit(day).alias("batch_date")), path, source, day, run)
    assert [tuple(r) for r in batch_scan(spark, path, day, source_id=source).select("id", "utility_id").orderBy("id").collect()] == [(0, source), (1, source)]


def test_a_reader_never_sees_two_drops_of_a_batch(spark, tmp_path):
    path, day = str(tmp_path / "raw"), date(2026, 4, 1)

    def rows(*ids, u="u"):
        return spark.createDataFrame([(i,) for i in ids], "id long").select("id", F.lit(u).alias("utility_id"), F.lit(day).alias("batch_date"))

    def left(load, *ids, u="u"):                                 # as a job leaves it that died before it removed the others
        partition_replace(rows(*ids, u=u).withColumn(LOAD_COL, F.lit(load)), path, RAW_PARTITIONS)

    load_batch(rows(1, 2), path, "u", day, "run-1")
    left("batch-000000000000001-old", 7)
    left("run-without-kind", 8)                                  # a load from before there were kinds
    left("stream-x-0", 3)
    left("batch-000000000000002-other", 9, u="v")
    assert len(superseded(spark, path)) == 2
    assert sorted(r.id for r in batch_scan(spark, path, day).collect()) == [1, 2, 3, 9]
    load_batch(rows(5), path, "u", day, "run-2")
    assert superseded(spark, path) == []
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [3, 5, 9]


def test_partition_writes_have_few_files(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = spark.range(0, 16000, 1, 32).select("id", (F.col("id") % 80).alias("batch_date"))
    partition_replace(df, path, ["batch_date"])
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert spark.read.parquet(path).count() == 16000 and len(files) <= 160


def test_no_hot_range_in_a_clustered_write(spark, tmp_path):
    """45 % of the rows have no feeder, a fifth share one: ranges stay even and still are ranges of the feeder."""
    df = spark.range(20000).select(
        F.lit("u").alias("utility_id"), F.col("id").cast("string").alias("der_id"), F.lit("installed").alias("status"),
        F.when(F.col("id") % 20 < 9, None).when(F.col("id") % 5 == 0, "HOT").otherwise(F.concat(F.lit("F"), F.col("id") % 700)).alias("feeder_id"))
    path = str(tmp_path / "details")
    clustered_write(df, path, "utility_id", ("feeder_id", "der_id", "status"), n=16)
    back = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f"), "feeder_id")
    files = back.groupBy("f").agg(F.count("*").alias("n"), F.min("feeder_id").alias("a"), F.max("feeder_id").alias("b")).collect()
    assert max(r.n for r in files) <= 2 * 20000 / len(files) and len(files) >= 12
    ranges = sorted((r.a, r.b) for r in files if r.a)
    assert all(x[1] <= y[0] for x, y in zip(ranges, ranges[1:]))


def csv_rows(spark, path, **kw):
    return csv_load(spark, str(path), lambda rows: rows.collect(), **kw)


def test_csv_files_are_read_by_their_own_headers(spark, tmp_path):
    write_drop(tmp_path / "d", {"a.csv": "id,cap\n1,10\n", "b.csv": "\ufeff cap ,id\n20,2\n", "c.csv": "id,cap,more\n3,30,x\n", "e.csv": ""})
    got = csv_rows(spark, tmp_path / "d", source_id="u")
    assert sorted((r.id, r["cap"], r.more, r.source_file[-5:]) for r in got) == [
        ("1", "10", None, "a.csv"), ("2", "20", None, "b.csv"), ("3", "30", "x", "c.csv")]
    assert sorted(map(tuple, csv_rows(spark, tmp_path / "d", columns=["cap", "id"]))) == [("1", "10"), ("2", "20"), ("3", "30")]
    with pytest.raises(ValueError, match="lacks the columns"):
        csv_rows(spark, tmp_path / "d", columns=["more"])
    with pytest.raises(Exception):
        csv_rows(spark, tmp_path / "nothing")


@pytest.mark.parametrize("other", ["cap,id\n20,2\n", "id\n2\n", "id,cap,more\n2,20,x\n", "id,size\n2,20\n"])
@pytest.mark.parametrize("multiline", [False, True])
def test_a_file_with_another_header_is_never_read_under_wrong_names(spark, tmp_path, other, multiline):
    write_drop(tmp_path / "d", {"a.csv": "id,cap\n1,10\n", "b.csv": other})
    with pytest.raises(Exception, match="header"):
        csv_scan(spark, str(tmp_path / "d"), multiline).collect()
    rows = csv_rows(spark, tmp_path / "d", multiline=multiline)
    assert sorted((r.id, r["cap"]) for r in rows) == [("1", "10"), ("2", "20" if "cap" in other else None)]


def test_one_bom_and_blank_lines(spark, tmp_path):
    write_drop(tmp_path / "d", {"a.csv": "\ufeffid, cap\n1,10\n", "b.csv": "\ufeffid, cap\n2,20\n", "c.csv": "\n\n", "e.csv": ""})
    assert sorted((r.id, r["cap"]) for r in csv_rows(spark, tmp_path / "d")) == [("1", "10"), ("2", "20")]
    write_drop(tmp_path / "none", {"a.csv": ""})
    assert csv_rows(spark, tmp_path / "none", columns=["id"], source_id="u") == []


def test_driver_jobs_do_not_grow_with_the_files(spark, tmp_path):
    write_drop(tmp_path / "many", {f"f{i:03d}.csv": f"id,cap\n{i},{i}\n" for i in range(200)})
    sc = spark.sparkContext
    sc.setJobGroup("many-files", "scan")
    rows = csv_scan(spark, str(tmp_path / "many"))
    jobs = len(sc.statusTracker().getJobIdsForGroup("many-files"))
    sc.setJobGroup("", "")
    assert jobs <= 3 and rows.count() == 200
