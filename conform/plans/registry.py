"""Every operator as a runnable job over the benchmark tables, with its DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs on whole tables; ``ORACLE[name]`` is the
same result in DuckDB SQL over the same Parquet files (views named after the tables).
Jobs that exercise writers (CSV drops, partition replace, snapshots, streams) write below the
session's shared checkpoint folder, each call into a new sub-folder.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conform.context import RunContext, audit_stamp
from conform.functions.scalars import key_normalise, lenient_number, lenient_ts
from conform.operators.conform import conform_dim_source, conform_fact_source, conform_facts, conform_lookup_source, union_all
from conform.operators.dedup import latest_per_key
from conform.operators.merge import scd2_apply, scd2_from_history, scd2_insert, upsert
from conform.operators.quality import (
    DIM_CHECKS,
    FACT_CHECKS,
    Check,
    check_report,
    apply_checks,
    drop_failing,
    dup_keys,
    expected_columns,
    failing_rows,
    header_drift,
    missing_categories,
    null_key_rows,
    null_key_triage,
    quality_snapshot,
    quality_summary,
    run_summary,
    schema_drift,
)
from conform.operators.resolve import bridge_build, bridge_one_per_key, segment_rollup
from conform.operators.serve import feeder_details, q_capacity_over, q_feeder_ders, sample_feeder, top_capacity
from conform.plans import testbed as tb
from conform.plans.jobs import CAPACITY_CLUSTER, DETAILS_CLUSTER, DIM_KEYS, DIM_ORDER, FACT_KEYS, FACT_ORDER, Layout, build_conformed, pipe_conform, pipe_raw, run_all
from conform.session import HASH_JOIN, SCAN_SPLIT, scratch_path
from conform.sources.csv import csv_load, csv_scan, header_clean, provenance
from conform.sources.keyed import read_keyed, upsert_keyed, without_bucket
from conform.sources.tables import (
    BATCH,
    LOAD_COL,
    RAW_PARTITIONS,
    batch_scan,
    clustered_write,
    footer_counts,
    load_batch,
    partition_replace,
    publish,
    raw_headers,
    read_table,
    write_observed,
)
from conform.spec import UTILITY1, UTILITY2
from conform.streaming.conform import stream_conform
from conform.streaming.ingest import stream_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# The run context used by every registered job, so audit columns are comparable.
FIXED_CTX = RunContext("run-fixed-0001", date(2026, 4, 1), datetime(2026, 4, 1, 6, 0, 0))
CTX_SQL = ("'run-fixed-0001' AS pipeline_run_id, DATE '2026-04-01' AS batch_date, "
           "TIMESTAMP '2026-04-01 06:00:00' AS ingestion_ts")
CAPACITY_X = 5000.0
FEEDER_X = "7"
BACKFILL_MONTH = "1996-01-01"


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _utc(spark: SparkSession) -> None:
    """The settings that the jobs of this file need, in whatever session they are run (``session.BASE_CONF`` has them too)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set(*HASH_JOIN)
    spark.conf.set(*SCAN_SPLIT)


def ntz(df: DataFrame) -> DataFrame:
    """Zone-less output timestamps (wall clock in UTC) so every engine reads the same value."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])


# ------------------------------------------------------------------ conformed building blocks
def dim_rows(spark, d, third=False) -> DataFrame:
    _utc(spark)
    frames = [conform_dim_source(tb.seg1(spark, d), UTILITY1), conform_dim_source(tb.circ2(spark, d), UTILITY2)]
    if third:
        frames.append(conform_dim_source(tb.circ3(spark, d), tb.UTILITY3))
    return union_all(frames)


def dim_latest(spark, d, third=False) -> DataFrame:
    return latest_per_key(drop_failing(dim_rows(spark, d, third), DIM_CHECKS), DIM_KEYS, DIM_ORDER)


def fact_rows(spark, d) -> DataFrame:
    _utc(spark)
    _, fact, _ = build_conformed(tb.raw_sources(spark, d), [UTILITY1, UTILITY2])
    return fact


def fact_latest(spark, d) -> DataFrame:
    return latest_per_key(fact_rows(spark, d), FACT_KEYS, FACT_ORDER)


def u1_fact_rows(spark, d) -> DataFrame:
    _utc(spark)
    seg = tb.seg1(spark, d)
    d1 = tb.der1(spark, d)
    return conform_facts({st: d1[ds.dataset] for st, ds in UTILITY1.der}, UTILITY1, conform_lookup_source(seg, UTILITY1))


# ------------------------------------------------------------------ scalars
@register("key_normalise", """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_linenumber % 4 = 3 THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END AS feeder_key
    FROM lineitem""")
def q_key_normalise(spark, d):
    li = tb.table(spark, d, "lineitem")
    k, ln = F.col("l_suppkey"), F.col("l_linenumber") % 4
    raw = (F.when(ln == 0, k.cast("double").cast("string"))          # 7.0
           .when(ln == 1, k.cast("string"))                           # 7
           .when(ln == 2, F.concat(k.cast("string"), F.lit("E0")))    # 7E0
           .otherwise(F.concat(F.lit("S"), k.cast("string"))))        # not a number
    return li.select("l_orderkey", "l_linenumber", key_normalise(raw).alias("feeder_key"))


@register("lenient_cast", """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_linenumber % 4 = 3 THEN l_quantity ELSE NULL END AS value
    FROM lineitem""")
def q_lenient_cast(spark, d):
    li = tb.table(spark, d, "lineitem")
    ln = F.col("l_linenumber") % 4
    text = (F.when(ln == 0, F.lit("NULL")).when(ln == 1, F.lit(""))
            .when(ln == 2, F.col("l_returnflag")).otherwise(F.col("l_quantity").cast("string")))
    return li.select("l_orderkey", "l_linenumber", lenient_number(text).alias("value"))


@register("ts_parse", tb.with_views("""
    SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE refresh END AS last_refresh_date
    FROM circ2""", "circ2"))
def q_ts_parse(spark, d):
    _utc(spark)
    src = tb.circ2(spark, d).select(
        F.regexp_extract("Master_CDF", r"C_(\d+)", 1).cast("bigint").alias("c_custkey"), "hca_refresh_date")
    text = F.when(F.col("c_custkey") % 10 == 0, F.lit("na")).otherwise(F.col("hca_refresh_date"))
    return ntz(src.select("c_custkey", lenient_ts(text, UTILITY2.ts_format).alias("last_refresh_date")))


@register("wide_to_label", tb.with_views("SELECT der_id, status, batch_date, der_type FROM der1_typed", "der1_typed"))
def q_wide_to_label(spark, d):
    d1 = tb.der1(spark, d)        # labels need no feeder resolution
    return union_all([conform_fact_source(d1[ds.dataset], UTILITY1, st) for st, ds in UTILITY1.der]) \
        .select("der_id", "status", "batch_date", "der_type")


# ------------------------------------------------------------------ roll-up, bridge, resolution
@register("segment_rollup", tb.with_views(
    "SELECT batch_date, feeder_id, max_hosting_capacity, min_hosting_capacity, last_refresh_date, voltage_kv "
    "FROM dim1_rows", "dim1_rows"))
def q_segment_rollup(spark, d):
    _utc(spark)
    s = UTILITY1
    return ntz(segment_rollup(tb.seg1(spark, d), s.feeder_id, s.max_hc, s.min_hc, s.refresh_date, s.voltage))


@register("bridge_build", tb.with_views("SELECT DISTINCT circuit_id, feeder_id FROM seg1", "seg1"))
def q_bridge_build(spark, d):
    return bridge_build(tb.seg1(spark, d), UTILITY1.circuit_id, UTILITY1.feeder_id)


@register("bridge_one_per_key", tb.with_views("SELECT circuit_id, feeder_id FROM bridge1", "bridge1"))
def q_bridge_one_per_key(spark, d):
    return bridge_one_per_key(bridge_build(tb.seg1(spark, d), UTILITY1.circuit_id, UTILITY1.feeder_id))


@register("resolve_two_step", tb.with_views(
    "SELECT der_id, status, source_feeder_ref, feeder_id, feeder_id_unresolved, batch_date FROM f1", "f1"))
def q_resolve_two_step(spark, d):
    return u1_fact_rows(spark, d).select("der_id", "status", "source_feeder_ref", "feeder_id",
                                         "feeder_id_unresolved", "batch_date")


@register("der_id_exact", """
    SELECT 'utility1' AS utility_id, status, count(*) AS total_rows, count(DISTINCT der_id) AS der_ids FROM (
        SELECT CASE l_linestatus WHEN 'F' THEN 'installed' ELSE 'planned' END AS status,
               CASE l_linenumber % 4 WHEN 0 THEN l_orderkey::VARCHAR || '.' || l_linenumber::VARCHAR
                    WHEN 1 THEN '00' || l_orderkey::VARCHAR || '0' || l_linenumber::VARCHAR
                    WHEN 2 THEN l_orderkey::VARCHAR || 'E' || l_linenumber::VARCHAR
                    ELSE l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR END AS der_id FROM lineitem)
    GROUP BY status""")
def q_der_id_exact(spark, d):
    """DER ids with fractions, leading zeros and exponents: all distinct ids survive conform and dedup."""
    _utc(spark)
    part = lambda i: F.split("ProjectID", "-").getItem(i)
    spelled = (F.when(part(1).cast("int") % 4 == 0, F.concat(part(0), F.lit("."), part(1)))
               .when(part(1).cast("int") % 4 == 1, F.concat(F.lit("00"), part(0), F.lit("0"), part(1)))
               .when(part(1).cast("int") % 4 == 2, F.concat(part(0), F.lit("E"), part(1))).otherwise(F.col("ProjectID")))
    d1 = {k: v.withColumn("ProjectID", spelled) for k, v in tb.der1(spark, d).items()}
    rows = conform_facts({st: d1[ds.dataset] for st, ds in UTILITY1.der}, UTILITY1, conform_lookup_source(tb.seg1(spark, d), UTILITY1))
    kept = latest_per_key(rows, FACT_KEYS, FACT_ORDER).groupBy("utility_id", "status").agg(F.count("*").alias("der_ids"))
    return rows.groupBy("utility_id", "status").agg(F.count("*").alias("total_rows")).join(kept, ["utility_id", "status"])


@register("conform_dim", tb.with_views("SELECT * FROM dim_latest", "dim_latest"))
def q_conform_dim(spark, d):
    return ntz(dim_latest(spark, d))


@register("third_source", tb.with_views(
    tb.latest_sql("(SELECT * FROM dim_all WHERE feeder_id IS NOT NULL UNION ALL SELECT * FROM dim3_rows)",
                  "utility_id, feeder_id", tb.LATEST_DIM_ORDER), "dim_all", "dim3_rows"))
def q_third_source(spark, d):
    return ntz(dim_latest(spark, d, third=True))


@register("third_source_ders", tb.with_views(
    tb.latest_sql("(SELECT * FROM fact_all UNION ALL SELECT * FROM f3)", "utility_id, der_id, status", tb.LATEST_FACT_ORDER), "fact_all", "f3"))
def q_third_source_ders(spark, d):
    """All three sources' DERs; the third is one more spec."""
    _utc(spark)
    _, fact, _ = build_conformed(tb.raw_sources(spark, d, third=True), [UTILITY1, UTILITY2, tb.UTILITY3])
    return latest_per_key(fact, FACT_KEYS, FACT_ORDER)


@register("conform_fact", tb.with_views("SELECT * FROM fact_latest", "fact_latest"))
def q_conform_fact(spark, d):
    return fact_latest(spark, d)


@register("latest_fact", tb.with_views(
    tb.latest_sql("f1", "utility_id, der_id, status", tb.LATEST_FACT_ORDER), "f1"))
def q_latest_fact(spark, d):
    return latest_per_key(u1_fact_rows(spark, d), FACT_KEYS, FACT_ORDER)


def circ2_twice(spark, d) -> DataFrame:
    """Source 2 feeders sent twice in one batch: every 4th feeder again, changed and refreshed later."""
    c = tb.circ2(spark, d)
    key = F.regexp_extract("Master_CDF", r"C_(\d+)", 1).cast("bigint")
    again = c.where(key % 4 == 0).select(
        "Master_CDF",
        (F.col("feeder_max_hc") + 100).alias("feeder_max_hc"),
        "feeder_min_hc", F.regexp_replace("hca_refresh_date", "^2022/", "2023/").alias("hca_refresh_date"),
        "feeder_voltage", "batch_date")
    return c.unionByName(again)


@register("latest_dim", tb.with_views(tb.latest_sql("""(
    SELECT utility_id, feeder_id, max_hosting_capacity, min_hosting_capacity, last_refresh_date, voltage_kv, batch_date
    FROM dim2_rows
    UNION ALL
    SELECT 'utility2', feeder_id, max_hc + 100, min_hc, refresh + INTERVAL 1 YEAR, voltage, batch_date
    FROM circ2 WHERE c_custkey % 4 = 0)""", "utility_id, feeder_id", tb.LATEST_DIM_ORDER), "dim2_rows", "circ2"))
def q_latest_dim(spark, d):
    _utc(spark)
    return ntz(latest_per_key(conform_dim_source(circ2_twice(spark, d), UTILITY2), DIM_KEYS, DIM_ORDER))


# ------------------------------------------------------------------ upsert, history
UPSERT_DIM_SQL = """
    WITH t AS (SELECT * FROM dim2_rows WHERE CAST(substr(feeder_id, 3) AS BIGINT) % 3 <> 0),
         s AS (SELECT utility_id, feeder_id, max_hosting_capacity + 1 AS max_hosting_capacity, min_hosting_capacity,
                      last_refresh_date, voltage_kv, batch_date
               FROM dim2_rows WHERE CAST(substr(feeder_id, 3) AS BIGINT) % 3 = 0 OR CAST(substr(feeder_id, 3) AS BIGINT) % 2 = 0)
    SELECT * FROM t WHERE feeder_id NOT IN (SELECT feeder_id FROM s) UNION ALL SELECT * FROM s"""


@register("upsert_dim", tb.with_views(UPSERT_DIM_SQL, "dim2_rows"))
def q_upsert_dim(spark, d):
    _utc(spark)
    dim = conform_dim_source(tb.circ2(spark, d), UTILITY2)
    k = F.substring("feeder_id", 3, 20).cast("bigint")
    target = dim.where(k % 3 != 0)
    source = dim.where((k % 3 == 0) | (k % 2 == 0)).withColumn("max_hosting_capacity", F.col("max_hosting_capacity") + 1)
    return ntz(upsert(target, source, DIM_KEYS))


UPSERT_FACT_SQL = """
    WITH t AS (SELECT * FROM f2 WHERE CAST(der_id AS BIGINT) % 3 <> 0),
         s AS (SELECT utility_id, der_id, der_type, capacity_kw + 1 AS capacity_kw, status, feeder_id,
                      feeder_id_unresolved, source_feeder_ref, batch_date
               FROM f2 WHERE CAST(der_id AS BIGINT) % 3 = 0 OR CAST(der_id AS BIGINT) % 2 = 0)
    SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.utility_id = t.utility_id AND s.der_id = t.der_id
                                      AND s.status = t.status)
    UNION ALL SELECT * FROM s"""


@register("upsert_fact", tb.with_views(UPSERT_FACT_SQL, "f2"))
def q_upsert_fact(spark, d):
    d2 = tb.der2(spark, d)
    fact = union_all([conform_fact_source(d2[ds.dataset], UTILITY2, st) for st, ds in UTILITY2.der])
    k = F.col("der_id").cast("bigint")
    target = fact.where(k % 3 != 0)
    source = fact.where((k % 3 == 0) | (k % 2 == 0)).withColumn("capacity_kw", F.col("capacity_kw") + 1)
    return upsert(target, source, FACT_KEYS)


UPSERT_NEWER_SQL = """
    WITH s AS (SELECT * REPLACE (capacity_kw + 1 AS capacity_kw, CASE WHEN CAST(der_id AS BIGINT) % 2 = 0
                      THEN batch_date + INTERVAL 1 MONTH ELSE batch_date - INTERVAL 1 MONTH END::DATE AS batch_date)
               FROM f2 WHERE CAST(der_id AS BIGINT) % 3 <> 1),
         t AS (SELECT * FROM f2 WHERE CAST(der_id AS BIGINT) % 3 <> 2)
    SELECT s.* FROM s LEFT JOIN t USING (utility_id, der_id, status) WHERE t.batch_date IS NULL OR s.batch_date >= t.batch_date
    UNION ALL
    SELECT t.* FROM t LEFT JOIN s USING (utility_id, der_id, status) WHERE s.batch_date IS NULL OR s.batch_date < t.batch_date"""


@register("upsert_only_newer", tb.with_views(UPSERT_NEWER_SQL, "f2"))
def q_upsert_only_newer(spark, d):
    """A re-sent batch replaces a row only where it isn't older; every DER is in the target, the batch or both."""
    d2 = tb.der2(spark, d)
    fact = conform_facts({st: d2[ds.dataset] for st, ds in UTILITY2.der}, UTILITY2)
    k = F.col("der_id").cast("bigint")
    months = F.when(k % 2 == 0, F.add_months("batch_date", 1)).otherwise(F.add_months("batch_date", -1))
    source = fact.where(k % 3 != 1).withColumns({"capacity_kw": F.col("capacity_kw") + 1, "batch_date": months})
    return upsert(fact.where(k % 3 != 2), source, FACT_KEYS, only_newer=True)


@register("upsert_keyed", tb.with_views("""
    SELECT * REPLACE (capacity_kw + CASE WHEN CAST(der_id AS BIGINT) % 3 = 0 OR CAST(der_id AS BIGINT) % 2 = 0 THEN 1 ELSE 0 END
                      + CASE WHEN CAST(der_id AS BIGINT) = (SELECT min(o_orderkey) FROM orders) THEN 5 ELSE 0 END AS capacity_kw)
    FROM f2""", "f2"))
def q_upsert_keyed(spark, d):
    """A fact table in buckets of its key: two thirds loaded, a batch that changes and adds, then a batch of a single DER, which rewrites one bucket."""
    d2 = tb.der2(spark, d)
    fact = conform_facts({st: d2[ds.dataset] for st, ds in UTILITY2.der}, UTILITY2)
    k, path = F.col("der_id").cast("bigint"), scratch_path(spark, "fact-keyed")
    upsert_keyed(fact.where(k % 3 != 0), path, FACT_KEYS, ("utility_id",), 16)
    upsert_keyed(fact.where((k % 3 == 0) | (k % 2 == 0)).withColumn("capacity_kw", F.col("capacity_kw") + 1), path, FACT_KEYS, ("utility_id",), 16)
    state = without_bucket(read_keyed(spark, path, fact.schema))
    least = state.agg(F.min(k).alias("k"))
    one = state.join(least, F.col("der_id").cast("bigint") == F.col("k"), "left_semi").withColumn("capacity_kw", F.col("capacity_kw") + 5)
    done = upsert_keyed(one, path, FACT_KEYS, ("utility_id",), 16)
    out = without_bucket(read_keyed(spark, path, fact.schema)).select(*fact.columns)
    # the last batch is a single DER: that it rewrote one bucket is part of the result
    return ntz(out.where(F.lit(done["buckets"] == 1)))


@register("scd2_history", """
    WITH h AS (
        SELECT o_custkey, o_orderpriority, o_orderdate, o_orderkey,
               lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
        FROM orders),
    s AS (SELECT * FROM h WHERE rn = 1 OR prev IS DISTINCT FROM o_orderpriority)
    SELECT o_custkey, o_orderpriority, o_orderdate AS effective_from,
           lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS effective_to,
           lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) IS NULL AS is_current
    FROM s""")
def q_scd2_history(spark, d):
    o = tb.table(spark, d, "orders")
    return scd2_from_history(o, ["o_custkey"], ["o_orderpriority"], "o_orderdate", ["o_orderkey"])


SCD2_CUT, SCD2_END = "1997-01-01", "2002-01-01"


def _latest_priority(orders: DataFrame) -> DataFrame:
    return latest_per_key(orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority"),
                          ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderpriority")


@register("scd2_apply", f"""
    WITH b1 AS (SELECT o_custkey, o_orderpriority FROM (
                    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
                    FROM orders WHERE o_orderdate < TIMESTAMP '{SCD2_CUT}') WHERE rn = 1),
         b2 AS (SELECT o_custkey, o_orderpriority FROM (
                    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
                    FROM orders) WHERE rn = 1),
         kept AS (SELECT b1.* FROM b1 LEFT JOIN b2 USING (o_custkey)
                  WHERE b2.o_custkey IS NULL OR b2.o_orderpriority IS NOT DISTINCT FROM b1.o_orderpriority),
         closing AS (SELECT b1.* FROM b1 JOIN b2 USING (o_custkey)
                     WHERE b2.o_orderpriority IS DISTINCT FROM b1.o_orderpriority)
    SELECT o_custkey, o_orderpriority, DATE '{SCD2_CUT}' AS effective_from, NULL::DATE AS effective_to,
           true AS is_current FROM kept
    UNION ALL
    SELECT o_custkey, o_orderpriority, DATE '{SCD2_CUT}', DATE '{SCD2_END}', false FROM closing
    UNION ALL
    SELECT o_custkey, o_orderpriority, DATE '{SCD2_END}', NULL::DATE, true FROM b2
    WHERE o_custkey NOT IN (SELECT o_custkey FROM kept)""")
def q_scd2_apply(spark, d):
    """A type-2 table built from one batch, then a later batch applied: changed keys closed and re-opened."""
    o = tb.table(spark, d, "orders")
    first = _latest_priority(o.where(F.col("o_orderdate") < F.lit(SCD2_CUT).cast("timestamp_ntz")))
    current = scd2_apply(None, first, ["o_custkey"], ["o_orderpriority"], date.fromisoformat(SCD2_CUT))
    return scd2_apply(current, _latest_priority(o), ["o_custkey"], ["o_orderpriority"], date.fromisoformat(SCD2_END))


YEARS_APPLIED = (1995, 1992, 1998, 1993, 1997, 1994, 1996, 1993)  # late batches, and one that is sent twice


@register("scd2_late", """
    WITH y AS (SELECT o_custkey, CAST(date_trunc('year', o_orderdate) AS DATE) AS day, o_orderpriority,
                      row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders),
    h AS (SELECT *, lag(o_orderpriority) OVER w AS prev, row_number() OVER w AS n FROM y WHERE rn = 1 WINDOW w AS (PARTITION BY o_custkey ORDER BY day)),
    s AS (SELECT * FROM h WHERE n = 1 OR prev IS DISTINCT FROM o_orderpriority)
    SELECT o_custkey, o_orderpriority, day AS effective_from, lead(day) OVER (PARTITION BY o_custkey ORDER BY day) AS effective_to,
           lead(day) OVER (PARTITION BY o_custkey ORDER BY day) IS NULL AS is_current FROM s""")
def q_scd2_late(spark, d):
    """Yearly batches of the customers' last priority, applied out of order; one first came with other values and is sent again."""
    o = tb.table(spark, d, "orders").withColumn("_year", F.year("o_orderdate"))
    path, seen = scratch_path(spark, "scd2-late"), set()
    years = [r[0] for r in o.select("_year").distinct().collect()]
    for year in [*YEARS_APPLIED, *sorted(set(years) - set(YEARS_APPLIED))]:
        batch = _latest_priority(o.where(F.col("_year") == year))
        if year == YEARS_APPLIED[-1] and year not in seen:
            batch = batch.withColumn("o_orderpriority", F.reverse("o_orderpriority"))
        seen.add(year)
        publish(scd2_insert(read_table(spark, path), batch, ["o_custkey"], ["o_orderpriority"], date(year, 1, 1)), path)
    return read_table(spark, path).drop("seen")


# ------------------------------------------------------------------ checks
def circ2_with_nulls(spark, d) -> DataFrame:
    _utc(spark)
    dim = conform_dim_source(tb.circ2(spark, d), UTILITY2)
    k = F.substring("feeder_id", 3, 20).cast("bigint")
    return dim.withColumn("max_hosting_capacity",
                          F.when(k % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("max_hosting_capacity"))) \
              .withColumn("feeder_id", F.when(k % 19 == 0, F.lit(None).cast("string")).otherwise(F.col("feeder_id")))


CIRC2_NULLS = """
    SELECT 'utility2' AS utility_id, CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE feeder_id END AS feeder_id,
           CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE max_hc END AS max_hosting_capacity,
           min_hc AS min_hosting_capacity, refresh AS last_refresh_date, voltage AS voltage_kv, batch_date
    FROM circ2"""

WARN_CHECK = Check("hosting_capacity_non_neg", "max_hosting_capacity >= 0", "warn")


def _report_sql(rel: str, checks, guards_sql: list[str]) -> str:
    parts = []
    for i, (ch, g) in enumerate(zip(checks, guards_sql)):
        fails = f"NOT coalesce(({ch.predicate}), {'true' if ch.null_policy == 'ignore' else 'false'})"
        parts.append(
            f"SELECT {i} AS check_order, '{ch.name}' AS check_name, '{ch.severity}' AS severity, "
            f"count(*) FILTER (WHERE {g}) AS total_rows, "
            f"count(*) FILTER (WHERE ({g}) AND {fails}) AS failed_rows, "
            f"count(*) FILTER (WHERE ({g}) AND ({ch.predicate}) IS NULL) AS unknown_rows FROM {rel}")
    return "\nUNION ALL\n".join(parts)


def _guards_sql(checks) -> list[str]:
    g, out = "true", []
    for ch in checks:
        out.append(g)
        if ch.severity == "drop":
            g = f"{g} AND coalesce(({ch.predicate}), {'true' if ch.null_policy == 'ignore' else 'false'})"
    return out


@register("expect_warn", tb.with_views(
    f"WITH x AS ({CIRC2_NULLS}) " + _report_sql("x", [WARN_CHECK], ["true"]), "circ2"))
def q_expect_warn(spark, d):
    return check_report(circ2_with_nulls(spark, d), [WARN_CHECK])


DROP_CHECK = Check("feeder_id_not_null", "feeder_id IS NOT NULL", "drop")


@register("expect_drop", tb.with_views(f"WITH x AS ({CIRC2_NULLS}) SELECT * FROM x WHERE feeder_id IS NOT NULL", "circ2"))
def q_expect_drop(spark, d):
    return ntz(drop_failing(circ2_with_nulls(spark, d), [DROP_CHECK]))


COMPOSE = [Check("capacity_non_neg", "max_hosting_capacity >= 0", "drop"),
           Check("capacity_over_1000", "max_hosting_capacity > 1000", "drop"),
           Check("voltage_known", "voltage_kv IS NOT NULL", "warn")]


@register("expect_compose", tb.with_views(
    f"WITH x AS ({CIRC2_NULLS}) " + _report_sql("x", COMPOSE, _guards_sql(COMPOSE)), "circ2"))
def q_expect_compose(spark, d):
    return check_report(circ2_with_nulls(spark, d), COMPOSE)


@register("apply_checks", tb.with_views(f"WITH x AS ({CIRC2_NULLS}) SELECT * FROM x WHERE max_hosting_capacity > 1000", "circ2"))
def q_apply_checks(spark, d):
    """What is left after all checks were counted and settled in one go."""
    return ntz(apply_checks(circ2_with_nulls(spark, d), COMPOSE, "circuits")[0])


@register("expect_dim", tb.with_views(_report_sql("dim_all", list(DIM_CHECKS), _guards_sql(DIM_CHECKS)), "dim_all"))
def q_expect_dim(spark, d):
    return check_report(dim_rows(spark, d), list(DIM_CHECKS))


@register("expect_fact", tb.with_views(_report_sql("fact_latest", list(FACT_CHECKS), _guards_sql(FACT_CHECKS)),
                                       "fact_latest"))
def q_expect_fact(spark, d):
    return check_report(fact_latest(spark, d), list(FACT_CHECKS))


FAIL_CHECKS = [Check("der_id_not_null", "der_id IS NOT NULL", "fail")]


@register("expect_fail", tb.with_views("""
    SELECT utility_id, NULL::VARCHAR AS der_id, der_type, capacity_kw, status, feeder_id, feeder_id_unresolved,
           source_feeder_ref, batch_date
    FROM f2 WHERE CAST(der_id AS BIGINT) % 97 = 0""", "f2"))
def q_expect_fail(spark, d):
    d2 = tb.der2(spark, d)
    fact = union_all([conform_fact_source(d2[ds.dataset], UTILITY2, st) for st, ds in UTILITY2.der])
    broken = fact.withColumn("der_id", F.when(F.col("der_id").cast("bigint") % 97 == 0, F.lit(None).cast("string"))
                             .otherwise(F.col("der_id")))
    return failing_rows(broken, FAIL_CHECKS, 0)


# ------------------------------------------------------------------ serving
@register("serve_capacity", tb.with_views("SELECT * FROM dim_latest", "dim_latest"))
def q_serve_capacity(spark, d):
    path = scratch_path(spark, "feeder_capacity")
    publish(dim_latest(spark, d), path, partition_cols=("utility_id",), cluster_cols=CAPACITY_CLUSTER,
            materialise=True)
    return ntz(read_table(spark, path))


@register("clustered_write", tb.with_views("SELECT * FROM dim_latest", "dim_latest"))
def q_clustered_write(spark, d):
    path = scratch_path(spark, "clustered")
    clustered_write(dim_latest(spark, d), path, "utility_id", CAPACITY_CLUSTER, materialise=True)
    return ntz(spark.read.parquet(path))


@register("serve_details", tb.with_views("SELECT * FROM details", "details"))
def q_serve_details(spark, d):
    return ntz(feeder_details(fact_latest(spark, d), dim_latest(spark, d)))


@register("q_capacity_over", tb.with_views(f"SELECT * FROM dim_latest WHERE max_hosting_capacity > {CAPACITY_X}",
                                           "dim_latest"))
def q_q_capacity_over(spark, d):
    path = scratch_path(spark, "feeder_capacity")
    publish(dim_latest(spark, d), path, partition_cols=("utility_id",), cluster_cols=CAPACITY_CLUSTER,
            materialise=True)
    return ntz(q_capacity_over(read_table(spark, path), CAPACITY_X))


@register("q_feeder_ders", tb.with_views(f"SELECT * FROM details WHERE feeder_id = '{FEEDER_X}'", "details"))
def q_q_feeder_ders(spark, d):
    """Point lookup on the published details table, laid out by (utility, feeder) for file skipping."""
    path = scratch_path(spark, "feeder_der_details")
    publish(feeder_details(fact_latest(spark, d), dim_latest(spark, d)), path, ("utility_id",), cluster_cols=DETAILS_CLUSTER,
            materialise=True)
    return ntz(q_feeder_ders(read_table(spark, path), FEEDER_X))


@register("q_feeder_ders_of", tb.with_views(f"SELECT *, row_number() OVER (ORDER BY status, der_type, der_id) AS place FROM details "
                                            f"WHERE feeder_id = '{FEEDER_X}' AND utility_id = 'utility1'", "details"))
def q_q_feeder_ders_of(spark, d):
    """The same lookup for one source; ``place`` is the row's place in the listing's order."""
    path = scratch_path(spark, "feeder_der_details")
    publish(feeder_details(fact_latest(spark, d), dim_latest(spark, d)), path, ("utility_id",), cluster_cols=DETAILS_CLUSTER,
            materialise=True)
    listed = q_feeder_ders(read_table(spark, path), FEEDER_X, "utility1")
    order = Window.orderBy("status", "der_type", "der_id")     # one feeder's DERs
    return ntz(listed.withColumn("place", F.row_number().over(order)))


@register("clustered_details", tb.with_views("SELECT * FROM details", "details"))
def q_clustered_details(spark, d):
    path = scratch_path(spark, "clustered-details")
    clustered_write(feeder_details(fact_latest(spark, d), dim_latest(spark, d)), path, "utility_id", DETAILS_CLUSTER, materialise=True)
    return ntz(spark.read.parquet(path))


@register("top_capacity", tb.with_views("""
    SELECT utility_id, feeder_id, max_hosting_capacity, voltage_kv, last_refresh_date FROM dim_latest
    WHERE max_hosting_capacity > 5 ORDER BY max_hosting_capacity DESC, utility_id, feeder_id LIMIT 20""", "dim_latest"))
def q_top_capacity(spark, d):
    return ntz(top_capacity(dim_latest(spark, d), 5.0, 20))


@register("sample_feeder", tb.with_views("SELECT min(feeder_id) AS feeder_id FROM details WHERE feeder_id IS NOT NULL",
                                         "details"))
def q_sample_feeder(spark, d):
    return sample_feeder(feeder_details(fact_latest(spark, d), dim_latest(spark, d)))


QUALITY_SQL = f"""
    SELECT utility_id, 'circuits' AS dataset, NULL::VARCHAR AS status, count(*) AS total_rows,
           0::BIGINT AS null_feeder_id_count, 0::BIGINT AS unresolved_feeder_id_count,
           max(last_refresh_date) AS last_refresh_date, {CTX_SQL}
    FROM dim_latest GROUP BY utility_id
    UNION ALL
    SELECT utility_id, 'der', status, count(*), count(*) FILTER (WHERE feeder_id IS NULL),
           count(*) FILTER (WHERE feeder_id_unresolved), NULL::TIMESTAMP, {CTX_SQL}
    FROM fact_latest GROUP BY utility_id, status"""


@register("quality_summary", tb.with_views(QUALITY_SQL, "dim_latest", "fact_latest"))
def q_quality_summary(spark, d):
    return ntz(quality_summary(dim_latest(spark, d), fact_latest(spark, d), FIXED_CTX))


@register("quality_snapshot", tb.with_views(f"SELECT * FROM ({QUALITY_SQL}) ORDER BY ingestion_ts DESC, utility_id, status NULLS FIRST",
                                            "dim_latest", "fact_latest"))
def q_quality_snapshot(spark, d):
    return ntz(quality_snapshot(quality_summary(dim_latest(spark, d), fact_latest(spark, d), FIXED_CTX)))


@register("missing_categories", tb.with_views("""
    SELECT utility_id, status, count(*) AS total_rows,
           count(*) FILTER (WHERE source_feeder_ref IS NULL) AS no_source_id,
           count(*) FILTER (WHERE source_feeder_ref IS NOT NULL AND feeder_id IS NULL) AS unresolvable_id,
           count(*) FILTER (WHERE feeder_id IS NOT NULL AND feeder_data_missing) AS feeder_without_data,
           count(*) FILTER (WHERE feeder_id IS NOT NULL AND NOT feeder_matched) AS feeder_unmatched
    FROM details GROUP BY utility_id, status""", "details"))
def q_missing_categories(spark, d):
    return missing_categories(feeder_details(fact_latest(spark, d), dim_latest(spark, d)))


# ------------------------------------------------------------------ operational queries
@register("dup_keys", tb.with_views(
    "SELECT der_id, status, count(*) AS n FROM der1 GROUP BY der_id, status HAVING count(*) > 1", "der1"))
def q_dup_keys(spark, d):
    d1 = tb.der1_all(spark, d).select(
        "ProjectID", F.when(F.col("l_linestatus") == "F", "installed").otherwise("planned").alias("status"))
    return dup_keys(d1, ["ProjectID", "status"]).withColumnRenamed("ProjectID", "der_id")


def der1_runs(spark, d) -> DataFrame:
    """Raw DER rows of source 1 with each monthly batch written by its own run."""
    return tb.der1_all(spark, d).select(
        "*",
        F.concat(F.lit("run-"), F.date_format("batch_date", "yyyyMM")).alias("pipeline_run_id"),
        (F.col("batch_date").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")).alias("ingestion_ts"))


@register("run_summary", tb.with_views("""
    SELECT 'run-' || strftime(batch_date, '%Y%m') AS pipeline_run_id, batch_date,
           max(CAST(batch_date AS TIMESTAMP) + INTERVAL 1 DAY) AS last_ingestion_ts, count(*) AS row_count
    FROM der1 GROUP BY 1, 2 ORDER BY last_ingestion_ts DESC, pipeline_run_id, batch_date LIMIT 10""", "der1"))
def q_run_summary(spark, d):
    return run_summary(der1_runs(spark, d), 10)


def der1_null_ids(spark, d) -> DataFrame:
    """Raw DER rows of source 1 of which some lack the project id, more of them in some batches."""
    rows = tb.der1_all(spark, d).withColumn("utility_id", F.lit("utility1"))
    key = F.split("ProjectID", "-").getItem(0).cast("bigint")
    lost = F.when(F.month("batch_date") % 4 == 0, key % 10 == 0).when(F.month("batch_date") % 4 == 1, key % 40 == 0).otherwise(key % 997 == 0)
    return rows.withColumn("ProjectID", F.when(~lost, F.col("ProjectID")))


NULL_IDS_SQL = """
    SELECT *, CASE WHEN month(batch_date) % 4 = 0 THEN l_orderkey % 10 = 0 WHEN month(batch_date) % 4 = 1 THEN l_orderkey % 40 = 0
                   ELSE l_orderkey % 997 = 0 END AS lost FROM der1"""


@register("null_key_triage", tb.with_views(f"""
    SELECT 'utility1' AS utility_id, batch_date, count(*) AS total_rows, count(*) FILTER (WHERE lost) AS null_key_rows,
           round(avg(CAST(lost AS DOUBLE)), 6) AS null_key_rate,
           CASE WHEN round(avg(CAST(lost AS DOUBLE)), 6) < 0.01 THEN 'tolerable'
                WHEN round(avg(CAST(lost AS DOUBLE)), 6) > 0.05 THEN 'format_change'
                ELSE 'investigate' END AS triage
    FROM ({NULL_IDS_SQL}) GROUP BY batch_date""", "der1"))
def q_null_key_triage(spark, d):
    """Missing DER ids per raw batch."""
    return null_key_triage(der1_null_ids(spark, d), "ProjectID", ("utility_id", "batch_date"))


@register("null_key_rows", tb.with_views(f"""
    SELECT ref AS source_feeder_ref, capacity_kw, batch_date FROM ({NULL_IDS_SQL}) WHERE lost""", "der1"))
def q_null_key_rows(spark, d):
    """The raw rows without a DER id themselves."""
    rows = null_key_rows(der1_null_ids(spark, d), "ProjectID")
    return rows.select(F.col("ProjectCircuitID").alias("source_feeder_ref"), F.col("NamePlateRating").alias("capacity_kw"), "batch_date")


def _drift_sql(dataset: str, rel: str, expected: dict[str, str], nulls: dict[str, str], fails: dict[str, str], absent: set[str]) -> str:
    rows = []
    for c, t in expected.items():
        rates = ("false AS present, NULL::DOUBLE AS null_rate, NULL::DOUBLE AS cast_fail_rate" if c in absent else
                 f"true AS present, round(count(*) FILTER (WHERE {nulls.get(c, 'false')}) / count(*), 6) AS null_rate, "
                 f"round(count(*) FILTER (WHERE {fails.get(c, 'false')}) / count(*), 6) AS cast_fail_rate")
        rows.append(f"SELECT '{dataset}' AS dataset, batch_date, count(*) AS total_rows, '{c}' AS column_name, '{t}' AS expected_type, "
                    f"{rates} FROM {rel} GROUP BY batch_date")
    return "\nUNION ALL\n".join(rows)


DRIFT_DER = expected_columns(UTILITY1, "install_der")
DRIFT_CIRCUITS = expected_columns(UTILITY2, "circuits")
DRIFT_SQL = "\nUNION ALL\n".join([
    _drift_sql("utility1_der", "der1", DRIFT_DER, {"ProjectCircuitID": "ref IS NULL"}, {"NamePlateRating": "l_orderkey % 10 = 0"},
               set(DRIFT_DER) - {"ProjectID", "ProjectCircuitID", "NamePlateRating", "Hybrid", "SolarPV", "Wind", "Other"}),
    _drift_sql("utility2_circuits", "circ2", DRIFT_CIRCUITS, {"feeder_voltage": "voltage IS NULL"}, {"hca_refresh_date": "c_custkey % 9 = 0"}, set()),
])


@register("schema_drift", tb.with_views(DRIFT_SQL, "der1", "circ2"))
def q_schema_drift(spark, d):
    """Both sources' mapped columns, taken from their specs, the date by the spec's own pattern."""
    _utc(spark)

    def text(df):
        return df.select(*[F.col(c).cast("string").alias(c) if c != "batch_date" else F.col(c) for c in df.columns])

    li_key = F.split("ProjectID", "-").getItem(0).cast("bigint")
    der = text(tb.der1_all(spark, d)).withColumn(
        "NamePlateRating", F.when(li_key % 10 == 0, F.lit("n/a")).otherwise(F.col("NamePlateRating")))
    key = F.regexp_extract("Master_CDF", r"C_(\d+)", 1).cast("bigint")
    circuits = text(tb.circ2(spark, d)).withColumn(
        "hca_refresh_date", F.when(key % 9 == 0, F.lit("2022-10")).otherwise(F.col("hca_refresh_date")))
    frames = [schema_drift(der, DRIFT_DER, ["batch_date"], UTILITY1.ts_format).withColumn("dataset", F.lit("utility1_der")),
              schema_drift(circuits, DRIFT_CIRCUITS, ["batch_date"], UTILITY2.ts_format).withColumn("dataset", F.lit("utility2_circuits"))]
    return union_all(frames)


# ------------------------------------------------------------------ raw layer
def _write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    df.select(*[F.col(c).cast("string") for c in df.columns]).write.option("header", "true").csv(path, compression=compression)


CUSTOMER_TYPES = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
                  "c_mktsegment": "string"}


def customer_back(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in CUSTOMER_TYPES.items()])


@register("csv_ingest", "SELECT * FROM customer")
def q_csv_ingest(spark, d):
    c = tb.table(spark, d, "customer")
    land = scratch_path(spark, "landing-customer")
    bom = c.where(F.col("c_custkey") % 2 == 0)
    bom = bom.toDF(*[("\ufeff" + n) if i == 0 else n for i, n in enumerate(bom.columns)])   # BOM in the header
    _write_csv(bom, f"{land}/a")
    other = c.where(F.col("c_custkey") % 2 == 1).select(*reversed(c.columns))                # another column order
    _write_csv(other, f"{land}/b")
    path = scratch_path(spark, "customer")
    csv_load(spark, [f"{land}/a", f"{land}/b"], lambda rows: publish(rows, path))
    return customer_back(read_table(spark, path))


@register("header_clean", "SELECT * FROM customer")
def q_header_clean(spark, d):
    c = tb.table(spark, d, "customer")
    messy = c.toDF(*[f" \ufeff{n}  " for n in c.columns])
    return header_clean(messy)


@register("provenance", "SELECT *, 'utility2' AS utility_id, 'customer.parquet' AS source_file FROM customer")
def q_provenance(spark, d):
    return provenance(tb.table(spark, d, "customer"), "utility2", file_name_only=True)


@register("audit_stamp", f"SELECT *, {CTX_SQL} FROM customer")
def q_audit_stamp(spark, d):
    return audit_stamp(tb.table(spark, d, "customer"), FIXED_CTX)


def orders_by_month(spark, d) -> DataFrame:
    o = tb.table(spark, d, "orders")
    return o.withColumn("batch_date", F.trunc(F.col("o_orderdate").cast("date"), "month"))


REPLACED_SQL = f"""
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN CAST(date_trunc('month', o_orderdate) AS DATE) = DATE '{BACKFILL_MONTH}'
                THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           o_orderdate, o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS batch_date
    FROM orders
    WHERE NOT (CAST(date_trunc('month', o_orderdate) AS DATE) = DATE '{BACKFILL_MONTH}' AND o_orderkey % 2 = 1)"""


def replaced_orders_table(spark, d) -> str:
    path = scratch_path(spark, "raw-orders")
    ob = orders_by_month(spark, d)
    partition_replace(ob, path, ["batch_date"])
    resend = ob.where((F.col("batch_date") == F.lit(BACKFILL_MONTH).cast("date")) & (F.col("o_orderkey") % 2 == 0)) \
               .withColumn("o_totalprice", F.col("o_totalprice") + 1)
    partition_replace(resend, path, ["batch_date"])
    return path


@register("partition_replace", REPLACED_SQL)
def q_partition_replace(spark, d):
    path = replaced_orders_table(spark, d)
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                           "o_orderdate", "o_orderpriority", "batch_date")


@register("batch_scan", f"SELECT * FROM ({REPLACED_SQL}) WHERE batch_date = DATE '{BACKFILL_MONTH}'")
def q_batch_scan(spark, d):
    path = replaced_orders_table(spark, d)
    return batch_scan(spark, path, batch_date=BACKFILL_MONTH).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "batch_date")


@register("write_metrics", "SELECT count(*) AS written_rows, count(*) FILTER (WHERE o_orderstatus = 'F') AS written_f FROM orders")
def q_write_metrics(spark, d):
    path = scratch_path(spark, "orders-by-status")
    m = write_observed(tb.table(spark, d, "orders"),
                       lambda x: x.write.partitionBy("o_orderstatus").parquet(path), "orders",
                       extra=[F.count_if(F.col("o_orderstatus") == "F").alias("written_f")])
    # the metrics were gathered by the write job itself; each is given only if the stored rows say the same
    back = spark.read.parquet(path).agg(F.count("*").alias("rows"), F.count_if(F.col("o_orderstatus") == "F").alias("f"))
    return back.select(F.when(F.col("rows") == m["rows"], F.col("rows")).alias("written_rows"),
                       F.when(F.col("f") == m["written_f"], F.col("f")).alias("written_f"))


STREAM_COLUMNS = list(CUSTOMER_TYPES)


@register("stream_ingest", "SELECT * FROM customer")
def q_stream_ingest(spark, d):
    c = tb.table(spark, d, "customer")
    land = scratch_path(spark, "landing-stream")
    table_path = scratch_path(spark, "raw-stream")
    ckpt = scratch_path(spark, "ckpt-stream")
    _write_csv(c.where(F.col("c_custkey") % 2 == 0), f"{land}/drop1")
    stream_ingest(spark, land + "/*", STREAM_COLUMNS, "utility2", table_path, ckpt, FIXED_CTX)
    _write_csv(c.where(F.col("c_custkey") % 2 == 1).select(*reversed(c.columns)), f"{land}/drop2")
    stream_ingest(spark, land + "/*", STREAM_COLUMNS, "utility2", table_path, ckpt, FIXED_CTX)
    stream_ingest(spark, land + "/*", STREAM_COLUMNS, "utility2", table_path, ckpt, FIXED_CTX)   # nothing new
    return customer_back(spark.read.parquet(table_path))


@register("batch_and_stream", "SELECT * FROM customer")
def q_batch_and_stream(spark, d):
    """One raw table: half of it from a batch drop, half from a stream."""
    c = tb.table(spark, d, "customer")
    land, table_path = scratch_path(spark, "landing-both"), scratch_path(spark, "raw-both")
    _write_csv(c.where(F.col("c_custkey") % 2 == 0), f"{land}/batch/drop")
    _write_csv(c.where(F.col("c_custkey") % 2 == 1), f"{land}/stream/drop")
    rows = audit_stamp(csv_scan(spark, f"{land}/batch/drop", source_id="utility2"), FIXED_CTX)
    for _ in range(2):                                  # the second load replaces the first
        load_batch(rows, table_path, "utility2", FIXED_CTX.batch_date, FIXED_CTX.pipeline_run_id)
    stream_ingest(spark, f"{land}/stream/*", STREAM_COLUMNS, "utility2", table_path, scratch_path(spark, "ckpt-both"), FIXED_CTX)
    return customer_back(batch_scan(spark, table_path, batch_date=FIXED_CTX.batch_date, source_id="utility2", run_id=FIXED_CTX.pipeline_run_id))


@register("stream_and_batch", "SELECT * FROM customer")
def q_stream_and_batch(spark, d):
    """One raw batch of a source with signs in its id: streamed, dropped, streamed, and the drop sent again in full.

    The drop's first load lacks rows, and one that a dead job left behind is still there; only the last one counts, beside all micro-batches.
    """
    c, source = tb.table(spark, d, "customer"), "u:2 50%/x"
    land, path, ckpt = (scratch_path(spark, f"{x}-mixed") for x in ("landing", "raw", "ckpt"))
    key = F.col("c_custkey") % 4

    def stream(k: int) -> None:
        _write_csv(c.where(key == k), f"{land}/stream/drop{k}")
        stream_ingest(spark, f"{land}/stream/*", STREAM_COLUMNS, source, path, ckpt, FIXED_CTX)

    def batch(rows: DataFrame, run: str) -> None:
        load_batch(audit_stamp(rows.withColumn("utility_id", F.lit(source)), FIXED_CTX), path, source, FIXED_CTX.batch_date, run)

    _write_csv(c.where(key >= 2), f"{land}/batch")
    drop = csv_scan(spark, f"{land}/batch")
    stream(0)
    batch(drop.where(F.length("c_custkey") > 1), "run-a")
    stream(1)
    batch(drop, "run-b")
    left = audit_stamp(drop.withColumn("utility_id", F.lit(source)), FIXED_CTX).withColumn(LOAD_COL, F.lit(f"{BATCH}-{1:015d}-dead"))
    partition_replace(left, path, RAW_PARTITIONS)
    return customer_back(batch_scan(spark, path, batch_date=FIXED_CTX.batch_date, source_id=source))


@register("stream_checks", """
    SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0""")
def q_stream_checks(spark, d):
    """Checks on a stream: a drop that fails leaves nothing, and its files are read again once the check allows it."""
    c = tb.table(spark, d, "customer")
    land, path, ckpt = (scratch_path(spark, f"{x}-checked") for x in ("landing", "raw", "ckpt"))
    _write_csv(c, f"{land}/drop")

    def run(*checks: Check) -> None:
        stream_ingest(spark, f"{land}/*", STREAM_COLUMNS, "utility2", path, ckpt, FIXED_CTX, checks=checks)

    try:
        run(Check("balance", "CAST(c_acctbal AS DOUBLE) >= 0", "fail"))
    except Exception as e:  # noqa: BLE001 the stream wraps the failed check
        if "check balance (fail)" not in str(e):
            raise
    run(Check("balance", "CAST(c_acctbal AS DOUBLE) >= 0", "drop"))
    return customer_back(batch_scan(spark, path)).select("c_custkey", "c_acctbal")


# Three batches of one raw table whose headers differ: all columns; one renamed and one more; one lacking and one renamed past recognition.
DRIFT_BATCHES = ("2024-01-01", "2024-02-01", "2024-03-01")
DRIFT_EXPECTED = {"o_orderkey": "double", "o_custkey": "double", "o_totalprice": "double", "o_orderpriority": "string"}


def drifting_loads(spark, d) -> str:
    path = scratch_path(spark, "raw-drift")
    o = tb.table(spark, d, "orders").select(*[F.col(c).cast("string") for c in DRIFT_EXPECTED], F.lit("utility2").alias("utility_id"))
    shapes = (lambda x: x, lambda x: x.withColumnRenamed("o_totalprice", "O_Total_Price").withColumn("remarks", F.col("o_orderkey")),
              lambda x: x.drop("o_orderpriority").withColumnRenamed("o_custkey", "buyer"))
    for i, (day, shape) in enumerate(zip(DRIFT_BATCHES, shapes)):
        rows = shape(o.where(F.col("o_orderkey").cast("bigint") % 3 == i)).withColumn("batch_date", F.lit(day).cast("date"))
        load_batch(rows, path, "utility2", day, f"run-{i}")
    return path


@register("header_drift", f"""
    SELECT 'utility2' AS utility_id, CAST(day AS DATE) AS batch_date, column_name, state, renamed FROM (VALUES
      ('{DRIFT_BATCHES[0]}', 'o_orderkey', 'present', NULL), ('{DRIFT_BATCHES[0]}', 'o_custkey', 'present', NULL),
      ('{DRIFT_BATCHES[0]}', 'o_totalprice', 'present', NULL), ('{DRIFT_BATCHES[0]}', 'o_orderpriority', 'present', NULL),
      ('{DRIFT_BATCHES[1]}', 'o_orderkey', 'present', NULL), ('{DRIFT_BATCHES[1]}', 'o_custkey', 'present', NULL),
      ('{DRIFT_BATCHES[1]}', 'o_totalprice', 'missing', 'O_Total_Price'), ('{DRIFT_BATCHES[1]}', 'O_Total_Price', 'unexpected', 'o_totalprice'),
      ('{DRIFT_BATCHES[1]}', 'remarks', 'unexpected', NULL), ('{DRIFT_BATCHES[1]}', 'o_orderpriority', 'present', NULL),
      ('{DRIFT_BATCHES[2]}', 'o_orderkey', 'present', NULL), ('{DRIFT_BATCHES[2]}', 'o_custkey', 'missing', NULL),
      ('{DRIFT_BATCHES[2]}', 'buyer', 'unexpected', NULL), ('{DRIFT_BATCHES[2]}', 'o_totalprice', 'present', NULL),
      ('{DRIFT_BATCHES[2]}', 'o_orderpriority', 'missing', NULL)) AS v(day, column_name, state, renamed)
    WHERE (SELECT count(DISTINCT o_orderkey % 3) FROM orders) = 3""")
def q_header_drift(spark, d):
    """Lacking, new and renamed columns of each batch of a raw table."""
    return header_drift(raw_headers(spark, drifting_loads(spark, d)), list(DRIFT_EXPECTED))


@register("schema_drift_by_batch", f"""
    WITH b AS (SELECT o_orderkey % 3 AS i, count(*) AS n, [{", ".join(f"DATE '{x}'" for x in DRIFT_BATCHES)}][CAST(o_orderkey % 3 AS INT) + 1] AS batch_date
               FROM orders GROUP BY o_orderkey % 3),
    c(column_name, expected_type, lacking) AS (VALUES ('o_orderkey', 'double', -1), ('o_custkey', 'double', 2), ('o_totalprice', 'double', 1), ('o_orderpriority', 'string', 2))
    SELECT batch_date, n AS total_rows, column_name, expected_type, i <> lacking AS present, CASE WHEN i <> lacking THEN 0.0::DOUBLE END AS null_rate,
           CASE WHEN i <> lacking THEN 0.0::DOUBLE END AS cast_fail_rate FROM b, c""")
def q_schema_drift_by_batch(spark, d):
    """A column that one batch's files lack is absent there, not empty."""
    path = drifting_loads(spark, d)
    raw = spark.read.option("mergeSchema", "true").parquet(path)
    return schema_drift(raw, DRIFT_EXPECTED, ["batch_date"], headers=raw_headers(spark, path))


# ------------------------------------------------------------------ whole chain
def write_landing(spark, d, landing: str) -> None:
    """Write both sources' drops as packed CSV files below folders named as the specs expect (a file a writing task)."""
    from conform.plans.jobs import run_concurrently
    raws = tb.raw_sources(spark, d)
    specs = {"utility1": UTILITY1, "utility2": UTILITY2}
    run_concurrently({f"{sid}_{ds}": (lambda df=df, sid=sid, ds=ds: _write_csv(
        df.drop("batch_date"), f"{landing}/{specs[sid].file_name(ds)}", "gzip")) for (sid, ds), df in raws.items()})


def run_chain(spark, d, times: int = 1) -> tuple[Layout, dict]:
    _utc(spark)
    root = scratch_path(spark, "chain")
    landing = f"{root}/landing"
    write_landing(spark, d, landing)
    layout = Layout(f"{root}/raw", f"{root}/conformed", f"{root}/serving")
    out = {}
    for i in range(times):
        out = run_all(spark, [UTILITY1, UTILITY2], landing, layout, FIXED_CTX, clear_landing=i == times - 1)
    return layout, out


# The chain ingests one drop: every raw row carries the run's batch date.
CHAIN_REDATE = {"seg1": "2026-04-01", "der1": "2026-04-01", "circ2": "2026-04-01", "der2": "2026-04-01"}
PIPE_FACT_SQL = tb.with_views(f"SELECT * EXCLUDE (batch_date), {CTX_SQL} FROM fact_latest", "fact_latest",
                              redate=CHAIN_REDATE)


@register("pipe_conform", PIPE_FACT_SQL)
def q_pipe_conform(spark, d):
    layout, _ = run_chain(spark, d)
    return ntz(read_table(spark, layout.conformed_table("fact_der")))


# Columns of the serving tables: numbers are compared as numbers, all others as text.
AUDIT = ("pipeline_run_id", "batch_date", "ingestion_ts")
CHAIN_COLUMNS = {
    "feeder_capacity": ("utility_id", "feeder_id", "last_refresh_date", "max_hosting_capacity", "min_hosting_capacity", "voltage_kv", *AUDIT),
    "feeder_der_details": ("utility_id", "feeder_id", "der_id", "status", "der_type", "feeder_id_unresolved", "source_feeder_ref", "feeder_matched",
                           "feeder_data_missing", "capacity_kw", "voltage_kv", "last_refresh_date", *AUDIT),
    "data_quality": ("utility_id", "dataset", "status", "total_rows", "null_feeder_id_count", "unresolved_feeder_id_count", "last_refresh_date", *AUDIT),
}
CHAIN_NUMBERS = ("max_hosting_capacity", "min_hosting_capacity", "voltage_kv", "capacity_kw", "total_rows", "null_feeder_id_count", "unresolved_feeder_id_count")
CHAIN_ALL = tuple(dict.fromkeys(c for cols in CHAIN_COLUMNS.values() for c in cols))


def chain_type(c: str) -> str:
    return "double" if c in CHAIN_NUMBERS else "string"


def _chain_sql() -> str:
    stamped = "(SELECT * EXCLUDE (batch_date), " + CTX_SQL + " FROM {})"
    rels = {"feeder_capacity": stamped.format("dim_latest"), "feeder_der_details": stamped.format("details"),
            "data_quality": f"({QUALITY_SQL})"}
    parts = []
    for name, rel in rels.items():
        kind = lambda c: "DOUBLE" if c in CHAIN_NUMBERS else "VARCHAR"
        cols = ", ".join(f"CAST({c} AS {kind(c)}) AS {c}" if c in CHAIN_COLUMNS[name] else f"NULL::{kind(c)} AS {c}" for c in CHAIN_ALL)
        parts.append(f"SELECT '{name}' AS table_name, {cols} FROM {rel}")
    return "\nUNION ALL\n".join(parts)


SERVE_SQL = tb.with_views(_chain_sql(), "dim_latest", "details", "fact_latest", redate=CHAIN_REDATE)


def served(spark, layout: Layout) -> DataFrame:
    """The three serving tables as one frame of numbers and texts (empty where a table lacks a column)."""
    frames = []
    for name, own in CHAIN_COLUMNS.items():
        t = ntz(read_table(spark, layout.serving_table(name)))
        frames.append(t.select(F.lit(name).alias("table_name"), *[
            (F.col(c) if c in own else F.lit(None)).cast(chain_type(c)).alias(c) for c in CHAIN_ALL]))
    return union_all(frames)


@register("pipe_serve", SERVE_SQL)
def q_pipe_serve(spark, d):
    """The three serving tables as the pipeline publishes them."""
    layout, _ = run_chain(spark, d)
    return served(spark, layout)


RERUN_SQL = tb.with_views(f"""
    SELECT * FROM ({_chain_sql()})
    UNION ALL BY NAME SELECT 'fact_der' AS table_name, utility_id, feeder_id, der_id, status, der_type, capacity_kw, source_feeder_ref FROM fact_latest
    UNION ALL BY NAME SELECT 'raw_utility1_der' AS table_name, der_id, NULL::VARCHAR AS status, capacity_kw, ref AS source_feeder_ref FROM der1
    UNION ALL BY NAME SELECT 'raw_utility2_circuits' AS table_name, feeder_id, max_hc AS max_hosting_capacity, voltage AS voltage_kv FROM circ2""",
    "dim_latest", "details", "fact_latest", "der1", "circ2", redate=CHAIN_REDATE)


@register("rerun_idempotent", RERUN_SQL)
def q_rerun_idempotent(spark, d):
    """The same drop twice: raw rows aren't doubled, conformed and serving tables stay as they are."""
    layout, _ = run_chain(spark, d, times=2)
    raw1 = [spark.read.parquet(layout.raw_table("utility1", ds)).select(F.lit("raw_utility1_der").alias("table_name"), F.col("ProjectID").alias("der_id"),
                                                                                     F.col("NamePlateRating").cast("double").alias("capacity_kw"), F.col("ProjectCircuitID").alias("source_feeder_ref"))
            for ds in ("install_der", "planned_der")]
    raw2 = spark.read.parquet(layout.raw_table("utility2", "circuits")).select(F.lit("raw_utility2_circuits").alias("table_name"), F.col("Master_CDF").alias("feeder_id"),
                                                                                      F.col("feeder_max_hc").cast("double").alias("max_hosting_capacity"), F.col("feeder_voltage").cast("double").alias("voltage_kv"))
    fact = read_table(spark, layout.conformed_table("fact_der")).select(F.lit("fact_der").alias("table_name"), "utility_id", "feeder_id", "der_id", "status", "der_type", "capacity_kw", "source_feeder_ref")
    return union_all([served(spark, layout), fact, *raw1, raw2])


# What a raw row of each dataset is compared by: id, reference, a number and a date, as the file has them.
RAW_COLUMNS = {
    ("utility1", "circuits"): ("Circuits_Phase3_CIRCUIT", "NYHCPV_csv_NFEEDER", "NYHCPV_csv_FMAXHC", "NYHCPV_csv_FVOLTAGE"),
    ("utility1", "install_der"): ("ProjectID", "ProjectCircuitID", "NamePlateRating", "SolarPV"),
    ("utility1", "planned_der"): ("ProjectID", "ProjectCircuitID", "NamePlateRating", "SolarPV"),
    ("utility2", "circuits"): ("Master_CDF", "hca_refresh_date", "feeder_max_hc", "feeder_voltage"),
    ("utility2", "install_der"): ("DER_ID", "DER_INTERCONNECTION_LOCATION", "DER_NAMEPLATE_RATING", None),
    ("utility2", "planned_der"): ("INTERCONNECTION_QUEUE_REQUEST_ID", "DER_INTERCONNECTION_LOCATION", "DER_NAMEPLATE_RATING", None),
}


@register("pipe_raw", tb.with_views(f"""
    SELECT *, {CTX_SQL} FROM (
    SELECT 'utility1' AS utility_id, 'circuits' AS dataset, circuit_id AS row_id, feeder_id || '.0' AS ref, max_hc AS n, voltage AS m FROM seg1
    UNION ALL SELECT 'utility1', CASE status WHEN 'installed' THEN 'install_der' ELSE 'planned_der' END, der_id, ref, capacity_kw, solar FROM der1
    UNION ALL SELECT 'utility2', 'circuits', feeder_id, strftime(refresh, '%Y/%m/%d %H:%M:%S+00'), max_hc, voltage FROM circ2
    UNION ALL SELECT 'utility2', CASE status WHEN 'installed' THEN 'install_der' ELSE 'planned_der' END, der_id, loc, capacity_kw, NULL FROM der2)""",
                                       "seg1", "der1", "circ2", "der2"))
def q_pipe_raw(spark, d):
    """Every row of the raw tables as the pipeline ingests them: ids, references, numbers and audit columns."""
    _utc(spark)
    root = scratch_path(spark, "raw-chain")
    write_landing(spark, d, f"{root}/landing")
    layout = Layout(f"{root}/raw", f"{root}/conformed", f"{root}/serving")
    counts = pipe_raw(spark, [UTILITY1, UTILITY2], f"{root}/landing", layout, FIXED_CTX)
    frames = []
    for (source, ds), (row_id, ref, n, m) in RAW_COLUMNS.items():
        rows = batch_scan(spark, layout.raw_table(source, ds), FIXED_CTX.batch_date, FIXED_CTX.pipeline_run_id, source)
        assert footer_counts(spark, layout.raw_table(source, ds)).first()["row_count"] == counts[f"{source}_{ds}"]
        frames.append(rows.select("utility_id", F.lit(ds).alias("dataset"), F.col(row_id).alias("row_id"), F.col(ref).alias("ref"), F.col(n).cast("double").alias("n"),
                                  (F.lit(None) if m is None else F.col(m)).cast("double").alias("m"), *AUDIT))
    return ntz(union_all(frames))


@register("footer_counts", """
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS batch_date, count(*) AS row_count, min(o_orderkey) AS min_o_orderkey, max(o_orderkey) AS max_o_orderkey
    FROM orders GROUP BY 1""")
def q_footer_counts(spark, d):
    """Rows and key range a batch without reading a column of the table."""
    path = scratch_path(spark, "orders-by-month")
    partition_replace(orders_by_month(spark, d), path, ["batch_date"])
    return footer_counts(spark, path, ["batch_date"], ["o_orderkey"])


STREAMED = ("2024-01-01", "2024-02-01")


@register("stream_conform", tb.with_views(f"""
    SELECT * EXCLUDE (batch_date, capacity_kw), capacity_kw + CASE WHEN CAST(der_id AS BIGINT) % 10 = 0 THEN 1 ELSE 0 END AS capacity_kw,
           CASE WHEN CAST(der_id AS BIGINT) % 2 = 1 OR CAST(der_id AS BIGINT) % 10 = 0 THEN DATE '{STREAMED[1]}' ELSE DATE '{STREAMED[0]}' END AS batch_date
    FROM f2""", "f2"))
def q_stream_conform(spark, d):
    """Conform by a stream over the raw tables: the newer batch first, the older one late, then all of it replayed."""
    _utc(spark)
    root = scratch_path(spark, "streamed")
    layout = Layout(f"{root}/raw", f"{root}/conformed", f"{root}/serving", fact_buckets=4)
    ids = {"install_der": "DER_ID", "planned_der": "INTERCONNECTION_QUEUE_REQUEST_ID"}

    def arrive(day: str, keep: str, more: int) -> None:
        for ds, df in {"circuits": tb.circ2(spark, d), **tb.der2(spark, d)}.items():
            if ds in ids:
                key = F.col(ids[ds]).cast("bigint")
                df = df.withColumn("_k", key).where(keep).withColumn("DER_NAMEPLATE_RATING", F.col("DER_NAMEPLATE_RATING") + F.when(key % 10 == 0, more).otherwise(0)).drop("_k")
            rows = df.withColumn("utility_id", F.lit("utility2")).withColumn("batch_date", F.lit(day).cast("date"))
            load_batch(rows, layout.raw_table("utility2", ds), "utility2", day, FIXED_CTX.pipeline_run_id)
        stream_conform(spark, [UTILITY1, UTILITY2], layout, f"{root}/checkpoint", FIXED_CTX)

    arrive(STREAMED[1], "_k % 2 = 1 OR _k % 10 = 0", 1)
    arrive(STREAMED[0], "_k % 2 = 0", 0)
    stream_conform(spark, [UTILITY2], layout, f"{root}/checkpoint-anew", FIXED_CTX)
    return read_table(spark, layout.conformed_table("fact_der")).select(
        "utility_id", "der_id", "der_type", "status", "feeder_id", "feeder_id_unresolved", "source_feeder_ref", "capacity_kw", "batch_date")


@register("backfill", tb.with_views(f"""
    SELECT * EXCLUDE (capacity_kw, batch_date),
           CASE WHEN batch_date = DATE '{BACKFILL_MONTH}' THEN capacity_kw + 1 ELSE capacity_kw END AS capacity_kw,
           batch_date
    FROM f2""", "f2"))
def q_backfill(spark, d):
    """All monthly drops of source 2 loaded and conformed, then one past month sent again with changed ratings, through the jobs.

    Another month is sent again empty: its raw rows go, what was conformed of them stays.
    """
    _utc(spark)
    root = scratch_path(spark, "backfill")
    layout = Layout(f"{root}/raw", f"{root}/conformed", f"{root}/serving")
    d2, source = tb.der2(spark, d), F.lit("utility2").alias("utility_id")
    for ds, df in d2.items():                           # the history, all months in one write
        partition_replace(df.select("*", source, F.lit(f"{BATCH}-{0:015d}-history").alias(LOAD_COL)), layout.raw_table("utility2", ds), RAW_PARTITIONS)
    raws = {st: batch_scan(spark, layout.raw_table("utility2", ds.dataset)) for st, ds in UTILITY2.der}
    history = latest_per_key(conform_facts(raws, UTILITY2), FACT_KEYS, FACT_ORDER)
    upsert_keyed(audit_stamp(history, FIXED_CTX, keep_batch_date=True), layout.conformed_table("fact_der"), FACT_KEYS, ("utility_id",), layout.fact_buckets)

    ctx = RunContext.for_batch(BACKFILL_MONTH, "run-backfill", FIXED_CTX.ingestion_ts)
    circuits = tb.circ2(spark, d).select(*[c for c in tb.circ2(spark, d).columns if c != "batch_date"], source, F.lit(ctx.batch_date).alias("batch_date"))
    load_batch(circuits, layout.raw_table("utility2", "circuits"), "utility2", ctx.batch_date, ctx.pipeline_run_id)
    for ds, df in d2.items():
        month = df.select("*", source).where(F.col("batch_date") == F.lit(ctx.batch_date))
        changed = month.withColumn("DER_NAMEPLATE_RATING", F.col("DER_NAMEPLATE_RATING") + 1)
        load_batch(changed, layout.raw_table("utility2", ds), "utility2", ctx.batch_date, ctx.pipeline_run_id)
        load_batch(month.where("false"), layout.raw_table("utility2", ds), "utility2", date(1996, 2, 1), ctx.pipeline_run_id)
    pipe_conform(spark, [UTILITY2], layout, ctx)
    return read_table(spark, layout.conformed_table("fact_der")).select(
        "utility_id", "der_id", "der_type", "status", "feeder_id", "feeder_id_unresolved", "source_feeder_ref",
        "capacity_kw", "batch_date")
