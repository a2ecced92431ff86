"""Source-shaped drops derived from the shared benchmark tables, and their DuckDB twins.

The benchmark tables have no utilities, so each source is mapped onto them:

* ``utility1`` circuits (segment rows)  ← every lineitem row
* ``utility1`` DERs (wide type columns) ← every lineitem row, status from ``l_linestatus``
* ``utility2`` circuits (feeder rows)   ← customer
* ``utility2`` DERs (direct feeder id)  ← orders: status F installed, all others planned
* ``utility3`` circuits (third source)  ← supplier
* ``utility3`` DERs                     ← part, each on the supplier with its key modulo 10

Spark frames carry the *source* column names (numbers typed, as a Parquet drop would have
them; the CSV jobs write them out as text), so the shipped ``SourceSpec``s apply unchanged. ``SQL_VIEWS`` holds the same derivations as
typed DuckDB CTEs for the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.spec import DerDataset, SourceSpec

# Fixed values of the derivation (shared with SQL_VIEWS below).
SOURCE2_BATCH = "2022-10-01"

UTILITY3 = SourceSpec(
    source_id="utility3",
    feeder_id="feeder_code",
    max_hc="hosting_capacity",
    voltage="nominal_kv",
    der=(("installed", DerDataset("install_der", der_id="site_no", nameplate="rated_kw", feeder_id="feeder", der_type="kind")),),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _month(c: str) -> Column:
    return F.trunc(F.col(c).cast("date"), "month")


def seg1(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("P"), _s("l_partkey")).alias("Circuits_Phase3_CIRCUIT"),
        F.col("l_suppkey").cast("double").alias("NYHCPV_csv_NFEEDER"),     # float-typed id, as real drops
        F.col("l_extendedprice").alias("NYHCPV_csv_FMAXHC"),
        F.col("l_discount").alias("NYHCPV_csv_FMINHC"),
        F.col("l_shipdate").alias("NYHCPV_csv_FHCADATE"),
        F.col("l_tax").alias("NYHCPV_csv_FVOLTAGE"),
        _month("l_shipdate").alias("batch_date"),
    )


def der1_ref() -> Column:
    q, ln = F.col("l_quantity"), F.col("l_linenumber")
    return (
        F.when(q % 5 == 0, F.lit(None).cast("string"))
        .when(ln % 2 == 0, F.concat(F.lit("P"), _s("l_partkey")))
        .when(ln % 3 == 0, F.concat(F.lit("X"), _s("l_partkey")))
        .otherwise(_s("l_suppkey"))
    )


def der1_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_linestatus"),
        F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("ProjectID"),
        der1_ref().alias("ProjectCircuitID"),
        F.col("l_extendedprice").alias("NamePlateRating"),
        F.when(F.col("l_tax") > 0.07, F.lit("Y")).otherwise(F.lit("N")).alias("Hybrid"),
        F.when(F.col("l_discount") > 0.05, F.col("l_discount")).otherwise(F.lit(0.0)).alias("SolarPV"),
        F.when(F.col("l_tax") > 0.04, F.col("l_tax")).otherwise(F.lit(0.0)).alias("Wind"),
        F.when(F.col("l_quantity") > 40, F.col("l_quantity")).otherwise(F.lit(0.0)).alias("Other"),
        _month("l_shipdate").alias("batch_date"),
    )


def der1(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    d = der1_all(spark, sf_dir)
    return {
        "install_der": d.where(F.col("l_linestatus") == "F").drop("l_linestatus"),
        "planned_der": d.where(~F.col("l_linestatus").eqNullSafe("F")).drop("l_linestatus"),
    }


def circ2(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    mm = F.lpad(_s(F.col("c_custkey") % 12 + 1), 2, "0")
    return c.select(
        F.concat(F.lit("C_"), _s("c_custkey")).alias("Master_CDF"),
        F.col("c_acctbal").alias("feeder_max_hc"),
        F.lit(0.0).alias("feeder_min_hc"),
        F.concat(F.lit("2022/"), mm, F.lit("/01 00:00:00+00")).alias("hca_refresh_date"),
        F.when(F.col("c_custkey") % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("c_nationkey").cast("double")).alias("feeder_voltage"),
        F.lit(SOURCE2_BATCH).cast("date").alias("batch_date"),
    )


def der2(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    o = table(spark, sf_dir, "orders")
    cust = F.col("o_custkey") + F.when(F.col("o_orderkey") % 11 == 0, F.lit(1000000)).otherwise(F.lit(0))
    base = o.select(
        F.col("o_orderstatus"),
        F.col("o_orderkey").alias("_id"),
        F.col("o_orderpriority").alias("DER_TYPE"),
        F.col("o_totalprice").alias("DER_NAMEPLATE_RATING"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("C_"), _s(cust))).alias("DER_INTERCONNECTION_LOCATION"),
        _month("o_orderdate").alias("batch_date"),
    )
    return {
        "install_der": base.where(F.col("o_orderstatus") == "F").drop("o_orderstatus")
                           .withColumnRenamed("_id", "DER_ID"),
        "planned_der": base.where(~F.col("o_orderstatus").eqNullSafe("F")).drop("o_orderstatus")
                           .withColumnRenamed("_id", "INTERCONNECTION_QUEUE_REQUEST_ID"),
    }


def circ3(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.concat(F.lit("S_"), _s("s_suppkey")).alias("feeder_code"),
        F.col("s_acctbal").alias("hosting_capacity"),
        F.col("s_nationkey").cast("double").alias("nominal_kv"),
        F.lit(SOURCE2_BATCH).cast("date").alias("batch_date"),
    )


def der3(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("site_no"),
        F.col("p_retailprice").alias("rated_kw"),
        F.when(F.col("p_size") % 5 != 0, F.concat(F.lit("S_"), _s(F.col("p_partkey") % 10))).alias("feeder"),
        F.col("p_brand").alias("kind"),
        F.lit(SOURCE2_BATCH).cast("date").alias("batch_date"),
    )


def raw_sources(spark: SparkSession, sf_dir: str, third: bool = False) -> dict[tuple[str, str], DataFrame]:
    d1, d2 = der1(spark, sf_dir), der2(spark, sf_dir)
    out = {
        ("utility1", "circuits"): seg1(spark, sf_dir),
        ("utility1", "install_der"): d1["install_der"],
        ("utility1", "planned_der"): d1["planned_der"],
        ("utility2", "circuits"): circ2(spark, sf_dir),
        ("utility2", "install_der"): d2["install_der"],
        ("utility2", "planned_der"): d2["planned_der"],
    }
    if third:
        out[("utility3", "circuits")] = circ3(spark, sf_dir)
        out[("utility3", "install_der")] = der3(spark, sf_dir)
    return out


# ----------------------------------------------------------------------------------------
# DuckDB twins (typed; a Spark text round trip of a double is exact, so CSV jobs agree too).
SQL_VIEWS = {
    "seg1": """
        SELECT 'P' || CAST(l_partkey AS VARCHAR) AS circuit_id, CAST(l_suppkey AS VARCHAR) AS feeder_id,
               l_extendedprice AS max_hc, l_discount AS min_hc, l_shipdate AS refresh, l_tax AS voltage,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS batch_date
        FROM lineitem""",
    "der1": """
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS der_id,
               CASE l_linestatus WHEN 'F' THEN 'installed' ELSE 'planned' END AS status,
               CASE WHEN l_quantity % 5 = 0 THEN NULL
                    WHEN l_linenumber % 2 = 0 THEN 'P' || CAST(l_partkey AS VARCHAR)
                    WHEN l_linenumber % 3 = 0 THEN 'X' || CAST(l_partkey AS VARCHAR)
                    ELSE CAST(l_suppkey AS VARCHAR) END AS ref,
               l_extendedprice AS capacity_kw,
               CASE WHEN l_tax > 0.07 THEN 'Y' ELSE 'N' END AS hybrid,
               CASE WHEN l_discount > 0.05 THEN l_discount ELSE 0.0 END AS solar,
               CASE WHEN l_tax > 0.04 THEN l_tax ELSE 0.0 END AS wind,
               CASE WHEN l_quantity > 40 THEN l_quantity ELSE 0.0 END AS other,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS batch_date,
               l_orderkey, l_linenumber
        FROM lineitem""",
    "circ2": f"""
        SELECT 'C_' || CAST(c_custkey AS VARCHAR) AS feeder_id, c_acctbal AS max_hc, 0.0::DOUBLE AS min_hc,
               make_timestamp(2022, CAST(c_custkey % 12 + 1 AS BIGINT), 1, 0, 0, 0) AS refresh,
               CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_nationkey AS DOUBLE) END AS voltage,
               DATE '{SOURCE2_BATCH}' AS batch_date, c_custkey
        FROM customer""",
    "der2": """
        SELECT CAST(o_orderkey AS VARCHAR) AS der_id, o_orderpriority AS der_type, o_totalprice AS capacity_kw,
               CASE o_orderstatus WHEN 'F' THEN 'installed' ELSE 'planned' END AS status,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL
                    ELSE 'C_' || CAST(o_custkey + CASE WHEN o_orderkey % 11 = 0 THEN 1000000 ELSE 0 END AS VARCHAR)
               END AS loc,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS batch_date, o_orderkey
        FROM orders""",
    "circ3": f"""
        SELECT 'S_' || CAST(s_suppkey AS VARCHAR) AS feeder_id, s_acctbal AS max_hc,
               CAST(s_nationkey AS DOUBLE) AS voltage, DATE '{SOURCE2_BATCH}' AS batch_date
        FROM supplier""",
    "f3": f"""
        SELECT 'utility3' AS utility_id, CAST(p_partkey AS VARCHAR) AS der_id, p_brand AS der_type, p_retailprice AS capacity_kw,
               'installed' AS status, CASE WHEN p_size % 5 <> 0 THEN 'S_' || CAST(p_partkey % 10 AS VARCHAR) END AS feeder_id,
               NOT p_size % 5 <> 0 AS feeder_id_unresolved,
               CASE WHEN p_size % 5 <> 0 THEN 'S_' || CAST(p_partkey % 10 AS VARCHAR) END AS source_feeder_ref,
               DATE '{SOURCE2_BATCH}' AS batch_date
        FROM part""",
    # conform layer
    "der1_typed": """
        SELECT *, CASE WHEN hybrid = 'Y' OR (CAST(solar > 0 AS INT) + CAST(wind > 0 AS INT) + CAST(other > 0 AS INT)) > 1
                         THEN 'Hybrid'
                       WHEN solar > 0 THEN 'Solar' WHEN wind > 0 THEN 'Wind' WHEN other > 0 THEN 'Other'
                       ELSE 'Unknown' END AS der_type
        FROM der1""",
    "bridge1": "SELECT circuit_id, min(feeder_id) AS feeder_id FROM (SELECT DISTINCT circuit_id, feeder_id FROM seg1) GROUP BY circuit_id",
    "known1": "SELECT DISTINCT feeder_id FROM seg1",
    "f1": """
        SELECT 'utility1' AS utility_id, d.der_id, d.der_type, d.capacity_kw, d.status,
               coalesce(b.feeder_id, k.feeder_id) AS feeder_id,
               coalesce(b.feeder_id, k.feeder_id) IS NULL AS feeder_id_unresolved,
               d.ref AS source_feeder_ref, d.batch_date
        FROM der1_typed d LEFT JOIN bridge1 b ON d.ref = b.circuit_id LEFT JOIN known1 k ON d.ref = k.feeder_id""",
    "f2": """
        SELECT 'utility2' AS utility_id, der_id, der_type, capacity_kw, status, loc AS feeder_id,
               loc IS NULL AS feeder_id_unresolved, loc AS source_feeder_ref, batch_date
        FROM der2""",
    "dim1_rows": """
        SELECT 'utility1' AS utility_id, feeder_id, max(max_hc) AS max_hosting_capacity,
               min(min_hc) AS min_hosting_capacity, max(refresh) AS last_refresh_date, max(voltage) AS voltage_kv,
               batch_date
        FROM seg1 GROUP BY batch_date, feeder_id""",
    "dim2_rows": """
        SELECT 'utility2' AS utility_id, feeder_id, max_hc AS max_hosting_capacity, min_hc AS min_hosting_capacity,
               refresh AS last_refresh_date, voltage AS voltage_kv, batch_date
        FROM circ2""",
    "dim3_rows": """
        SELECT 'utility3' AS utility_id, feeder_id, max_hc AS max_hosting_capacity,
               CAST(NULL AS DOUBLE) AS min_hosting_capacity, CAST(NULL AS TIMESTAMP) AS last_refresh_date,
               voltage AS voltage_kv, batch_date
        FROM circ3""",
}

LATEST_FACT_ORDER = ("batch_date DESC NULLS LAST, der_type DESC NULLS LAST, capacity_kw DESC NULLS LAST, "
                     "feeder_id DESC NULLS LAST, feeder_id_unresolved DESC NULLS LAST, source_feeder_ref DESC NULLS LAST")
LATEST_DIM_ORDER = ("batch_date DESC NULLS LAST, last_refresh_date DESC NULLS LAST, max_hosting_capacity DESC NULLS LAST, "
                    "min_hosting_capacity DESC NULLS LAST, voltage_kv DESC NULLS LAST")


def latest_sql(rel: str, keys: str, order: str) -> str:
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS _rn "
            f"FROM {rel}) WHERE _rn = 1")


SQL_VIEWS.update({
    "fact_all": "SELECT * FROM f1 UNION ALL SELECT * FROM f2",
    "fact_latest": latest_sql("fact_all", "utility_id, der_id, status", LATEST_FACT_ORDER),
    "dim_all": "SELECT * FROM dim1_rows UNION ALL SELECT * FROM dim2_rows",
    "dim_latest": latest_sql("(SELECT * FROM dim_all WHERE feeder_id IS NOT NULL)", "utility_id, feeder_id",
                             LATEST_DIM_ORDER),
    "details": """
        SELECT f.*, d.voltage_kv, d.last_refresh_date, d.voltage_kv IS NULL AS feeder_data_missing,
               d.feeder_id IS NOT NULL AS feeder_matched
        FROM fact_latest f LEFT JOIN dim_latest d ON f.utility_id = d.utility_id AND f.feeder_id = d.feeder_id""",
})


def with_views(body: str, *names: str, redate: dict[str, str] | None = None) -> str:
    """``WITH`` clause holding the named views (and everything they depend on) + ``body``.

    ``redate`` replaces the ``batch_date`` of listed views by a fixed date (one-drop runs).
    """
    redate = redate or {}
    order = list(SQL_VIEWS)
    need: set[str] = set()

    def add(n: str):
        if n in need:
            return
        need.add(n)
        text = SQL_VIEWS[n]
        for other in order:
            if other != n and _mentions(text, other):
                add(other)

    for n in names:
        add(n)
    def body_of(n: str) -> str:
        if n in redate:
            return f"SELECT * EXCLUDE (batch_date), DATE '{redate[n]}' AS batch_date FROM ({SQL_VIEWS[n]})"
        return SQL_VIEWS[n]

    ctes = ",\n".join(f"{n} AS ({body_of(n)})" for n in order if n in need)
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":       # body has its own CTEs: one WITH list
        return f"WITH {ctes},\n{stripped[5:]}"
    return f"WITH {ctes}\n{body}"


def _mentions(text: str, name: str) -> bool:
    import re
    return re.search(rf"\b{name}\b", text) is not None
