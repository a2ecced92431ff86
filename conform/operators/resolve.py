"""Segment roll-up, circuit→feeder bridge and two-step feeder resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conform.functions.scalars import lenient_number, lenient_ts, lookup_key, null_tokens
from conform.operators.joins import left_lookup


def _batch_keys(df: DataFrame) -> list[str]:
    return ["batch_date"] if "batch_date" in df.columns else []


def segment_rollup(
    raw: DataFrame,
    feeder_col: str,
    max_col: str | None,
    min_col: str | None,
    refresh_col: str | None,
    voltage_col: str | None,
    ts_format: str | None = None,
    tokens: tuple[str, ...] = ("",),
) -> DataFrame:
    """Segment rows → one row per (batch, feeder).

    Values are parsed *before* aggregating (text max would compare lexically) and the key is
    normalised *before* grouping (``7`` and ``7.0`` are one feeder). Feeder-level columns are
    constant per feeder by contract; ``max`` keeps the pick deterministic. Plain max/min
    aggregates keep Spark's partial (map-side) aggregation, so a feeder holding a large share
    of the segments is pre-reduced in every task before the shuffle.
    """
    types = {f.name: f.dataType for f in raw.schema.fields}

    def num(c):
        return lenient_number(c, types.get(c)) if c else F.lit(None).cast("double")

    parsed = raw.select(
        *_batch_keys(raw),
        lookup_key(null_tokens(feeder_col, tokens, types.get(feeder_col)), types.get(feeder_col)).alias("feeder_id"),
        num(max_col).alias("max_hosting_capacity"),
        num(min_col).alias("min_hosting_capacity"),
        (lenient_ts(refresh_col, ts_format, types.get(refresh_col)) if refresh_col
         else F.lit(None).cast("timestamp")).alias("last_refresh_date"),
        num(voltage_col).alias("voltage_kv"),
    )
    return parsed.groupBy(*_batch_keys(raw), "feeder_id").agg(
        F.max("max_hosting_capacity").alias("max_hosting_capacity"),
        F.min("min_hosting_capacity").alias("min_hosting_capacity"),
        F.max("last_refresh_date").alias("last_refresh_date"),
        F.max("voltage_kv").alias("voltage_kv"),
    )


def bridge_build(raw: DataFrame, circuit_col: str, feeder_col: str, tokens: tuple[str, ...] = ("",)) -> DataFrame:
    """Distinct non-null (circuit_id, feeder_id) pairs from segment rows."""
    types = {f.name: f.dataType for f in raw.schema.fields}

    def key(c):
        return lookup_key(null_tokens(c, tokens, types.get(c)), types.get(c))

    return (
        raw.select(key(circuit_col).alias("circuit_id"), key(feeder_col).alias("feeder_id"))
        .dropna(subset=["circuit_id", "feeder_id"])
        .distinct()
    )


def bridge_one_per_key(bridge: DataFrame) -> DataFrame:
    """One feeder per circuit: the smallest feeder id (text order), deterministic."""
    return bridge.groupBy("circuit_id").agg(F.min("feeder_id").alias("feeder_id"))


def _merge_lookup(pairs: DataFrame) -> DataFrame:
    """(_k, _bridge_feeder, _direct_feeder) candidates → one row per id: one grouped minimum, no join."""
    return pairs.where(F.col("_k").isNotNull()).groupBy("_k").agg(
        F.min("_bridge_feeder").alias("_bridge_feeder"), F.min("_direct_feeder").alias("_direct_feeder"))


def feeder_lookup(bridge: DataFrame | None, known_feeders: DataFrame | None) -> DataFrame | None:
    """Published bridge and known feeders → lookup id → (bridge hit, direct hit)."""
    none = F.lit(None).cast("string")
    frames = []
    if bridge is not None:
        frames.append(bridge.select(F.col("circuit_id").alias("_k"), F.col("feeder_id").alias("_bridge_feeder"),
                                    none.alias("_direct_feeder")))
    if known_feeders is not None:
        frames.append(known_feeders.select(F.col("feeder_id").alias("_k"), none.alias("_bridge_feeder"),
                                           F.col("feeder_id").alias("_direct_feeder")))
    if not frames:
        return None
    return _merge_lookup(frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1]))


def circuit_lookup(raw: DataFrame, circuit_col: str, feeder_col: str, tokens: tuple[str, ...] = ("",)) -> DataFrame:
    """The same lookup straight from circuits rows, in one pass: every row stands under its circuit and its feeder id."""
    types = {f.name: f.dataType for f in raw.schema.fields}

    def key(c):
        return lookup_key(null_tokens(c, tokens, types.get(c)), types.get(c))

    none = F.lit(None).cast("string")
    ids = raw.select(key(circuit_col).alias("c"), key(feeder_col).alias("f")).where("f IS NOT NULL")
    return _merge_lookup(ids.select(F.inline(F.array(
        F.struct(F.col("c").alias("_k"), F.col("f").alias("_bridge_feeder"), none.alias("_direct_feeder")),
        F.struct(F.col("f").alias("_k"), none.alias("_bridge_feeder"), F.col("f").alias("_direct_feeder"))))))


def resolve(rows: DataFrame, ref_col: str, lookup: DataFrame | None) -> DataFrame:
    """Resolve an id that may name a circuit or a feeder.

    Bridge hit (circuit → feeder, the smallest feeder of the circuit) wins over a direct hit on a known
    feeder; neither → NULL feeder and ``feeder_id_unresolved``. Exactly one output row per input row: the
    lookup has one row per id. The rows are joined, and if the lookup isn't small shuffled, once
    (``left_lookup``): broadcast only when the measured size is under ``spark.sql.autoBroadcastJoinThreshold``,
    else sort-merge joined with AQE splitting hot ids; rows without an id get spread-out never-matching keys.
    """
    if lookup is None:
        none = F.lit(None).cast("string")
        out = rows.withColumns({"_bridge_feeder": none, "_direct_feeder": none})
    else:
        out = left_lookup(rows, ref_col, lookup, "_k")
    feeder = F.coalesce(F.col("_bridge_feeder"), F.col("_direct_feeder"))
    return out.withColumns({"feeder_id": feeder, "feeder_id_unresolved": feeder.isNull()}).drop("_bridge_feeder", "_direct_feeder")


def resolve_two_step(rows: DataFrame, ref_col: str, bridge: DataFrame | None, known_feeders: DataFrame | None) -> DataFrame:
    """``resolve`` against a bridge and a list of known feeders."""
    return resolve(rows, ref_col, feeder_lookup(bridge, known_feeders))
