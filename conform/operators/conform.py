"""Spec-driven mapping of one source's raw rows onto the shared model, and the union of sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conform.functions.scalars import lenient_number, lenient_ts, lookup_key, null_tokens, wide_to_label
from conform.operators.resolve import bridge_build, circuit_lookup, feeder_lookup, resolve, segment_rollup
from conform.operators.schemas import DIM_COLUMNS, FACT_COLUMNS, enforce
from conform.spec import SourceSpec


def _types(df: DataFrame) -> dict:
    return {f.name: f.dataType for f in df.schema.fields}


def _id(spec: SourceSpec, c: str | None, types: dict) -> Column:
    if c is None:
        return F.lit(None).cast("string")
    t = types.get(c)
    v = null_tokens(F.col(c), spec.null_tokens, t)
    return lookup_key(v, t) if spec.numeric_ids else v.cast("string")


def _prepare(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    return spec.transform(raw) if spec.transform is not None else raw


def conform_dim_source(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """One source's circuits rows → dimension rows (declared schema + ``batch_date``)."""
    raw = _prepare(raw, spec)
    if spec.segments:
        dim = segment_rollup(raw, spec.feeder_id, spec.max_hc, spec.min_hc, spec.refresh_date, spec.voltage,
                             spec.ts_format, spec.null_tokens)
    else:
        types = _types(raw)

        def num(c):
            return lenient_number(c, types.get(c)) if c else F.lit(None).cast("double")
        dim = raw.select(
            *(["batch_date"] if "batch_date" in raw.columns else []),
            _id(spec, spec.feeder_id, types).alias("feeder_id"),
            num(spec.max_hc).alias("max_hosting_capacity"),
            num(spec.min_hc).alias("min_hosting_capacity"),
            (lenient_ts(spec.refresh_date, spec.ts_format, types.get(spec.refresh_date)) if spec.refresh_date
             else F.lit(None).cast("timestamp")).alias("last_refresh_date"),
            num(spec.voltage).alias("voltage_kv"),
        )
    return enforce(dim.withColumn("utility_id", F.lit(spec.source_id)), DIM_COLUMNS)


def conform_bridge_source(raw: DataFrame, spec: SourceSpec) -> DataFrame | None:
    """Circuit → feeder bridge of a segment source; None for sources without circuit ids."""
    if not spec.circuit_id:
        return None
    return bridge_build(_prepare(raw, spec), spec.circuit_id, spec.feeder_id, spec.null_tokens)


def der_type_column(raw: DataFrame, spec: SourceSpec, type_col: str | None) -> Column:
    if type_col:
        return F.col(type_col).cast("string")
    if spec.label_columns:
        present = set(raw.columns)
        cols = [(c, label) for c, label in spec.label_columns if c in present]   # absent → 0, never counts
        flag = spec.hybrid_flag if spec.hybrid_flag and spec.hybrid_flag in present else None
        return wide_to_label(cols, flag, dtypes=_types(raw))
    return F.lit(None).cast("string")


def _der_rows(raw: DataFrame, spec: SourceSpec, status: str) -> DataFrame:
    """One source's DER rows of one status in the shared columns, the feeder not yet resolved.

    ``der_id`` is part of the merge key and stays exactly as sent (``7.5``, ``007`` and ``7`` are three
    DERs); only feeder and circuit ids, which are looked up, are normalised.
    """
    ds = spec.der_for(status)
    if ds is None:
        raise KeyError(f"source {spec.source_id} has no dataset for status {status!r}")
    raw = _prepare(raw, spec)
    types = _types(raw)
    ref = _id(spec, ds.circuit_id or ds.feeder_id, types)
    return raw.select(
        *(["batch_date"] if "batch_date" in raw.columns else []),
        F.lit(spec.source_id).alias("utility_id"),
        null_tokens(F.col(ds.der_id), spec.null_tokens, types.get(ds.der_id)).cast("string").alias("der_id"),
        der_type_column(raw, spec, ds.der_type).alias("der_type"),
        lenient_number(ds.nameplate, types.get(ds.nameplate)).alias("capacity_kw"),
        F.lit(status).alias("status"),
        ref.alias("source_feeder_ref"),
    )


def conform_facts(raws: dict[str, DataFrame], spec: SourceSpec, lookup: DataFrame | None = None) -> DataFrame:
    """One source's DER rows of all statuses (``raws`` by status) → fact rows (declared schema + ``batch_date``).

    Datasets that send an ambiguous circuit-or-feeder id are resolved against ``lookup`` (``feeder_lookup``
    or ``circuit_lookup``) in one join for all their statuses; those that send the feeder directly are
    unresolved only when the id is missing.
    """
    direct, ambiguous = [], []
    for status, raw in raws.items():
        rows = _der_rows(raw, spec, status)
        (ambiguous if spec.der_for(status).circuit_id else direct).append(rows)
    out = [resolve(union_all(ambiguous), "source_feeder_ref", lookup)] if ambiguous else []
    out += [rows.withColumns({"feeder_id": F.col("source_feeder_ref"), "feeder_id_unresolved": F.col("source_feeder_ref").isNull()})
            for rows in direct]
    return enforce(union_all(out), FACT_COLUMNS)


def conform_fact_source(
    raw: DataFrame,
    spec: SourceSpec,
    status: str,
    bridge: DataFrame | None = None,
    known_feeders: DataFrame | None = None,
) -> DataFrame:
    """Fact rows of one status, resolved against ``bridge``, then against ``known_feeders`` (the dimension's
    feeder ids of this source)."""
    return conform_facts({status: raw}, spec, feeder_lookup(bridge, known_feeders))


def conform_lookup_source(raw: DataFrame, spec: SourceSpec) -> DataFrame | None:
    """Circuit and feeder ids of a drop's own circuits rows as one lookup (one pass); None for sources without circuit ids."""
    if not spec.circuit_id:
        return None
    return circuit_lookup(_prepare(raw, spec), spec.circuit_id, spec.feeder_id, spec.null_tokens)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by column name (all inputs already carry the declared schema)."""
    frames = [f for f in frames if f is not None]
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
