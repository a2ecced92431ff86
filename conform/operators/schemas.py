"""Declared conformed schemas, enforced by a final cast-and-select."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIM_COLUMNS = (
    ("utility_id", "string"),
    ("feeder_id", "string"),
    ("max_hosting_capacity", "double"),
    ("min_hosting_capacity", "double"),
    ("last_refresh_date", "timestamp"),
    ("voltage_kv", "double"),
)

FACT_COLUMNS = (
    ("utility_id", "string"),
    ("der_id", "string"),
    ("der_type", "string"),
    ("capacity_kw", "double"),
    ("status", "string"),
    ("feeder_id", "string"),
    ("feeder_id_unresolved", "boolean"),
    ("source_feeder_ref", "string"),   # id as the source sent it (after NULL tokens); lineage for triage
)


def enforce(df: DataFrame, columns, extra: tuple[str, ...] = ("batch_date",)) -> DataFrame:
    """Select the declared columns in order, cast to their types; missing → typed NULL.

    Columns named in ``extra`` are kept (after the declared ones) when present.
    """
    have = set(df.columns)
    out = [
        (F.col(name).cast(t) if name in have else F.lit(None).cast(t)).alias(name)
        for name, t in columns
    ]
    out += [F.col(c) for c in extra if c in have and c not in dict(columns)]
    return df.select(*out)
