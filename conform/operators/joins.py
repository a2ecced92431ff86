"""Join helpers for lookups whose probe side may hold many NULL (never-matching) keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_lookup(rows: DataFrame, key: str | Sequence[str], lookup: DataFrame,
                lookup_key: str | Sequence[str], stored: bool = False) -> DataFrame:
    """``rows LEFT JOIN lookup ON rows.key = lookup.lookup_key`` with NULL keys spread out.

    Keys may be composite (equal-length lists). A row with any NULL key part cannot match; a number joins as
    one more key, 0 for rows that may match and a hash of the row for those that can't, so that these spread over
    all partitions, where one hash of NULL would give them to one task. The rows carry that number and no second copy of their
    keys through the shuffle. ``lookup`` must be unique on ``lookup_key`` (one output row per input row).
    The last key part, compared as text, comes first: sorts before the join compare its first bytes only, and a leading
    source id would be equal in nearly all rows.
    No join hint: the planner broadcasts ``lookup`` only when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold``, otherwise both sides are shuffled and AQE's
    skew handling splits partitions of hot non-NULL keys.

    ``stored`` says that ``rows`` are a table, cheap to scan twice: rows that can't match are then read apart and never shuffled.
    """
    keys = [key] if isinstance(key, str) else list(key)
    lkeys = [lookup_key] if isinstance(lookup_key, str) else list(lookup_key)
    if len(keys) != len(lkeys):
        raise ValueError("key and lookup_key differ in length")
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    if stored:
        lone = rows.where(any_null).withColumns({f.name: F.lit(None).cast(f.dataType) for f in lookup.schema.fields if f.name not in lkeys})
        return left_lookup(rows.where(~any_null), keys, lookup, lkeys).unionByName(lone)
    probe = rows.withColumn("_spread", F.when(any_null, F.hash(*[F.col(c) for c in rows.columns])).otherwise(F.lit(0)))
    build = lookup.withColumns({**{f"_jk{i}": F.col(k) for i, k in enumerate(lkeys)}, "_jks": F.lit(0)}).drop(*lkeys)
    last = len(keys) - 1
    on = [F.col(keys[last]).cast("string") == F.col(f"_jk{last}").cast("string"),
          *[F.col(keys[i]) == F.col(f"_jk{i}") for i in range(last)], F.col("_spread") == F.col("_jks")]
    return probe.join(build, on, "left").drop("_spread", "_jks", *[f"_jk{i}" for i in range(len(keys))])
