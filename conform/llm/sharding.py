"""Sharding by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table (a start and a step, both from a
digest of its name). The shards take turns; each claims the first slot of its permutation that is still free.
So the shards hold equal parts of the table (they differ by one slot at most), and adding or removing a
shard moves few other slots. The table has a fixed, checked size and is broadcast; placing a row is
one hash and one look-up, without a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 65_537
MAX_TABLE_SIZE = 4_000_037  # 8 bytes a slot: at most 32 MB are broadcast


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE) -> np.ndarray:
    """Slot -> index of its shard."""
    names = list(shards)
    if not names or len(set(names)) != len(names):
        raise ValueError("shards must be a non-empty list of distinct names")
    if not _is_prime(size) or size < len(names) or size > MAX_TABLE_SIZE:
        raise ValueError(f"table size must be a prime from the number of shards to {MAX_TABLE_SIZE}")
    starts, steps = [], []
    for n in names:
        d = hashlib.md5(n.encode()).digest()
        starts.append(int.from_bytes(d[:8], "big") % size)
        steps.append(int.from_bytes(d[8:], "big") % (size - 1) + 1 if size > 2 else 1)
    owner = [-1] * size
    at = list(starts)
    left = size
    while left:
        for i in range(len(names)):
            slot = at[i]
            while owner[slot] >= 0:
                slot = (slot + steps[i]) % size
            owner[slot] = i
            at[i] = (slot + steps[i]) % size
            left -= 1
            if not left:
                break
    return np.array(owner, dtype=np.int32)


def place(docs: DataFrame, shards: Sequence[str], key: str = "doc_id", size: int = TABLE_SIZE,
          spare_key: Sequence[str] = (), shard_col: str = "shard", slot_col: str | None = "slot") -> DataFrame:
    """``docs`` with the shard (and slot) of every row.

    Rows with equal keys go to the same shard. A null key is replaced by a hash over the ``spare_key``
    columns, so that rows without an id don't all land in one shard; without any they share one slot.
    Columns named like the new ones are replaced, all others kept as they are. Row order, texts,
    repeated rows and empty tables need no special treatment: every row comes out once.
    """
    owner = fill_table(shards, size)
    spark = docs.sparkSession
    # an Arrow table stays a local relation; pandas or rows would be handed through Python workers on the executors
    slots = spark.createDataFrame(
        pa.table({"__slot": np.arange(size, dtype=np.int64), "__shard": pa.array(list(shards), pa.string()).take(pa.array(owner))}),
        "__slot long, __shard string")
    hashed = F.xxhash64(F.col(key))
    if spare_key:
        hashed = F.when(F.col(key).isNull(), F.xxhash64(*[F.col(c) for c in spare_key])).otherwise(hashed)
    new = {c for c in (shard_col, slot_col) if c}
    keep = [F.col(c) for c in docs.columns if c not in new]
    out = docs.withColumn("__at", F.pmod(hashed, F.lit(size)))
    out = out.join(F.broadcast(slots), out["__at"] == slots["__slot"], "left")
    added = [F.col("__at").alias(slot_col)] if slot_col else []
    return out.select(*keep, *added, F.col("__shard").alias(shard_col))


def write_shards(placed: DataFrame, path: str, key: str = "doc_id", shard_col: str = "shard",
                 files_per_shard: int = 8, rows_per_file: int = 1_000_000) -> None:
    """One folder a shard. A shard's rows are written by several tasks, so none gets a whole shard."""
    salt = F.pmod(F.xxhash64(F.col(key)), F.lit(files_per_shard))
    (placed.repartition(F.col(shard_col), salt).write.option("maxRecordsPerFile", rows_per_file)
     .partitionBy(shard_col).parquet(path))
