from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import DOCS, make  # noqa: F401 (fixtures)

from conform.llm.sharding import fill_table, place, write_shards
from conform.session import scratch_path

SHARDS = [f"s{i}" for i in range(7)]


def slow_table(names, size):
    """The definition: in turns, each shard claims the first free slot of its permutation."""
    import hashlib

    orders = []
    for n in names:
        d = hashlib.md5(n.encode()).digest()
        start, step = int.from_bytes(d[:8], "big") % size, int.from_bytes(d[8:], "big") % (size - 1) + 1
        orders.append(iter([(start + i * step) % size for i in range(size)]))
    owner = {}
    while len(owner) < size:
        for i, o in enumerate(orders):
            if len(owner) < size:
                owner[next(s for s in o if s not in owner)] = i
    return [owner[s] for s in range(size)]


@pytest.mark.parametrize("size", [7, 101, 1009])
def test_table_as_defined(size):
    t = fill_table(SHARDS, size)
    assert t.tolist() == slow_table(SHARDS, size)
    n = Counter(t.tolist())
    assert max(n.values()) - min(n.values()) <= 1


def test_little_moves_when_a_shard_goes():
    a, b = fill_table(SHARDS, 10_007), fill_table(SHARDS[:-1], 10_007)
    stay = a != len(SHARDS) - 1
    assert np.mean(a[stay] != b[stay]) < 0.1


@pytest.mark.parametrize("names,size", [([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2), (["a"], 4_000_081)])
def test_wrong_tables(names, size):
    with pytest.raises(ValueError):
        fill_table(names, size)


def test_rows_keep_their_columns_and_equal_keys_share_a_shard(make):
    rows = [(i // 2, None, None, f"x{i % 50}", i) for i in range(2000)] + [(None, None, None, f"y{i}", i) for i in range(500)]
    df = make(rows, DOCS)
    got = place(df, SHARDS, spare_key=("source", "n_chars")).collect()
    assert len(got) == 2500
    assert set(got[0].asDict()) == {*df.columns, "slot", "shard"} and sum(r.asDict()["fp"] is not None for r in got) in (0, 2500)
    by = {}
    for r in got:
        if r.doc_id is not None:
            by.setdefault(r.doc_id, set()).add(r.shard)
    assert all(len(s) == 1 for s in by.values())
    spread = Counter(r.shard for r in got if r.doc_id is None)
    assert len(spread) == 7 and max(spread.values()) < 150
    table = fill_table(SHARDS)
    hashed = {r.doc_id: r.h for r in df.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(65_537)).alias("h")).collect()}
    assert all(r.slot == hashed[r.doc_id] and r.shard == SHARDS[table[r.slot]] for r in got if r.doc_id is not None)


def test_empty_table_and_files(make, spark):
    assert place(make([], DOCS), SHARDS).collect() == []
    path = scratch_path(spark, "shards")
    placed = place(make([(i, "t", None, None, None) for i in range(300)], DOCS, extra=()), SHARDS, slot_col=None)
    write_shards(placed, path, files_per_shard=2)
    back = spark.read.parquet(path)
    assert {(r.doc_id, r.shard) for r in back.collect()} == {(r.doc_id, r.shard) for r in placed.collect()}


def test_the_table_needs_no_python_workers(spark):
    plan = place(spark.range(5), SHARDS, key="id")._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" in plan and "LogicalRDD" not in plan
