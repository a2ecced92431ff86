import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import make  # noqa: F401 (fixtures)

from conform.llm.topk_search import Best, choose_pivots, top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def want(rows, step=5, k=5):
    ok = [(i, [math.floor(256 * float(np.float32(v))) for v in x]) for i, x, _ in rows
          if i is not None and x is not None and all(v is not None and math.isfinite(v) for v in x)]
    queries = {}
    for i, x in ok:
        if i % step == 0:
            queries[i] = min(queries.get(i, x), x, key=lambda q: (len(q), q))
    out = []
    for q, x in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(x, y)), c) for c, y in ok if c != q and len(y) == len(x))
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def run(make, rows, step=5, **kw):
    found = top_k(make(rows, SCHEMA), F.col("vec_id") % step == 0, **kw)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())


def vectors(n, dim, seed, first=0):
    g = np.random.default_rng(seed)
    return [(first + i, [float(v) for v in g.normal(0, 0.2, dim).astype(np.float32)], None) for i in range(n)]


def test_odd_rows(make):
    rows = vectors(60, 8, 1)
    rows += [(100, None, 1), (101, [None] * 8, 1), (102, [float("nan")] * 8, 1), (103, [float("inf")] + [0.0] * 7, 1), (None, [0.5] * 8, 1),
             (105, [0.0] * 8, None), (200, [0.25] * 3, 1), (201, [0.5, -0.5, 0.25], 1), (300, [], 1), (301, [], 1), (-5, [0.1] * 8, 1)]
    rows += [(400 + i, [0.3] * 8, None) for i in range(12)]          # ties
    rows += [rows[3], rows[3], rows[5], (10, [9.0] * 8, None)]       # repeated rows, and a query id with two vectors
    assert run(make, rows) == want(rows)


def test_small_blocks_and_lanes(make):
    rows = vectors(300, 16, 2)
    assert run(make, rows, block_rows=17, query_rows=7, lanes=3, n_pivots=6, sample_rows=20) == want(rows)


def test_large_numbers_stay_exact(make):
    rows = [(i, [float(2 ** 20 + i), float(2 ** 19 - i)], None) for i in range(40)]
    assert run(make, rows) == want(rows)


def test_long_vectors_are_kept(make):
    """Vectors whose own squared length leaves a long still have scores that fit, with short queries or at right angles."""
    rows = [(0, [1.0, 0.0], None), (1, [3e7, 0.0], None), (2, [0.5, 0.0], None), (3, [-3e13, 0.0], None), (4, [0.0, 1e30], None), (5, [2e7, 1e30], None),
            (6, [2e7, -1e38], None)] + [(7 + i, [float(2 ** 33 + 4096 * i), float(i)], None) for i in range(20)]
    got = run(make, rows, step=1000)
    assert got == want(rows, step=1000) and {c for _, _, c, _ in got} == {26, 25, 24, 23, 22}
    assert run(make, rows[:4], step=1000)[0] == (0, 1, 1, 1_966_080_000_000)
    assert run(make, rows[:7], step=1000) == want(rows[:7], step=1000)
    with pytest.raises(Exception, match="fit a long"):
        run(make, [(0, [1e13, 0.0], None), (1, [1e13, 0.0], None)], step=1000)


def test_empty_table_and_lone_query(make):
    assert run(make, []) == []
    assert run(make, [(5, [0.5], None)]) == []


@pytest.mark.parametrize("clusters", [True, False])
def test_the_bound_stops_early_and_loses_nothing(clusters):
    g = np.random.default_rng(3)
    x = g.normal(0, 40, (4000, 8)).round()
    if clusters:
        x = (g.normal(0, 200, (8, 8))[g.integers(0, 8, 4000)] + g.normal(0, 5, (4000, 8))).round()
    p = choose_pivots(x[:500], 16)
    d = np.sqrt(((x[:, None, :] - p[None, :, :]) ** 2).sum(axis=2))
    best = Best(np.arange(20), x[:20], d[:20], 5)
    for lo in range(0, 4000, 1000):
        best.visit(np.arange(lo, lo + 1000), x[lo:lo + 1000], d[lo:lo + 1000])
    for q, top in enumerate(best.top):
        s = x @ x[q]
        s[q] = -np.inf
        order = np.lexsort((np.arange(4000), -s))[:5]
        assert [c for _, c in top] == order.tolist()
    assert best.evaluated < 20 * 4000 * (0.6 if clusters else 1.01)


def test_cells_of_parts_and_lanes(make):
    """Several parts of queries and lanes of candidates, of two dimensions; each meets each."""
    rows = vectors(150, 6, 21) + vectors(90, 4, 22, first=1000)
    want_rows = want(rows, step=3)
    for kw in ({"query_rows": 4, "block_rows": 16, "part_blocks": 2, "lane_blocks": 3}, {"query_rows": 1, "block_rows": 1, "part_blocks": 9, "lane_blocks": 40}):
        assert run(make, rows, step=3, **kw) == want_rows


def test_blocks_are_sent_by_part_and_lane_not_by_pair(make):
    """No join of blocks: the plan has one exchange of them, and neither a broadcast nor a sort above a join."""
    found = top_k(make(vectors(40, 4, 23), SCHEMA), F.col("vec_id") % 5 == 0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan
