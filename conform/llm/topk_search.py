"""Exact top-k inner product search by pivot-table elimination.

Vectors are made integer, so scores are exact. For every vector the Euclidean distances to a set of pivots are computed
once and stored beside it. For a query q and a candidate c the triangle inequality gives, for every pivot, a
lower bound |d(q, p) - d(c, p)| of their distance; the largest of them bounds the inner product from above:

    <q, c> = (|q|^2 + |c|^2 - d(q, c)^2) / 2 <= (|q|^2 + |c|^2 - bound^2) / 2

The origin is one of the pivots (its distances are the norms). Candidates are evaluated in order of their bounds, best
first, and a query stops as soon as the next bound is below its k-th best score: nothing left can enter.

Candidates and queries are packed into blocks, query blocks are dealt out to parts and candidate blocks to lanes. Every part meets every
lane in a cell: a task holds the query blocks of one part, streams the lane's candidate blocks past them and carries their best k along. So
a candidate is sent once a part and a query once a lane, never once a pair of blocks, and both numbers grow with the tables. Queries are a
stated share of the rows; the result of a cell is k rows a query, merged at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conform.llm.common import staged

EXACT = 2.0 ** 53      # doubles hold every integer below
SAFE = 2.0 ** 62       # products that add up to less are summed in 64 bits
ROUND = 256            # candidates evaluated before the first look at the bound; twice as many before each next one


def quantised(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, x (doubles holding floor(scale * component)), dim; vectors that can't take part are left out."""
    def whole(v: Column) -> Column:
        return F.when(F.abs(v * scale) < F.lit(EXACT), F.floor(v * F.lit(scale)).cast("double")).otherwise(v * scale)

    x = F.transform(F.col(vector_col).cast("array<double>"), whole)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    out = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~F.coalesce(bad, F.lit(True)))
    return out.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"), F.size(vector_col).alias("dim"))


def choose_pivots(rows: np.ndarray, n: int) -> np.ndarray:
    """The origin, then rows of the sample, each the one farthest from all pivots before it."""
    picked = [np.zeros(rows.shape[1])]
    far = (rows ** 2).sum(axis=1)
    while len(picked) < n and len(rows) and far.max() > 0:
        i = int(np.argmax(far))
        picked.append(rows[i])
        far = np.minimum(far, ((rows - rows[i]) ** 2).sum(axis=1))
    return np.array(picked)


def _pack(df: DataFrame, pivots: dict[int, np.ndarray], rows: int) -> DataFrame:
    """Blocks of up to ``rows`` vectors of one dimension: dim, ids, vectors and pivot distances as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids, x = (np.concatenate(c) for c in zip(*held.pop(dim)))
            p = pivots.get(dim, np.zeros((1, dim)))
            d2 = (x ** 2).sum(axis=1)[:, None] + (p ** 2).sum(axis=1)[None, :] - 2 * (x @ p.T)
            d = np.sqrt(np.maximum(d2, 0))
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary()), pa.array([d.tobytes()], pa.binary())],
                names=["dim", "ids", "vectors", "distances"])

        for b in batches:
            ids, dims = b.column("vec_id").to_numpy(), b.column("dim").to_numpy()
            lists = b.column("x")
            begin, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                x = values[begin[own][:, None] + np.arange(dim)[None, :]]
                for lo in range(0, len(own), rows):
                    held.setdefault(dim, []).append((ids[own[lo:lo + rows]], x[lo:lo + rows]))
                    if sum(len(i) for i, _ in held[dim]) >= rows:
                        yield out(dim)
        for dim in list(held):
            yield out(dim)

    return df.mapInArrow(run, "dim int, ids binary, vectors binary, distances binary")


def exact_scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of integers held as doubles: 64-bit sums where these can't overflow, else Python's integers."""
    with np.errstate(all="ignore"):
        far = ~(np.abs(x) @ np.abs(q) < SAFE)
        scores = x.astype(np.int64) @ q.astype(np.int64)
    if far.any():
        scores = scores.astype(object)
        whole = [int(v) for v in q]
        for j in np.flatnonzero(far):
            scores[j] = sum(int(a) * b for a, b in zip(x[j], whole))
    return scores


class Best:
    """The k best (score, smaller id first) of every query of a block."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, d: np.ndarray, k: int) -> None:
        self.ids, self.x, self.d, self.k = ids, x, d, k
        self.top: list[list[tuple[int, int]]] = [[] for _ in ids]
        self.evaluated = 0

    def visit(self, ids: np.ndarray, x: np.ndarray, d: np.ndarray) -> None:
        norms = d[:, 0] ** 2                                  # pivot 0 is the origin
        exact = (x ** 2).sum(axis=1)
        big = max(exact.max(initial=0), (self.x ** 2).sum(axis=1).max(initial=0)) >= 2.0 ** 52
        by_pivot = np.ascontiguousarray(d.T)
        one, gap = np.empty(len(ids)), np.empty(len(ids))
        for i, q in enumerate(self.ids):
            gap.fill(0)
            for p, column in enumerate(by_pivot):
                np.subtract(column, self.d[i, p], out=one)
                np.abs(one, out=one)
                np.maximum(gap, one, out=gap)
            q2 = self.d[i, 0] ** 2
            # distances are rounded; the slack keeps the bound an upper one
            with np.errstate(all="ignore"):
                bound = (q2 + norms - gap * gap) / 2 + 1e-6 * (q2 + norms) + 1e-6
            bound[~np.isfinite(bound)] = np.inf               # too long to bound in doubles: to be evaluated
            bound[ids == q] = -np.inf
            self._search(i, ids, x, bound, big)

    def _search(self, i: int, ids: np.ndarray, x: np.ndarray, bound: np.ndarray, big: bool) -> None:
        q = self.x[i]
        left = np.flatnonzero(bound > -np.inf)
        batch = ROUND // 2
        while len(left):
            batch *= 2
            top = self.top[i]
            if len(top) == self.k:
                left = left[bound[left] >= top[-1][0]]        # the exact stop: nothing below can enter
                if not len(left):
                    return
            if len(left) > batch:
                order = np.argpartition(-bound[left], batch)
                now, left = left[order[:batch]], left[order[batch:]]
            else:
                now, left = left, left[:0]
            scores = exact_scores(x[now], q) if big else x[now] @ q
            self.evaluated += len(now)
            few = np.arange(len(now))
            if len(now) > 4 * self.k and scores.dtype != object:  # those at least as good as the k-th best of the batch
                few = np.flatnonzero(scores >= np.partition(scores, -self.k)[-self.k])
            if scores.dtype == object:
                few = np.array(sorted(few.tolist(), key=lambda j: (-scores[j], ids[now[j]]))[:self.k], dtype=np.int64)
            else:
                few = few[np.lexsort((ids[now[few]], -scores[few]))[:self.k]]
            self.top[i] = sorted([*top, *((int(scores[j]), int(ids[now[j]])) for j in few)], key=lambda t: (-t[0], t[1]))[:self.k]

    def rows(self) -> Iterator[tuple[int, int, int]]:
        for q, top in zip(self.ids.tolist(), self.top):
            for score, c in top:
                if not -(1 << 63) <= score < 1 << 63:
                    raise OverflowError(f"the score {score} of {q} and {c} doesn't fit a long")
                yield q, c, score


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, n_pivots: int = 24, sample_rows: int = 2048,
          query_rows: int = 512, block_rows: int = 4096, part_blocks: int = 16, lane_blocks: int = 16, lanes: int | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best candidates by integer inner product, ties to smaller ids.

    ``vectors`` (vec_id, embedding); ``is_query`` is a condition on vec_id. Candidates are all rows but those with the
    query's own id. Null vectors, vectors with null or non-finite components (scaled, so from 2^1016 on) and rows without an id take
    no part. Vectors of any other length do, with exact scores; one among a query's k best that doesn't fit a long is an error. Vectors only meet vectors of their length. A repeated
    query id is one query, with its smallest vector; repeated candidates take a rank each. Fewer candidates than k give
    fewer rows; an empty table gives none. Other columns are not read. ``sample_rows`` bounds the rows from which pivots
    are chosen; every row is bounded by them and none is skipped otherwise. A cell holds about ``part_blocks`` blocks of ``query_rows`` queries and reads at most
    about ``lane_blocks`` blocks of ``block_rows`` candidates, fewer where that gives more tasks to run at once;
    ``lanes`` sets their number instead.
    """
    spark = vectors.sparkSession
    base = quantised(vectors, scale)
    sample = base.orderBy(F.xxhash64("vec_id"), "vec_id", "x").limit(sample_rows).select("dim", "x").collect()
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(r.dim, []).append(r.x)
    pivots = {dim: choose_pivots(np.array(x, dtype=float).reshape(len(x), dim), n_pivots) for dim, x in sorted(by_dim.items())}
    queries = base.where(is_query).groupBy("vec_id").agg(F.min(F.struct("dim", "x")).alias("m")).select("vec_id", "m.x", "m.dim")
    q = staged(spark, _pack(queries, pivots, query_rows), "topk-queries")
    c = staged(spark, _pack(base, pivots, block_rows), "topk-candidates")
    n_queries, n_candidates = q.count(), c.count()            # blocks
    parts = max(1, -(-n_queries // part_blocks))
    at_once = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // parts)
    lanes = lanes or max(1, min(n_candidates, max(-(-n_candidates // lane_blocks), at_once)))

    def dealt(blocks: DataFrame, own: str, n_own: int, other: str, n_other: int, role: int) -> DataFrame:
        return blocks.withColumn(own, F.pmod(F.xxhash64("ids"), F.lit(n_own)).cast("int")).withColumn("role", F.lit(role)).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))).select("dim", "part", "lane", "role", "ids", "vectors", "distances")

    cells = dealt(q, "part", parts, "lane", lanes, 0).union(dealt(c, "lane", lanes, "part", parts, 1))
    cells = cells.repartition(parts * lanes, "dim", "part", "lane").sortWithinPartitions("dim", "part", "lane", "role")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def arrays(b: pa.RecordBatch, i: int, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            ids, x, d = (b.column(n)[i].as_buffer() for n in ("ids", "vectors", "distances"))
            ids = np.frombuffer(ids, np.int64)
            return ids, np.frombuffer(x, np.float64).reshape(len(ids), dim), np.frombuffer(d, np.float64).reshape(len(ids), -1)

        def result(best: Best) -> pa.RecordBatch:
            rows = list(zip(*best.rows())) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in rows], names=["query_id", "vec_id", "score"])

        at, part = None, []
        for b in batches:
            for i in range(b.num_rows):
                dim, *cell, role = (b.column(n)[i].as_py() for n in ("dim", "part", "lane", "role"))
                if (dim, *cell) != at:
                    yield from map(result, part)
                    at, part = (dim, *cell), []
                if role == 0:                                 # a cell's queries come before its candidates
                    part.append(Best(*(x.copy() for x in arrays(b, i, dim)), k))
                else:
                    block = arrays(b, i, dim) if part else None
                    for best in part:
                        best.visit(*block)
        yield from map(result, part)

    found = cells.mapInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
