"""SimHash near-duplicates by pivot distance tables.

A text's fingerprint has bit i set if more than half of its word shingles' hashes have it set. Fingerprints within
a few bits are linked; linked documents form a component.

Search: Hamming distances to reference fingerprints ("pivots") are the coordinates of a fingerprint. Two
fingerprints within t bits differ by at most t in every coordinate, so a pair with a larger difference anywhere
is discarded without being looked at. The discarding is done by a partition tree: a node holds a pivot and a
threshold c; rows with distance <= c + t - 1 go left, those with distance >= c go right (the few in between go
both ways), so no pair that could link is separated. Inside a leaf the table of all distances is sorted by its two most
telling coordinates; pairs within t in both are held against the table's other coordinates, and what the maximum
difference doesn't discard is verified by XOR and bit count. Leaves give a spanning forest, never all pairs.

The tree is fitted to a bounded sample (its size only affects speed); every fingerprint is put through it. A leaf
that still is large is cut into blocks, and every pair of blocks becomes a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.llm import tokens
from conform.llm.common import gathered, spread_join, staged, text_batches
from conform.llm.components import connected_components

SEED = 42  # fixed: the shingle hash's seed
RESULT_ROWS = 50_000  # rows of the result in a task
LANES = np.uint64(0x0101010101010101)


def _block_fingerprints(column: pa.Array, width: int) -> np.ndarray:
    data, offsets = tokens.text_bytes(column)
    w = tokens.find_words(tokens.LOWER[data], offsets, tokens.NOT_BLANK)
    n_words = w.counts()
    # single blanks between words: each run of blanks after a word keeps its first byte
    keep = tokens.NOT_BLANK[w.data]
    follows = np.zeros(len(keep), bool)
    follows[1:] = keep[:-1]
    packed = np.where(keep, w.data, np.uint8(0x20))[keep | follows].tobytes()
    at = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep | follows, out=at[1:])
    start, end = at[w.start], at[w.end - 1] + 1
    n_shingles = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    first = np.repeat(w.first[:-1], n_shingles) + tokens.runs_of(n_shingles)
    last = first + np.repeat(np.minimum(n_words, width), n_shingles) - 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(packed[s:e], SEED) for s, e in zip(start[first].tolist(), end[last].tolist())), np.uint64, len(first))
    out = np.zeros(len(n_words), np.uint64)
    full = np.flatnonzero(n_shingles)
    if not len(full):
        return out
    # eight bits at a time, one per byte lane; a lane holds sums of up to 255 hashes
    size = n_shingles[full]
    begin = np.cumsum(size) - size
    parts = -(-size // 255)
    part_begin = np.repeat(begin, parts) + 255 * tokens.runs_of(parts)
    row_begin = np.cumsum(parts) - parts
    bits = np.empty((len(full), 64), bool)
    for j in range(8):
        lanes = np.add.reduceat((h >> np.uint64(j)) & LANES, part_begin).view(np.uint8).reshape(-1, 8)
        counts = np.add.reduceat(lanes.astype(np.int64), row_begin, axis=0)
        bits[:, j::8] = 2 * counts > size[:, None]
    out[full] = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, width: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, (carried columns,) fp: the 64-bit fingerprint as a long, one row for each row of ``docs``."""
    text_batches(docs.sparkSession)
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *carry, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(b.num_columns - 1)
            parts = [_block_fingerprints(c, width) for _, c in tokens.blocks(text)]
            fp = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp.view(np.int64))], names=[*b.schema.names[:-1], "fp"])

    kinds = dict(kept.dtypes)
    return kept.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in ("doc_id", *carry)) + ", fp long")


def pivots(n: int) -> np.ndarray:
    """The reference fingerprints: fixed pseudo-random 64-bit numbers."""
    return tokens.mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(tokens.WORD_BASE))


@dataclass
class Tree:
    """Node i: pivot, threshold, children (a negative child c is leaf -c - 1)."""

    pivot: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaves: int
    bits: int

    def leaves_of(self, fp: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows) for all leaves that get rows."""
        todo = [(0 if len(self.pivot) else -1, np.arange(len(fp)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                yield -node - 1, rows
                continue
            d = np.bitwise_count(fp[rows] ^ self.pivot[node])
            c = self.threshold[node]
            todo.append((int(self.left[node]), rows[d <= c + self.bits - 1]))
            todo.append((int(self.right[node]), rows[d >= c]))


def fit_tree(sample: np.ndarray, total: int, refs: np.ndarray, bits: int, leaf_rows: int) -> Tree:
    """Split until a leaf is expected to hold ``leaf_rows`` of ``total`` rows, or no pivot divides it any more."""
    rows: list[list[int]] = []
    weight = total / max(1, len(sample))
    leaves = 0
    todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(sample)), -1, 0)]
    step = max(bits, 1)
    while todo:
        idx, parent, side = todo.pop()
        best = None
        if len(idx) * weight > leaf_rows and len(idx) >= 16:
            few = idx[:: -(-len(idx) // 4096)]
            d = np.bitwise_count(sample[few][None, :] ^ refs[:, None]).astype(np.int64)
            hist = np.bincount((d + 65 * np.arange(len(refs))[:, None]).ravel(), minlength=65 * len(refs)).reshape(-1, 65)
            below = np.cumsum(hist, axis=1)
            left = below[:, step - 1:]                                   # rows with d <= c + t - 1, for c = 0 ...
            right = len(few) - np.concatenate([np.zeros((len(refs), 1), np.int64), below[:, :64]], axis=1)[:, :left.shape[1]]
            cost = left ** 2 + right ** 2
            p, c = np.unravel_index(np.argmin(cost), cost.shape)
            if cost[p, c] < 0.9 * len(few) ** 2:
                best = int(p), int(c)
        if best is None:
            me = -leaves - 1
            leaves += 1
        else:
            me = len(rows)
            rows.append([best[0], best[1], 0, 0])
            d = np.bitwise_count(sample[idx] ^ refs[best[0]])
            todo.append((idx[d <= best[1] + bits - 1], me, 2))
            todo.append((idx[d >= best[1]], me, 3))
        if parent >= 0:
            rows[parent][side] = me
    t = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return Tree(refs[t[:, 0]], t[:, 1], t[:, 2], t[:, 3], leaves, bits)


def _within(table: np.ndarray, i: np.ndarray, j: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose largest difference in any row of ``table`` is at most ``bits``.

    Rows are taken eight at a time, each on the pairs that are left. Eight rows that discard less than a hundredth of
    many pairs end it: these are close in earnest, and verifying them is cheaper than looking on.
    """
    for k in range(0, len(table), 8):
        before = len(i)
        if not before:
            break
        for row in table[k:k + 8]:
            near = np.abs(row[i] - row[j]) <= bits
            i, j = i[near], j[near]
        if len(i) > 1 << 16 and len(i) > 0.99 * before:
            break
    return i, j


def link_leaf(fp: np.ndarray, refs: np.ndarray, bits: int, chunk: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints: (row, row of its root)."""
    n = len(fp)
    d = np.bitwise_count(fp[None, :] ^ refs[:, None]).astype(np.int8)
    d = d[np.argsort(-d.astype(np.float32).var(axis=1), kind="stable")]
    key = d[0].astype(np.int64) * 128 + d[1]
    order = np.argsort(key, kind="stable")
    key, sorted_fp, table = key[order], fp[order], d[2:, order]
    firsts, seconds = [], []
    for a in range(bits + 1):
        lo = np.searchsorted(key, key + a * 128 - (bits if a else 0), "left")
        hi = np.searchsorted(key, key + a * 128 + bits, "right")
        upto = np.append(0, np.cumsum(hi - lo))
        r0 = 0
        while r0 < n:                                        # rows with about ``chunk`` pairs, one row at least
            r1 = max(r0 + 1, int(np.searchsorted(upto, upto[r0] + chunk, "right")) - 1)
            size = (hi - lo)[r0:r1]
            i = np.repeat(np.arange(r0, r1), size)
            j = np.repeat(lo[r0:r1], size) + tokens.runs_of(size)
            real = i != j
            i, j = _within(table, i[real], j[real], bits)
            near = np.bitwise_count(sorted_fp[i] ^ sorted_fp[j]) <= bits
            firsts.append(i[near])
            seconds.append(j[near])
            r0 = r1
    i = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
    j = np.concatenate(seconds) if seconds else np.zeros(0, np.int64)
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        while True:
            jump = new[new]
            if np.array_equal(jump, new):
                break
            new = jump
        label = new
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]
    child = np.flatnonzero(label != np.arange(n))
    return order[child], order[label[child]]


def near_links(spark: SparkSession, distinct: DataFrame, bits: int = 2, n_pivots: int = 64, leaf_rows: int = 8192,
               sample_rows: int = 65_536) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within ``bits`` bits; ``distinct`` has one row a fingerprint (fp)."""
    refs = pivots(n_pivots)
    total = distinct.count()
    part = min(1.0, sample_rows / max(1, total))
    picked = distinct.where((F.pmod(F.xxhash64(F.lit(7), "fp"), F.lit(1 << 24)) < int(part * (1 << 24)))).select("fp").toArrow()
    sample = np.sort(picked.column("fp").to_numpy().astype(np.int64)).view(np.uint64)
    tree = fit_tree(sample[np.argsort(tokens.mix64(sample))], total, refs, bits, leaf_rows)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(fps: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            fp = np.concatenate(fps)
            for leaf, rows in tree.leaves_of(fp.view(np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), leaf, np.int32)), pa.array(fp[rows])], names=["leaf", "fp"])

        held: list[np.ndarray] = []
        for b in batches:
            held.append(b.column("fp").to_numpy(zero_copy_only=False))
            if sum(map(len, held)) >= 1 << 20:
                yield from out(held)
                held = []
        if held:
            yield from out(held)

    placed = staged(spark, distinct.select("fp").mapInArrow(place, "leaf int, fp long"), "simhash-leaves")
    sizes = placed.groupBy("leaf").agg(F.count("*").alias("n"))
    cut = placed.join(sizes.select(F.col("leaf").alias("l"), F.ceil(F.col("n") / (2 * leaf_rows)).cast("int").alias("c")), F.col("leaf") == F.col("l"))
    cut = cut.withColumn("k", F.pmod(F.xxhash64("fp"), F.col("c")).cast("int"))
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("c") - 1), lambda x: F.struct(F.least(F.col("k"), x).alias("i"), F.greatest(F.col("k"), x).alias("j"))))
    cut = cut.select("leaf", "fp", pair.alias("p")).select("leaf", "p.i", "p.j", "fp")

    def link(group: pa.Table) -> pa.Table:
        fp = group.column("fp").to_numpy().astype(np.int64)
        a, b = link_leaf(fp.view(np.uint64), refs, bits)
        return pa.table({"a": fp[a], "b": fp[b]})

    return cut.groupBy("leaf", "i", "j").applyInArrow(link, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 3, bits: int = 2, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, (carried columns,) fp, component_id, root for every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that can be reached over links, the row's own included; root is the smallest
    fingerprint of the component. Equal fingerprints are one node, so copies cost one row each and no links among
    themselves. A null or empty text has fingerprint 0 and links like any other. Rows without doc_id take part; a
    component that has no other rows has a null id. Repeated rows come out as often as they came in, an empty table
    gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    fps = staged(spark, fingerprints(docs, width, carry), "simhash-fp")
    rows = fps.count()
    distinct = staged(spark, fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "simhash-distinct", rows)
    edges = near_links(spark, distinct, bits)
    roots = connected_components(spark, edges, rows)
    linked = distinct.join(roots, distinct["fp"] == roots["node"]).select("node", "root", "least")
    least = linked.groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("nodes"))
    linked = spread_join(linked.select("node", "root"), least, "root", "nodes", ["node"])
    named = distinct.join(linked, distinct["fp"] == linked["node"], "left").select(
        "fp", "n", F.when(F.col("node").isNull(), F.col("least")).otherwise(F.col("component")).alias("component_id"), F.coalesce("root", "fp").alias("root"))
    out = spread_join(fps, named, "fp", "n", ["doc_id", *carry]).select("doc_id", *carry, "fp", "component_id", "root")
    return gathered(out, rows, RESULT_ROWS)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
