"""Audit of how filters interact: what each removes in every order of applying them.

Every document gets a bit a filter that it fails. Whatever the order, a filter removes the documents that fail it and none
of the filters before it, so the counts of documents by mask (at most 32 a source, and sums of them) answer all 120 orders;
no order is run over the documents.

One filter, "same text as a document with a smaller id", needs other documents. A counting Bloom filter of text hashes is built
first: each task counts in a sketch of its own, sketches are merged by adding. A text that finds one of its counters at one is
unique for certain. Only the other texts are shuffled, in full, for the smallest id of each distinct text, which is then exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.llm.common import UPPER, spread_join, staged
from conform.llm.tokens import mix64

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTERS = 16              # counters a row
LEAST_BITS, MOST_BITS = 16, 28  # log2 of the number of counters: two bits each, so 64 MB are broadcast at the most
PAGE_BITS = 16             # counters of a sketch's page: one row when sketches are merged
PROBES = 3
BLANKS = "\t\n\x0b\x0c\r"  # and the blank itself


# ---------------------------------------------------------------- the sketch
def counters_of(h: np.ndarray, bits: int) -> np.ndarray:
    """The counters of each hash, one row a probe."""
    return np.stack([mix64(h + np.uint64(i + 1)) >> np.uint64(64 - bits) for i in range(PROBES)])


def _sketches(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """A task's counters that aren't zero, one row a page: places in the page, those that count two or more marked by their highest bit."""
    once, more = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for b in batches:
        h = b.column("h").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        # the probes of one text count once a counter, however they fall
        at = np.sort(counters_of(h, bits).astype(np.int64), axis=0)
        keep = np.ones(at.shape, bool)
        keep[1:] = at[1:] != at[:-1]
        places, n = np.unique(at[keep], return_counts=True)
        more = np.union1d(np.union1d(more, places[n > 1]), np.intersect1d(once, places, assume_unique=True))
        once = np.union1d(once, places)
    if not len(once):
        return
    page = once >> PAGE_BITS
    marked = (once & ((1 << PAGE_BITS) - 1)) | (np.isin(once, more, assume_unique=True).astype(np.int64) << 31)
    cut = np.flatnonzero(np.diff(page, prepend=-1))
    for lo, hi in zip(cut, [*cut[1:], len(once)]):
        yield pa.RecordBatch.from_arrays([pa.array([int(page[lo])]), pa.array([marked[lo:hi].astype("<u4").tobytes()])], names=["page", "places"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the sketches of a page, saturating at two, in two bits a counter; rows of a page follow each other."""
    def row(page, counts):
        c = counts.reshape(-1, 4)
        packed = c[:, 0] | c[:, 1] << 2 | c[:, 2] << 4 | c[:, 3] << 6
        return pa.RecordBatch.from_arrays([pa.array([page], pa.int64()), pa.array([packed.tobytes()])], names=["page", "places"])

    page, counts = None, None
    for b in batches:
        for p, places in zip(b.column("page").to_pylist(), b.column("places")):
            if p != page:
                if counts is not None:
                    yield row(page, counts)
                page, counts = p, np.zeros(1 << PAGE_BITS, np.uint8)
            marked = np.frombuffer(places.as_py(), "<u4")
            at = marked & np.uint32((1 << 31) - 1)
            counts[at] = np.minimum(counts[at] + 1 + (marked >> np.uint32(31)).astype(np.uint8), 2)
    if counts is not None:
        yield row(page, counts)


def sketch(spark: SparkSession, hashes: DataFrame, rows: int) -> tuple[Broadcast, int]:
    """(broadcast counters, log2 of their number) over a column ``h`` of 64-bit text hashes.

    ``COUNTERS`` a row, but 64 MB (2^28 counters) at the most: with more than 17 million rows it clears a smaller share of the unique texts, so
    more are shuffled, and the result stays the same.
    """
    bits = int(min(max(np.ceil(np.log2(max(1, COUNTERS * rows))), LEAST_BITS), MOST_BITS))
    kind = "page long, places binary"
    parts = hashes.select("h").mapInArrow(lambda batches: _sketches(batches, bits), kind)
    pages = parts.repartition("page").sortWithinPartitions("page").mapInArrow(_merged, kind)
    out = np.zeros((1 << bits) // 4, np.uint8)
    size = (1 << PAGE_BITS) // 4
    for r in pages.collect():  # 2^(bits - 16) rows of 16 KB at the most
        out[r["page"] * size:(r["page"] + 1) * size] = np.frombuffer(r["places"], np.uint8)
    return spark.sparkContext.broadcast(out.tobytes()), bits


def may_repeat(h: Column, counters: Broadcast, bits: int) -> Column:
    """False only for texts that no other row has. Just the hash goes to Python."""
    @F.pandas_udf("boolean")
    def test(hashes):
        held = np.frombuffer(counters.value, np.uint8)
        at = counters_of(hashes.to_numpy(np.int64).view(np.uint64), bits)
        counts = held[at >> np.uint64(2)] >> ((at & np.uint64(3)) * np.uint64(2)).astype(np.uint8) & np.uint8(3)
        return pd.Series(counts.min(axis=0) > 1)

    return test(h)


# ---------------------------------------------------------------- filters
def failures(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with ``mask``, the bits of the filters A to D that the text (no nulls) fails; words are case-sensitive.

    A: under 200 words; B: fewer than half of the words are distinct; C: over 2 % of the code points are A-Z; D: one of ``#$%&*|``.
    """
    t, w = F.col(text), F.col("__words")
    words = F.array_remove(F.split(F.translate(t, BLANKS, " " * len(BLANKS)), " ", -1), "")
    upper = F.length(t) - F.length(F.translate(t, UPPER, ""))
    tests = (F.size(w) < 200, 100 * F.size(F.array_distinct(w)) < 50 * F.size(w),
             100 * upper > 2 * F.length(t), F.length(F.translate(t, "#$%&*|", "")) < F.length(t))
    mask = sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(tests)), F.lit(0))
    return rows.withColumn("__words", words).withColumn("mask", mask).drop("__words")


def later(doc_id: Column, first: Column) -> Column:
    """Whether a row comes after the smallest id of its text; a row without an id comes after all that have one."""
    return F.coalesce(doc_id > first, first.isNotNull())


def later_copies(spark: SparkSession, docs: DataFrame, scanned: DataFrame, text_hash: Callable[[Column], Column]) -> DataFrame:
    """The rows (doc_id, part, mask) of ``scanned`` whose text a row with a smaller id has, table-wide.

    ``docs`` has (doc_id, part, text), ``scanned`` (doc_id, part, mask, h) of the same rows.
    """
    counters, bits = sketch(spark, scanned, scanned.count())
    maybe = may_repeat(F.col("h"), counters, bits)
    texts = docs.withColumn("h", text_hash(F.col("text"))).where(maybe)
    # copies meet in the partial aggregate: a task sends each of its texts once
    firsts = texts.groupBy("h", "text").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    by_hash = staged(spark, firsts.groupBy("h").agg(F.count("*").alias("texts"), F.min("first").alias("first"), F.sum("n").alias("n"))
                     .where("n > 1"), "audit-firsts", 1)
    alone = by_hash.where("texts = 1").select("h", "first", "n")
    met = spread_join(scanned.where(maybe), alone, "h", "n", ["doc_id", "part", "mask"])
    found = met.where(later(F.col("doc_id"), F.col("first"))).select("doc_id", "part", "mask")
    shared = by_hash.where("texts > 1").select(F.col("h").alias("__h"))
    if not shared.isEmpty():  # different texts of one hash: told apart by the texts themselves
        own = failures(texts.join(shared, F.col("h") == F.col("__h"), "left_semi"))
        again = own.groupBy("h", "text").agg(F.min("doc_id").alias("first")).withColumnsRenamed({"h": "__h", "text": "__text"})
        both = own.join(again, (own["h"] == again["__h"]) & (own["text"] == again["__text"]))
        found = found.unionByName(both.where(later(F.col("doc_id"), F.col("first"))).select("doc_id", "part", "mask"))
    return staged(spark, found, "audit-later", scanned.count())


def mask_counts(docs: DataFrame, labels: DataFrame, text_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(part, mask, n, good, toxic): documents by source and the filters that they fail.

    Counts are added up: every row counts with its bits A to D, and a later copy is then moved to the mask that has E too.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    scanned = staged(spark, failures(rows).select("doc_id", "part", "mask", text_hash(F.col("text")).alias("h")), "audit-scanned")
    copies = later_copies(spark, rows, scanned, text_hash)
    bit = 1 << FILTERS.index("E")
    counted = scanned.select("doc_id", "part", "mask", F.lit(1).cast("long").alias("n"))
    for mask, n in ((F.col("mask"), -1), (F.col("mask") + bit, 1)):
        counted = counted.unionByName(copies.select("doc_id", "part", mask.alias("mask"), F.lit(n).cast("long").alias("n")))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("__id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("long")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("long")), F.lit(0)).alias("bad"))
    marks = staged(spark, marks.where("good + bad > 0"), "audit-labels", labels.count())
    marked = counted.join(marks, F.col("doc_id") == F.col("__id"))
    zero = F.lit(0).cast("long")
    added = counted.select("part", "mask", "n", zero.alias("good"), zero.alias("toxic")).unionByName(
        marked.select("part", "mask", zero.alias("n"), (F.col("n") * F.col("good")).alias("good"), (F.col("n") * F.col("bad")).alias("toxic")))
    return added.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def report(counts: DataFrame) -> DataFrame:
    """Mask counts -> one row a part, filter order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    With ``pass[S]`` the documents that fail no filter of the set S, a step removes ``pass[before] - pass[before and own]``.
    """
    def total(s):
        def add(a, x):
            return F.struct(*[(a[c] + x[c]).alias(c) for c in ("n", "good", "toxic")])

        none = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("n", "good", "toxic")])
        return F.aggregate(F.filter("c", lambda x: x["mask"].bitwiseAND(s) == 0), none, add)

    every = F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1))
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("c"))
    parts = parts.select("part", F.transform(every, total).alias("p"))
    passing = lambda s: F.col("p")[s]
    # a set of k filters stands before a given one in k! (4 - k)! of the orders
    weight = F.array(*[F.lit(w) for w in (24, 6, 4, 6, 24)])
    steps = parts.select("part", "p", F.explode(F.lit(ORDERS)).alias("filter_order")).select(
        "part", "p", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    place = [F.instr("filter_order", f) for f in FILTERS]
    before = sum((F.when(at < F.col("step"), 1 << i).otherwise(0) for i, at in enumerate(place)), F.lit(0))
    own = sum((F.when(at == F.col("step"), 1 << i).otherwise(0) for i, at in enumerate(place)), F.lit(0))
    steps = steps.withColumn("a", before).withColumn("f", own).withColumn("b", F.col("a") + F.col("f"))
    f, all_ = F.col("f"), (1 << len(FILTERS)) - 1
    at_any = F.aggregate(F.filter(every, lambda s: s.bitwiseAND(f) == 0), F.lit(0).cast("long"), lambda x, s:
                         x + weight[F.bit_count(s)] * (passing(s)["n"] - passing(s + f)["n"]))
    lost = {c: passing(F.col("a"))[c] - passing(F.col("b"))[c] for c in ("n", "good", "toxic")}
    return steps.select(
        "part", "filter_order", "step", passing(F.col("b"))["n"].alias("kept"), lost["n"].alias("removed"),
        (passing(F.lit(0))["n"] - passing(f)["n"] - lost["n"]).alias("redundant"),
        (passing(F.lit(all_) - f)["n"] - passing(F.lit(all_))["n"]).alias("unique_fails"),
        lost["good"].alias("good_lost"), lost["toxic"].alias("toxic_lost"), at_any.alias("shapley"))


def audit_filters(docs: DataFrame, labels: DataFrame, text_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """The report over ``docs`` (doc_id, source, text) and ``labels`` (doc_id, quality, toxic): 600 rows a source.

    A null text is empty, a null source the part ''. Among rows that share an id and a text none comes after the other; a row without an
    id comes after all that have one. A document is good (toxic) if any of its label rows says so. Texts of any length
    count whole, repeated rows count each, an empty table gives no rows, and other columns are not read.
    """
    return report(mask_counts(docs, labels, text_hash))
