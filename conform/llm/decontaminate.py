"""Benchmark decontamination by spaced seeds.

A mask covers a few neighbouring words and ignores some of them, so a hash over the others survives a substituted word
at an ignored place. Benchmark and training texts are hashed with the same masks at every word position and
joined; every hit fixes an alignment of a document with an item, along which the words are compared. A
document is contaminated by an item if, along one alignment,

* at least ``similarity`` of the whole item's words agree, or
* a stretch of at least ``min_words`` words has that share of agreeing words.

Words are runs of letters and digits, lower-cased, so case and punctuation make no difference.

Stretches of documents with equal words and hits are one class: they are joined and compared once, and the result goes to all of
them. Joins whose keys may be hot (a seed in a third of the documents, a class of many copies) are split.

The documents are read once. A Bloom filter of the benchmark's hashes (bounded size, exact join behind it) lets only the
words around possible hits out of the scan; all else stays where it is.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.llm import bloom, tokens
from conform.llm.common import spread_join, staged, text_batches, with_row_key

# Fixed masks: 1 is compared, 0 ignored. Of a stretch of 13 words or more of which 80 % agree, one mask at one place meets agreeing
# words only, whichever they are. A stretch of 26 words or more can be cut into ones of 13 to 25, of which one has that share
# too, so these lengths are the whole proof; the tests go through all their patterns. Masks begin and end with a compared
# word, so none reaches over the end of a document in which an item is cut off.
MASKS = ("110110011", "101101101", "111001011", "110010111", "111000000111")
MASKS_FROM, MASKS_SHARE = 13, 0.8
# The same for whole items of 5 to 12 words. Fewer words have to agree all of them.
SHORT_MASKS = {5: ("1111", "10111", "11011", "11101"), 6: ("11111", "101111", "110111", "111011", "111101"), 7: ("11111", "1101011", "1110111"),
               8: ("111111", "11001111", "11110011"), 9: ("1111011", "1101111"), 10: ("111011", "11010011", "11111"), 11: ("1101011", "1110011"), 12: ("11101011", "101100111", "111111")}
SHORTEST = 5  # items with fewer words are found in almost any text and are searched only if asked for


def _words(column: pa.Array) -> tuple[tokens.Words, np.ndarray]:
    data, offsets = tokens.text_bytes(pc.utf8_lower(pc.fill_null(column, "")))
    w = tokens.find_words(data, offsets, tokens.ALNUM)
    return w, w.hashes()


def _seeds(h: np.ndarray, first: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """(word positions, hashes) of every place where the mask fits into a text."""
    span = len(mask)
    if len(h) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    n = len(h) - span + 1
    total = np.full(n, int(mask, 2) * tokens.BYTE_BASE & (1 << 64) - 1, np.uint64)
    up, _ = tokens.WORD_POWERS.upto(span + 1)
    for i, c in enumerate(mask):
        if c == "1":
            total += h[i:i + n] * up[i + 1]
    ends = np.repeat(first[1:], np.diff(first))[:n]
    at = np.flatnonzero(np.arange(n) + span <= ends)
    return at, tokens.mix64(total[at])


def _exact(n_words: int, similarity: float) -> bool:
    """Whether an item of that length has no words to spare."""
    return n_words < min(SHORT_MASKS) and n_words - 1 < similarity * n_words


def _item_masks(n_words: int, similarity: float, min_words: int) -> tuple[str, ...]:
    if n_words < 1:
        return ()
    if _exact(n_words, similarity):
        return ("1" * n_words,)
    if n_words >= min(SHORT_MASKS) and similarity >= MASKS_SHARE and (min_words >= MASKS_FROM or n_words <= min_words):
        return MASKS if n_words >= MASKS_FROM else SHORT_MASKS[n_words]
    # a looser criterion than the masks are made for: k changed words leave one of k + 1 runs that long
    lengths = range(min(n_words, min_words), min(n_words, 2 * min_words - 1) + 1)
    changed = ((n, math.floor(n - similarity * n + 1e-9)) for n in lengths)
    return ("1" * max(1, min(-(-(n - k) // (k + 1)) for n, k in changed)),)


def benchmark_items(benchmark: DataFrame, similarity: float, min_words: int, shortest: int) -> DataFrame:
    """item (key), item_id, item_ids, n, words (hashes as bytes), seeds; items with equal words are one, under the smallest id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w, h = _words(b.column("text"))
            rows = []
            for i, item_id in enumerate(b.column("item_id").to_pylist()):
                own = h[w.first[i]:w.first[i + 1]]
                found = [_seeds(own, np.array([0, len(own)]), m) for m in _item_masks(len(own), similarity, min_words)]
                if found and len(own) >= shortest:
                    at, s = (np.concatenate(x) for x in zip(*found))
                    rows.append((item_id, len(own), own.tobytes(), [{"h": int(x), "at": int(a)} for a, x in zip(at, s.view(np.int64))]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary()),
                 pa.array([r[3] for r in rows], pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32())])))],
                names=["item_id", "n", "words", "seeds"])

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        run, "item_id long, n int, words binary, seeds array<struct<h: long, at: int>>")
    return items.groupBy("words").agg(F.min("item_id").alias("item_id"), F.collect_set(F.struct("item_id")).alias("item_ids"), F.first("n").alias("n"), F.first("seeds").alias("seeds")).select(
        F.xxhash64("words").alias("item"), "item_id", "item_ids", "n", "words", "seeds")


def _verify(a: np.ndarray, b: np.ndarray, similarity: float, min_words: int) -> tuple[int, int, int] | None:
    """(start, words, agreeing words) of the best stretch of two aligned word rows that passes, or None.

    ``a`` is the item with the document's words beside it in ``b``; places outside the document hold a zero in ``b``.
    """
    same = (a == b).astype(np.int64)
    if same.sum() >= similarity * len(a):
        inside = np.flatnonzero(same)
        return int(inside[0]), int(inside[-1] - inside[0] + 1), int(same.sum())
    if len(a) < min_words:
        return None
    # longest stretch with a share of at least ``similarity``: its weighted sum is not negative
    sums = np.concatenate([[0.0], np.cumsum(same - similarity)]) + np.arange(len(a) + 1) * 1e-9
    best = None
    low = np.minimum.accumulate(sums)
    for end in range(len(a), min_words - 1, -1):
        start = int(np.searchsorted(-low, -sums[end], "left"))
        if end - start >= min_words and (best is None or end - start > best[1]):
            best = start, end - start
    return None if best is None else (best[0], best[1], int(same[best[0]:best[0] + best[1]].sum()))


def _each(left: DataFrame, right: DataFrame, key: str, by: list[str]) -> DataFrame:
    """``left`` joined to every row of ``right`` with its ``key``. Hot keys of ``left`` are split; a key's rows of ``right``, as many as
    there are benchmark items and places, travel as a list."""
    lists = right.groupBy(key).agg(F.collect_list(F.struct(*[c for c in right.columns if c != key])).alias("__all"))
    counts = left.groupBy(key).agg(F.count("*").alias("__rows")).join(lists, key)
    return spread_join(left, counts, key, "__rows", by).withColumn("__one", F.explode("__all")).select(*left.columns, "__one.*")


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, min_words: int = 13,
                 carry: tuple[str, ...] = (), shortest: int = SHORTEST, every_id: bool = False,
                 any_item: bool = False) -> DataFrame:
    """doc_id, (carried,) item_id, start_word, n_words, n_same, item_words: one row for each document and item found.

    ``docs`` (doc_id, text), ``benchmark`` (item_id, text). Of several places of an item in a document the one with most
    agreeing words is given, the first of equal ones. Repeated rows of ``docs`` give one row; rows that share an id
    but not the text are searched each. Items with equal words are found under the smallest of their ids; ``every_id`` gives
    a row for each of the ids (a null one too). Null and empty texts contain nothing; items with fewer than ``shortest``
    words are not searched (1: all are; below 5 words 80 % are all words); of all others every place that meets the criterion is found. A null doc_id is returned as it is. Either table
    may be empty. Other columns are not read.

    ``any_item`` gives doc_id and the carried columns only, one row for a contaminated document: each seed is tried with one of its
    items first, and only the stretches in which nothing is found that way are held against the others. Question openers that
    many items share so cost a comparison a document, not one for each of the items.
    """
    spark = docs.sparkSession
    text_batches(spark)
    items = staged(spark, benchmark_items(benchmark, similarity, min_words, shortest), "decon-items", benchmark.count())
    seeds = items.select("item", F.explode("seeds").alias("s")).select("item", F.col("s.h").alias("h"), F.col("s.at").alias("at"))
    longest = items.agg(F.max("n")).first()[0] or 0
    most = max(MASKS_FROM, 2 * min_words)  # items from that length on have the same masks
    lengths = sorted(n for (n,) in items.select(F.least("n", F.lit(most))).distinct().collect())
    masks = list(dict.fromkeys(m for n in lengths for m in _item_masks(n, similarity, min_words))) or MASKS
    # a few common words stand in a text often, and all their places are alike: the first is enough
    once = {"1" * n for n in lengths if _exact(n, similarity)}
    once -= {m for n in lengths if not _exact(n, similarity) for m in _item_masks(n, similarity, min_words)}
    held, bits = bloom.build(spark, seeds.select("h"), "h")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *carry, "text")
    names = source.columns[:-1]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(held.value, np.uint8)
        for b in batches:
            rows, starts, words, hits, alike = [], [], [], [], []
            for lo, block in tokens.blocks(b.column(b.num_columns - 1)):
                w, h = _words(block)
                found = []
                for m in masks:
                    at, s = _seeds(h, w.first, m)
                    ok = np.flatnonzero(bloom.contains(table, bits, s))
                    if m in once and len(ok):
                        doc = np.searchsorted(w.first, at[ok], "right") - 1
                        order = np.lexsort((at[ok], s[ok], doc))
                        d, k = doc[order], s[ok][order]
                        ok = ok[order[np.append(True, (d[1:] != d[:-1]) | (k[1:] != k[:-1]))]]
                    found.append((at[ok], s[ok], np.full(len(ok), len(m))))
                at, s, span = (np.concatenate(x) for x in zip(*found))
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, s, span = at[order], s[order], span[order]
                doc = np.searchsorted(w.first, at, "right") - 1
                begin = np.maximum(at - longest, w.first[doc])
                end = np.minimum(at + span + longest, w.first[doc + 1])
                # hits whose surroundings overlap share a segment
                new = np.ones(len(at), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (begin[1:] > np.maximum.accumulate(end)[:-1])
                cut = np.append(np.flatnonzero(new), len(at))
                for i, j in zip(cut[:-1], cut[1:]):
                    d, first = doc[i], begin[i]
                    rows.append(lo + d)
                    starts.append(first - w.first[d])
                    words.append(h[first:end[i:j].max()].tobytes())
                    hits.append([{"h": int(x), "at": int(p)} for x, p in zip(s[i:j].view(np.int64), at[i:j] - first)])
                    alike.append(hashlib.blake2b(words[-1] + s[i:j].tobytes() + (at[i:j] - first).astype("<i8").tobytes(), digest_size=16).digest())
            if rows:
                own = b.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns[:-1], pa.array(starts, pa.int32()), pa.array(words, pa.binary()),
                     pa.array(hits, pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32())]))), pa.array(alike, pa.binary())],
                    names=[*names, "start", "near", "hits", "class"])

    kinds = dict(source.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", start int, near binary, hits array<struct<h: long, at: int>>, class binary"
    segments = staged(spark, source.mapInArrow(scan, schema), "decon-segments")
    classes = staged(spark, segments.select("class", "near", "hits").dropDuplicates(["class"]), "decon-classes")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, out = [], []
            for i, (shift, near, words) in enumerate(zip(*(b.column(c).to_pylist() for c in ("shift", "near", "words")))):
                a, d = np.frombuffer(words, np.uint64), np.frombuffer(near, np.uint64)
                beside = np.zeros(len(a), np.uint64)   # the item's first word falls on word ``shift`` of the stretch
                i0, i1 = max(0, -shift), min(len(a), len(d) - shift)
                beside[i0:i1] = d[shift + i0:shift + i1]
                best = _verify(a, beside, similarity, min_words)
                if best:
                    rows.append(i)
                    out.append((shift + best[0], best[1], best[2]))
            if rows:
                own = b.take(pa.array(rows, pa.int64()))
                s, n, same = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [*(own.column(c) for c in ("class", "item", "item_id", "n")), pa.array(s, pa.int32()), pa.array(n, pa.int32()), pa.array(same, pa.int32())],
                    names=["class", "item", "item_id", "item_words", "s", "n_words", "n_same"])

    def verified(classes: DataFrame, seeds: DataFrame) -> DataFrame:
        hit = classes.select("class", F.explode("hits").alias("s")).select("class", F.col("s.h").alias("h"), F.col("s.at").alias("p"))
        lines = _each(hit, seeds, "h", ["class", "p"]).select("class", "item", (F.col("p") - F.col("at")).alias("shift")).distinct()
        pairs = lines.join(classes.select("class", "near"), "class").join(items.select("item", "item_id", "n", "words"), "item")
        return pairs.select("class", "item", "item_id", "n", "shift", "near", "words").mapInArrow(
            check, "class binary, item long, item_id long, item_words int, s int, n_words int, n_same int")

    if any_item:
        first = seeds.groupBy("h").agg(F.min(F.struct("item", "at")).alias("m")).select("h", "m.item", "m.at")
        soon = staged(spark, verified(classes, first).select("class").distinct(), "decon-first")
        later = verified(classes.join(soon, "class", "left_anti"), seeds).select("class").distinct()
        return segments.join(soon.union(later), "class", "left_semi").select("doc_id", *carry).distinct()

    best = F.max(F.struct("n_same", (-F.col("s")).alias("s"), "n_words")).alias("m")
    found = verified(classes, seeds).groupBy("class", "item", "item_id", "item_words").agg(best).select(
        "class", "item", "item_id", "item_words", "m.n_same", (-F.col("m.s")).alias("s"), "m.n_words")
    if every_id:
        ids = items.where(F.size("item_ids") > 1).select(F.col("item").alias("same"), F.explode("item_ids").alias("own"))
        found = found.join(ids, found["item"] == ids["same"], "left").withColumn(
            "item_id", F.when(F.col("own").isNull(), F.col("item_id")).otherwise(F.col("own.item_id")))
    found = _each(segments.select("doc_id", *carry, "class", "start"), found.drop("item"), "class", ["doc_id", "start"])
    found = found.withColumn("start_word", F.col("start") + F.col("s"))
    best = F.max(F.struct("n_same", (-F.col("start_word")).alias("s"), "n_words")).alias("m")
    return found.groupBy("doc_id", *carry, "item_id", "item_words").agg(best).select(
        "doc_id", *carry, "item_id", (-F.col("m.s")).alias("start_word"), F.col("m.n_words").alias("n_words"), F.col("m.n_same").alias("n_same"), "item_words")


def removed_by_short_items(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, min_words: int = 13) -> DataFrame:
    """One row: documents (rows that differ), removed (with items of any length), removed_by_short (not removed if items below ``SHORTEST`` words were left out).

    Such items can only be matched whole, so one of a common word removes every document that holds it: what that costs is to be seen before
    the pipeline is run with them. Empty tables give zeros; null and empty texts are documents that nothing removes.
    """
    keyed = with_row_key(docs)
    every = keyed.select("doc_id", "__h").distinct().select(F.lit("documents").alias("kind"))
    removed, long = (contaminated(keyed, benchmark, similarity, min_words, carry=("__h",), shortest=n, any_item=True).select(F.lit(kind).alias("kind"))
                     for kind, n in (("removed", 1), ("long", SHORTEST)))
    n = {kind: F.count(F.when(F.col("kind") == kind, 1)) for kind in ("documents", "removed", "long")}
    return every.union(removed).union(long).agg(
        n["documents"].alias("documents"), n["removed"].alias("removed"), (n["removed"] - n["long"]).alias("removed_by_short"))
