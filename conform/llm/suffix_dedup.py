"""Repeated passages by a sparse suffix array.

Only suffixes that start at a minimiser are kept: in every window of ``min_words`` words the position whose short
word run has the smallest hash. Which position that is depends on the window's words alone, so two equal windows keep the
same one, and every repeated passage of ``min_words`` words is seen through suffixes it shares.

A kept suffix stands for its neighbourhood, the words of all windows that selected it: some to its left, the others to its
right. Hashes only decide who is compared: suffixes whose short run no other document has are dropped, the rest are cut into
parts that hold a run whole. What counts as repeated is decided by words:

* a part's suffixes are sorted by the words to their right, and neighbours compared word by word;
* equal neighbourhoods in different documents: the whole neighbourhood is repeated;
* others are extended to the right as far as the words agree with their neighbours' in that order, and to the left by
  refining, word after word, the classes of suffixes whose words to the left agree: a window is repeated if a suffix of another document
  agrees with it on both sides;
* a run that is too frequent for one part is cut. Its suffixes that aren't settled are sorted again, over range partitions, by the words to their
  right: an answer is final unless the suffixes that agree so far reach beyond the partition. Those go on to the same comparison in the order of the words
  to their left. What is open in both orders, windows whose halves are frequent on both sides, is grouped by the windows' whole text.

Overlapping repeated windows are joined, so the result are maximal passages: exactly the words that lie in a
window of ``min_words`` words which another document has too.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from conform.llm import tokens
from conform.llm.common import spread_join, staged

RUN_WORDS = 8
PART_ROWS = 20_000         # suffixes that are compared at a time in a task
FOUND = "doc_id long, doc long, b int, e int, place int, right binary, left binary, least int"  # a span, or a suffix with its words
PIECE_BYTES = 4 << 20      # of words sent on at a time
POSITION_BITS = np.uint64((1 << 24) - 1)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, in linear time."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.uint64(2 ** 64 - 1))
    padded[:len(x)] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def _picks(run: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest hash in every run of ``width`` places, the leftmost of equal ones.

    A place goes into the low bits of the key, so it counts from the begin of a slice that these bits can number.
    """
    slice_len = int(POSITION_BITS) + 1
    if width > slice_len:
        raise ValueError("min_words is too large")
    n = len(run) - width + 1
    picks = np.empty(n, np.int64)
    step = slice_len - width + 1                             # slices overlap, so that each window lies in one whole
    for lo in range(0, n, step):
        part = run[lo:lo + slice_len]
        key = (part & ~POSITION_BITS) | np.arange(len(part), dtype=np.uint64)
        own = (_sliding_least(key, width) & POSITION_BITS).astype(np.int64) + lo
        picks[lo:lo + len(own)] = own
    return picks


def block_suffixes(column: pa.Array, min_words: int, run_words: int) -> tuple[np.ndarray, ...]:
    """Kept suffixes of a block: (text, first window, last window, run hash, neighbourhood hash, place)."""
    data, offsets = tokens.text_bytes(column)
    w = tokens.find_words(data, offsets, tokens.NOT_BLANK)
    h = w.hashes()
    none = np.zeros(0, np.int64)
    if len(h) < min_words:
        return none, none, none, none.view(np.uint64), none.view(np.uint64), none
    runs = tokens.Runs(h, tokens.WORD_POWERS)
    at = np.arange(len(h) - run_words + 1)
    run = runs.hash(at, at + run_words)
    pick = _picks(run, min_words - run_words + 1)
    text = w.text_of_word()
    begin = np.arange(len(pick))
    inside = text[begin] == text[begin + min_words - 1]
    begin, pick = begin[inside], pick[inside]
    if not len(begin):
        return none, none, none, none.view(np.uint64), none.view(np.uint64), none
    new = np.ones(len(begin), bool)
    new[1:] = (pick[1:] != pick[:-1]) | (text[begin[1:]] != text[begin[:-1]])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(begin)) - 1
    lo, hi, pick = begin[lo], begin[hi], pick[lo]
    t = text[lo]
    return t, lo - w.first[t], hi - w.first[t], run[pick], runs.hash(lo, hi + min_words), pick - w.first[t]


def _parts(t: pa.Table, part_rows: int) -> pa.Table:
    """The rows of a partition (sorted by run) whose run several documents have, or may have beyond the partition.

    Adds ``part``, at most twice ``part_rows`` neighbouring rows, and ``cut``, whether rows of the same run may be in another part.
    """
    run, doc = (t.column(c).to_numpy() for c in ("run", "doc"))
    n = len(run)
    first = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    sizes = np.diff(np.append(first, n))
    edge = np.zeros(len(first), bool)
    edge[0] = edge[-1] = True
    several = (np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)) | edge
    keep = np.flatnonzero(np.repeat(several, sizes))
    first, sizes, edge = np.cumsum(sizes[several]) - sizes[several], sizes[several], edge[several]
    at, whole = np.arange(len(keep)), sizes <= part_rows
    number = np.where(np.repeat(whole, sizes), np.repeat(first, sizes), at) // part_rows
    t = t.take(pa.array(keep))
    _, head, number = np.unique(number, return_index=True, return_inverse=True)
    heads = t.take(pa.array(head))                            # a part is named by its first row, on every attempt alike
    name = np.zeros(len(heads), np.uint64)
    for c in ("run", "doc", "first"):
        name = tokens.mix64(name + heads.column(c).to_numpy().astype(np.int64).view(np.uint64))
    return t.append_column("part", pa.array(name.view(np.int64)[number])).append_column("cut", pa.array(np.repeat(edge | ~whole, sizes)))


def _slices(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
    """Binary array of ``data[lo:hi]``, a value a pair."""
    n = hi - lo
    offsets = np.append(0, np.cumsum(n)).astype(np.int32)
    at = np.arange(offsets[-1], dtype=np.int64) + np.repeat(lo - offsets[:-1], n)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at]))])


def _lined(w: tokens.Words) -> tuple[np.ndarray, np.ndarray]:
    """All words, a line feed before, between and after them, and the offset of the one before each word (and of the last)."""
    at = np.append(0, np.cumsum(w.end - w.start + 1))
    out = np.full(at[-1] + 1, 10, np.uint8)
    inside = np.ones(len(out), bool)
    inside[at] = False
    out[inside] = w.data[tokens.NOT_BLANK[w.data]]
    return out, at


def _lines(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(place of each row's first word, number of words, words) of rows of words that each end in a line feed."""
    lists = pc.split_pattern(column.combine_chunks(), b"\n")
    ends = lists.offsets.to_numpy().astype(np.int64)
    return ends[:-1], np.diff(ends) - 1, lists.values


def _tables(right: pa.ChunkedArray, left: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words to the right and to the left (both nearest first) as numbers, equal ones for equal words, -1 beyond a row's end; their counts."""
    r_at, r_n, r_words = _lines(right)
    l_at, l_n, l_words = _lines(left)
    r_ids, l_ids = (c.indices.to_numpy() for c in pa.chunked_array([r_words, l_words]).dictionary_encode().unify_dictionaries().chunks)

    def table(flat: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        out = np.full((len(n), max(1, int(n.max(initial=0)))), -1, np.int32)
        col = tokens.runs_of(n)
        out[np.repeat(np.arange(len(n)), n), col] = flat[np.repeat(at, n) + col]
        return out

    return table(r_ids, r_at, r_n), r_n, table(l_ids, l_at, l_n), l_n


def _agree(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Number of words in which a row agrees with the row before it, 0 for the first row."""
    out = np.zeros(len(x), np.int64)
    if len(x) > 1:
        differs = np.hstack([x[1:] != x[:-1], np.ones((len(x) - 1, 1), bool)])
        out[1:] = np.minimum(differs.argmax(axis=1), np.minimum(n[1:], n[:-1]))
    return out


def _several(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether rows of another document have the same key; whether the row stands for its key (two of different documents, if there are)."""
    order = np.lexsort((doc, key))
    k, d = key[order], doc[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    sizes = np.diff(np.append(first, len(k)))
    ends = first + sizes - 1
    differ, stands = np.empty(len(key), bool), np.zeros(len(key), bool)
    differ[order] = np.repeat(d[first] != d[ends], sizes)
    stands[order[first]] = stands[order[ends]] = True
    return differ, stands


def _extend(x: np.ndarray, x_n: np.ndarray, y: np.ndarray, y_n: np.ndarray, doc: np.ndarray, min_words: int, run_words: int, by_left: bool) -> tuple[np.ndarray, ...]:
    """(repeated, open, needed) by row and number of words to the left of the place, for rows sorted by the words ``x`` on one side.

    Rows whose nearest words in ``x`` agree are neighbours; those that agree in ``y`` too are found by refining classes word by word. A window is open
    if the rows that agree with it in ``x`` reach the first or last row; an open one is needed if it isn't repeated or stands for its words.
    """
    m, widest = len(doc), min_words - run_words
    repeated, open_, needed = (np.zeros((m, widest + 1), bool) for _ in range(3))
    agree = _agree(x, x_n)
    in_y = np.zeros(m, np.int64)
    least, most = (run_words, min_words) if by_left else (0, widest)
    for j in range(most + 1):
        k = min_words - j
        at = np.flatnonzero((x_n >= k) & (y_n >= j))
        if j >= least and len(at):
            a = k if by_left else j
            in_x = np.cumsum(agree < k)
            again, stands = _several(in_x[at] * m + in_y[at], doc[at])
            reach = (in_x[at] == in_x[0]) | (in_x[at] == in_x[-1])
            repeated[at, a], open_[at, a], needed[at, a] = again, reach, reach & (~again | stands)
        if j < most and j < y.shape[1]:
            in_y = np.unique(in_y * (int(y.max()) + 2) + y[:, j] + 1, return_inverse=True)[1]
    return repeated, open_, needed


def _spans(repeated: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first window, last window) of neighbouring repeated windows."""
    m, n = repeated.shape
    by_begin = np.zeros((m, n + 2), bool)
    by_begin[:, 1:-1] = repeated[:, ::-1]
    row, b = np.nonzero(by_begin[:, 1:] & ~by_begin[:, :-1])
    _, e = np.nonzero(by_begin[:, :-1] & ~by_begin[:, 1:])
    return row, place[row] - (n - 1) + b, place[row] - (n - 1) + e - 1


def compare_suffixes(t: pa.Table, min_words: int, run_words: int) -> tuple[np.ndarray, ...]:
    """Neighbour comparison in one part (doc, place, right, left), sorted by (right, left, doc).

    Returns spans (row, first window, last window) that another document has too, and the rows that others must be compared with: those not
    settled by an equal neighbourhood, and for each settled neighbourhood one row of two documents.
    """
    doc, place = t.column("doc").to_numpy(), t.column("place").to_numpy().astype(np.int64)
    right, r_n, left, l_n = _tables(t.column("right"), t.column("left"))
    n = len(doc)
    same = (_agree(right, r_n) == r_n) & (np.append(-1, r_n[:-1]) == r_n) & (np.append(-1, l_n[:-1]) == l_n)
    same[1:] &= (left[1:] == left[:-1]).all(axis=1)
    h0 = np.flatnonzero(~same)
    sizes = np.diff(np.append(h0, n))
    h1 = h0 + sizes - 1
    whole = np.repeat(doc[h0] != doc[h1], sizes)              # equal neighbourhoods, sorted by document
    looked = ~whole
    looked[h0] = looked[h1] = True
    rest = np.flatnonzero(looked)                             # still sorted by the words to the right
    repeated, _, _ = _extend(right[rest], r_n[rest], left[rest], l_n[rest], doc[rest], min_words, run_words, False)
    row, b, e = _spans(repeated, place[rest])
    settled = np.flatnonzero(whole)
    first, last = place - l_n, place + r_n - min_words
    return np.append(settled, rest[row]), np.append(first[settled], b), np.append(last[settled], e), rest


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each part, from batches sorted by part."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        part = b.column("part").to_numpy()
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi > lo:
                if held and held[0].column("part")[0].as_py() != part[lo]:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(b.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _table(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    held = [b for b in batches if len(b)]
    return pa.Table.from_batches(held) if held else None


def _found(t: pa.Table, row: np.ndarray, b: np.ndarray, e: np.ndarray) -> list[pa.RecordBatch]:
    """Rows of ``FOUND`` for repeated spans [b, e)."""
    out = t.select(["doc_id", "doc"]).take(pa.array(row))
    for name, values in (("b", b), ("e", e)):
        out = out.append_column(name, pa.array(values.astype(np.int32)))
    for name, kind in (("place", pa.int32()), ("right", pa.binary()), ("left", pa.binary()), ("least", pa.int32())):
        out = out.append_column(name, pa.nulls(len(row), kind))
    return out.combine_chunks().to_batches()


def _open(t: pa.Table, row: np.ndarray, least: np.ndarray) -> list[pa.RecordBatch]:
    """Rows of ``FOUND`` for suffixes to be compared further, windows of ``least`` words to the left or more."""
    some = t.take(pa.array(row))
    nothing = pa.nulls(len(row), pa.int32())
    out = some.select(["doc_id", "doc"]).append_column("b", nothing).append_column("e", nothing)
    for name in ("place", "right", "left"):
        out = out.append_column(name, some.column(name))
    return out.append_column("least", pa.array(least)).combine_chunks().to_batches()


def _windows(t: pa.Table, row: np.ndarray, a: np.ndarray, min_words: int) -> pa.RecordBatch:
    """Windows with their words (as the columns hold them), that of row i beginning ``a[i]`` words left of its place."""
    some = t.take(pa.array(row))
    begin = some.column("place").to_numpy().astype(np.int32) - a.astype(np.int32)
    texts = []
    for left, right, n in zip(some.column("left").to_pylist(), some.column("right").to_pylist(), a.tolist(), strict=True):
        texts.append(b"\n".join([*left.split(b"\n")[:n], *right.split(b"\n")[:min_words - n]]))
    return pa.RecordBatch.from_arrays([*(some.column(c).combine_chunks() for c in ("doc_id", "doc")), pa.array(begin), pa.array(begin + np.int32(min_words)),
                                       pa.array(texts, pa.binary())], names=["doc_id", "doc", "b", "e", "window"])


def repeated_passages(docs: DataFrame, min_words: int = 50, run_words: int = RUN_WORDS, part_rows: int = PART_ROWS) -> DataFrame:
    """doc_id, start_word, end_word (exclusive), n_words: maximal passages that other documents have too.

    ``docs`` (doc_id, text); words are runs of characters other than blanks, compared as they are, numbered from 0.
    A row is known by doc_id and text: rows equal in both are one document, rows that share an id but not the
    text are different ones (and equal passages of them are joined under the id they share only if the
    texts are equal). A null doc_id is returned as it is. Null, empty and short texts have no passages. Repeats inside one
    document only don't count. An empty table gives an empty result; other columns are not read. ``part_rows`` bounds the memory of a task;
    the result doesn't depend on it.
    """
    if min_words < run_words:
        raise ValueError("min_words must not be below run_words")
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("doc"), "text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, block in tokens.blocks(b.column("text")):
                text, first, last, run, hood, place = block_suffixes(block, min_words, run_words)
                rows = pa.array(text + lo)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(rows), b.column("doc").take(rows), *(pa.array(x.astype(np.int32)) for x in (first, last, place)),
                     pa.array(run.view(np.int64)), pa.array(hood.view(np.int64))],
                    names=["doc_id", "doc", "first", "last", "place", "run", "hood"])

    kept = "doc_id long, doc long, first int, last int, place int, run long, hood long"
    suffixes = staged(spark, base.mapInArrow(keep, kept), "suffixes")
    rows = suffixes.count()
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["run", "hood", "doc", "first"]
    ranged = suffixes.repartitionByRange(max(shuffle, rows // 500_000), *order).sortWithinPartitions(*order)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)                                  # one range partition: bounded by their number
        if held:
            t = pa.Table.from_batches(held).select(["doc_id", "doc", "first", "last", "place", "run"])
        if held and len(t):
            yield from _parts(t, part_rows).drop_columns(["run"]).combine_chunks().to_batches()

    asked = ranged.mapInArrow(assign, "doc_id long, doc long, first int, last int, place int, part long, cut boolean")
    asked = staged(spark, asked, "suffixes-asked", rows, 200_000)
    shared = asked.count()

    # the words around the suffixes of shared runs, sorted by the words to the right
    places = (asked.groupBy(F.col("doc_id").alias("d_id"), F.col("doc").alias("d"))
              .agg(F.collect_set(F.struct("first", "last", "place", "part", "cut")).alias("places")))
    texts = base.join(places, (base["doc"] == places["d"]) & base["doc_id"].eqNullSafe(places["d_id"])).select("doc_id", "doc", "places", "text")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, block in tokens.blocks(b.column("text")):
                data, offsets = tokens.text_bytes(block)
                w = tokens.find_words(data, offsets, tokens.NOT_BLANK)
                ahead, at = _lined(w)
                back, size = ahead[::-1], len(ahead)          # words to the left come nearest first, their bytes backwards
                lists = b.column("places").slice(lo, len(block))
                flat = lists.flatten()
                row = np.repeat(np.arange(len(block)), np.diff(lists.offsets.to_numpy()))
                first, last, place = (flat.field(c).to_numpy() + w.first[row] for c in ("first", "last", "place"))
                r0, r1 = at[place] + 1, at[last + min_words] + 1
                l0, l1 = size - at[place], size - at[first]
                piece = np.cumsum(r1 - r0 + l1 - l0) // PIECE_BYTES
                for k in np.unique(piece):
                    i = np.flatnonzero(piece == k)
                    own, docs_of = flat.take(pa.array(i)), pa.array(row[i] + lo)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id").take(docs_of), b.column("doc").take(docs_of), *(own.field(c) for c in ("place", "part", "cut")),
                         _slices(ahead, r0[i], r1[i]), _slices(back, l0[i], l1[i])],
                        names=["doc_id", "doc", "place", "part", "cut", "right", "left"])

    worded = texts.mapInArrow(words, "doc_id long, doc long, place int, part long, cut boolean, right binary, left binary")
    worded = worded.repartition(max(shuffle, shared // 50_000), "part").sortWithinPartitions("part", "right", "left", "doc", "place")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _by_part(batches):
            row, b, e, rest = compare_suffixes(t, min_words, run_words)
            yield from _found(t, row, b, e + min_words)
            rest = rest[t.column("cut").to_numpy()[rest]]
            yield from _open(t, rest, np.zeros(len(rest), np.int32))

    found = staged(spark, worded.mapInArrow(compare, FOUND), "suffix-matches")

    def ordered(df: DataFrame, *by: str) -> DataFrame:
        rest = df.where("right is not null")
        return rest.repartitionByRange(max(1, -(-rest.count() // part_rows)), *by).sortWithinPartitions(*by)

    def by_right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _table(batches)                                   # one range partition: bounded by their number
        if t is not None:
            right, r_n, left, l_n = _tables(t.column("right"), t.column("left"))
            repeated, open_, needed = _extend(right, r_n, left, l_n, t.column("doc").to_numpy(), min_words, run_words, False)
            row, b, e = _spans(repeated, t.column("place").to_numpy().astype(np.int64))
            yield from _found(t, row, b, e + min_words)
            rest = np.flatnonzero(needed.any(axis=1))
            yield from _open(t, rest, open_[rest].argmax(axis=1).astype(np.int32))

    again = staged(spark, ordered(found, "right", "left", "doc", "place").mapInArrow(by_right, FOUND), "suffix-matches-right")

    def by_left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _table(batches)
        if t is not None:
            right, r_n, left, l_n = _tables(t.column("right"), t.column("left"))
            repeated, _, needed = _extend(left, l_n, right, r_n, t.column("doc").to_numpy(), min_words, run_words, True)
            row, b, e = _spans(repeated, t.column("place").to_numpy().astype(np.int64))
            needed &= np.arange(needed.shape[1]) >= t.column("least").to_numpy()[:, None]    # others are settled in the order of the words to the right
            for r in _found(t, row, b, e + min_words):
                yield r.select(["doc_id", "doc", "b", "e"]).append_column("window", pa.nulls(len(r), pa.binary()))
            row, a = np.nonzero(needed)
            for lo in range(0, len(row), 10_000):
                yield _windows(t, row[lo:lo + 10_000], a[lo:lo + 10_000], min_words)

    last = ordered(again, "left", "right", "doc", "place").mapInArrow(by_left, "doc_id long, doc long, b int, e int, window binary")
    last = staged(spark, last, "suffix-matches-left")
    opened = last.where("window is not null")
    both = opened.groupBy("window").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count("*").alias("copies"))
    both = both.where("least <> most").select("window", "copies")
    extended = spread_join(opened, both, "window", "copies", ["doc", "b"])
    spans = [df.select("doc_id", "doc", "b", "e") for df in (found.where("right is null"), again.where("right is null"), last.where("window is null"), extended)]
    return _joined(reduce(DataFrame.union, spans))


def _joined(spans: DataFrame) -> DataFrame:
    """Overlapping and touching spans [b, e) of a document as one."""
    spans = spans.groupBy("doc_id", "doc", "b").agg(F.max("e").alias("e"))
    by = Window.partitionBy("doc_id", "doc").orderBy("b")
    reach = F.max("e").over(by.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("b") > reach), 1).otherwise(0)
    piece = F.sum("new").over(by)
    out = spans.withColumn("new", new).withColumn("piece", piece).groupBy("doc_id", "doc", "piece").agg(F.min("b").alias("b"), F.max("e").alias("e"))
    return out.select("doc_id", F.col("b").alias("start_word"), F.col("e").alias("end_word"), (F.col("e") - F.col("b")).alias("n_words")).distinct()


def mark_repeats(spark: SparkSession, docs: DataFrame, min_words: int = 50) -> DataFrame:
    """doc_id, repeated_words and passages (start, end) of the documents that have any; passages of rows that share an id come together."""
    return repeated_passages(docs, min_words).groupBy("doc_id").agg(
        F.sum("n_words").alias("repeated_words"), F.sort_array(F.collect_list(F.struct("start_word", "end_word"))).alias("passages"))
