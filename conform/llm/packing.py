"""Packing documents into token windows of a fixed length: online sum-of-squares bin packing.

A task reads its documents in one pass. Whole windows are cut off a long document; what is left of it (or a short
document) goes to the fill level that minimises the sum of the squared numbers of partially filled windows. Only the
level array (windows held at each fill level) decides, so a placement looks at one number a level, never at the windows
or the documents themselves. Keeping these numbers even is what keeps some window at hand that a document completes.

The windows that are still open at the end of a task (and whenever a task holds ``most_open`` of them) are cut anew: their
pieces are laid end to end and cut into whole windows. The last rest is split into lengths that are powers of two, which
need no padding. Nothing is shuffled, and a task holds ``most_open`` windows at the most.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conform.llm.tokens import blocks, text_bytes

WINDOW = 2048
MOST_OPEN = 4096           # open windows a task holds: at 4 bytes an id 32 MB
CACHED = 1 << 18           # chunks of text in a generation of those whose ids a worker keeps
ENCODED = 8 << 20          # bytes of text encoded at a time
SPAN = 1 << 33             # sequence ids of a task
OUT_BYTES = 4 << 20        # of ids in a batch that a task returns

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"

#: Kinds of bytes that the tokenizer tells apart: blanks, letters, digits, signs; 0: control characters and bytes beyond ASCII.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, *range(0x09, 0x0E)]] = 1
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 2
KIND[0x30:0x3A] = 3
KIND[[b for b in range(0x21, 0x7F) if not KIND[b]]] = 4
#: How a byte is written in the vocabulary of a byte-level tokenizer: printable ones as they are, the others in order from U+0100.
PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
SIGNS = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in PRINTABLE)}
#: White space beyond ASCII (fixed values): next to it, texts are cut at ASCII letters and signs only.
WIDE_BLANKS = r"[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


#: The same for all bytes: how they are written, as UTF-8 (one byte or two).
WRITTEN = [chr(SIGNS.get(i, i)).encode() for i in range(256)]
WRITTEN_SIZE = np.array([len(w) for w in WRITTEN], np.int64)
WRITTEN_FIRST, WRITTEN_LAST = (np.array([w[i] for w in WRITTEN], np.uint8) for i in (0, -1))


def _kinds(data: np.ndarray) -> np.ndarray:
    """Kinds of the bytes; Latin letters beyond ASCII (U+00C0 to U+017F but for the signs of times and division) are letters."""
    kind = KIND[data]
    at = np.flatnonzero((data >= 0xC3) & (data <= 0xC5))                # first of two bytes
    at = at[(data[at] != 0xC3) | ((data[at + 1] != 0x97) & (data[at + 1] != 0xB7))]
    kind[at] = kind[at + 1] = 2
    return kind


def _begins(data: np.ndarray, kind: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where inside texts (that begin at ``starts``) a word of the tokenizer surely begins: at a change of kind.

    Exceptions: a space belongs to the word behind it, an apostrophe perhaps to the letters behind it, and next to bytes of no kind
    nothing is sure. Of several blanks before something else the last one stands apart.
    """
    begins = np.zeros(len(data), bool)
    before, here = kind[:-1], kind[1:]
    begins[1:] = (before != here) & (before != 0) & (here != 0) & (data[:-1] != 0x20) & ~((data[:-1] == 0x27) & (here == 2))
    begins[1:] |= (before == 0) & (here == 1)
    last = (kind[:-2] == 1) & (kind[1:-1] == 1) & (kind[2:] > 1)
    last[starts[starts >= 2] - 2] = False                              # what stands behind them is another text
    begins[1:-1] |= last
    begins[starts] = False
    return begins


class Encoder:
    """Token ids of texts, from a byte-level file of the ``tokenizers`` library.

    Such a tokenizer cuts a text into words by the kinds of its characters, and its model takes each word by itself. Texts are cut
    where a word surely begins, and each distinct chunk is encoded once: by the model, if it is one word, else by
    the tokenizer. The ids are those of the whole text. Ids of chunks are kept in two generations of a bounded size, so
    frequent ones stay.
    """

    kept: dict[str, Encoder] = {}

    def __init__(self, content: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.model = self.tokenizer.model
        self.added = "|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str, content: str) -> Encoder:
        """The worker's encoder for a file: loading one takes longer than a small task."""
        if path not in cls.kept:
            cls.kept[path] = cls(content)
        return cls.kept[path]

    def _holds_added(self, texts: pa.Array) -> pa.Array:
        """Texts that hold an added token, which the tokenizer takes out before it cuts words."""
        return pc.match_substring_regex(texts, self.added) if self.added else pa.repeat(pa.scalar(False), len(texts))

    def _written(self, chunks: pa.Array) -> tuple[list[str], np.ndarray]:
        """(the chunks as the model's vocabulary writes them, whether each is one word)."""
        data, offsets = text_bytes(chunks)
        kind = _kinds(data)
        # an apostrophe may belong to the letters behind it
        more = np.append(0, np.cumsum(_begins(data, kind, offsets[:-1]) | (kind == 0) | (data == 0x27)))
        single = (more[offsets[1:]] == more[offsets[:-1]]) & ~self._holds_added(chunks).to_numpy(zero_copy_only=False)
        upto = np.append(0, np.cumsum(WRITTEN_SIZE[data]))
        out = np.empty(upto[-1], np.uint8)
        out[upto[:-1]] = WRITTEN_FIRST[data]
        out[upto[1:] - 1] = WRITTEN_LAST[data]
        return pa.LargeStringArray.from_buffers(len(chunks), pa.py_buffer(upto[offsets]), pa.py_buffer(out)).to_pylist(), single

    def _ids(self, chunks: pa.Array) -> list[bytes]:
        written, single = self._written(chunks)
        out = list(map(self.young.get, written))
        tokenize, encode, old, young = self.model.tokenize, self.tokenizer.encode, self.old, self.young
        for i in [i for i, ids in enumerate(out) if ids is None]:
            w = written[i]
            ids = old.get(w)
            if ids is None:
                found = [t.id for t in tokenize(w)] if single[i] else encode(chunks[i].as_py(), add_special_tokens=False).ids
                ids = array("I", found).tobytes()
            out[i] = young[w] = ids
        if len(young) > CACHED:
            self.old, self.young = young, {}
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of the texts in them); null is empty."""
        data, offsets = text_bytes(column)
        n = len(data)
        if n == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        texts = pc.fill_null(column, "")
        kind = _kinds(data)
        starts = offsets[:-1][offsets[:-1] < n]
        begins = _begins(data, kind, starts)
        if pc.any(pc.match_substring_regex(texts, WIDE_BLANKS)).as_py():
            begins[1:] &= (data[:-1] < 0x80) & (data[1:] < 0x80)
        added = self._holds_added(texts)
        if pc.any(added).as_py():                                        # before blanks only, there
            whole = np.repeat(added.to_numpy(zero_copy_only=False), np.diff(offsets))
            begins[1:] &= ~whole[1:] | ((kind[1:] == 1) & (kind[:-1] != 1))
        begins[starts] = True
        cut = np.flatnonzero(begins)
        chunks = pa.LargeStringArray.from_buffers(len(cut), pa.py_buffer(np.append(cut, n)), pa.py_buffer(np.ascontiguousarray(data)))
        coded = chunks.dictionary_encode()
        ids = self._ids(coded.dictionary)
        flat = np.frombuffer(b"".join(ids), np.uint32)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        first = np.cumsum(lengths) - lengths
        at = coded.indices.to_numpy(zero_copy_only=False)
        of_chunk = lengths[at]
        upto = np.concatenate([[0], np.cumsum(of_chunk)])
        out = flat[np.repeat(first[at] - upto[:-1], of_chunk) + np.arange(upto[-1])]
        return out, upto[np.searchsorted(cut, offsets)]


class Windows:
    """The open windows of a task by fill level, and the level array that places documents."""

    def __init__(self, size: int, most_open: int) -> None:
        self.size, self.most_open, self.held = size, most_open, 0
        self.level = np.zeros(size + 1, np.int64)
        self.open: dict[int, list[list]] = {}

    def best(self, n: int) -> int:
        """Fill level (0: a new window) to which a piece of ``n`` ids adds least to the sum of squares; ties: the fullest."""
        at = np.flatnonzero(self.level[:self.size - n + 1])
        if not len(at):
            return 0
        here, there = self.level[at], self.level[at + n]
        more = 2 * (there - here) + 2
        more[at + n == self.size] -= 1                             # a completed window leaves the sum
        k = len(at) - 1 - int(np.argmin(more[::-1]))
        return int(at[k]) if more[k] <= 2 * self.level[n] + 1 else 0

    def add(self, piece: tuple) -> list | None:
        """Place (document, start, ids); the window, if that completes it."""
        n = len(piece[2])
        h = self.best(n)
        window = []
        if h:
            window = self.open[h].pop()
            self.level[h] -= 1
            self.held -= 1
        window.append(piece)
        if h + n == self.size:
            return window
        self._keep(window, h + n)
        return None

    def _keep(self, window: list, fill: int) -> None:
        self.open.setdefault(fill, []).append(window)
        self.level[fill] += 1
        self.held += 1

    def recut(self, last: bool) -> Iterator[list]:
        """The open windows cut into full ones; the rest stays open or, at the ``last`` call, goes out in powers of two."""
        pieces = [p for fill in sorted(self.open, reverse=True) for w in self.open[fill] for p in w]
        self.open, self.held = {}, 0
        self.level[:] = 0
        left = sum(len(p[2]) for p in pieces)
        window, room = [], 0
        for doc, start, ids in pieces:
            while len(ids):
                if room == 0:
                    room = self.size if left >= self.size else 1 << (left.bit_length() - 1) if last else left
                    goal = room
                part, ids = ids[:room], ids[room:]
                window.append((doc, start, part))
                start, room, left = start + len(part), room - len(part), left - len(part)
                if room == 0:
                    if goal == self.size or last:
                        yield window
                    else:
                        self._keep(window, goal)
                    window = []


def _pieces(batches: Iterator[pa.RecordBatch], encoder: Encoder, size: int, end_id: int, most_open: int) -> Iterator[list]:
    """Full windows of ((doc_id, doc_tokens), start, ids), document by document."""
    windows = Windows(size, most_open)
    end = np.array([end_id], np.uint32)
    for b in batches:
        doc_ids, texts = b.column("doc_id"), b.column("text")
        for lo, part in blocks(texts, ENCODED):
            flat, offsets = encoder.encode(part)
            for i in range(len(part)):
                ids = np.concatenate([flat[offsets[i]:offsets[i + 1]], end])
                doc, whole = (doc_ids[lo + i].as_py(), len(ids)), len(ids) // size * size
                for start in range(0, whole, size):
                    yield [(doc, start, ids[start:start + size])]
                if whole < len(ids):
                    done = windows.add((doc, whole, ids[whole:].copy()))
                    if done:
                        yield done
                    if windows.held >= most_open:
                        yield from windows.recut(last=False)
    yield from windows.recut(last=True)


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = 1, most_open: int = MOST_OPEN) -> DataFrame:
    """Documents (doc_id, text) -> one row a piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    A document is its text's ids by the byte-level ``tokenizer`` (a file of the ``tokenizers`` library, read by the driver and sent to
    the tasks) and then ``end_id``; ``start`` counts its ids before the piece and ``offset`` those before it in its sequence. ``ids``
    holds the piece's ids as little-endian unsigned 32-bit numbers. Every sequence has ``window`` ids or a power of
    two below that, so none needs padding.

    A null text counts as an empty one, which is its ``end_id`` alone. Rows that share an id (or have none) are packed
    one by one, so repeated rows take room each; an empty table gives no rows. Columns other than doc_id and text are not read.
    """
    if window < 2:
        raise ValueError("a window holds two ids at least")
    with open(tokenizer, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file: a few MB

    def run(batches):
        encoder = Encoder.of(tokenizer, content.value)
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) * SPAN
        rows, held = [], 0

        def batch():
            columns = list(zip(*rows))
            kinds = [pa.int64()] * 6 + [pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in PIECES.split(", ")])

        for sequence in _pieces(batches, encoder, window, end_id, most_open):
            offset = 0
            for (doc_id, doc_tokens), start, ids in sequence:
                rows.append((doc_id, start, len(ids), doc_tokens, number, offset, ids.astype("<u4", copy=False).tobytes()))
                offset += len(ids)
            held += 4 * offset
            number += 1
            if held >= OUT_BYTES:
                yield batch()
                rows, held = [], 0
        if rows:
            yield batch()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, PIECES)


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """One row a sequence: sequence_id, n_tokens, ids (its pieces in order, padded to ``window`` unless n_tokens is a power of two).

    A sequence has at most ``window`` pieces, so no group is larger than that.
    """
    by = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"),
                                           F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("x")))).alias("parts"))
    whole = F.unhex(F.array_join(F.transform("parts", lambda p: p["x"]), ""))
    power = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    missing = F.when(power, 0).otherwise(F.lit(window) - F.col("n_tokens")).cast("int")
    pad = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), missing))
    return by.select("sequence_id", "n_tokens", F.concat(whole, pad).alias("ids"))
