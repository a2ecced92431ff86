from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from samples import DOCS, make, odd_docs, prose  # noqa: F401 (fixtures)
from tokenizers import Tokenizer

from conform.llm import packing
from conform.llm.packing import Encoder, Windows, pack, sequences

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def checked(pieces, docs, window):
    """Every id in exactly one piece, sequences without a gap, of the window's length or a power of two; the rows."""
    rows = pieces.collect()
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        assert r.length > 0 and len(r.ids) == 4 * r.length and r.start + r.length <= r.doc_tokens
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == [sum(x.length for x in parts[:i]) for i in range(len(parts))]
        total = sum(r.length for r in parts)
        assert total == window or (total < window and total & (total - 1) == 0)
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    want = defaultdict(list)
    for d in docs:
        want[d[0]].append(ids_of(d[1]))
    assert set(by_doc) == set(want)
    for d, texts in want.items():
        if len(texts) == 1:
            parts = sorted(by_doc[d], key=lambda r: r.start)
            assert np.frombuffer(b"".join(r.ids for r in parts), "<u4").tolist() == texts[0]
            assert {r.doc_tokens for r in parts} == {len(texts[0])}
        else:
            assert sum(r.length for r in by_doc[d]) == sum(map(len, texts))
    return rows


@pytest.mark.parametrize("window", [2048, 100, 2])
def test_round_trip(make, odd_docs, window):
    checked(pack(make(odd_docs, DOCS).repartition(3), PATH, window=window), odd_docs, window)


def test_many_documents(spark):
    docs = [(i, prose(i, (i * 37) % 400)) for i in range(800)]
    rows = checked(pack(spark.createDataFrame(docs, "doc_id long, text string").coalesce(2), PATH, window=512), docs, 512)
    assert sum(r.length for r in rows) == sum(len(ids_of(t)) for _, t in docs)
    cut = len(rows) - sum(-(-len(ids_of(t)) // 512) for _, t in docs)
    assert cut < 0.4 * len(docs)                               # only what is open at the end is cut more often than its length asks for


def test_few_open_windows_at_any_time(spark, monkeypatch):
    docs = [(i, "x " * 150) for i in range(300)]               # no two fit into a window of 256
    held = []
    add = Windows.add
    monkeypatch.setattr(Windows, "add", lambda self, piece: (held.append(self.held), add(self, piece))[1])
    encoder = Encoder.of(PATH, open(PATH, encoding="utf-8").read())
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs]), pa.array([t for _, t in docs])], names=["doc_id", "text"])
    out = list(packing._pieces(iter([batch]), encoder, 256, 1, 20))
    assert max(held) < 20 and sum(len(p[2]) for w in out for p in w) == sum(len(ids_of(t)) for _, t in docs)
    checked(pack(spark.createDataFrame(docs, "doc_id long, text string"), PATH, window=256, most_open=20), docs, 256)


def test_empty_table_and_texts(spark, make):
    assert pack(make([], DOCS), PATH).collect() == []
    docs = [(1, None), (2, ""), (3, " "), (None, "a"), (None, "b")]
    rows = checked(pack(make([(d, t, "en", "s", 0) for d, t in docs], DOCS), PATH), docs, 2048)
    assert {r.doc_id: r.doc_tokens for r in rows if r.doc_id and r.doc_id < 3} == {1: 1, 2: 1}
    with pytest.raises(ValueError, match="two ids"):
        pack(make([], DOCS), PATH, window=1)


def test_a_placement_adds_least_to_the_sum_of_squares():
    r = np.random.default_rng(5)
    w = Windows(64, 10_000)
    for n in r.integers(1, 64, 3000).tolist():
        level = w.level.copy()

        def after(h, level=level, n=n):
            new = level.copy()
            new[h] -= h > 0
            if h + n < 64:
                new[h + n] += 1
            return int((new[1:64] ** 2).sum())

        options = {h: after(h) for h in range(0, 64 - n + 1) if h == 0 or level[h]}
        assert options[w.best(n)] == min(options.values())
        w.add((0, 0, np.zeros(n, np.uint32)))
        assert w.held == w.level.sum() == sum(map(len, w.open.values()))
    assert w.held < 400                                        # first fit leaves about as many; one window a piece would be 2,000


def test_ids_of_chunks_are_those_of_the_text():
    e = Encoder.of(PATH, open(PATH, encoding="utf-8").read())
    alphabet = ["a", "b", " ", "\n", "\t", "é", " ", "　", "1", "'s", "<|endoftext|>", "!", "\x0b", "\x1c", "日", "  ", "\x85", "\r\n", "Ab", "...", "don't", "-x"]
    r = np.random.default_rng(3)
    texts = ["".join(r.choice(alphabet, r.integers(0, 25))) for _ in range(4000)] + [None, ""]
    for size in (1, 50):
        for lo in range(0, 1000 if size == 1 else len(texts), size):
            ids, at = e.encode(pa.array(texts[lo:lo + size], pa.string()))
            assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [ids_of(t)[:-1] for t in texts[lo:lo + size]]


def test_ids_of_odd_neighbours():
    e = Encoder.of(PATH, open(PATH, encoding="utf-8").read())
    alphabet = [*"aZé×÷ÀſǄßñ09٣²½!'’_-.,$ \n\t\r\x00\x1f\x7f", "\u0301", "\u00a0", "日", "𝒜", "😀", "'s", "'ll", " '", "  ", "\n\n", "<|endoftext|>"]
    plain = alphabet[:-1]
    plain.remove("\u00a0")
    r = np.random.default_rng(4)
    for signs in (alphabet, plain):
        texts = ["".join(r.choice(signs, r.integers(0, 12))) for _ in range(6000)]
        for lo in range(0, len(texts), 30):
            ids, at = e.encode(pa.array(texts[lo:lo + 30], pa.string()))
            assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [ids_of(t)[:-1] for t in texts[lo:lo + 30]]


def test_a_word_is_encoded_once_whatever_signs_follow():
    e = Encoder(open(PATH, encoding="utf-8").read())
    e.encode(pa.array(["so señor, señor. señor!\nseñor; señor 12 señor"]))
    assert len(e.young) == 9                                   # so, 12, the other word with and without its space, four signs, a line end


def test_kept_chunks_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "CACHED", 100)
    e = Encoder(open(PATH, encoding="utf-8").read())
    for i in range(20):
        text = prose(i, 80)
        ids, _ = e.encode(pa.array([text]))
        assert ids.tolist() == ids_of(text)[:-1]
        assert len(e.young) <= 200 and len(e.old) <= 200


def test_sequences_are_padded_to_the_window(make, odd_docs):
    pieces = pack(make(odd_docs, DOCS).coalesce(1), PATH, window=256)
    got = sequences(pieces, 256).collect()
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in got) and sum(r["n_tokens"] == 256 for r in got) > 10
    short = pieces.where(F.col("length") == F.col("doc_tokens")).withColumn("sequence_id", F.lit(7)).where("doc_tokens < 20")
    (one,) = sequences(short.withColumn("offset", F.row_number().over(__import__("pyspark").sql.Window.orderBy("ids"))), 256).collect()
    padded = one["n_tokens"] & (one["n_tokens"] - 1) != 0
    assert len(one["ids"]) == 4 * (256 if padded else one["n_tokens"])
