import brute
import numpy as np
import pyarrow as pa
from samples import DOCS, make, odd_docs, prose  # noqa: F401 (fixtures)

from conform.llm import suffix_dedup
from conform.llm.suffix_dedup import mark_repeats, repeated_passages


def check(make, docs, **kw):
    rows = [(d, t, None, None, None) for d, t in docs]
    got = {(r.doc_id, r.start_word, r.end_word) for r in repeated_passages(make(rows, DOCS), **kw).collect()}
    assert got == brute.repeated_spans(docs, kw.get("min_words", 50))
    return got


def test_odd_rows(make, odd_docs):
    assert check(make, [(d, t) for d, t, *_ in odd_docs])


def test_edges_of_passages(make):
    """Passages of 49, 50, 51 and 70 words in different surroundings, with partners on different sides."""
    p = prose(60, 120).split()
    docs = [(i, f"{prose(200 + i, i % 7)} {' '.join(p[a:b])} {prose(300 + i, i % 5)}") for i, (a, b) in enumerate(
        [(0, 49), (0, 49), (10, 60), (10, 60), (5, 56), (30, 100), (0, 120), (60, 111), (61, 111), (69, 120), (70, 120), (0, 50), (49, 99)])]
    assert check(make, docs)


def test_common_line_in_many_surroundings(make):
    line, passage = prose(61, 20), prose(62, 55)
    docs = [(i, f"{prose(400 + i, 60)} {line} {prose(500 + i, 60)}") for i in range(40)]
    docs += [(100 + i, f"{prose(600 + i, 30)} {passage} {prose(700 + i, 30)}") for i in range(40)]
    assert {d for d, *_ in check(make, docs)} == {100 + i for i in range(40)}


def test_repeats_inside_one_document_do_not_count(make):
    assert check(make, [(1, " ".join([prose(63, 60)] * 3)), (2, "a " * 300), (1, " ".join([prose(63, 60)] * 3))]) == set()


def test_shorter_passages(make):
    p = prose(64, 30)
    assert check(make, [(1, f"x y {p}"), (2, f"{p} z"), (3, prose(65, 30))], min_words=12)


def test_runs_cut_over_parts(make):
    """Parts of a few suffixes: most runs are cut, and their windows compared by their texts."""
    line, passage, p = prose(61, 20), prose(62, 55), prose(60, 120).split()
    docs = [(i, f"{prose(400 + i, 60)} {line} {prose(500 + i, 60)}") for i in range(20)]
    docs += [(100 + i, f"{prose(600 + i, 30)} {passage} {prose(700 + i, 30)}") for i in range(20)]
    docs += [(200 + i, f"{prose(200 + i, i % 7)} {' '.join(p[a:b])} {prose(300 + i, i % 5)}") for i, (a, b) in enumerate(
        [(0, 49), (10, 60), (10, 60), (5, 56), (30, 100), (0, 120), (60, 111), (61, 111), (70, 120), (49, 99)])]
    whole = check(make, docs)
    assert whole and all(check(make, docs, part_rows=n) == whole for n in (1, 7))


def test_equal_hashes_of_different_words_give_no_passage(make, monkeypatch):
    """Run hashes of two values and one neighbourhood hash: all suffixes are compared, the words decide."""
    real = suffix_dedup.block_suffixes

    def colliding(column, min_words, run_words):
        text, first, last, run, hood, place = real(column, min_words, run_words)
        return text, first, last, run & np.uint64(1), hood & np.uint64(0), place

    monkeypatch.setattr(suffix_dedup, "block_suffixes", colliding)
    passage = prose(80, 53)
    assert check(make, [(i, prose(81 + i, 150)) for i in range(12)]) == set()
    docs = [(i, f"{prose(81 + i, 90)} {passage if i % 3 else ''} {prose(181 + i, 90)}") for i in range(12)]
    assert {d for d, *_ in check(make, docs)} == {d for d, _ in docs if d % 3}
    assert check(make, docs, part_rows=9)


def test_words_of_one_part_are_compared_to_both_sides():
    """The same short run between words that agree to the left, to the right, on both sides and on none."""
    def lined(words):
        return "".join(w + "\n" for w in words).encode()

    left, right = prose(90, 5).split(), prose(91, 12).split()
    other = prose(92, 5).split()
    rows = sorted((lined(r), lined(x[::-1]), d) for d, (x, r) in enumerate(
        [(left, right), (left, right[:9] + other[:3]), (other[:3] + left[3:], right), (other, other + right[:7])]))
    t = pa.table({"doc": pa.array([d for *_, d in rows]), "place": pa.array([5] * 4, pa.int32()),
                  "right": pa.array([r for r, *_ in rows], pa.binary()), "left": pa.array([x for _, x, _ in rows], pa.binary())})
    row, b, e, rest = suffix_dedup.compare_suffixes(t, 12, 7)
    got = {(rows[i][2], x, y) for i, x, y in zip(row.tolist(), b.tolist(), e.tolist(), strict=True)}
    # windows of 12 words from word 0 to 5; document 0 agrees with 1 up to word 13 and with 2 from word 3 on
    assert got == {(0, 0, 5), (1, 0, 2), (2, 3, 5)}
    assert len(rest) == 4


def test_words_that_are_no_text(make, spark):
    """Control characters inside words, and texts whose blanks differ: words are compared, not the blanks between them."""
    words = ["\x01a", "b\x02", "c", "\u00e9t\u00e9", "\x7f"] * 11
    a, b = " ".join(words), "\t\n".join(words)
    assert check(make, [(1, a), (2, "x " + b + " y"), (None, a + " z")])


def test_empty_table_and_summary(make, spark):
    assert check(make, []) == set()
    p = prose(66, 60)
    rows = mark_repeats(spark, make([(1, p, None, None, None), (2, p, None, None, None)], DOCS)).collect()
    assert sorted((r.doc_id, r.repeated_words) for r in rows) == [(1, 60), (2, 60)]


def test_texts_with_more_words_than_a_key_can_number(monkeypatch):
    words = prose(70, 3000)
    column = pa.array([prose(71, 700) + " " + words, words, "short", prose(72, 200)])
    whole = suffix_dedup.block_suffixes(column, 50, 8)
    for bits in (6, 8, 10):
        monkeypatch.setattr(suffix_dedup, "POSITION_BITS", np.uint64((1 << bits) - 1))
        got = suffix_dedup.block_suffixes(column, 50, 8)
        assert all((a == b).all() for a, b in zip(whole, got, strict=True))
    in_both = [set(whole[4][whole[0] == t].tolist()) for t in (0, 1)]
    assert len(in_both[0] & in_both[1]) >= len(in_both[1]) - 2
