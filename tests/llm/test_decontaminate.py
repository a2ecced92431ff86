
import math
from itertools import combinations

import brute
import pytest
from samples import DOCS, make, prose  # noqa: F401 (fixtures)

from conform.llm.decontaminate import _item_masks, contaminated, removed_by_short_items
from conform.llm.queries import QUERIES
from conform.llm.stages import decontaminate_stage
from conform.session import scratch_path

ITEM, SHORT, LONG = prose(50, 30), prose(51, 6), prose(52, 400)
BENCH = [(1, ITEM), (2, SHORT), (3, LONG), (4, None), (5, ""), (6, "of the"), (None, prose(53, 20)), (8, ITEM.upper() + "!")]
SCHEMA = "item_id long, text string"


def substituted(text, every):
    return " ".join("other" if i % every == every - 1 else w for i, w in enumerate(text.split()))


def around(text, seed):
    return prose(seed, 40) + " " + text + " " + prose(seed + 1, 40)


def found(make, docs, bench=BENCH, **kw):
    rows = [(d, t, None, None, None) for d, t in docs]
    return sorted({(r.doc_id, r.item_id) for r in contaminated(make(rows, DOCS), make(bench, SCHEMA), **kw).collect()}, key=str)


def test_copies_substitutions_case_and_punctuation(make):
    docs = [(1, around(ITEM, 100)), (2, around(ITEM.upper().replace(" ", " , "), 102)), (3, around(substituted(ITEM, 6), 104)),
            (4, around(SHORT, 106)), (5, around(" ".join(LONG.split()[100:140]), 108)), (6, around(" ".join(LONG.split()[10:20]), 110)),
            (7, prose(112, 500)), (8, None), (9, ""), (10, around("of the", 114)), (None, around(ITEM, 116)), (1, around(ITEM, 100)),
            (11, around(substituted(ITEM, 2), 118)), (12, ITEM), (13, around(prose(53, 20), 120)), (14, prose(122, 20_000) + " " + ITEM)]
    assert found(make, docs) == sorted([(1, 1), (2, 1), (3, 1), (4, 2), (5, 3), (None, 1), (12, 1), (13, None), (14, 1)], key=str)


def test_place_and_counts(make):
    r = contaminated(make([(1, around(ITEM, 100), None, None, None)], DOCS), make(BENCH, SCHEMA)).collect()[0]
    assert (r.start_word, r.n_words, r.n_same, r.item_words) == (40, 30, 30, 30)


def test_empty_tables(make):
    assert found(make, []) == []
    assert found(make, [(1, ITEM)], bench=[]) == []


def test_every_random_substitution_up_to_a_fifth_is_found(make):
    import random

    r = random.Random(9)
    docs, items = [], []
    for i in range(60):
        words = prose(1000 + i, r.randint(15, 60)).split()
        items.append((i, " ".join(words)))
        for j in r.sample(range(len(words)), len(words) // 6):
            words[j] = "changed"
        docs.append((i, around(" ".join(words), 2000 + 2 * i)))
    assert found(make, docs, items) == sorted([(i, i) for i in range(60)], key=str)


def changed_at(text, places):
    return " ".join(f"changed{i}" if i in places else w for i, w in enumerate(text.split()))


def kept(n, changed, masks):
    """Whether a mask meets no changed place of n words somewhere."""
    return any(not any(m[c - at] == "1" for c in changed if 0 <= c - at < len(m)) for m in masks for at in range(n - len(m) + 1))


@pytest.mark.parametrize("n", range(1, 26))
def test_every_pattern_of_a_fifth_keeps_a_seed(n):
    masks = _item_masks(n, 0.8, 13)
    assert all(kept(n, c, masks) for c in combinations(range(n), n // 5))
    assert all(m[0] == m[-1] == "1" for m in masks)
    if n >= 13:
        assert _item_masks(500, 0.8, 13) == masks


@pytest.mark.parametrize("similarity, min_words", [(0.7, 13), (0.8, 10), (0.9, 13), (0.5, 6)])
def test_other_criteria_keep_a_seed_too(similarity, min_words):
    for n in range(1, 15):
        masks = _item_masks(n, similarity, min_words)
        assert all(kept(n, c, masks) for c in combinations(range(n), n - math.ceil(similarity * n)))


def test_every_substitution_of_exactly_a_fifth_is_found(make):
    docs, items, want = [], [], []
    for n in (9, 10, 11, 12, 15):
        text = prose(300 + n, n)
        items.append((n, text))
        for places in combinations(range(n), n // 5):
            docs.append((len(docs), around(changed_at(text, places), 4000 + 2 * len(docs))))
            want.append((len(docs) - 1, n))
    assert all(brute.contaminated(t, dict(items)[n]) for (_, t), (_, n) in zip(docs, want))
    assert found(make, docs, items) == sorted(want, key=str)


def test_stretch_of_a_long_item_and_items_cut_off(make):
    words = LONG.split()
    docs = [(1, around(changed_at(" ".join(words[200:215]), (5, 7, 8)), 130)),          # 12 of 15 words inside 400
            (2, " ".join(ITEM.split()[6:])), (3, " ".join(ITEM.split()[:24])), (4, " ".join(ITEM.split()[:10]))]
    assert found(make, docs, [(1, ITEM), (3, LONG)]) == [(1, 3), (2, 1), (3, 1)]


def test_short_items_with_one_changed_word(make):
    docs, items, want = [], [], []
    for n in (5, 6, 7, 8):
        text = prose(320 + n, n)
        items.append((n, text))
        for i in range(n):
            docs += [(len(docs), around(changed_at(text, (i,)), 6000 + 2 * len(docs))), (len(docs) + 1, around(changed_at(text, (i, (i + 2) % n)), 8000 + 2 * len(docs)))]
            want.append((len(docs) - 2, n))
    assert found(make, docs, items) == sorted(want, key=str)


def test_items_below_five_words_if_asked_for(make):
    bench = [(1, "yes"), (2, "of the"), (3, "Of the four"), (4, "one two three four"), (5, "one two three four five"), (6, ""), (7, None), (8, "...")]
    docs = [(1, "so yes, of the one two three four and yes of the"), (2, "of four"), (3, "one two three six five yesterday"), (4, None), (5, "OF THE FOUR"),
            (6, "the of " * 40 + "of the " * 40), (None, "yes")]
    want = {(1, 1): 1, (1, 2): 2, (1, 4): 4, (1, 5): 4, (3, 5): 0, (5, 2): 0, (5, 3): 0, (6, 2): 1, (None, 1): 0}
    rows = [(d, t, None, None, None) for d, t in docs]
    got = contaminated(make(rows, DOCS), make(bench, SCHEMA), shortest=1).collect()
    assert {(r.doc_id, r.item_id): r.start_word for r in got} == want and len(got) == len(want)
    assert found(make, docs, bench) == [(1, 5), (3, 5)]


def test_query_and_stage_search_items_below_five_words(spark):
    path = scratch_path(spark, "short-items-sf")
    spark.createDataFrame([(1, "blue whale"), (2, ITEM)], SCHEMA).write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(1, "a Blue-Whale", "en", "s", 12), (2, "a blue or whale", "en", "s", 15)], DOCS).write.parquet(f"{path}/documents.parquet")
    assert [(r.doc_id, r.item_id) for r in QUERIES["op2_spaced_seeds"](spark, path).collect()] == [(1, 1)]
    assert [r.doc_id for r in decontaminate_stage(spark, spark.read.parquet(f"{path}/documents.parquet"), path).collect()] == [2]


def test_every_id_of_items_with_equal_words(make, spark):
    bench = [(1, ITEM), (8, ITEM.upper() + "!"), (8, ITEM), (None, ITEM), (3, LONG), (4, prose(53, 20))]
    docs = [(1, around(ITEM, 100)), (2, around(substituted(ITEM, 6), 104)), (3, around(" ".join(LONG.split()[100:140]), 108))]
    want = [(1, 1), (1, 8), (1, None), (2, 1), (2, 8), (2, None), (3, 3)]
    got = contaminated(make([(d, t, None, None, None) for d, t in docs], DOCS), make(bench, SCHEMA), every_id=True).collect()
    assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == sorted(want, key=str)
    assert {(r.start_word, r.n_words, r.n_same) for r in got if r.doc_id == 1} == {(40, 30, 30)}
    path = scratch_path(spark, "equal-items-sf")
    make(bench, SCHEMA).write.parquet(f"{path}/benchmark.parquet")
    make([(d, t, None, None, None) for d, t in docs], DOCS).write.parquet(f"{path}/documents.parquet")
    assert sorted(((r.doc_id, r.item_id) for r in QUERIES["op2_spaced_seeds"](spark, path).collect()), key=str) == sorted(want, key=str)


OPENER = prose(70, 17)


def opened(n, seed):
    """n texts that begin alike and go on in their own words."""
    return [OPENER + " " + prose(seed + i, 30) for i in range(n)]


def test_an_opener_of_many_items_in_many_documents(make):
    items = list(enumerate(opened(25, 30_000)))
    docs = [(i, around(t, 40_000 + 2 * i)) for i, t in enumerate(opened(25, 50_000))] + [(100, prose(1, 200)), (101, items[7][1])]
    pairs = found(make, docs, items)
    assert {p for p in pairs if p[0] != 101} == {(d, i) for d in range(25) for i in range(25)} and (101, 7) in pairs
    rows = make([(d, t, None, None, None) for d, t in docs], DOCS)
    got = contaminated(rows, make(items, SCHEMA), any_item=True)
    assert got.columns == ["doc_id"] and sorted(r[0] for r in got.collect()) == [*range(25), 101]


def test_any_item_looks_beyond_the_first_item_of_a_seed(make):
    """Seeds of two items agree; the first fails where the second is found."""
    a, b = prose(80, 9), prose(81, 40)
    items = [(1, a + " " + prose(82, 20)), (2, a + " " + b)]
    docs = [(5, around(a + " " + " ".join(b.split()[:12]), 90)), (6, around(a, 92)), (None, around(items[0][1], 94))]
    rows = make([(d, t, None, None, None) for d, t in docs], DOCS)
    got = contaminated(rows, make(items, SCHEMA), any_item=True).collect()
    assert sorted([r[0] for r in got], key=str) == sorted({d for d, _ in found(make, docs, items)}, key=str) == [5, None]


def test_copies_are_compared_once_and_all_come_out(make):
    docs = [(i, around(ITEM, 100)) for i in range(40)] + [(50, prose(99, 7) + " " + around(ITEM, 100))]
    rows = contaminated(make([(d, t, None, None, None) for d, t in docs], DOCS), make(BENCH, SCHEMA)).collect()
    assert sorted((r.doc_id, r.item_id, r.start_word, r.n_same) for r in rows) == [(i, 1, 40, 30) for i in range(40)] + [(50, 1, 47, 30)]


def test_what_short_items_remove_is_counted(make):
    """Three documents hold the one-word item, one of them a long item too; repeated rows are one document."""
    bench = [(1, "yes"), (2, ITEM), (3, ITEM)]
    docs = [(1, f"yes {ITEM}"), (2, "no and yes"), (2, "no and yes"), (3, "yes"), (4, ITEM), (5, "no"), (6, None), (None, "")]
    rows = [(d, t, None, None, None) for d, t in docs]
    got = removed_by_short_items(make(rows, DOCS), make(bench, SCHEMA)).first()
    assert (got.documents, got.removed, got.removed_by_short) == (7, 4, 2)
    empty = removed_by_short_items(make([], DOCS), make([], SCHEMA)).first()
    assert (empty.documents, empty.removed, empty.removed_by_short) == (0, 0, 0)
