import brute
import numpy as np
import pytest
from samples import DOCS, make, odd_docs  # noqa: F401 (fixtures)

from conform.llm import simhash
from conform.llm.simhash import as_hex, fingerprints, near_duplicates, near_links


def want(docs, bits=2):
    fp = [brute.simhash(t) for _, t, *_ in docs]
    root = brute.components(len(docs), lambda i, j: (fp[i] ^ fp[j]).bit_count() <= bits)
    least = {}
    for (d, *_), r in zip(docs, root):
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return sorted(((d, "%016x" % f, least[r]) for (d, *_), f, r in zip(docs, fp, root)), key=str)


def test_rows_as_brute_force(make, odd_docs):
    found = near_duplicates(make(odd_docs, DOCS))
    got = found.select("doc_id", as_hex(found["fp"]).alias("f"), "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == want(odd_docs)


def test_empty_table(make):
    assert near_duplicates(make([], DOCS)).collect() == []
    assert fingerprints(make([], DOCS)).collect() == []


@pytest.mark.parametrize("bits,leaf_rows", [(1, 64), (2, 64), (3, 100_000)])
def test_links_of_close_fingerprints(spark, bits, leaf_rows):
    """Random fingerprints, pairs at a few bits, and a dense ball, in small leaves and in one that is cut into blocks."""
    rng = np.random.default_rng(5)
    one = lambda n: np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    base = rng.integers(0, 2 ** 63, 400, dtype=np.uint64)
    x = np.unique(np.concatenate([base, base[:200] ^ one(200) ^ one(200), base[0] ^ one(300) ^ one(300) ^ one(300)]))
    edges = near_links(spark, spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long"), bits, leaf_rows=leaf_rows).collect()
    place = {int(v): i for i, v in enumerate(x.view(np.int64))}
    label = brute.components(len(x), lambda i, j: int(x[i] ^ x[j]).bit_count() <= bits)
    linked = {(place[a], place[b]) for a, b in edges}
    assert all((int(x[i]) ^ int(x[j])).bit_count() >= 1 for i, j in linked)
    assert all(label[i] == label[j] for i, j in linked)
    merged = brute.components(len(x), lambda i, j: (i, j) in linked or (j, i) in linked)
    assert merged == label


def test_a_leaf_that_cannot_be_divided_is_cut_into_blocks(spark):
    """All rows in one leaf (no sample to fit a tree to) and blocks of four rows: no link is lost."""
    x = np.array([0, 1, 3, 7, 15, 31, 63, 127, 255, 1 << 40, 3 << 40, 7 << 40, (1 << 63) - 1], dtype=np.int64)
    edges = near_links(spark, spark.createDataFrame([(int(v),) for v in x], "fp long"), 1, leaf_rows=2, sample_rows=1).collect()
    place = {int(v): i for i, v in enumerate(x)}
    linked = {(place[a], place[b]) for a, b in edges}
    assert brute.components(len(x), lambda i, j: (i, j) in linked or (j, i) in linked) == \
        brute.components(len(x), lambda i, j: (int(x[i]) ^ int(x[j])).bit_count() <= 1)


def test_tree_never_parts_close_rows():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2 ** 63, 3000, dtype=np.uint64)
    y = x ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64))
    tree = simhash.fit_tree(x, 100_000, simhash.pivots(32), 2, 500)
    assert tree.leaves > 50
    of = [set() for _ in range(6000)]
    for leaf, rows in tree.leaves_of(np.concatenate([x, y])):
        for r in rows:
            of[r].add(leaf)
    assert all(of[i] & of[i + 3000] for i in range(3000))


def test_the_table_discards_by_the_largest_difference():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2 ** 63, 500, dtype=np.uint64)
    table = np.bitwise_count(x[None, :] ^ simhash.pivots(24)[:, None]).astype(np.int8)
    i, j = (a.ravel() for a in np.meshgrid(np.arange(500), np.arange(500)))
    got = simhash._within(table, i, j, 5)
    want = np.abs(table[:, i].astype(int) - table[:, j]).max(axis=0) <= 5
    assert 500 <= want.sum() < len(i) / 100
    assert set(zip(*got)) == set(zip(i[want], j[want]))


@pytest.mark.parametrize("chunk", [1, 50, 1 << 20])
def test_a_leaf_in_chunks_of_pairs(chunk):
    rng = np.random.default_rng(4)
    x = np.unique(rng.integers(0, 2 ** 10, 200, dtype=np.uint64) << np.uint64(20))
    a, b = simhash.link_leaf(x, simhash.pivots(64), 2, chunk)
    merged = brute.components(len(x), lambda i, j: (i, j) in linked or (j, i) in linked) if (linked := set(zip(a.tolist(), b.tolist()))) else []
    assert merged == brute.components(len(x), lambda i, j: int(x[i] ^ x[j]).bit_count() <= 2)
