import numpy as np
import pytest
import zlib
from pyspark.sql import functions as F
from samples import DOCS, make, prose  # noqa: F401 (fixtures)

from conform.llm.quality import FEATURES, LEXICAL, Sample, block_features, classify, estimate_prior, fit, minimise_risk, with_score

LABELS = "doc_id long, quality int, toxic int"


def junk(i):
    w = prose(i, 40)
    return [w.upper().replace(" ", "!! ") + "!!", " ".join(x + "$$$" for x in w.split()), " ".join(x for x in w.split() for _ in range(8)),
            " | ".join(w.split()[:20])][i % 4]


def corpus(n):
    """Every seventh document is junk; about half of all carry a label."""
    rows = [(i, junk(i) if i % 7 == 0 else prose(i, 30 + i % 200), None, None, None) for i in range(n)]
    return rows, [(i, int(i % 7 != 0), 0) for i in range(n) if (i * 2654435761) % 100 < 50]


@pytest.fixture(scope="module")
def scored(make):
    rows, labels = corpus(1500)
    odd = [(5001, None, None, None, None), (5002, "", None, None, None), (None, prose(1, 50), None, None, None), (1, rows[1][1], None, None, None),
           (5003, " ".join([prose(2, 100)] + [prose(i, 1000) for i in range(30)]), None, None, None), (5004, "\x00 \u2028 ß", None, None, None)]
    labels += [(None, 1, None), (3, None, None), (3, 1, 0), (9999, 1, 0)]
    return rows + odd, classify(make(rows + odd, DOCS), make(labels, LABELS)).collect()


def test_every_row_once_with_its_fold(scored):
    rows, got = scored
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_held_out_accuracy(scored):
    _, got = scored
    held = [(r.predicted, int(r.doc_id % 7 != 0)) for r in got if r.held_out and r.doc_id < 1500]
    assert len(held) > 200
    assert sum(a == b for a, b in held) / len(held) > 0.97


def test_equal_texts_have_equal_scores(scored):
    rows, got = scored
    assert len({r.score for r in got if r.doc_id == 1}) == 1
    assert len({r.score for r in got if r.doc_id in (5001, 5002)}) == 1


def test_negative_labels_and_held_out_labels_are_not_used(make):
    rows, labels = corpus(400)
    held = lambda d: zlib.crc32(str(d).encode()) % 5 == 0
    other = [(d, 1 - q if held(d) else q, 1) for d, q, _ in labels if q == 1 or held(d)]
    a, b = ({(r.doc_id, r.score) for r in classify(make(rows, DOCS), make(x, LABELS)).collect()} for x in (labels, other))
    assert a == b


def test_nothing_to_learn_from(make):
    rows, labels = corpus(20)
    assert classify(make([], DOCS), make(labels, LABELS)).collect() == []
    got = classify(make(rows, DOCS), make([], LABELS)).collect()
    assert len(got) == 20 and {r.score for r in got} == {0.5}


def test_prior_and_bounded_sample(make):
    g = np.random.default_rng(0)
    pos, neg = g.normal(1.5, 1, (4000, 3)), g.normal(-1.5, 1, (4000, 3))
    for share in (0.3, 0.6, 0.9):
        n = int(4000 * share)
        assert abs(estimate_prior(pos[:2000], np.vstack([g.normal(1.5, 1, (n, 3)), neg[:4000 - n]])) - share) < 0.06
    rows, labels = corpus(600)
    got = classify(make(rows, DOCS), make(labels, LABELS), Sample(positives=100, unlabelled=200)).collect()
    assert sum(r.predicted == int(r.doc_id % 7 != 0) for r in got) / 600 > 0.95
    assert fit(np.zeros((0, 3)), pos) is None


def test_features_do_not_depend_on_the_batch():
    import pyarrow as pa

    texts = [None, "", "a", "A b\nc", prose(1, 300), "x " * 500, "ÄÖ ü!"]
    together = block_features(pa.array(texts))
    alone = np.vstack([block_features(pa.array([t], pa.string())) for t in texts])
    assert together.shape == (len(texts), len(FEATURES) + LEXICAL) and np.allclose(together, alone) and np.isfinite(together).all()


def test_the_minimiser_against_newtons_method():
    """Where the negatives' risk stays positive the risk is convex: Newton's steps find its one minimum from second derivatives."""
    g = np.random.default_rng(7)
    prior, l2 = 0.4, 1e-2
    pos = g.normal(0.5, 1, (800, 5))
    unl = np.vstack([g.normal(0.5, 1, (400, 5)), g.normal(-0.5, 1, (600, 5))])
    p, u = np.hstack([pos, np.ones((800, 1))]), np.hstack([unl, np.ones((1000, 1))])
    ridge = l2 * np.diag([1.0] * 5 + [0.0])
    t = np.zeros(6)
    for _ in range(50):
        s = 1 / (1 + np.exp(-u @ t))
        slope = -prior * p.mean(axis=0) + u.T @ s / len(u) + ridge @ t
        t = t - np.linalg.solve((u * (s * (1 - s))[:, None]).T @ u / len(u) + ridge, slope)
    assert np.abs(slope).max() < 1e-10
    assert np.logaddexp(0, u @ t).mean() - prior * np.logaddexp(0, p @ t).mean() > 0
    assert np.allclose(minimise_risk(pos, unl, prior, 2000, l2), t, atol=2e-3)


def test_the_negatives_risk_is_kept_from_going_below_zero():
    """With a prior far too high and room to overfit, the plain estimate falls below zero; the minimiser steps back from it."""
    g = np.random.default_rng(8)
    pos, unl = g.normal(0, 1, (30, 60)), g.normal(0, 1, (30, 60))
    t = minimise_risk(pos, unl, 0.9, 2000, 0.0)
    z = lambda x: x @ t[:-1] + t[-1]
    assert np.logaddexp(0, z(unl)).mean() - 0.9 * np.logaddexp(0, z(pos)).mean() > -0.1


def test_fluent_texts_are_told_apart_by_their_words(make):
    """Good and bad texts of one build, characters and lengths alike: only their words differ."""
    g = np.random.default_rng(9)
    spell = lambda i: "".join(chr(97 + (i * 7 + j * (i % 5 + 3)) % 26) for j in range(6))
    good, bad, both = ([spell(k * 1000 + i) for i in range(60)] for k in (1, 2, 3))
    text = lambda i: " ".join(g.choice(bad + both if i % 3 == 0 else good + both, 80))
    rows = [(i, text(i), None, None, None) for i in range(1500)]
    got = classify(make(rows, DOCS), make([(i, int(i % 3 != 0), 0) for i in range(1500) if i % 2], LABELS)).collect()
    held = [r for r in got if r.held_out]
    up, down = ([r.score for r in held if (r.doc_id % 3 != 0) == k] for k in (True, False))
    assert np.mean([a > b for a in up for b in down]) > 0.95


def test_long_texts_come_in_small_batches(spark):
    class Rows:
        def score(self, x):
            return np.full(len(x), float(len(x)))

    docs = spark.range(0, 600, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 2000).alias("text"))
    for scored in (with_score(docs, Rows()), with_score(docs, Rows(), drop_text=False, least=0.0)):
        rows = scored.select("score").collect()
        assert len(rows) == 600 and max(r.score for r in rows) * 22_000 <= 5 << 20
