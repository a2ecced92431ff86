"""Quality classifier by positive-unlabelled learning.

Only positives are trusted: documents labelled good, from the training folds. Unlabelled are documents of the
same folds taken as they come, good ones among them. With the class prior p (the share of good documents among the
unlabelled), the risk of a score f is

    p * E_pos[loss(f, +)] + max(0, E_unl[loss(f, -)] - p * E_pos[loss(f, -)])

whose second part is an unbiased estimate of the negatives' risk, kept from going below zero. It is minimised over a
logistic model of two kinds of inputs: statistics of the text (its make-up of characters, lines and repeats), and the rates of
its words and word pairs, hashed into ``LEXICAL`` buckets (what it is about). The prior is estimated first, from the
statistics: a plain positive-against-unlabelled model is fitted on one half of the sample, and on the other half the smallest
ratio of the unlabelled to the positives above any of its thresholds is taken, with an allowance for small counts.

The model is fitted on a bounded sample (``Sample``); all documents are scored, over their whole text. Statistics are
computed in Arrow batches with numpy; the texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conform.llm import tokens
from conform.llm.common import text_batches

THRESHOLD = 0.3
FOLDS = 5


@dataclass(frozen=True)
class Sample:
    """Bounds of what the model is fitted on; rows are chosen by a hash of their id."""

    positives: int = 16_000
    unlabelled: int = 32_000


# Byte kinds counted in a text; fixed.
_KINDS = np.zeros(256, np.int64)
for _i, _chars in enumerate((range(0x61, 0x7B), range(0x41, 0x5B), range(0x30, 0x3A), range(0x80, 0x100), b" \t\r\v\f", b"\n", b".,;:'\"()-", b"!?"), 1):
    _KINDS[list(_chars)] = _i
_N_KINDS = 9  # 0: all other characters

FEATURES = ("words", "chars_per_word", "lower", "upper", "digits", "beyond_ascii", "blanks", "lines", "stops", "shouts", "symbols",
            "word_repeats", "word_variety", "pair_variety", "upper_words", "marked_words", "long_words", "short_words", "line_words")

LEXICAL = 256         # buckets of words and pairs of neighbouring words, lower-cased
LEXICAL_SCALE = 0.1   # a bucket's standardised rate counts that much of a statistic, so its weight costs more


def _per_text(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(text, values, n)


def block_features(column: pa.Array) -> np.ndarray:
    """One row of statistics for each text; an empty text has zeros throughout."""
    data, offsets = tokens.text_bytes(column)
    n = len(offsets) - 1
    size = np.diff(offsets)
    kinds = np.bincount(_KINDS[data] + _N_KINDS * np.repeat(np.arange(n), size), minlength=_N_KINDS * n).reshape(n, _N_KINDS)
    w = tokens.find_words(data, offsets, tokens.NOT_BLANK)
    h, text, count = w.hashes(), w.text_of_word(), w.counts()
    length = w.end - w.start
    some, words = np.maximum(size, 1), np.maximum(count, 1)
    repeats = np.zeros(n)
    pairs = np.zeros(n)
    if len(h) > 1:
        beside = text[1:] == text[:-1]
        repeats = _per_text((h[1:] == h[:-1]) & beside, text[1:], n)
        two = tokens.mix64(h[:-1] + h[1:] * np.uint64(3))[beside]
        pairs = _distinct(two, text[1:][beside], n)
    upper = (data[w.start] >= 0x41) & (data[w.start] <= 0x5A) & (data[(w.start + np.minimum(1, length - 1))] <= 0x5A) & (length > 1)
    last = _KINDS[data[w.end - 1]] if len(h) else np.zeros(0, np.int64)
    marked = (last == 0) | (last == 8)
    out = np.empty((n, len(FEATURES)))
    out[:, 0] = np.log1p(count)
    out[:, 1] = size / words
    for j, k in enumerate((1, 2, 3, 4, 5, 6, 7, 8, 0)):
        out[:, 2 + j] = kinds[:, k] / some
    out[:, 7] = kinds[:, 6] / words
    out[:, 11] = repeats / words
    # variety falls with length in any text; against the square root it doesn't
    out[:, 12] = _distinct(h, text, n) / words ** 0.8
    out[:, 13] = pairs / words
    out[:, 14] = _per_text(upper, text, n) / words
    out[:, 15] = _per_text(marked, text, n) / words
    out[:, 16] = _per_text(length > 20, text, n) / words
    out[:, 17] = _per_text(length <= 2, text, n) / words
    out[:, 18] = np.log1p(count / (kinds[:, 6] + 1))
    out[count == 0] = 0
    return np.hstack([out, _lexical(data, w, n)])


def _lexical(data: np.ndarray, w: tokens.Words, n: int) -> np.ndarray:
    """Square roots of the buckets' shares in a text's words and pairs; the root evens out rare and frequent ones."""
    text = w.text_of_word()
    h = tokens.Words(tokens.LOWER[data], w.start, w.end, w.first).hashes()
    beside = text[1:] == text[:-1]
    grams = np.concatenate([h, tokens.mix64(h[:-1] + h[1:] * np.uint64(3))[beside]]) if len(h) else h
    of = np.concatenate([text, text[1:][beside]])
    counts = np.bincount(of * LEXICAL + (grams % np.uint64(LEXICAL)).astype(np.int64), minlength=n * LEXICAL).reshape(n, LEXICAL)
    # half precision, as the sample is sent: a score is the same wherever it is computed
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).astype(np.float16).astype(float)


def _distinct(h: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct hashes of each text; ``text`` is sorted."""
    if not len(h):
        return np.zeros(n)
    order = np.lexsort((h, text))
    h = h[order]
    new = np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1]))
    return np.bincount(text[new], minlength=n).astype(float)


def features(column: pa.Array) -> np.ndarray:
    parts = [block_features(c) for _, c in tokens.blocks(column)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES) + LEXICAL))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = _standard(x, self.mean, self.scale) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    x = x - mean
    x /= scale
    np.clip(x, -8, 8, out=x)
    x[:, len(FEATURES):] *= LEXICAL_SCALE
    return x


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _minimise(gradient, size: int, steps: int, rate: float = 0.05) -> np.ndarray:
    """Adam from zero."""
    t, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for i in range(1, steps + 1):
        g = gradient(t)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        t = t - rate * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.999 ** i)) + 1e-8)
    return t


def _plus_one(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1))])


def estimate_prior(pos: np.ndarray, unl: np.ndarray, steps: int = 200) -> float:
    """Share of positives among the unlabelled: the least ratio of the two above a threshold of a fitted score."""
    p, u = _plus_one(pos[::2]), _plus_one(unl[::2])

    def gradient(t: np.ndarray) -> np.ndarray:
        sp, su = 1 / (1 + np.exp(-np.clip(p @ t, -30, 30))), 1 / (1 + np.exp(-np.clip(u @ t, -30, 30)))
        return p.T @ (sp - 1) / len(p) + u.T @ su / len(u) + 1e-3 * t

    t = _minimise(gradient, p.shape[1], steps)
    sp, su = np.sort(_plus_one(pos[1::2]) @ t), np.sort(_plus_one(unl[1::2]) @ t)
    if not len(sp) or not len(su):
        return 0.5
    cuts = np.quantile(sp, np.linspace(0, 0.9, 91))
    above_p = 1 - np.searchsorted(sp, cuts, "left") / len(sp)
    above_u = 1 - np.searchsorted(su, cuts, "left") / len(su)
    slack = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(sp)) + 1 / np.sqrt(len(su)))
    best = int(np.argmin((above_u + slack) / above_p))
    return float(np.clip(above_u[best] / above_p[best], 0.02, 0.98))


def fit(pos: np.ndarray, unl: np.ndarray, steps: int = 400, l2: float = 1e-4) -> Model | None:
    """Model of least non-negative risk; None if either sample is empty."""
    if not len(pos) or not len(unl):
        return None
    mean, scale = unl.mean(axis=0), unl.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    p, u = _standard(pos, mean, scale), _standard(unl, mean, scale)
    del pos, unl
    prior = estimate_prior(p[:, :len(FEATURES)].astype(float), u[:, :len(FEATURES)].astype(float))
    t = minimise_risk(p, u, prior, steps, l2)
    return Model(mean, scale, t[:-1], float(t[-1]), prior)


def minimise_risk(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 400, l2: float = 1e-4) -> np.ndarray:
    """Weights and, last, bias of least non-negative risk plus ``l2`` / 2 times the weights' squares."""
    def pull(x: np.ndarray, residual: np.ndarray) -> np.ndarray:
        return np.append(x.T @ residual, residual.sum()) / len(x)

    def gradient(t: np.ndarray) -> np.ndarray:
        zp, zu = (np.clip(x @ t[:-1].astype(x.dtype) + x.dtype.type(t[-1]), -30, 30) for x in (p, u))
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        up = prior * pull(p, sp - 1)
        down = pull(u, su) - prior * pull(p, sp)
        rest = _softplus(zu).mean() - prior * _softplus(zp).mean()
        decay = l2 * np.append(t[:-1], 0)
        # where the estimate of the negatives' risk has gone below zero, step back from it
        return up + down + decay if rest >= 0 else -down + decay

    return _minimise(gradient, p.shape[1] + 1, steps)


def held_out(doc_id: Column) -> Column:
    """Fold 0 of crc32 of the id as text; rows without an id are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _share(df: DataFrame, bound: int) -> Column:
    """A condition that holds for about ``bound`` of the rows, all if there are fewer, by a hash of doc_id."""
    n = df.count()
    part = int(min(1.0, bound / max(n, 1)) * (1 << 30))
    return F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 30)) < part


def train(docs: DataFrame, labels: DataFrame, sample: Sample = Sample()) -> Model | None:
    """Fit on documents of the training folds. ``docs`` (doc_id, text), ``labels`` (doc_id, quality).

    A document with several labels counts as good if all of them say so. Null ids and null labels are not used.
    """
    text_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    good = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    good = good.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")
    some = good.where(_share(good, sample.positives)).limit(2 * sample.positives)   # the limit proves the bound; it isn't reached
    trusted = docs.join(F.broadcast(some), "doc_id")
    taken = docs.where(_share(docs.select("doc_id"), sample.unlabelled))

    k = len(FEATURES)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = features(b.column("text"))
            packed = [r[:k].tobytes() + r[k:].astype(np.float16).tobytes() for r in x]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "x"])

    def gather(df: DataFrame) -> np.ndarray:   # bounded by ``sample``
        t = df.select("doc_id", "text").mapInArrow(compute, "doc_id long, x binary").toArrow()
        ids, packed = t.column("doc_id").to_numpy(), t.column("x").combine_chunks()
        del t
        if not len(ids):
            return np.zeros((0, k + LEXICAL), np.float32)
        size = 8 * k + 2 * LEXICAL                                   # bytes of a row
        raw = np.frombuffer(packed.buffers()[2], np.uint8)[packed.offset * size:][:len(ids) * size].reshape(-1, size)
        stats = np.ascontiguousarray(raw[:, :8 * k]).view(np.float64)
        order = np.lexsort((*stats.T, ids))                          # the same in every run
        x = np.empty((len(ids), k + LEXICAL), np.float32)
        x[:, :k] = stats[order]
        for lo in range(0, len(ids), 4096):
            x[lo:lo + 4096, k:] = raw[order[lo:lo + 4096], 8 * k:].view(np.float16)
        return x

    return fit(gather(trusted), gather(taken))


def with_score(docs: DataFrame, model: Model | None, text: str = "text", score: str = "score", drop_text: bool = True,
               least: float | None = None) -> DataFrame:
    """``docs`` with the score of every row; ``least`` keeps only rows with at least that score.

    A column that is called like the score is replaced. Without a model (no positives, or no documents) all score 0.5.
    """
    text_batches(docs.sparkSession)
    docs = docs.select(*[c for c in docs.columns if c != score])
    keep = [c for c in docs.columns if not (drop_text and c == text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(features(b.column(text))) if model else np.full(b.num_rows, 0.5)
            out = pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(s)], names=[*keep, score])
            yield out if least is None else out.filter(pa.array(s >= least))

    schema = docs.select(*keep).withColumn(score, F.lit(0.0)).schema
    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, sample: Sample = Sample(), threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: good more likely), predicted (1 from ``threshold`` on), one row a document.

    Null and empty texts are scored from zero statistics. Rows without an id are scored and not held out. Repeated rows come
    out as often as they came in; an empty table gives an empty result. Scores depend on the text alone.
    """
    model = train(docs, labels, sample)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_score(base, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
