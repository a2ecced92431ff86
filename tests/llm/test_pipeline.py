from collections import Counter

import brute
import pyarrow as pa
import pytest
from samples import DOCS, make, odd_docs  # noqa: F401 (fixtures)

import corpus_pipeline
from conform.llm.common import table
from conform.llm.quality import THRESHOLD, features, train
from conform.llm.sharding import place
from conform.llm.stages import SHARDS, dedup_stage, decontaminate_stage, mix_stage, quality_stage, shard_stage
from conform.session import scratch_path

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def by_definition(spark, docs, sf_dir):
    """Rows after each stage, from plain Python over the same model."""
    model = train(spark.createDataFrame(docs, DOCS), table(spark, sf_dir, "labels"))
    steps = []
    docs = [d for d in docs if (model.score(features(pa.array([d[1]], pa.string())))[0] if model else 0.5) >= THRESHOLD]
    steps.append(docs)
    fp = [brute.simhash(d[1]) for d in docs]
    root = brute.components(len(docs), lambda i, j: (fp[i] ^ fp[j]).bit_count() <= 2)
    best = {}
    for d, r in zip(docs, root):
        k = (d[0] is None, d[0] or 0)
        if r not in best or k < best[r][0]:
            best[r] = k, d
    docs = [d for _, d in best.values()]
    steps.append(docs)
    items = [r.text for r in table(spark, sf_dir, "benchmark").collect()]
    docs = [d for d in docs if not any(brute.contaminated(d[1], i) for i in items)]
    steps.append(docs)
    docs = [d for d, n in zip(docs, brute.mixed([(d[0], d[1], d[3]) for d in docs])) for _ in range(n)]
    steps.append(docs)
    return steps


def key(r):
    return str(tuple(r)[:5])


def test_every_stage_on_the_table(spark):
    docs = table(spark, SF, "documents")
    rows = [tuple(r[c] for c in COLUMNS) for r in docs.collect()]
    for (name, stage), want in zip(corpus_pipeline.STAGES, by_definition(spark, rows, SF)):
        docs = stage(spark, docs, SF)
        assert docs.columns == COLUMNS, name
        assert Counter(map(key, docs.collect())) == Counter(map(key, want)), name
        assert 0 < len(want) < 2 * len(rows), name
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*COLUMNS, "shard"]
    assert Counter(map(key, out.collect())) == Counter(map(key, want))
    alone = {r.doc_id: r.shard for r in place(docs, SHARDS).collect()}
    assert all(r.shard == alone[r.doc_id] for r in out.collect())


@pytest.fixture(scope="module")
def small_sf(spark):
    path = scratch_path(spark, "small-sf")
    spark.createDataFrame([(i, i % 2, 0) for i in range(1, 8)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.mark.parametrize("stage", [quality_stage, dedup_stage, decontaminate_stage, mix_stage, shard_stage])
def test_stages_on_odd_rows_and_empty_tables(stage, spark, make, odd_docs, small_sf):
    empty = make([], DOCS)
    assert stage(spark, empty, small_sf).collect() == []
    docs = make(odd_docs, DOCS)
    got = stage(spark, docs, small_sf)
    assert set(got.columns) == {*docs.columns, "shard"}
    given = Counter(key([r[c] for c in COLUMNS]) for r in docs.collect())
    rows = Counter(key([r[c] for c in COLUMNS]) for r in got.collect())
    assert set(rows) <= set(given)
    if stage is shard_stage:
        assert rows == given
    if stage is decontaminate_stage:
        assert set(rows) == set(given)
    if stage is dedup_stage:
        fp = {k: brute.simhash(t) for k, t in ((key((d, t, *r)), t) for d, t, *r in odd_docs)}
        assert len(rows) < len(given) and all(n == 1 for n in rows.values())
        assert all(any((fp[k] ^ fp[o]).bit_count() <= 2 for o in rows) for k in given)
