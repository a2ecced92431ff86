"""The pipeline's stages: (spark, docs, sf_dir) -> DataFrame; all but the last return the columns of ``docs``.

Decisions are taken on narrow rows and joined to the documents once, by a hash of the whole row and doc_id: rows
without an id and repeated ids are told apart by what they hold. The classifier's stage needs no join at all.
Rows that are equal in every column count as one document where a stage joins its decisions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.llm.common import gathered_texts, join_decisions, same_row, table, with_row_key
from conform.llm.decontaminate import contaminated
from conform.llm.mixing import mix
from conform.llm.quality import THRESHOLD, train, with_score
from conform.llm.sharding import place
from conform.llm.simhash import near_duplicates

SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier doesn't reject; empty texts are scored like others."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return with_score(docs, model, score="__score", drop_text=False, least=THRESHOLD).select(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every SimHash component the document with the smallest doc_id (no id: last; then by row hash)."""
    keyed = with_row_key(docs)
    found = near_duplicates(keyed, carry=("__h",))
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__h")).alias("m"))
    return join_decisions(keyed, first.select("m.doc_id", "m.__h")).select(*docs.columns)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; items of a few words count too, if all their words stand in a row."""
    keyed = with_row_key(docs)
    bad = contaminated(keyed, table(spark, sf_dir, "benchmark"), carry=("__h",), shortest=1, any_item=True).select(
        F.col("doc_id").alias("__bad_id"), F.col("__h").alias("__bad_h"))
    same = same_row(keyed, "__h", "doc_id", bad, "__bad_h", "__bad_id")
    return gathered_texts(keyed.join(bad, same, "left_anti").select(*docs.columns), docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (0, 1 or 2 times)."""
    keyed = with_row_key(docs)
    taken = mix(keyed, carry=("__h",)).where("copies > 0").groupBy("doc_id", "__h").agg(F.sum("copies").cast("int").alias("__copies"))
    out = join_decisions(keyed, taken)
    return out.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__copies")))).select(*docs.columns)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents with their shard."""
    return place(docs, SHARDS, spare_key=("source", "lang", "n_chars"), slot_col=None)
