"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.session import TEXT_BATCH, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


FILE_ROWS = 500_000  # narrow rows in a file
TEXT_ROWS = 10_000   # documents in a file
TEXT_BYTES = 64 << 20  # of text in a file


def gathered(df: DataFrame, rows: int, per_file: int = FILE_ROWS, size: int = 0) -> DataFrame:
    """``df`` of at most ``rows`` rows and ``size`` bytes of text in no more partitions than these need: few rows in many shuffle
    partitions would be written as many tiny files. Never more partitions than before, so nothing changes where there is much."""
    return df.coalesce(max(1, -(-rows // per_file), -(-size // TEXT_BYTES)))


def gathered_texts(df: DataFrame, docs: DataFrame) -> DataFrame:
    """``df``, rows of ``docs`` each at most once, in the partitions that the rows and bytes of ``docs`` need."""
    texts = [F.coalesce(F.octet_length(F.col(c)), F.lit(0)).cast("long") for c, kind in docs.dtypes if kind in ("string", "binary")]
    r = docs.agg(F.count("*").alias("rows"), F.coalesce(F.sum(sum(texts, F.lit(0))), F.lit(0)).alias("size")).first()
    return gathered(df, r["rows"], TEXT_ROWS, r["size"])


def staged(spark: SparkSession, df: DataFrame, name: str, rows: int | None = None, per_file: int = FILE_ROWS) -> DataFrame:
    """Write ``df`` (of at most ``rows`` rows, if that is known) to the shared scratch folder and read it back.

    Cuts the lineage: an executor lost later only costs the tasks that read the stored rows again.
    """
    path = scratch_path(spark, name)
    (df if rows is None else gathered(df, rows, per_file)).write.parquet(path)
    return spark.read.parquet(path)


def text_batches(spark: SparkSession) -> None:
    """The setting that operators need which send whole texts to Python (``session.BASE_CONF`` has it too)."""
    spark.conf.set(*TEXT_BATCH)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, all other characters as they are."""
    return F.translate(c, UPPER, UPPER.lower())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_row_key(docs: DataFrame) -> DataFrame:
    """Adds ``__h``, a hash over all columns, doc_id too: it tells rows apart that share an id (or have none)."""
    usable = [F.col(c) for c, kind in docs.dtypes if "map<" not in kind and kind != "void"]
    return docs.withColumn("__h", F.xxhash64(*usable))


def same_row(left: DataFrame, h: str, doc_id: str, right: DataFrame, right_h: str, right_id: str) -> Column:
    """Join condition on the row hash, with doc_id (null as 0, the hash tells them apart) as a check of it.

    The check is no equality, so it doesn't become part of the shuffle's key: what follows by (doc_id, hash) then finds the rows of a
    key together and needs no shuffle of its own.
    """
    own, other = F.coalesce(left[doc_id], F.lit(0)), F.coalesce(right[right_id], F.lit(0))
    return (left[h] == right[right_h]) & own.between(other, other)


def join_decisions(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """``docs`` with ``__h`` joined to ``decisions`` (doc_id, __h, more), one row for each kept (doc_id, __h).

    The texts are shuffled once, by a key that no group of copies makes hot; rows that are equal in every column
    collapse on the same partitioning.
    """
    d = decisions.withColumnsRenamed({"doc_id": "__d_id", "__h": "__d_h"})
    both = docs.join(d, same_row(docs, "__h", "doc_id", d, "__d_h", "__d_id"), "inner")
    return gathered_texts(both.drop("__d_id", "__d_h").dropDuplicates(["doc_id", "__h"]), docs)


def spread_join(left: DataFrame, right: DataFrame, key: str, count: str, by: list[str], rows: int | None = None) -> DataFrame:
    """``left`` (inner) joined to ``right``, which has one row a key and in ``count`` the key's rows in ``left``.

    A key with more than its even share of the rows is split: its left rows get a salt from the columns ``by``, its right row
    is repeated for each salt. Such keys are fewer than the shuffle partitions by the choice of the share, so
    their list has a proven bound and is broadcast. ``key`` comes out once, ``count`` not at all. ``rows`` is the sum of ``count``
    where it is known; a bound above it makes the share larger, nothing else.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = (right.agg(F.sum(count)).first()[0] or 0) if rows is None else rows
    share = max(1, total // parts)
    pieces = F.ceil(F.col(count) / share).cast("int")
    hot = right.where(F.col(count) > share).select(F.col(key).alias("__key"), pieces.alias("__pieces"))
    salted = left.join(F.broadcast(hot), left[key] == hot["__key"], "left").drop("__key")
    salted = salted.withColumn("__salt", F.coalesce(F.pmod(F.xxhash64(*by), F.col("__pieces")), F.lit(0)).cast("int")).drop("__pieces")
    repeated = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.when(F.col(count) > share, pieces - 1).otherwise(F.lit(0))))).drop(count)
    return salted.join(repeated, [key, "__salt"]).drop("__salt")
