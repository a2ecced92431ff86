"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``target / source size`` times. Within the source the documents are put
in a fixed order and the expected copies are summed up; one offset in [0, 1) is added, and a document is
emitted once for every integer that its step of the sum crosses. Ordered by size, the words taken differ from the
target by no more than about one document's.

The order is global, so the prefix sum is done in two steps: rows are range-partitioned by (source, size, id),
numbered inside each partition, and the number of rows of the same source in earlier partitions is added. No task
sees a whole source, whatever its share.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conform.llm.common import staged

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words (null: 0): words become one letter each, the blanks between them go."""
    letters = F.regexp_replace(text, WORD, "x")
    return F.coalesce(F.length(F.translate(letters, "\t\n\x0b\x0c\r ", "")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: tuple[int, int] = (3, 2),
                   most: int = 2) -> DataFrame:
    """(source, size) rows -> (source, source_size, target, copies): one row a source.

    Sources ordered by code point, null last, weigh ``weights`` in turn and share ``share`` (a fraction) of all
    sizes. A target stops at ``most`` times its source's size; what it leaves is shared again by weight. Closed
    form: with the sources ordered by cap / weight, those at their cap come first, and one level per
    unit of weight holds for all others. Sizes are summed by source first, so the ordered windows run over
    one row a source.
    """
    num, den = share
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    n = len(weights)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), (place % n + 1).cast("int"))
    by = by.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    by = by.withColumn("turn", F.row_number().over(order))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    by = (by.withColumn("budget", F.sum("source_size").over(whole) * num / den)
          .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0)))
          .withColumn("open", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
          .withColumn("level", (F.col("budget") - F.col("capped")) / F.col("open"))
          # the level is that of the first source which stays under its cap
          .withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("turn", "level"))).over(whole)["level"]))
    target = F.coalesce(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")), F.col("cap").cast("double"))
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return by.withColumn("target", target).select("source", "source_size", "target", copies.alias("copies"))


def offset_of(source: Column, seed: int) -> Column:
    """The source's random offset in [0, 1): 32 bits of a seeded digest of its name."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)


def _number(spark: SparkSession, sized: DataFrame) -> DataFrame:
    """Rows with ``part`` and ``place``: the number of the row among those of its source in its partition, from 1,
    in the order of (source, size, doc_id) that also holds between partitions."""
    order = [F.col("source").asc_nulls_first(), F.col("size").asc(), F.col("doc_id").asc_nulls_first()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = sized.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def number(batches):
        source, count = object(), 0
        for b in batches:
            runs = pc.run_end_encode(b.column("source"))
            ends, begin, places = runs.run_ends.to_numpy(), 0, np.empty(b.num_rows, np.int64)
            for end, s in zip(ends, runs.values.to_pylist()):
                count = count if s == source else 0
                places[begin:end] = np.arange(count + 1, count + 1 + end - begin)
                source, count, begin = s, count + int(end) - begin, int(end)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(places)], names=[*b.schema.names, "place"])

    numbered = ranged.mapInArrow(number, T.StructType([*ranged.schema.fields, T.StructField("place", T.LongType())]))
    return staged(spark, numbered, "mix-numbered", sized.count())


def _earlier(numbered: DataFrame) -> DataFrame:
    """(source, part) -> rows of the source in earlier partitions: at most partitions + sources rows."""
    held = numbered.groupBy("source", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return held.select("source", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: tuple[int, int] = (3, 2), most: int = 2,
        seed: int = 42, carry: Sequence[str] = ()) -> DataFrame:
    """Copies of every document in the mix: doc_id, source, size, source_size, target, copies.

    Every row of ``docs`` (doc_id, text, source) comes out once, repeated rows too; copies may be 0. Equal sizes are
    ordered by doc_id, null first; rows that also share it are interchangeable. A null text has size 0,
    null sources form one source of their own. Empty documents are drawn like others and take no words;
    a source without words has target 0 and no copies. An empty table gives an empty result. No document gets
    more than ``most`` copies. ``carry`` names further columns to pass on; others are not read.
    """
    spark = docs.sparkSession
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"), *carry)
    sized = staged(spark, sized, "mix-sizes")
    targets = source_targets(sized, weights, share, most)
    numbered = _number(spark, sized)
    held = _earlier(numbered)
    # what holds for a source is first joined to its few partitions: the join of the documents then has
    # (partition, source) as its key, which no source can make hot
    held = held.join(targets, held["source"].eqNullSafe(targets["source"]), "left").select(
        held["source"].alias("__source"), held["part"].alias("__part"), "earlier", "source_size", "target", F.col("copies").alias("each"))
    out = numbered.join(held, (numbered["part"] == held["__part"]) & numbered["source"].eqNullSafe(held["__source"]), "left")
    u = offset_of(F.col("source"), seed)
    at = F.col("place") + F.col("earlier")
    crossed = F.floor(at * F.col("each") + u) - F.floor((at - 1) * F.col("each") + u)
    return out.select("doc_id", "source", "size", "source_size", "target",
                      F.least(crossed, F.lit(most)).cast("int").alias("copies"), *carry)
