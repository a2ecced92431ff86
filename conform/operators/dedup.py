"""Deterministic latest-row-per-key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# Columns from which on a window is used. Measured at sf0.1 (600,000 rows, seconds, struct / window): 10 columns 0.6 / 1.4 with 30 rows a
# key and 0.7 / 1.6 with a third of the rows in one key; 60 columns 4.7 / 3.7 and 5.4 / 4.4.
WIDE = 32


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("batch_date",), wide: bool | None = None,
                   ranges: Sequence[str] = ()) -> DataFrame:
    """Keep one row per key: the greatest by ``order`` columns, then by all other columns.

    All comparisons are descending with NULL lowest, so the result is a total order and does
    not depend on input partitioning or file order. Rows of up to ``WIDE`` columns go through ``max(struct(...))`` per
    key: an aggregate with map-side partial evaluation. Wider rows are ranked by a window (``wide`` decides otherwise): Spark
    limits its groups to their first row in every task before the shuffle, and compares further columns only on ties.
    Either way a key that holds a large share of the rows is reduced to one row per task before the shuffle.

    ``ranges`` is for rows that are to lie in an order afterwards, and whose keys seldom repeat: key columns or columns that follow from the
    key (its bucket). The rows are range-partitioned by them and the key in the one shuffle that there is, and nothing is sorted before
    it: the rows of a task, not yet parted, may be more than its memory holds. Rows of one key meet in one task.
    """
    keys = list(keys)
    if ranges:
        df = df.repartitionByRange(*ranges, *[k for k in keys if k not in ranges])
        keys += [c for c in ranges if c not in keys]
    order = [c for c in order if c in df.columns and c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.select(*keys).distinct()
    if len(df.columns) > WIDE if wide is None else wide:
        first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order + rest])
        return df.withColumn("_place", F.row_number().over(first)).where("_place = 1").drop("_place")
    # the first key is mostly a source id, equal in nearly all rows; sorts compare the first bytes of the first column before anything else
    picked = df.groupBy(*keys[1:], keys[0]).agg(F.max(F.struct(*order, *rest)).alias("_latest"))
    return picked.select(*[F.col(k) for k in keys], *[F.col(f"_latest.{c}").alias(c) for c in order + rest]) \
                 .select(*df.columns)
