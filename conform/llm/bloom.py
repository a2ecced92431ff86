"""A Bloom filter of bounded size over a column of 64-bit hashes, for use in Arrow tasks."""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE = 1 << 15  # positions of one bitmap row


def build(spark: SparkSession, hashes: DataFrame, column: str, least_bits: int = 20, most_bits: int = 27) -> tuple[Broadcast, int]:
    """(broadcast bytes, log2 of the number of positions) over the hashes of ``column``.

    About 256 positions a hash, so that one in 16,000 other hashes gets through, but 2^most_bits (16 MB) at the most:
    beyond that it lets more rows through, never fewer, so it may only be used ahead of an exact join. Bitmaps are aggregated by page on the executors.
    """
    n = hashes.count()
    bits = int(min(max(np.ceil(np.log2(256 * max(n, 1))), least_bits), most_bits))
    at = F.explode(F.array(F.shiftrightunsigned(F.col(column), 64 - bits), F.col(column).bitwiseAND((1 << bits) - 1)))
    pages = (hashes.select(at.alias("at")).groupBy(F.shiftright("at", 15).alias("page"))
             .agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(PAGE - 1)).alias("map")))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for page, part in pages.collect():  # 2^(bits - 15) rows of 4 KB at the most
        out[page * (PAGE // 8):(page + 1) * (PAGE // 8)] = np.frombuffer(part, np.uint8)
    return spark.sparkContext.broadcast(out.tobytes()), bits


def contains(table: np.ndarray, bits: int, h: np.ndarray) -> np.ndarray:
    """Which of the (unsigned) hashes may be in the filter."""
    def test(at: np.ndarray) -> np.ndarray:
        return (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1)

    found = test(h >> np.uint64(64 - bits)).astype(bool)
    some = np.flatnonzero(found)
    found[some] = test(h[some] & np.uint64((1 << bits) - 1)).astype(bool)
    return found
