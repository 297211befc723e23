"""Split a frame by membership in a key set of any size, shuffling only likely members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the broadcast map; 64 to a row, so 2**17 rows at most.
MAP_BITS = 1 << 23


def mark_likely(rows: DataFrame, key: Column, keys: DataFrame, bits: int = MAP_BITS) -> DataFrame:
    """``rows`` with ``_likely``: true for every row whose ``key`` is in the one column of ``keys``.

    It is true for few other rows: a map of ``bits`` bits is broadcast, however many keys there are.
    """
    hashed = F.xxhash64(F.col(keys.columns[0]))
    words = (
        keys.select(_word(hashed, bits).alias("_word"), _mark(hashed).alias("_mark"))
        .groupBy("_word")
        .agg(F.bit_or("_mark").alias("_marks"))
    )
    found = rows.withColumn("_hashed", F.xxhash64(key)).withColumn("_word", _word(F.col("_hashed"), bits))
    return (
        found.join(F.broadcast(words), "_word", "left")
        .withColumn("_likely", F.coalesce(F.col("_marks").bitwiseAND(_mark(F.col("_hashed"))) != 0, F.lit(False)))
        .drop("_word", "_marks", "_hashed")
    )


def _word(hashed: Column, bits: int) -> Column:
    return F.pmod(F.shiftrightunsigned(hashed, 6), F.lit(bits // 64))


def _mark(hashed: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(hashed, F.lit(64)).cast("int"))


def without(rows: DataFrame, key: Column, keys: DataFrame, bits: int = MAP_BITS) -> DataFrame:
    """``rows`` whose ``key`` is not in ``keys``; only likely members take part in the join."""
    (name,) = keys.columns
    packed = rows.select(F.struct("*").alias("row"), key.alias("key"))
    marked = mark_likely(packed, F.col("key"), keys, bits)
    sure = marked.where(~F.col("_likely")).select("row.*")
    left = marked.where("_likely").join(keys.select(F.col(name).alias("key")), "key", "left_anti")
    return sure.unionByName(left.select("row.*"))
