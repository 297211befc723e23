"""Partition layout of frames that an iterative algorithm reads many times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.schema import ID


def spread(df: DataFrame, key: str = ID, parts: int | None = None) -> DataFrame:
    """Hash-partition narrow rows that are few bytes but much work each.

    The number of parts is stated, not asked from the data: asking a shuffled frame for its
    partitions would run all shuffles above it once more.
    """
    return df.repartition(parts or tasks(df.sparkSession), key)


def tasks(spark: SparkSession) -> int:
    """Task count for a shuffle whose rows are few bytes but much work each.

    Stated explicitly, because adaptive execution sizes shuffles by bytes alone and
    would put such rows into one task.
    """
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
