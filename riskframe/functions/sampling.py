"""Repeatable samples of a fixed number of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.numeric import hash_rank
from riskframe.schema import ID

BIG = 1_000_000


def smallest(df: DataFrame, rank: Column, rows: int, below, big: int = BIG) -> DataFrame:
    """The ``rows`` rows with the smallest (rank, id).

    A plain top-k sends ``rows`` rows of every partition to one task.  On a big frame
    rows whose rank is surely too large are dropped first: ``below(share)`` is the
    condition that holds for that share of all rows, as ranks are uniform.  If the
    guess was too tight the plain top-k is taken, so the result is the same.
    """
    n = df.count()
    if n > big:
        share = (rows + 10 * rows**0.5 + 100) / n
        narrowed = df.where(below(share))
        if share < 1 and narrowed.count() >= rows:
            df = narrowed
    return df.orderBy(rank, ID).limit(rows)


def hash_sample(df: DataFrame, rows: int, seed: int, big: int = BIG) -> DataFrame:
    rank = hash_rank(F.col(ID), seed)
    return smallest(df, rank, rows, lambda share: rank < F.lit(int(share * 2**52)), big)
