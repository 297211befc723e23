"""Running totals over an ordering of the whole frame, without a one-task window."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType
from pyspark.sql.window import Window


def _is_number(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (NumericType, BooleanType))


def range_slices(df: DataFrame, order: str, slices: int) -> list:
    """Cut points that split ``order`` into slices of about equal row count.

    They only balance the work; any cut points give the same totals.  Values that are no numbers are
    cut at ranks of a bounded sample of them (the smallest hashes).
    """
    if not _is_number(df, order):
        sample = df.select(order).where(F.col(order).isNotNull()).orderBy(F.xxhash64(order)).limit(50 * slices)
        found = sorted({r[0] for r in sample.collect()})
        return sorted({found[len(found) * i // slices] for i in range(1, slices)}) if found else []
    probs = [i / slices for i in range(1, slices)]
    row = df.agg(F.percentile_approx(F.col(order).cast("double"), probs, 10 * slices)).first()
    return sorted(set(row[0] or []))


def with_slice(df: DataFrame, order: str, cuts: list, name: str = "_slice") -> DataFrame:
    """Number of cut points <= value, as a double column."""
    if cuts and not _is_number(df, order):
        below = F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(order))
        return df.withColumn(name, F.size(below).cast("double"))
    splits = [float("-inf"), *cuts, float("inf")]
    if len(splits) < 3:
        return df.withColumn(name, F.lit(0.0))
    source = f"{name}_in"
    bucketizer = Bucketizer(splits=splits, inputCol=source, outputCol=name)
    return bucketizer.transform(df.withColumn(source, F.col(order).cast("double"))).drop(source)


def running_totals(
    df: DataFrame,
    order: str,
    values: list[str],
    group: list[str] | None = None,
    descending: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Add ``before_<v>``: the sum of ``v`` over rows strictly earlier in the order.

    ``(group, order)`` must be unique.  Rows are cut into value ranges; the totals
    of the ranges (few rows) are summed first and then added to a sum inside each
    range, so a group that holds a third of all rows is still spread over all
    ranges instead of landing in one window task.
    """
    group = group or []
    if slices is None:
        slices = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sliced = with_slice(df, order, range_slices(df, order, slices))

    def ordered(name):
        return F.col(name).desc() if descending else F.col(name).asc()

    before = (Window.unboundedPreceding, -1)
    by_slice = Window.partitionBy(*group).orderBy(ordered("_slice")).rowsBetween(*before)
    offsets = sliced.groupBy(*group, "_slice").agg(
        *[F.sum(v).alias(f"_sum_{v}") for v in values]
    )
    offsets = offsets.select(
        *group,
        "_slice",
        *[F.coalesce(F.sum(f"_sum_{v}").over(by_slice), F.lit(0)).alias(f"_off_{v}") for v in values],
    )
    inside = Window.partitionBy(*group, "_slice").orderBy(ordered(order)).rowsBetween(*before)
    joined = sliced.join(offsets, [*group, "_slice"], "inner")
    totals = {
        f"before_{v}": F.col(f"_off_{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values
    }
    return joined.withColumns(totals).drop("_slice", *[f"_off_{v}" for v in values])
