"""Exact quantiles of columns with any number of distinct values.

Spark's ``percentile`` keeps every distinct value of a column in one
aggregation buffer, which fails once a column (a timestamp, a probability) has
about as many values as rows.  Here each pass counts rows in a bounded number of
equal-width buckets and keeps only the buckets that hold a wanted rank, so no
task and no driver ever sees more than a few thousand rows.  The first pass also sketches
where the ranks lie, so the buckets of the second pass are fine there and mostly decide.  Columns with few
distinct values need no buckets: one pass counts the values.
"""

from __future__ import annotations

import math
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKETS = 4096
#: Error of the sketch as a share of all rows, and the margin taken around it.
SKETCH_ERROR = 1e-4
MARGIN = 3e-4
DIRECT_ROWS = 20_000
#: Columns with no more distinct values, about, are counted value by value.
FEW_VALUES = 2_000


def exact_quantiles(
    df: DataFrame,
    columns: dict[str, Column] | list[str],
    probs: list[float],
    buckets: int = BUCKETS,
    direct_rows: int = DIRECT_ROWS,
) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles, nulls left out; ``None`` for empty columns."""
    exprs = columns if isinstance(columns, dict) else {c: F.col(c) for c in columns}
    exprs = {name: expr.cast("double") for name, expr in exprs.items()}
    found = _of_few_values(df, exprs, probs)
    rest = {name: expr for name, expr in exprs.items() if name not in found}
    if rest:
        found |= _of_many_values(df, rest, probs, buckets, direct_rows)
    return {name: found[name] for name in exprs}


def _of_few_values(df: DataFrame, exprs: dict[str, Column], probs: list[float]) -> dict[str, list[float | None]]:
    """Quantiles of the columns with few distinct values, such as ages and hours, from the counts of these values."""
    names = list(exprs)
    row = df.agg(*[F.approx_count_distinct(exprs[c]).alias(f"a{i}") for i, c in enumerate(names)]).first()
    few = [c for i, c in enumerate(names) if row[i] <= FEW_VALUES]
    if not few:
        return {}
    slots = F.array(*[F.struct(F.lit(i).alias("k"), exprs[c].alias("v")) for i, c in enumerate(few)])
    values = df.select(F.explode(slots).alias("s")).select("s.k", "s.v").groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    held: dict[int, list] = {i: [] for i in range(len(few))}
    for k, v, n in values.where(F.col("v").isNotNull()).collect():
        held[k].append((v, n))
    return {c: [_of_counts(sorted(held[i]), p) for p in probs] for i, c in enumerate(few)}


def _of_counts(values: list[tuple[float, int]], p: float) -> float | None:
    """Quantile of values with counts, ascending."""
    if not values:
        return None
    n = sum(count for _, count in values)
    found, wanted, before = {}, _neighbours(p, n), 0
    for value, count in values:
        found.update({(0, r): value for r in wanted if before <= r < before + count})
        before += count
    return _interpolate(found, 0, p, n)


def _of_many_values(
    df: DataFrame, exprs: dict[str, Column], probs: list[float], buckets: int, direct_rows: int
) -> dict[str, list[float | None]]:
    counts, stats = _bounds(df, exprs, probs)
    wanted = {
        i: {r for p in probs for r in _neighbours(p, n)} for i, n in enumerate(counts) if n
    }
    found = _select(df, list(exprs.values()), stats, wanted, buckets, direct_rows)
    out = {}
    for i, (name, n) in enumerate(zip(exprs, counts)):
        out[name] = [_interpolate(found, i, p, n) if n else None for p in probs]
    return out


def exact_order_statistics(
    df: DataFrame, column: Column, ranks: list[int], buckets: int = BUCKETS, direct_rows: int = DIRECT_ROWS
) -> list[float | None]:
    """Values at the given 0-based ranks of the sorted column."""
    counts, stats = _bounds(df, {"v": column.cast("double")})
    wanted = {0: {r for r in ranks if 0 <= r < counts[0]}}
    found = _select(df, [column.cast("double")], stats, wanted, buckets, direct_rows)
    return [found.get((0, r)) for r in ranks]


def _neighbours(p: float, n: int) -> tuple[int, int]:
    position = p * (n - 1)
    return math.floor(position), math.ceil(position)


def _interpolate(found: dict, column: int, p: float, n: int) -> float:
    low_rank, high_rank = _neighbours(p, n)
    low, high = found[column, low_rank], found[column, high_rank]
    if low_rank == high_rank or low == high:
        return low
    return low + (high - low) * (p * (n - 1) - low_rank)


def _bounds(df: DataFrame, exprs: dict[str, Column], probs: list[float] = ()):
    """Counts, and (min, max, sketched range of the wanted values) of each column."""
    near = sorted({min(max(p + d, 0.0), 1.0) for p in probs for d in (-MARGIN, MARGIN)}) or [0.0, 1.0]
    sketch = lambda e: F.percentile_approx(e, near, int(1 / SKETCH_ERROR))
    aggs = list(
        chain.from_iterable((F.count(e), F.min(e), F.max(e), sketch(e)) for e in exprs.values())
    )
    row = tuple(df.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggs)]).first())
    counts = [row[4 * i] for i in range(len(exprs))]
    stats = []
    for i in range(len(exprs)):
        low, high, found = row[4 * i + 1 : 4 * i + 4]
        stats.append((low, high, (found[0], found[-1]) if found else None))
    return counts, stats


def _select(df, exprs, stats, wanted, buckets, direct_rows) -> dict[tuple[int, int], float]:
    found: dict[tuple[int, int], float] = {}
    brackets = []
    for i, ranks in wanted.items():
        low, high, inner = stats[i]
        if low == high:
            found.update({(i, r): low for r in ranks})
        elif ranks:
            brackets.append(dict(col=i, low=low, high=high, below=0, rows=None, ranks=ranks, inner=inner))
    while brackets:
        brackets = _narrow(df, exprs, brackets, found, buckets, direct_rows)
    return found


def _narrow(df, exprs, brackets, found, buckets, direct_rows):
    """One pass over the data: split every open bracket, keep the parts with a wanted rank."""
    sizes = [b["rows"] for b in brackets]
    direct = all(s is not None for s in sizes) and sum(sizes) <= direct_rows
    used = sorted({b["col"] for b in brackets})
    slots = []
    for c in used:
        value = exprs[c]
        inside = [(k, b) for k, b in enumerate(brackets) if b["col"] == c]
        number = F
        for k, b in inside:
            number = number.when((value >= b["low"]) & (value <= b["high"]), k)
        slots.append(F.struct(number.alias("k"), value.alias("v")))
    picked = df.select(slots[0].alias("s")) if len(slots) == 1 else df.select(F.explode(F.array(*slots)).alias("s"))
    # Values outside all brackets stay as one null-keyed group: a filter on k would be
    # pushed below the projection and repeat the value's expression per comparison.
    picked = picked.select("s.k", "s.v")
    part = F.col("v") if direct else _bucket(brackets, buckets)
    histogram = (
        picked.withColumn("part", part.cast("double"))
        .groupBy("k", "part")
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    )
    upto = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    summed = histogram.withColumn("upto", F.sum("n").over(upto))
    ranks = F.array(*[_longs(r - b["below"] for r in sorted(b["ranks"])) for b in brackets])
    holds = F.exists(
        F.element_at(ranks, F.col("k") + 1),
        lambda r: (r >= F.col("upto") - F.col("n")) & (r < F.col("upto")),
    )
    # at most one row per wanted rank comes back
    rest = []
    for row in summed.where(holds).collect():
        parent = brackets[row["k"]]
        first = parent["below"] + row["upto"] - row["n"]
        ranks = {r for r in parent["ranks"] if first <= r < first + row["n"]}
        if row["low"] == row["high"]:
            found.update({(parent["col"], r): row["low"] for r in ranks})
        else:
            rest.append(
                dict(col=parent["col"], low=row["low"], high=row["high"], below=first, rows=row["n"], ranks=ranks)
            )
    return rest


def _longs(values) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _bucket(brackets, buckets: int) -> Column:
    """Equal-width bucket of ``v`` in its bracket; two halves where a width overflows.

    A bracket with a sketched inner range has its buckets there, and one more on each side.
    """
    scales, middles, lows, highs = [], [], [], []
    for b in brackets:
        low, high = b.get("inner") or (b["low"], b["high"])
        lows.append(low)
        highs.append(high)
        if low == high:
            scales.append(0.0)
            middles.append(low)
            continue
        width = high - low
        scale = buckets / width if width else math.inf
        scales.append(scale if math.isfinite(scale) and math.isfinite(width) else math.nan)
        middle = low / 2 + high / 2
        middles.append(middle if middle < high else low)

    def of(values):
        return F.element_at(F.array(*[F.lit(float(x)) for x in values]), F.col("k") + 1)

    scale, value = of(scales), F.col("v")
    even = F.least(F.floor((value - of(lows)) * scale), F.lit(buckets - 1))
    return (
        F.when(value < of(lows), F.lit(-1).cast("long"))
        .when(value > of(highs), F.lit(buckets).cast("long"))
        .when(F.isnan(scale), (value > of(middles)).cast("long"))
        .otherwise(even)
    )
