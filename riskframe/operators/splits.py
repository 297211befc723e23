"""Train/validation/test splits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.functions.numeric import count_of, hash_rank
from riskframe.functions.quantiles import exact_order_statistics, exact_quantiles
from riskframe.functions.timeparts import event_micros, instant
from riskframe.schema import ID, LABEL, TIME

SPLIT = "parte"


def stratified_split(df: DataFrame, test_share: float, seed: int = 42, label: str = LABEL) -> DataFrame:
    """Random split with the same test share in each class.

    Per class the test part is the rows with the smallest seeded hashes, found as
    an exact order statistic; no class is ever ranked in one task.
    """
    rank = hash_rank(F.col(ID), seed)
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    is_test = F.lit(False)
    for value, n in sizes.items():
        test_rows = round(n * test_share)
        if not test_rows:
            continue
        same = F.col(label).eqNullSafe(F.lit(value))
        last = exact_order_statistics(df.where(same), rank, [test_rows - 1])[0]
        is_test = is_test | (same & (rank <= F.lit(int(last))))
    return df.withColumn(SPLIT, F.when(is_test, "test").otherwise("train"))


def temporal_split(
    df: DataFrame, train_share: float = 0.7, test_share: float = 0.2, min_train: int = 30, min_test: int = 10
) -> DataFrame:
    """Train up to the time quantile, test after it (rows without a time too).

    Falls back to a stratified split if there is no time column or a part is tiny.
    """
    if TIME in df.columns:
        micros = event_micros(F.col(TIME))
        cut = exact_quantiles(df, {"t": micros}, [train_share])["t"][0]
        if cut is not None:
            part = F.when(micros <= F.lit(cut), "train").otherwise("test")
            split = df.withColumn(SPLIT, part)
            sizes = _sizes(split)
            if sizes.get("train", 0) >= min_train and sizes.get("test", 0) >= min_test:
                return split
    return stratified_split(df, test_share)


def temporal_split_3way(
    df: DataFrame, train_share: float = 0.60, valid_until: float = 0.85, min_train: int = 50, min_valid: int = 20
) -> DataFrame:
    """60/25/15 by time; rows without a time are left out.

    In the fallback there is no 'valid' part: validation uses the test rows.
    """
    if TIME in df.columns:
        micros = event_micros(F.col(TIME))
        first, second = exact_quantiles(df, {"t": micros}, [train_share, valid_until])["t"]
        if first is not None:
            part = F.when(micros <= F.lit(first), "train").when(micros <= F.lit(second), "valid").otherwise("test")
            split = df.where(F.col(TIME).isNotNull()).withColumn(SPLIT, part)
            sizes = _sizes(split)
            if sizes.get("train", 0) >= min_train and sizes.get("valid", 0) >= min_valid:
                return split
            return stratified_split(df, 0.25)
    return stratified_split(df, 0.3)


def fixed_date_split(df: DataFrame, last_train: dt.date, last_valid: dt.date) -> DataFrame:
    """By two instants (midnight of the given days); rows without a time are left out."""
    first = instant(dt.datetime.combine(last_train, dt.time()))
    second = instant(dt.datetime.combine(last_valid, dt.time()))
    time = F.col(TIME)
    part = F.when(time <= first, "train").when(time <= second, "valid").otherwise("test")
    return df.where(time.isNotNull()).withColumn(SPLIT, part)


def part(split: DataFrame, name: str) -> DataFrame:
    return split.where(F.col(SPLIT) == name)


def _sizes(split: DataFrame) -> dict[str, int]:
    return {r[SPLIT]: r["n"] for r in split.groupBy(SPLIT).agg(F.count(F.lit(1)).alias("n")).collect()}


def split_summary(split: DataFrame) -> DataFrame:
    return (
        split.groupBy(SPLIT)
        .agg(F.min(TIME).alias("inicio"), F.max(TIME).alias("fim"), F.count(F.lit(1)).alias("tamanho"))
        .orderBy(SPLIT)
    )


def split_overlap(split: DataFrame) -> DataFrame:
    """Number of ids that two parts share (0 for a sound split), from one grouping by id."""
    names = ["train", "valid", "test"]
    present = split.groupBy(ID).agg(*[F.bool_or(F.col(SPLIT) == n).alias(n) for n in names])
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    sums = present.agg(*[count_of(F.col(a) & F.col(b)).alias(f"{a}_{b}") for a, b in pairs])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}_{b}").alias("comuns")) for a, b in pairs]
    return sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weights n / (classes * n_class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()  # one row per class
    weight = F.sum("n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n"))
    return counts.select(label, "n", weight.alias("peso")).orderBy(label)


def majority_label(train: DataFrame, label: str = LABEL) -> int:
    """Most frequent label, the smaller one on ties."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), label).first()[label]
