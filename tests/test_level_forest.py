"""Forests grown level by level."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F
from riskframe.operators import level_forest as lf
from riskframe.operators import supervised as sv
from riskframe.operators.deep_forest import _gains

BINS = np.array([5, 2, 9, 2])


def block(n=3000):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(0, b, n) for b in BINS]).astype(np.uint8)
    y = ((x[:, 0] + 2 * x[:, 2] + x[:, 1]) % 3 == 0).astype(np.uint8)
    return x, y, rng.integers(0, 1 << 63, n).astype(np.uint64)


def test_counts_and_splits_equal_those_by_single_rows():
    x, y, h = block()
    weights, tree = (0.6, 1.7), lf.Tree.root()
    times = lf.drawn(h, 3, 42).astype(int)
    for level in range(4):
        chosen, starts, sizes = lf.tries(3, level, len(tree.open), BINS, 42)
        counts = lf.counted(np.ascontiguousarray(x).ravel(), 4, y, h, tree, 3, level, (chosen, starts, sizes), 42)
        found = lf.best_splits(counts, chosen, starts, sizes, weights, 5)
        at = np.zeros(len(x), dtype=int)
        for _ in range(level):
            f = tree.feature[at]
            at = np.where(f < 0, at, tree.left[at] + (x[np.arange(len(x)), f] > tree.code[at]))
        for k, node in enumerate(tree.open):
            own = at == node
            total, ones = times[own].sum(), times[own & (y == 1)].sum()
            assert (found[0][k], found[1][k]) == (total, ones)
            best = -1.0
            for f in chosen[:, k]:
                for c in range(BINS[f]):
                    low = own & (x[:, f] <= c)
                    n, n1 = times[low].sum(), times[low & (y == 1)].sum()
                    if min(n, total - n) >= 5:
                        best = max(best, _gains(n, n1, total, ones, weights))
            assert found[6][k] == (best > lf.LEAST_GAIN)
            if found[6][k]:
                assert _gains(found[4][k], found[5][k], total, ones, weights) == pytest.approx(best)
        tree = tree.grown(*found, 5)
    assert len(tree.feature) > 7


def rows(spark, n=4000):
    cells = spark.range(n).select(F.col("id").alias("id_ocorrencia"), *[(F.xxhash64("id", F.lit(k)) % 6).cast("double").alias(f"c{k}") for k in (1, 2, 3)])
    label = ((F.col("c1") > 0) & (F.col("c2") > -3)).cast("int").alias("risco_alto")
    return cells.select("id_ocorrencia", array_to_vector(F.array("c1", "c2", "c3")).alias("features"), label, F.lit(1.0).alias("peso"))


def said(model, df):
    scored = model.transform(df).select("id_ocorrencia", vector_to_array("probability")[1])
    return dict(scored.collect())


def test_forest_does_not_depend_on_the_layout_of_the_rows(spark):
    """A forest whose draws follow the partitions differs here."""
    df = rows(spark)
    first, second = (sv.forest(6, 10, 5).fit(df.repartition(parts)) for parts in (1, 7))
    assert said(first, df) == pytest.approx(said(second, df))
    right = [(p >= 0.5) == label for p, label in zip(said(first, df).values(), [r[0] for r in df.select("risco_alto").collect()])]
    assert np.mean(right) > 0.99
    importance = first.featureImportances.toArray()
    assert importance.sum() == pytest.approx(1.0)
    assert importance[2] < 0.1


def test_one_class_and_few_rows(spark):
    df = rows(spark, 40)
    one = df.withColumn("risco_alto", F.lit(1))
    assert set(said(sv.forest(3, 10, 5).fit(one), one).values()) == {1.0}
    assert len(said(sv.forest(3, 10, 5).fit(df.limit(2)), df)) == 40
