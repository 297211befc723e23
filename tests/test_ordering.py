"""Quantiles, running totals, joins and samples against brute force."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from riskframe.functions import lookup
from riskframe.functions.quantiles import exact_order_statistics, exact_quantiles
from riskframe.functions.running import running_totals
from riskframe.functions.sampling import hash_sample

PROBS = [0.0, 0.1, 0.5, 0.77, 1.0]


def column(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")


@pytest.mark.parametrize("direct_rows,buckets", [(20_000, 4096), (5, 8), (0, 2)])
def test_quantiles_on_all_paths(spark, direct_rows, buckets):
    rng = np.random.default_rng(3)
    values = [*rng.normal(0, 1, 300), *rng.integers(0, 3, 200), *([1e9] * 3), None]
    got = exact_quantiles(column(spark, values), ["v"], PROBS, buckets, direct_rows)["v"]
    assert got == pytest.approx(list(np.quantile([v for v in values if v is not None], PROBS)), rel=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=30))
def test_order_statistics_of_any_doubles(spark, values):
    ranks = list(range(len(values)))
    got = exact_order_statistics(column(spark, values), F.col("v"), ranks, buckets=4, direct_rows=2)
    assert got == sorted(values)


def test_quantiles_of_empty_and_several_columns(spark):
    df = spark.createDataFrame([(1.0, None, 5), (2.0, None, 5)], "a double, b double, c int")
    assert exact_quantiles(df, ["a", "b", "c"], [0.5]) == {"a": [1.5], "b": [None], "c": [5.0]}


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("slices", [2, 7, 50])
def test_running_totals(spark, descending, slices):
    rng = np.random.default_rng(1)
    rows = [(str(g), float(o), int(rng.integers(0, 9))) for g in range(3) for o in rng.permutation(40 * (g * g + 1))]
    df = spark.createDataFrame(rows, "g string, o double, n long")
    got = running_totals(df, "o", ["n"], group=["g"], descending=descending, slices=slices).collect()
    assert len(got) == len(rows)
    for r in got:
        earlier = [n for g, o, n in rows if g == r["g"] and (o > r["o"] if descending else o < r["o"])]
        assert r["before_n"] == sum(earlier)


def test_join_paths_agree(spark, monkeypatch):
    left = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k")
    )
    right = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    want = sorted(map(tuple, left.join(right, "k", "left").select("id", "v").collect()))
    small = lookup.lookup_join(left, right, ["k"])
    monkeypatch.setattr(lookup, "SMALL_ROWS", 0)
    salted = lookup.lookup_join(left, right, ["k"], max_rows=5, spread_by="id")
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    for frame in (small, salted):
        assert sorted(map(tuple, frame.select("id", "v").collect())) == want
    inner = lookup.spread_join(left, right, ["k"], "inner").count()
    assert inner == left.join(right, "k").count()


def test_hash_sample_does_not_depend_on_narrowing(spark):
    df = spark.range(20_000).select(F.col("id").alias("id_ocorrencia"))
    plain = {r[0] for r in hash_sample(df, 100, 42).collect()}
    narrowed = {r[0] for r in hash_sample(df.repartition(5), 100, 42, big=10).collect()}
    assert plain == narrowed and len(plain) == 100
