"""Rules, patterns, splits and aggregates on hand-made tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from riskframe.operators import aggregates as agg
from riskframe.operators import rules, splits

COLUMNS = "bairro string, tipo_crime string, arma_utilizada string, turno string, dia_semana string, risco_alto int"


@pytest.fixture(scope="module")
def baskets(spark):
    rows = [("A", "Roubo", "Faca", "Noite", "Monday", 1)] * 6
    rows += [("B", "Roubo", "Faca", "Tarde", "Monday", 1)] * 4
    rows += [("B", "Furto", "Faca", "Tarde", None, 1)] * 2
    rows += [("B", "Furto", "Faca", "Tarde", "Monday", 0)] * 50
    return spark.createDataFrame(rows, COLUMNS)


def test_itemset_supports(baskets):
    got = {tuple(r["items"]): r["n"] for r in rules.frequent_itemsets(baskets, 0.2).collect()}
    assert got[("Arma_Faca",)] == 12 and got[("Bairro_A",)] == 6 and got[("Bairro_B", "Turno_Tarde")] == 6
    assert got[("Dia_Monday",)] == 10
    assert ("Crime_Furto",) not in got
    assert all(n >= 2.4 for n in got.values())


def test_rules(baskets):
    got = {(tuple(r["antecedents"]), tuple(r["consequents"])): r for r in rules.association_rules(baskets, 0.2, 0.6).collect()}
    rule = got[("Bairro_B",), ("Crime_Roubo",)]
    assert (rule["support"], rule["confidence"], rule["lift"]) == (0.333, 0.67, 0.8)
    pair = got[("Bairro_A",), ("Crime_Roubo", "Turno_Noite")]
    assert (pair["confidence"], pair["lift"]) == (1.0, 2.0)
    for (a, c), r in got.items():
        assert not set(a) & set(c)
        if (c, a) in got:
            assert got[c, a]["lift"] == r["lift"]


def test_too_few_transactions(baskets):
    assert rules.frequent_itemsets(baskets.limit(5), 0.1).count() == 0
    assert rules.association_rules(baskets.limit(5)).count() == 0


def test_correlation_of_constant_and_few_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0)], "a double, b double, c double")
    got = {(r["a"], r["b"]): r["correlacao"] for r in agg.correlation(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == 1.0 and got["a", "c"] is None and len(got) == 9
    assert agg.correlation(df, ["a", "b"]).count() == 0


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(0.5,)] * 4, "s double")
    got = agg.histogram(df, "s", 30).collect()
    assert len(got) == 30 and sum(r["n"] for r in got) == 4


def test_null_keys_drop_out(spark):
    df = spark.createDataFrame([("A", 1), ("A", 0), (None, 1)], "bairro string, risco_alto int")
    assert [tuple(r) for r in agg.risk_by(df, ["bairro"]).collect()] == [("A", 2, 1, 0.5)]


def test_kpis_of_nothing(spark):
    df = spark.createDataFrame([], "risco_alto int")
    assert tuple(agg.overall_kpis(df).first()) == (0, 0, 0.0, "SITUAÇÃO NORMAL")


def timed(spark, n, with_time=True):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(hours=i) if with_time else None, int(i % 4 == 0)) for i in range(n)]
    return spark.createDataFrame(rows, "id_ocorrencia long, data_ocorrencia timestamp_ntz, risco_alto int")


def sizes(frame):
    return {r["parte"]: r["n"] for r in frame.groupBy("parte").agg(F.count("*").alias("n")).collect()}


def test_temporal_split_and_fallbacks(spark):
    assert sizes(splits.temporal_split(timed(spark, 100))) == {"train": 70, "test": 30}
    assert sizes(splits.temporal_split(timed(spark, 20))) == {"train": 16, "test": 4}
    assert sizes(splits.temporal_split(timed(spark, 100, with_time=False))) == {"train": 80, "test": 20}
    no_column = timed(spark, 100).drop("data_ocorrencia")
    assert sizes(splits.temporal_split_3way(no_column)) == {"train": 70, "test": 30}
    assert sizes(splits.temporal_split_3way(timed(spark, 100))) == {"train": 60, "valid": 25, "test": 15}
    assert sizes(splits.temporal_split_3way(timed(spark, 40))) == {"train": 30, "test": 10}


def test_stratified_split_keeps_the_shares(spark):
    out = splits.stratified_split(timed(spark, 100), 0.2)
    got = {(r["parte"], r["risco_alto"]): r["n"] for r in out.groupBy("parte", "risco_alto").agg(F.count("*").alias("n")).collect()}
    assert got == {("test", 0): 15, ("test", 1): 5, ("train", 0): 60, ("train", 1): 20}


def test_balanced_weights(spark):
    got = {r["risco_alto"]: r["peso"] for r in splits.class_weights(timed(spark, 100)).collect()}
    assert got == {0: 100 / (2 * 75), 1: 2.0}


def test_three_months(spark):
    df = spark.createDataFrame([("2024-01", 1), ("2024-02", 0), ("2024-03", 1), ("2024-03", 0), (None, 1)], "ano_mes string, risco_alto int")
    assert [tuple(r) for r in agg.monthly_rate(df).collect()] == [("2024-01", 1.0), ("2024-02", 0.0), ("2024-03", 0.5)]
