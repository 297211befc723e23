"""Hand-computed values of the scalar expressions."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F
from riskframe.functions import risk
from riskframe.functions.numeric import as_number, np_round, safe_ratio
from riskframe.functions.timeparts import event_micros, shift_of_hour, time_parts


def values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_np_round_is_half_even_after_scaling(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (0.125,), (None,)], "x double")
    assert values(df, np_round(F.col("x"), 0)) == [0.0, 2.0, 2.0, 0.0, None]
    assert values(df, np_round(F.col("x"), 2))[3] == 0.12


def test_as_number(spark):
    df = spark.createDataFrame([("2",), ("x",), ("NaN",), ("",), (None,)], "x string")
    assert values(df, as_number(F.col("x"))) == [2.0, None, None, None, None]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (0, 0)], "a long, b long")
    assert values(df, safe_ratio(F.col("a"), F.col("b"))) == [0.5, 0.0, 0.0]


def test_shift_edges(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 23, None]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    assert values(df, shift_of_hour(F.col("h"))) == [
        "Madrugada", "Madrugada", "Manhã", "Manhã", "Tarde", "Tarde", "Noite", "Noite", "Não Informado",
    ]


def test_time_parts(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 3, 23, 59, 59, 7),), (None,)], "t timestamp_ntz")
    parts = time_parts(F.col("t"))
    rows = df.select(*[e.alias(n) for n, e in parts.items()], event_micros(F.col("t")).alias("us")).collect()
    assert rows[0].asDict() == {
        "ano": 2024, "mes": 3, "dia": 3, "hora": 23, "dia_semana": "Sunday", "dia_semana_idx": 6,
        "ano_mes": "2024-03", "fim_semana": 1, "turno": "Noite", "us": 1709510399000007,
    }
    assert set(rows[1].asDict().values()) == {None, "Não Informado"}


@pytest.mark.parametrize("weapon,value", [("Arma de Fogo", 1.0), ("Faca", 0.6), ("Nenhum", 0.1), ("", 0.3), (None, 0.3), ("?", 0.3)])
def test_weapon_risk(spark, weapon, value):
    df = spark.createDataFrame([(weapon,)], "w string")
    assert values(df, risk.weapon_risk(F.col("w"))) == [value]


def test_suspect_risk(spark):
    base = {None: 0.3, -1.0: 0.0, 0.0: 0.1, 1.0: 0.3, 1.5: 0.0, 2.0: 0.6, 2.5: 0.0, 3.0: 0.9, 9.0: 0.9}
    shift = {None: 0.0, 25.0: 0.1, 26.0: 0.0, 49.0: 0.0, 50.0: -0.1}
    cases = list(itertools.product(base, shift))
    df = spark.createDataFrame(cases, "s double, a double")
    got = values(df, risk.suspect_risk(F.col("s"), F.col("a")))
    assert got == [min(max(base[s] + shift[a], 0.0), 1.0) for s, a in cases]
    assert values(df.limit(1), risk.suspect_risk(F.lit(1.5), round_counts=True)) == [0.6]


def test_temporal_risk(spark):
    rows = [("Noite", 3, 0), ("?", 23, 0), ("?", 6, 0), ("?", 12, 6), ("?", 21, 4), ("?", None, 5), (None, None, None)]
    df = spark.createDataFrame(rows, "t string, h int, d int")
    got = values(df, risk.temporal_risk(F.col("h"), F.col("d"), F.col("t")))
    assert got == pytest.approx([0.8, 0.8, 0.3, 0.6, 0.8, 0.6, 0.5])


def test_band_edges(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.3, 0.3000001, 0.7, 0.7000001, 1.0)], "s double")
    assert values(df, risk.risk_band(F.col("s"))) == ["Baixo", "Baixo", "Médio", "Médio", "Alto", "Alto"]


def test_recommendation(spark):
    df = spark.createDataFrame(
        [(0.85, "Homicídio", "Arma de Fogo", 3.0), (0.65, "Furto", "Faca", 1.0), (0.4, None, None, None), (0.1, "Furto", "Nenhum", 3.0)],
        "s double, c string, w string, n double",
    )
    rows = df.select(risk.recommendation(F.col("s"), F.col("c"), F.col("w"), F.col("n")).alias("r")).select("r.*").collect()
    assert [r.priority_level for r in rows] == ["Critical", "High", "Medium", "Low"]
    assert [r.response_protocol for r in rows] == ["High Risk", "Enhanced", "Standard", "Standard"]
    assert [r.backup_required for r in rows] == [True, True, False, True]
    assert [len(r.tactical_notes) for r in rows] == [4, 2, 1, 2]
    assert rows[0].special_equipment == ["Colete balístico", "Escudo tático"]
    assert rows[1].special_equipment == ["Escudo tático"]
