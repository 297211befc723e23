"""Reading, cleaning, filters and scoring on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from riskframe.operators import filters, prep, scoring
from riskframe.sources import incidents

CSV = """id_ocorrencia,data_ocorrencia,bairro,tipo_crime,arma_utilizada,quantidade_suspeitos,idade_suspeito
1,2024-01-01 10:00:00,Centro,Roubo,Faca,2,30
2,not a date,Centro,Furto,,x,
3,2024-01-06,NA,Homicídio,Arma de Fogo,1,70
4,2024-01-02T23:30:00,Sul,,Explosivos,4,20
"""


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("csv") / "incidents.csv"
    path.write_text(CSV, encoding="utf-8")
    return incidents.read_csv(spark, str(path))


@pytest.fixture(scope="module")
def cleaned(raw):
    return prep.clean(raw, prep.fit_medians(raw))


def test_csv_cleaning(cleaned):
    rows = {r["id_ocorrencia"]: r for r in cleaned.collect()}
    assert rows[2]["data_ocorrencia"] is None and rows[2]["turno"] == "Não Informado" and rows[2]["hora"] is None
    assert rows[3]["bairro"] == "Não Informado" and rows[3]["hora"] == 0 and rows[3]["fim_semana"] == 1
    assert rows[4]["tipo_crime"] == "Não Informado" and rows[4]["turno"] == "Noite"
    assert rows[2]["arma_utilizada"] is None and rows[2]["risco_alto"] == 0
    assert [rows[i]["risco_alto"] for i in (1, 3, 4)] == [0, 1, 1]
    assert rows[2]["quantidade_suspeitos"] == 2.0 and rows[2]["idade_suspeito"] == 30.0
    assert "latitude" not in cleaned.columns


def test_scoring_without_optional_columns(cleaned):
    scored = scoring.with_risk(cleaned.drop("quantidade_suspeitos", "idade_suspeito"))
    assert {r["suspect_risk"] for r in scored.collect()} == {0.3}


def test_location_risk_uses_history(spark, cleaned):
    history = spark.createDataFrame([("Centro", 1), ("Centro", 0), ("Centro", 0), ("Centro", 0)], "bairro string, risco_alto int")
    got = {r["bairro"]: r["location_risk"] for r in scoring.with_risk(cleaned, history).collect()}
    assert got == {"Centro": 0.5, "Sul": 0.5, "Não Informado": 0.5}
    own = {r["bairro"]: r["location_risk"] for r in scoring.with_risk(cleaned).collect()}
    assert own == {"Centro": 0.0, "Sul": 1.0, "Não Informado": 1.0}


def test_time_column_fallback(spark):
    df = spark.createDataFrame([("2024-01-01",)], "Data_Registro string")
    assert incidents.with_time_column(df).first()["data_ocorrencia"] == dt.datetime(2024, 1, 1)
    plain = spark.createDataFrame([(1,)], "x int")
    assert incidents.with_time_column(plain).columns == ["x"]


def test_required_columns(raw):
    assert incidents.require_columns(raw).columns == ["data_ocorrencia", "bairro", "tipo_crime", "arma_utilizada"]
    with pytest.raises(ValueError, match="latitude"):
        incidents.require_columns(raw, ["latitude"])


def test_date_filter_is_inclusive_by_day(spark):
    day = dt.datetime(2024, 1, 2)
    times = [day - dt.timedelta(microseconds=1), day, day + dt.timedelta(hours=23), day + dt.timedelta(days=1), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id_ocorrencia int, data_ocorrencia timestamp_ntz")
    ids = lambda f: sorted(r[0] for r in f.collect())
    assert ids(filters.in_dates(df, day.date(), day.date())) == [1, 2]
    assert ids(filters.in_dates(df, day.date(), day.date(), end_inclusive_midnight=True)) == [1, 2, 3]


def test_pick_all_means_no_filter(cleaned):
    assert filters.pick(cleaned).count() == 4
    assert filters.pick(cleaned, place="Centro", shifts=["Manhã"]).count() == 1
    assert filters.pick(cleaned, weapon="Faca", shifts=[]).count() == 1


def test_size_guard(cleaned):
    assert filters.at_least(cleaned, 4, "x") is cleaned
    with pytest.raises(filters.TooFewRows):
        filters.at_least(cleaned, 5, "x")


def test_last_hours_of_empty_frame(spark):
    df = spark.createDataFrame([], "id_ocorrencia int, data_ocorrencia timestamp_ntz")
    assert filters.last_hours(df).count() == 0


def test_date_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "a")], "id_ocorrencia long, data_ocorrencia timestamp_ntz, bairro string").write.parquet(path)
    df = filters.in_dates(spark.read.parquet(path), dt.date(2024, 1, 1), dt.date(2024, 1, 2)).select("id_ocorrencia")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(data_ocorrencia" in plan and "bairro" not in plan


def test_cleaning_and_scoring_need_no_shuffle(data):
    plan = data.scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Python" not in plan


def test_report_file(spark, data, tmp_path):
    from riskframe.operators.report import report_lines, summary_lines

    incidents.write_report(report_lines(data.clean, "2025-01-01 00:00:00", {"f1": 0.5, "roc_auc": float("nan")}), str(tmp_path / "r"))
    text = "\n".join(r[0] for r in spark.read.text(str(tmp_path / "r")).collect())
    assert text.startswith("Relatório") and " - F1: 0.500" in text and "ROC_AUC" not in text
    empty = data.clean.where(F.lit(False))
    assert [r["text"] for r in summary_lines(empty).collect()] == ["Sem registros no filtro atual."]
    assert report_lines(empty, "t").count() == 7
