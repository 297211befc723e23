"""Queries that return incidents: scans, cleaning, filters, scoring."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from riskframe.functions import risk
from riskframe.functions.numeric import np_round
from riskframe.functions.timeparts import shift_of_hour, time_parts
from riskframe.operators import filters, geo, prep, scoring, splits
from riskframe.operators.rules import transactions
from riskframe.plans.data import SCORE_NUMBERS, time_text
from riskframe.plans.oracle import (
    RAW,
    clean_cte,
    on_clean,
    on_flags,
    on_raw,
    on_scored,
    r,
    shift_sql,
    ts_text,
)
from riskframe.plans.registry import query
from riskframe.schema import IGNORED, RAW_SCHEMA, UNKNOWN_SHIFT
from riskframe.sources import incidents

ID = "id_ocorrencia"
START, END = dt.date(2024, 1, 5), dt.date(2024, 1, 20)
_OTHER_RAW = [c for c in RAW_SCHEMA.names if c not in (ID, "data_ocorrencia")]


@query(
    "scan_incidents",
    on_raw(f"select id_ocorrencia, {ts_text('data_ocorrencia')} as data_ocorrencia, {', '.join(_OTHER_RAW)} from raw"),
)
def scan_incidents(data):
    return data.raw.select(ID, time_text("data_ocorrencia").alias("data_ocorrencia"), *_OTHER_RAW)


@query("detect_time_column", on_raw(f"select id_ocorrencia, {ts_text('data_ocorrencia')} as momento from raw"))
def detect_time_column(data):
    renamed = data.raw.withColumnRenamed("data_ocorrencia", "data_registro")
    return incidents.with_time_column(renamed).select(ID, time_text("data_ocorrencia").alias("momento"))


@query(
    "safe_columns",
    on_raw(f"select {ts_text('data_ocorrencia')} as momento, bairro, tipo_crime, arma_utilizada from raw"),
)
def safe_columns(data):
    return incidents.require_columns(data.raw).select(
        time_text("data_ocorrencia").alias("momento"), "bairro", "tipo_crime", "arma_utilizada"
    )


@query(
    "preview",
    on_raw(
        "select id_ocorrencia, bairro, tipo_crime, arma_utilizada, (select count(*) from raw) as n_rows, "
        "cast(14 as bigint) as n_columns from raw order by id_ocorrencia limit 5"
    ),
)
def preview(data):
    return incidents.preview(data.raw, ID).select(
        ID, "bairro", "tipo_crime", "arma_utilizada", "n_rows", "n_columns"
    )


_CLEAN_COLUMNS = (
    "bairro, tipo_crime, sexo_suspeito, orgao_responsavel, status_investigacao, descricao_modus_operandi, "
    "arma_utilizada, quantidade_vitimas, quantidade_suspeitos, idade_suspeito, latitude, longitude, turno, risco_alto"
)


@query(
    "clean_incidents",
    on_clean(f"select id_ocorrencia, {ts_text('data_ocorrencia')} as momento, {_CLEAN_COLUMNS} from clean"),
)
def clean_incidents(data):
    return data.clean.select(ID, time_text("data_ocorrencia").alias("momento"), *_CLEAN_COLUMNS.split(", "))


@query(
    "clean_older_labels",
    f"with {RAW},{clean_cte(IGNORED, UNKNOWN_SHIFT)}\n"
    "select id_ocorrencia, bairro, sexo_suspeito, descricao_modus_operandi, turno from clean",
)
def clean_older_labels(data):
    older = prep.clean(data.raw, {}, IGNORED, UNKNOWN_SHIFT)
    return older.select(ID, "bairro", "sexo_suspeito", "descricao_modus_operandi", "turno")


_PARTS = "ano, mes, dia, hora, dia_semana, dia_semana_idx, ano_mes, fim_semana"


@query("time_parts", on_clean(f"select id_ocorrencia, {_PARTS} from clean"))
def time_parts_query(data):
    parts = time_parts(F.col("data_ocorrencia"))
    return data.raw.select(ID, *[parts[c].alias(c) for c in _PARTS.split(", ")])


@query(
    "shift_of_day",
    on_raw(f"select id_ocorrencia, {shift_sql('hour(data_ocorrencia)')} as turno from raw"),
)
def shift_of_day(data):
    return data.raw.select(ID, shift_of_hour(F.hour("data_ocorrencia")).alias("turno"))


@query(
    "high_risk_flag",
    on_raw(
        "select id_ocorrencia, cast(coalesce(arma_utilizada = 'Arma de Fogo' or arma_utilizada = 'Explosivos', false) "
        "as integer) as risco_alto from raw"
    ),
)
def high_risk_flag(data):
    return data.plain.select(ID, "risco_alto")


@query(
    "impute_median",
    on_clean(
        "select id_ocorrencia, quantidade_vitimas, quantidade_suspeitos, idade_suspeito, "
        f"{r('latitude')} as latitude, {r('longitude')} as longitude from clean"
    ),
)
def impute_median(data):
    return data.clean.select(
        ID,
        "quantidade_vitimas",
        "quantidade_suspeitos",
        "idade_suspeito",
        np_round(F.col("latitude"), 6).alias("latitude"),
        np_round(F.col("longitude"), 6).alias("longitude"),
    )


@query("feature_flags", on_flags("select id_ocorrencia, arma_letal, crime_violento, periodo_noturno from flags"))
def feature_flags(data):
    return prep.with_flags(data.plain).select(ID, "arma_letal", "crime_violento", "periodo_noturno")


@query(
    "rule_items",
    on_clean(
        "select id_ocorrencia, concat('Bairro_', bairro) || '|' || concat('Crime_', tipo_crime) || '|' || "
        "concat('Arma_', arma_utilizada) || '|' || concat('Turno_', turno) || "
        "coalesce('|Dia_' || dia_semana, '') as itens from clean where risco_alto = 1"
    ),
)
def rule_items(data):
    return transactions(data.plain).select(ID, F.array_join("items", "|").alias("itens"))


# --- filters ------------------------------------------------------------------------


@query(
    "filter_date_range",
    on_clean(
        "select id_ocorrencia, bairro, risco_alto from clean "
        f"where cast(data_ocorrencia as date) between date '{START}' and date '{END}'"
    ),
)
def filter_date_range(data):
    return filters.in_dates(data.plain, START, END).select(ID, "bairro", "risco_alto")


@query(
    "filter_date_range_older",
    on_clean(
        "select id_ocorrencia, bairro, risco_alto from clean "
        f"where data_ocorrencia >= timestamp '{START} 00:00:00' "
        f"and data_ocorrencia <= timestamp '{END} 00:00:00' + interval 1 day"
    ),
)
def filter_date_range_older(data):
    return filters.in_dates(data.plain, START, END, end_inclusive_midnight=True).select(ID, "bairro", "risco_alto")


@query(
    "filter_incidents",
    on_clean(
        "select id_ocorrencia, tipo_crime, arma_utilizada, turno from clean where bairro = 'NATION_11' "
        "and arma_utilizada = 'Faca' and turno in ('Noite', 'Madrugada')"
    ),
)
def filter_incidents(data):
    picked = filters.pick(data.plain, place="NATION_11", weapon="Faca", shifts=["Noite", "Madrugada"])
    return picked.select(ID, "tipo_crime", "arma_utilizada", "turno")


@query(
    "filter_options",
    on_clean(
        "select distinct 'bairro' as field, bairro as value from clean "
        "union all select distinct 'tipo_crime', tipo_crime from clean where bairro = 'NATION_11' "
        "union all select distinct 'arma_utilizada', arma_utilizada from clean "
        "where bairro = 'NATION_11' and tipo_crime = 'Roubo' and arma_utilizada is not null"
    ),
)
def filter_options(data):
    return filters.cascading_options(data.plain, place="NATION_11", crime="Roubo")


@query(
    "date_bounds",
    on_clean(
        "select strftime(min(data_ocorrencia), '%Y-%m-%d') as min_date, "
        "strftime(max(data_ocorrencia), '%Y-%m-%d') as max_date from clean"
    ),
)
def date_bounds(data):
    return filters.date_bounds(data.plain).select(
        F.date_format("min_date", "yyyy-MM-dd").alias("min_date"),
        F.date_format("max_date", "yyyy-MM-dd").alias("max_date"),
    )


@query(
    "recent_rows",
    on_clean(
        f"select id_ocorrencia, {ts_text('data_ocorrencia')} as momento, bairro from clean "
        "order by data_ocorrencia desc nulls last, id_ocorrencia desc limit 200"
    ),
)
def recent_rows(data):
    return filters.newest(data.plain).select(ID, time_text("data_ocorrencia").alias("momento"), "bairro")


@query(
    "last_24h",
    on_clean(
        f"select id_ocorrencia, {ts_text('data_ocorrencia')} as momento, bairro from clean "
        "where data_ocorrencia > (select max(data_ocorrencia) from clean) - interval 24 hours"
    ),
)
def last_24h(data):
    return filters.last_hours(data.plain, 24).select(ID, time_text("data_ocorrencia").alias("momento"), "bairro")


# --- scoring ------------------------------------------------------------------------


@query("weapon_risk", on_scored("select id_ocorrencia, arma_utilizada, weapon_risk from scored"))
def weapon_risk(data):
    return data.plain.select(ID, "arma_utilizada", risk.weapon_risk(F.col("arma_utilizada")).alias("weapon_risk"))


@query("crime_risk", on_scored("select id_ocorrencia, tipo_crime, crime_risk from scored"))
def crime_risk(data):
    return data.plain.select(ID, "tipo_crime", risk.crime_risk(F.col("tipo_crime")).alias("crime_risk"))


@query("suspect_risk", on_scored(f"select id_ocorrencia, {r('suspect_risk', 9)} as suspect_risk from scored"))
def suspect_risk(data):
    value = risk.suspect_risk(F.col("quantidade_suspeitos"), F.col("idade_suspeito"))
    return data.filled(*SCORE_NUMBERS).select(ID, np_round(value, 9).alias("suspect_risk"))


@query("location_risk", on_scored("select id_ocorrencia, bairro, location_risk from scored"))
def location_risk(data):
    return data.scored.select(ID, "bairro", "location_risk")


@query("temporal_risk", on_scored(f"select id_ocorrencia, {r('temporal_risk', 9)} as temporal_risk from scored"))
def temporal_risk(data):
    value = risk.temporal_risk(F.col("hora"), F.col("dia_semana_idx"), F.col("turno"))
    return data.plain.select(ID, np_round(value, 9).alias("temporal_risk"))


@query("risk_score", on_scored(f"select id_ocorrencia, {r('risk_score', 9)} as risk_score from scored"))
def risk_score(data):
    return data.scored.select(ID, np_round(F.col("risk_score"), 9).alias("risk_score"))


@query(
    "risk_category",
    on_scored(f"select id_ocorrencia, bairro, {r('risk_score', 9)} as risk_score, risk_category from scored"),
)
def risk_category(data):
    return data.scored.select(ID, "bairro", np_round(F.col("risk_score"), 9).alias("risk_score"), "risk_category")


_VIOLENT3 = "tipo_crime in ('Homicídio', 'Latrocínio', 'Sequestro')"
_LETHAL = "coalesce(arma_utilizada in ('Arma de Fogo', 'Explosivos'), false)"


@query(
    "risk_recommendations",
    on_scored(
        f"""select id_ocorrencia,
  case when risk_score >= 8e-1 then 'Critical' when risk_score >= 6e-1 then 'High'
    when risk_score >= 4e-1 then 'Medium' else 'Low' end as priority_level,
  case when {_VIOLENT3} or risk_score >= 8e-1 then 'High Risk' when risk_score >= 6e-1 then 'Enhanced'
    else 'Standard' end as response_protocol,
  cast(risk_score >= 6e-1 or {_LETHAL} or quantidade_suspeitos >= 3 or {_VIOLENT3} as integer) as backup_required,
  case when {_LETHAL} then 'Colete balístico; Escudo tático' when arma_utilizada = 'Faca' then 'Escudo tático'
    else '' end as special_equipment,
  case when risk_score >= 8e-1 then 'Situação de alto risco - extrema cautela'
    when risk_score >= 6e-1 then 'Risco elevado - solicitar backup'
    when risk_score >= 4e-1 then 'Risco moderado - manter protocolo padrão'
    else 'Risco baixo - abordagem padrão' end
  || case when {_LETHAL} then '; ARMA LETAL PRESENTE - máxima cautela'
    when arma_utilizada = 'Faca' then '; Arma branca - manter distância' else '' end
  || case when quantidade_suspeitos >= 3 then '; Múltiplos suspeitos - necessário reforço' else '' end
  || case when {_VIOLENT3} then '; Crime violento - protocolo especial' else '' end as tactical_notes
from scored"""
    ),
)
def risk_recommendations(data):
    return scoring.with_recommendation(data.scored).select(
        ID,
        "priority_level",
        "response_protocol",
        F.col("backup_required").cast("int").alias("backup_required"),
        F.array_join("special_equipment", "; ").alias("special_equipment"),
        F.array_join("tactical_notes", "; ").alias("tactical_notes"),
    )


@query(
    "high_risk_alerts",
    on_scored(
        f"select id_ocorrencia, bairro, {r('risk_score', 9)} as risk_score, "
        "'Situação de alto risco - extrema cautela' as tactical_recommendation from scored where risk_score >= 8e-1"
    ),
)
def high_risk_alerts(data):
    return scoring.high_risk_alerts(data.scored).select(
        ID, "bairro", np_round(F.col("risk_score"), 9).alias("risk_score"), "tactical_recommendation"
    )


@query(
    "rule_baseline",
    on_clean(
        """select id_ocorrencia, risco_alto, cast(coalesce(tipo_crime in ('Latrocínio', 'Homicídio', 'Roubo',
  'Tráfico de Drogas', 'Estupro', 'Sequestro'), false) or coalesce(quantidade_suspeitos >= 2, false)
  or coalesce(dia_semana_idx in (0, 1, 2, 4, 5, 6), false) as integer) as rule_prediction from clean"""
    ),
)
def rule_baseline(data):
    return scoring.rule_baseline(data.filled("quantidade_suspeitos")).select(ID, "risco_alto", "rule_prediction")


@query(
    "geo_points",
    on_clean(
        """, low as (select id_ocorrencia from clean where risco_alto = 0
  order by md5('42:' || cast(id_ocorrencia as varchar)), id_ocorrencia limit 1000)
select id_ocorrencia, """
        f"""{r('latitude')} as latitude, {r('longitude')} as longitude, risco_alto,
  case when risco_alto = 1 then 'Bairro: ' || bairro || '<br>Crime: ' || tipo_crime || '<br>Arma: '
    || coalesce(arma_utilizada, 'N/A') else bairro end as texto
from clean where risco_alto = 1 or id_ocorrencia in (select id_ocorrencia from low)"""
    ),
)
def geo_points(data):
    return geo.geo_points(data.filled("latitude", "longitude")).select(
        ID,
        np_round(F.col("latitude"), 6).alias("latitude"),
        np_round(F.col("longitude"), 6).alias("longitude"),
        "risco_alto",
        "texto",
    )


@query("geo_center", on_clean(f"select {r('avg(latitude)')} as latitude, {r('avg(longitude)')} as longitude from clean"))
def geo_center(data):
    return geo.geo_center(data.filled("latitude", "longitude"))


# --- splits -------------------------------------------------------------------------

_CUT = """, cut as (select quantile_cont(epoch_us(data_ocorrencia), [6e-1, 7e-1, 85e-2]) as q from clean)"""


@query(
    "temporal_split",
    on_clean(
        _CUT + "\nselect id_ocorrencia, case when epoch_us(data_ocorrencia) <= q[2] then 'train' else 'test' end as parte "
        "from clean cross join cut"
    ),
)
def temporal_split(data):
    return splits.temporal_split(data.kept_plain).select(ID, "parte")


_THREE = (
    _CUT
    + """, split as (select clean.*, case when epoch_us(data_ocorrencia) <= q[1] then 'train'
  when epoch_us(data_ocorrencia) <= q[3] then 'valid' else 'test' end as parte
  from clean cross join cut where data_ocorrencia is not null)"""
)


def three_way(data):
    return splits.temporal_split_3way(data.kept_plain)


@query("temporal_split_3way", on_clean(_THREE + "\nselect id_ocorrencia, parte from split"))
def temporal_split_3way(data):
    return three_way(data).select(ID, "parte")


FIRST_CUT, SECOND_CUT = dt.date(2024, 1, 18), dt.date(2024, 1, 25)


@query(
    "fixed_date_split",
    on_clean(
        f"""select id_ocorrencia, case when data_ocorrencia <= timestamp '{FIRST_CUT} 00:00:00' then 'train'
  when data_ocorrencia <= timestamp '{SECOND_CUT} 00:00:00' then 'valid' else 'test' end as parte
from clean where data_ocorrencia is not null"""
    ),
)
def fixed_date_split(data):
    return splits.fixed_date_split(data.plain, FIRST_CUT, SECOND_CUT).select(ID, "parte")


@query(
    "split_summary",
    on_clean(
        _THREE + f"\nselect parte, {ts_text('min(data_ocorrencia)')} as inicio, {ts_text('max(data_ocorrencia)')} as fim, "
        "count(*) as tamanho from split group by parte"
    ),
)
def split_summary(data):
    return splits.split_summary(three_way(data)).select(
        "parte", time_text("inicio").alias("inicio"), time_text("fim").alias("fim"), "tamanho"
    )


@query(
    "split_overlap",
    on_clean(
        _THREE
        + """, pairs as (select * from (values ('train', 'valid'), ('train', 'test'), ('valid', 'test')) t(a, b))
select a, b, (select count(*) from split s where s.parte = pairs.a and exists
  (select 1 from split o where o.parte = pairs.b and o.id_ocorrencia = s.id_ocorrencia)) as comuns from pairs"""
    ),
)
def split_overlap(data):
    return splits.split_overlap(three_way(data))


@query(
    "class_weights",
    on_clean(
        f"""select risco_alto, count(*) as n, {r('(select count(*) from clean) / (2e0 * count(*))')} as peso
from clean group by risco_alto"""
    ),
)
def class_weights(data):
    return splits.class_weights(data.plain).withColumn("peso", np_round(F.col("peso"), 6))


@query(
    "dummy_baseline",
    on_clean(
        _THREE
        + """, major as (select risco_alto as m from split where parte = 'train' group by 1
  order by count(*) desc, risco_alto limit 1)
select id_ocorrencia, risco_alto, m as dummy_prediction from split cross join major where parte = 'valid'"""
    ),
)
def dummy_baseline(data):
    split = three_way(data)
    label = splits.majority_label(splits.part(split, "train"))
    return splits.part(split, "valid").select(ID, "risco_alto", F.lit(label).alias("dummy_prediction"))
