"""Building blocks of the ANSI SQL twins that DuckDB runs on the test tables."""

from __future__ import annotations

from riskframe.schema import (
    CRIME_RISK,
    FILLED_NUMBERS,
    FILLED_TEXT,
    RISK_WEIGHTS,
    SHIFT_RISK,
    WEAPON_RISK,
)

RAW = """
raw as (
select e.event_id as id_ocorrencia,
  case when e.event_id % 97 = 0 then null else e.ts end as data_ocorrencia,
  case when e.event_id % 41 = 0 then null else n.n_name end as bairro,
  case e.h % 10 when 0 then 'Homicídio' when 1 then 'Latrocínio' when 2 then 'Sequestro'
    when 3 then 'Tráfico de Drogas' when 4 then 'Roubo' when 5 then 'Estupro' when 6 then 'Ameaça'
    when 7 then 'Violência Doméstica' when 8 then 'Furto' else 'Estelionato' end as tipo_crime,
  case when e.event_id % 53 = 0 then null
    when e.w < 5 - e.h % 10 then 'Arma de Fogo'
    when e.w = 9 and e.h % 2 = 0 then 'Explosivos'
    when e.w in (1, 2, 6) then 'Faca'
    when e.w in (3, 7) then 'Objeto Contundente' else 'Nenhum' end as arma_utilizada,
  cast(case when e.event_id % 31 = 0 then null else e.h % 4 end as double) as quantidade_suspeitos,
  cast(e.w % 4 as double) as quantidade_vitimas,
  cast(case when e.event_id % 29 = 0 then null else 16 + e.h % 50 end as double) as idade_suspeito,
  case when e.h % 5 < 3 then 'M' when e.h % 5 = 3 then 'F' else null end as sexo_suspeito,
  case when e.event_id % 37 = 0 then null else -8.05e0 + (e.h % 100) / 1000e0 end as latitude,
  -34.90e0 + (e.w * 7 % 100) / 1000e0 as longitude,
  case e.user_id % 3 when 0 then 'Unidade A' when 1 then 'Unidade B' else 'Unidade C' end as orgao_responsavel,
  case e.event_id % 4 when 0 then 'Aberto' when 1 then 'Em andamento' when 2 then 'Concluído' else null end as status_investigacao,
  e.event_type as descricao_modus_operandi
from (select *, cast(floor(h / 10e0) as bigint) % 10 as w
      from (select *, cast(round(value * 100) as bigint) * 7919 % 10007 + event_id * 31 % 101 as h from events) e0) e
join customer c on e.user_id = c.c_custkey
join nation n on c.c_nationkey = n.n_nationkey
)"""

LETHAL = "coalesce(arma_utilizada in ('Arma de Fogo', 'Explosivos'), false)"


def shift_sql(hour: str, missing: str = "Não Informado") -> str:
    return (
        f"case when {hour} is null then '{missing}' when {hour} < 6 then 'Madrugada' "
        f"when {hour} < 12 then 'Manhã' when {hour} < 18 then 'Tarde' else 'Noite' end"
    )


def _text(label: str) -> str:
    return ", ".join(f"coalesce({c}, '{label}') as {c}" for c in FILLED_TEXT)


def clean_cte(label: str = "Não Informado", missing_shift: str = "Não Informado") -> str:
    medians = ", ".join(f"quantile_cont({c}, 5e-1) as m_{c}" for c in FILLED_NUMBERS)
    numbers = ", ".join(f"coalesce({c}, m_{c}) as {c}" for c in FILLED_NUMBERS)
    return f"""
med as (select {medians} from raw),
clean as (select id_ocorrencia, data_ocorrencia, {_text(label)}, arma_utilizada, {numbers},
  cast(year(data_ocorrencia) as integer) as ano, cast(month(data_ocorrencia) as integer) as mes,
  cast(day(data_ocorrencia) as integer) as dia, cast(hour(data_ocorrencia) as integer) as hora,
  dayname(data_ocorrencia) as dia_semana, cast(isodow(data_ocorrencia) - 1 as integer) as dia_semana_idx,
  strftime(data_ocorrencia, '%Y-%m') as ano_mes,
  cast(isodow(data_ocorrencia) in (6, 7) as integer) as fim_semana,
  {shift_sql('hour(data_ocorrencia)', missing_shift)} as turno,
  cast({LETHAL} as integer) as risco_alto
  from raw cross join med)"""


CLEAN = clean_cte()


def map_sql(column: str, table: dict[str, float], default: str) -> str:
    cases = " ".join(f"when '{k}' then {num(v)}" for k, v in table.items())
    return f"case {column} {cases} else {default} end"


def num(x: float) -> str:
    """A double literal; a plain 0.3 would be a decimal."""
    text = repr(float(x))
    return text if "e" in text else text + "e0"


SUSPECT = """least(greatest(case when quantidade_suspeitos is null then 3e-1 when quantidade_suspeitos >= 3 then 9e-1
  when quantidade_suspeitos = 2 then 6e-1 when quantidade_suspeitos = 1 then 3e-1
  when quantidade_suspeitos = 0 then 1e-1 else 0e0 end
  + case when idade_suspeito <= 25 then 1e-1 when idade_suspeito >= 50 then -1e-1 else 0e0 end, 0e0), 1e0)"""
BY_HOUR = """case when hora is null then 5e-1 when hora between 6 and 11 then 3e-1
  when hora between 12 and 17 then 5e-1 when hora between 18 and 21 then 7e-1 else 8e-1 end"""
TEMPORAL = (
    f"least(greatest({map_sql('turno', SHIFT_RISK, BY_HOUR)} "
    "+ case when dia_semana_idx in (4, 5, 6) then 1e-1 else 0e0 end, 0e0), 1e0)"
)
_TOTAL = " + ".join(f"{name} * {num(weight)}" for name, weight in RISK_WEIGHTS.items())

SCORED = f"""
rates as (select bairro, avg(risco_alto) as place_rate from clean group by bairro),
parts as (select clean.*, {map_sql('arma_utilizada', WEAPON_RISK, '3e-1')} as weapon_risk,
  {map_sql('tipo_crime', CRIME_RISK, '3e-1')} as crime_risk, {SUSPECT} as suspect_risk,
  case when place_rate is null then 5e-1 else least(place_rate * 2, 1e0) end as location_risk, {TEMPORAL} as temporal_risk
  from clean left join rates using (bairro)),
scored0 as (select *, least(greatest({_TOTAL}, 0e0), 1e0) as risk_score from parts),
scored as (select *, case when risk_score <= 3e-1 then 'Baixo' when risk_score <= 7e-1 then 'Médio'
  else 'Alto' end as risk_category from scored0),
pred as (select id_ocorrencia, bairro, ano_mes, turno, tipo_crime, risco_alto as y, risk_score as score from scored)"""

FLAGS = """
flags as (select *, cast(coalesce(arma_utilizada in ('Arma de Fogo', 'Explosivos'), false) as integer) as arma_letal,
  cast(coalesce(tipo_crime in ('Homicídio', 'Latrocínio', 'Roubo', 'Sequestro', 'Tráfico de Drogas'), false) as integer) as crime_violento,
  cast(coalesce(turno in ('Noite', 'Madrugada'), false) as integer) as periodo_noturno from scored)"""


def r(x: str, places: int = 6) -> str:
    """Scale, round half to even, scale back."""
    scale = f"{10 ** places}e0"
    return f"(round_even(({x}) * {scale}, 0) / {scale})"


def pct_text(rate: str) -> str:
    return f"printf('%.1f%%', {r(f'({rate}) * 100', 1)})"


def ts_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def on_raw(body: str) -> str:
    return f"with {RAW}\n{body}"


def on_clean(body: str) -> str:
    return f"with {RAW},{CLEAN}\n{body}"


def on_scored(body: str) -> str:
    return f"with {RAW},{CLEAN},{SCORED}\n{body}"


def on_flags(body: str) -> str:
    return f"with {RAW},{CLEAN},{SCORED},{FLAGS}\n{body}"
