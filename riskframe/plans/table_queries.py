"""Queries that return grouped tables, patterns, rules and report lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.numeric import np_round
from riskframe.operators import aggregates as agg
from riskframe.operators import baskets, filters, patterns, report, rules
from riskframe.plans.data import time_text
from riskframe.plans.oracle import LETHAL, on_clean, on_scored, pct_text, r, ts_text
from riskframe.plans.registry import query
from riskframe.schema import FILLED_NUMBERS, FILLED_TEXT

CRT = "count(*) as total, cast(sum(risco_alto) as bigint) as alto_risco"
_RECENT = (
    ", recent as (select * from scored order by data_ocorrencia desc nulls last, id_ocorrencia desc limit 200)\n"
)


def _round_rate(df, places=6, *more):
    return agg.rounded(df, ["taxa_risco", *more], places)


@query(
    "overall_kpis",
    on_clean(
        f"""select total, alto_risco, {r('alto_risco / total * 100')} as taxa_pct,
  case when alto_risco / total * 100 >= 15 then 'ALERTA MÁXIMO' when alto_risco / total * 100 >= 10 then 'ATENÇÃO'
  else 'SITUAÇÃO NORMAL' end as alerta from (select {CRT} from clean)"""
    ),
)
def overall_kpis(data):
    return agg.overall_kpis(data.plain)


def _recent_sql(key, tail=""):
    return on_scored(
        _RECENT
        + f"""select *, case when taxa_risco * 100 >= 20 then 'alto' when taxa_risco * 100 >= 10 then 'medio'
  else 'baixo' end as alerta from (select {key}, {CRT}, {r('avg(risco_alto)', 2)} as taxa_risco,
  {r('avg(risk_score)', 2)} as score_medio from recent group by {key}) order by taxa_risco desc, {key} {tail}"""
    )


@query("recent_bairro_risk", _recent_sql("bairro", "limit 10"))
def recent_bairro_risk(data):
    return agg.group_alerts(filters.newest(data.scored), "bairro", 10)


@query("recent_turno_risk", _recent_sql("turno"))
def recent_turno_risk(data):
    return agg.group_alerts(filters.newest(data.scored), "turno")


@query(
    "alert_level",
    on_clean(
        """select bairro, case when avg(risco_alto) * 100 >= 20 then 'alto' when avg(risco_alto) * 100 >= 10 then 'medio'
  else 'baixo' end as grupo, case when avg(risco_alto) * 100 >= 15 then 'ALERTA MÁXIMO'
  when avg(risco_alto) * 100 >= 10 then 'ATENÇÃO' else 'SITUAÇÃO NORMAL' end as cidade,
  case when avg(risco_alto) * 100 >= 50 then 'alto' when avg(risco_alto) * 100 >= 25 then 'medio' else 'baixo' end as crime
from clean group by bairro"""
    ),
)
def alert_level(data):
    from riskframe.functions.risk import band

    pct = F.col("taxa_risco") * 100
    levels = {"grupo": agg.GROUP_ALERT, "cidade": agg.CITY_ALERT, "crime": agg.CRIME_ALERT}
    return agg.risk_by(data.plain, ["bairro"]).select(
        "bairro", *[band(pct, high, mid, names).alias(k) for k, (high, mid, names) in levels.items()]
    )


@query(
    "patrol_priority",
    on_clean(
        f"""select bairro, {r('avg(risco_alto) * 100')} as risco_pct, count(*) filter (where {LETHAL}) as armas
from clean group by bairro order by avg(risco_alto) desc, bairro limit 5"""
    ),
)
def patrol_priority(data):
    return agg.patrol_priority(data.plain)


@query(
    "weapon_pivot",
    on_clean(
        """select bairro, count(*) filter (where arma_utilizada = 'Arma de Fogo') as arma_de_fogo,
  count(*) filter (where arma_utilizada = 'Explosivos') as explosivos
from clean where arma_utilizada is not null group by bairro"""
    ),
)
def weapon_pivot(data):
    return agg.weapon_pivot(data.plain).withColumnsRenamed(
        {"Arma de Fogo": "arma_de_fogo", "Explosivos": "explosivos"}
    )


@query(
    "risk_by_weekday",
    on_clean(
        f"""select dia_semana, {CRT}, {r('avg(risco_alto)')} as taxa_risco, {r('avg(risco_alto) * 100')} as taxa_risco_pct
from clean where dia_semana is not null group by dia_semana"""
    ),
)
def risk_by_weekday(data):
    return _round_rate(agg.risk_by_weekday(data.plain), 6, "taxa_risco_pct")


@query(
    "risk_by_shift",
    on_clean(
        f"""select turno, {CRT}, {r('avg(risco_alto)')} as taxa_risco, count(*) filter (where {LETHAL}) as armas_letais,
  {r('avg(risco_alto) * 100')} as taxa_risco_pct from clean group by turno"""
    ),
)
def risk_by_shift(data):
    return _round_rate(agg.risk_by_shift(data.plain), 6, "taxa_risco_pct")


@query(
    "shift_metrics",
    on_clean(
        f"""select *, {r('taxa_risco * 100', 1)} as taxa_risco_pct from (select turno, {CRT},
  {r('avg(risco_alto)', 2)} as taxa_risco, {r('avg(quantidade_suspeitos)', 2)} as media_suspeitos,
  {r('avg(quantidade_vitimas)', 2)} as media_vitimas from clean group by turno)"""
    ),
)
def shift_metrics(data):
    return agg.shift_metrics(data.filled("quantidade_suspeitos", "quantidade_vitimas"))


@query(
    "crime_risk_rank",
    on_clean(
        f"""select *, taxa_risco * 100 as taxa_risco_pct, case when taxa_risco * 100 >= 50 then 'alto'
  when taxa_risco * 100 >= 25 then 'medio' else 'baixo' end as alerta from (select tipo_crime, {CRT},
  {r('avg(risco_alto)', 2)} as taxa_risco, {r('avg(quantidade_suspeitos)', 2)} as media_suspeitos
  from clean group by tipo_crime) order by taxa_risco desc, tipo_crime limit 8"""
    ),
)
def crime_risk_rank(data):
    return agg.crime_risk_rank(data.filled("quantidade_suspeitos"))


def _top_sql(key, above=None):
    inner = (
        f"select {key}, avg(risco_alto) as t from clean where {key} is not null "
        f"group by {key} order by t desc, {key} limit 3"
    )
    keep = f" where t > {above}" if above else ""
    return on_clean(f"select {key}, {r('t')} as taxa_risco from ({inner}){keep}")


@query("top_bairros", _top_sql("bairro"))
def top_bairros(data):
    return _round_rate(agg.top_rates(data.plain, "bairro", 3))


@query("top_hours", _top_sql("hora"))
def top_hours(data):
    return _round_rate(agg.top_rates(data.plain, "hora", 3))


@query("top_crimes", _top_sql("tipo_crime", "3e-1"))
def top_crimes(data):
    return _round_rate(agg.top_rates(data.plain, "tipo_crime", 3, above=0.3))


@query(
    "risk_statistics",
    on_clean(
        f"""select count(*) as total_ocorrencias, cast(sum(risco_alto) as bigint) as total_alto_risco,
  {r('avg(risco_alto)')} as taxa_risco_geral, count(distinct bairro) as bairros_unicos,
  {ts_text('min(data_ocorrencia)')} as inicio, {ts_text('max(data_ocorrencia)')} as fim from clean"""
    ),
)
def risk_statistics(data):
    out = agg.risk_statistics(data.plain)
    return out.withColumns({c: time_text(c) for c in ("inicio", "fim")})


_MEANS3 = (
    f"{r('avg(risco_alto)', 3)} as taxa_risco, {r('avg(quantidade_suspeitos)', 3)} as media_suspeitos, "
    f"{r('avg(quantidade_vitimas)', 3)} as media_vitimas"
)


@query("bairro_summary", on_clean(f"select bairro, {CRT}, {_MEANS3} from clean group by bairro"))
def bairro_summary(data):
    return agg.place_summary(data.filled("quantidade_suspeitos", "quantidade_vitimas"))


@query(
    "temporal_patterns",
    on_clean(
        "\nunion all\n".join(
            f"select '{k}' as padrao, cast({k} as varchar) as chave, {CRT}, {r('avg(risco_alto)', 3)} as taxa_risco "
            f"from clean where {k} is not null group by {k}"
            for k in ("turno", "dia_semana", "hora")
        )
    ),
)
def temporal_patterns(data):
    return agg.temporal_patterns(data.plain)


_RAW_TYPES = {
    "id_ocorrencia": "bigint",
    "data_ocorrencia": "timestamp_ntz",
    "bairro": "string",
    "tipo_crime": "string",
    "arma_utilizada": "string",
    "quantidade_suspeitos": "double",
    "quantidade_vitimas": "double",
    "idade_suspeito": "double",
    "sexo_suspeito": "string",
    "latitude": "double",
    "longitude": "double",
    "orgao_responsavel": "string",
    "status_investigacao": "string",
    "descricao_modus_operandi": "string",
}


@query(
    "data_quality",
    on_clean(
        "\nunion all\n".join(
            f"select '{c}' as coluna, '{t}' as tipo, count(*) as total_linhas, count(*) - count({c}) as ausentes, "
            f"case when count({c}) < count(*) then {pct_text(f'(count(*) - count({c})) / count(*)')} end as ausentes_pct, "
            "'warning' as status, 'Variável target ''risco_alto'' não encontrada' as avisos from raw"
            for c, t in _RAW_TYPES.items()
        )
    ),
)
def data_quality(data):
    return agg.data_quality(data.raw)


_TEXTS = [*FILLED_TEXT, "arma_utilizada", "turno", "dia_semana", "ano_mes"]
_NUMBERS = [*FILLED_NUMBERS, "ano", "mes", "dia", "hora", "dia_semana_idx", "risco_alto"]
_NONE = "cast(null as double)"


def _describe_sql():
    parts = [
        f"""select '{c}' as coluna, cast(sum(n) as bigint) as n, count(*) as distintos,
  (select {c} from clean where {c} is not null group by {c} order by count(*) desc, {c} limit 1) as mais_comum,
  max(n) as frequencia, {_NONE} as media, {_NONE} as desvio, {_NONE} as minimo, {_NONE} as q25, {_NONE} as q50,
  {_NONE} as q75, {_NONE} as maximo
from (select {c}, count(*) as n from clean where {c} is not null group by {c})"""
        for c in _TEXTS
    ]
    parts += [
        f"""select '{c}', count({c}), null, null, null, {r(f'avg({c})')}, {r(f'stddev_samp({c})')},
  {r(f'cast(min({c}) as double)')}, {r(f'quantile_cont(cast({c} as double), 25e-2)')},
  {r(f'quantile_cont(cast({c} as double), 5e-1)')}, {r(f'quantile_cont(cast({c} as double), 75e-2)')},
  {r(f'cast(max({c}) as double)')} from clean"""
        for c in _NUMBERS
    ]
    return on_clean("\nunion all\n".join(parts))


@query("describe", _describe_sql())
def describe(data):
    return agg.describe(data.clean, _TEXTS, _NUMBERS)


@query(
    "risk_pattern_stats",
    on_scored(
        "\nunion all\n".join(
            [
                f"select 'geral' as grupo, 'avg_risk_score' as chave, {r('avg(risk_score)', 9)} as valor, count(*) as n from scored",
                f"select 'geral', 'high_risk_percentage', {r('count(*) filter (where risk_score >= 7e-1) / count(*) * 100')}, count(*) from scored",
                f"select 'geral', 'low_risk_percentage', {r('count(*) filter (where risk_score <= 3e-1) / count(*) * 100')}, count(*) from scored",
            ]
            + [
                f"select '{k}', {k}, {r('avg(risk_score)', 3)}, count(*) from scored group by {k}"
                for k in ("bairro", "turno", "tipo_crime")
            ]
        )
    ),
)
def risk_pattern_stats(data):
    return agg.risk_pattern_stats(data.scored)


@query(
    "risk_heatmap",
    on_clean(
        f"""select dia_semana, hora, {r('avg(risco_alto)')} as media from clean
where dia_semana is not null and hora is not null group by dia_semana, hora"""
    ),
)
def risk_heatmap(data):
    return agg.heatmap(data.plain).withColumn("media", np_round(F.col("media"), 6))


_HOURS = ", ".join(f"{r(f'avg(risco_alto) filter (where hora = {h})')} as h{h:02d}" for h in range(24))


@query("risk_heatmap_pivot", on_clean(f"select dia_semana, {_HOURS} from clean where dia_semana is not null group by dia_semana"))
def risk_heatmap_pivot(data):
    return agg.heatmap_by_hour(data.plain)


_FILLED_HOURS = ", ".join(f"coalesce({r(f'avg(risco_alto) filter (where hora = {h})')}, 0e0) as h{h:02d}" for h in range(24))


@query(
    "risk_heatmap_pivot_filled",
    on_clean(f"select dia_semana, {_FILLED_HOURS} from clean where dia_semana is not null group by dia_semana"),
)
def risk_heatmap_pivot_filled(data):
    return agg.heatmap_by_hour(data.plain, fill=0.0)


@query(
    "suspects_heatmap",
    on_clean(
        f"""select turno, dia_semana, {r('avg(quantidade_suspeitos)')} as media from clean
where turno is not null and dia_semana is not null group by turno, dia_semana"""
    ),
)
def suspects_heatmap(data):
    """Any value over any two keys."""
    found = agg.heatmap(data.filled("quantidade_suspeitos"), "dia_semana", "turno", "quantidade_suspeitos")
    return found.withColumn("media", np_round(F.col("media"), 6))


@query(
    "risk_by_hour",
    on_clean(
        f"""select 'hora' as padrao, cast(hora as varchar) as chave, {r('avg(risco_alto) * 100')} as risco_pct
from clean where hora is not null group by hora union all
select 'dia_semana', dia_semana, {r('avg(risco_alto) * 100')} from clean where dia_semana is not null group by dia_semana"""
    ),
)
def risk_by_hour(data):
    return agg.risk_by_hour_and_day(data.plain)


@query("shift_counts", on_clean("select turno, count(*) as n from clean group by turno"))
def shift_counts(data):
    return agg.shift_counts(data.plain)


@query(
    "daily_evolution",
    on_clean(
        f"""select strftime(d, '%Y-%m-%d') as dia, {r('avg(risco_alto) * 100')} as risco_pct
from (select cast(data_ocorrencia as date) as d, risco_alto from clean where data_ocorrencia is not null)
group by d order by d desc limit 30"""
    ),
)
def daily_evolution(data):
    return agg.daily_evolution(data.plain).withColumn("dia", F.date_format("dia", "yyyy-MM-dd"))


@query(
    "monthly_rate",
    on_clean(f"select ano_mes, {r('avg(risco_alto)')} as taxa_risco from clean where ano_mes is not null group by ano_mes"),
)
def monthly_rate(data):
    return agg.monthly_rate(data.plain)


@query(
    "top_rates",
    on_clean(
        "\nunion all\n".join(
            f"select * from (select '{k}' as grupo, {k} as chave, {r('avg(risco_alto) * 100', 1)} as risco_pct "
            f"from clean group by {k} order by avg(risco_alto) desc, {k} limit {n})"
            for k, n in (("bairro", 10), ("tipo_crime", 12))
        )
    ),
)
def top_rates(data):
    return agg.top_places_and_crimes(data.plain)


@query(
    "weapon_counts",
    on_clean(
        """select arma_utilizada, count(*) as n, cast(arma_utilizada in ('Arma de Fogo', 'Explosivos') as integer) as letal
from clean where arma_utilizada is not null group by arma_utilizada order by n desc, arma_utilizada limit 8"""
    ),
)
def weapon_counts(data):
    return agg.weapon_counts(data.plain)


_CORR = ["risco_alto", "quantidade_suspeitos", "quantidade_vitimas", "hora", "dia_semana_idx"]


@query(
    "risk_correlation",
    on_clean(
        "\nunion all\n".join(
            f"select '{a}' as a, '{b}' as b, {r(f'corr({a}, {b})')} as correlacao from clean" for a in _CORR for b in _CORR
        )
    ),
)
def risk_correlation(data):
    return agg.correlation(data.modelled, _CORR)


@query(
    "score_histogram",
    on_scored(
        f""", lim as (select min(risk_score) as lo, (max(risk_score) - min(risk_score)) / 30 as w,
  quantile_cont(risk_score, 8e-1) as q from scored),
binned as (select least(cast(floor((risk_score - lo) / w) as integer), 29) as faixa from scored cross join lim)
select cast(b as integer) as faixa, {r('lo + w * b')} as inicio,
  (select count(*) from binned where faixa = b) as n, {r('q')} as corte
from (select unnest(range(30)) as b) cross join lim"""
    ),
)
def score_histogram(data):
    return agg.histogram(data.scored, "risk_score", 30, level=0.8)


@query(
    "rank_predicted",
    on_scored(
        f"select bairro, {r('avg(score)')} as risco_previsto from pred group by bairro order by 2 desc, bairro limit 10"
    ),
)
def rank_predicted(data):
    return agg.mean_score_by_place(data.scored)


# --- patterns -----------------------------------------------------------------------

_G1 = f"""select bairro, turno, {CRT}, avg(risco_alto) as t from clean group by bairro, turno
  having count(*) >= 10 and avg(risco_alto) >= 3e-1 order by t desc, bairro, turno limit 10"""
_G2 = """select tipo_crime, arma_utilizada, bairro, count(*) as qtd from clean where arma_utilizada is not null
  group by 1, 2, 3 order by qtd desc, tipo_crime, arma_utilizada, bairro limit {n}"""
_G3 = """select dia_semana, hora, tipo_crime, count(*) as total, avg(risco_alto) as t from clean
  where hora is not null group by 1, 2, 3 having count(*) >= 5 and avg(risco_alto) >= 5e-1
  order by t desc, dia_semana, hora, tipo_crime limit 10"""
_KINDS = (patterns.PLACE_SHIFT, patterns.CRIME_WEAPON_PLACE, patterns.TIME_CRIME)


@query("pattern_place_shift", on_clean(f"select bairro, turno, total, alto_risco, {r('t')} as taxa_risco from ({_G1})"))
def pattern_place_shift(data):
    return patterns.place_shift(data.plain)


@query("pattern_crime_weapon_place", on_clean(_G2.format(n=15)))
def pattern_crime_weapon_place(data):
    return patterns.crime_weapon_place(data.plain)


@query("pattern_time_crime", on_clean(f"select dia_semana, hora, tipo_crime, total, {r('t')} as taxa_risco from ({_G3})"))
def pattern_time_crime(data):
    return patterns.time_crime(data.plain)


@query(
    "pattern_summary",
    on_clean(
        f""", p as (select '{_KINDS[0]}' as padrao from ({_G1}) union all
select '{_KINDS[1]}' from ({_G2.format(n=15)}) union all select '{_KINDS[2]}' from ({_G3}))
select padrao, count(*) as linhas, (select count(distinct padrao) from p) as total_padroes from p group by padrao"""
    ),
)
def pattern_summary(data):
    return patterns.pattern_summary(data.plain)


@query(
    "pattern_labels",
    on_clean(
        f"""select '{_KINDS[0]}' as padrao, bairro || ' - ' || turno as rotulo, {r('t')} as valor from ({_G1})
union all select '{_KINDS[1]}', tipo_crime || ' + ' || arma_utilizada, cast(qtd as double) from ({_G2.format(n=10)})"""
    ),
)
def pattern_labels(data):
    return patterns.pattern_labels(data.plain)


@query(
    "top_danger_combos",
    on_scored(
        """, danger as (select * from scored where risk_score >= (select quantile_cont(risk_score, 8e-1) from scored))
select * from (select 'bairro+tipo_crime' as combinacao, bairro as a, tipo_crime as b, count(*) as qtd from danger
  group by bairro, tipo_crime order by qtd desc, bairro, tipo_crime limit 12)
union all
select * from (select 'tipo_crime+descricao_modus_operandi', tipo_crime, descricao_modus_operandi, count(*) as qtd
  from danger group by tipo_crime, descricao_modus_operandi order by qtd desc, tipo_crime, descricao_modus_operandi limit 12)"""
    ),
)
def top_danger_combos(data):
    return patterns.top_danger_combos(data.scored)


# --- association rules ----------------------------------------------------------------

_ITEMS = list(rules.ITEM_PREFIXES.items())
MIN_SUPPORT, MIN_CONFIDENCE = 0.05, 0.3


def _itemset_cte(support: str = "5e-2") -> str:
    """One grouping per non-empty subset of the five columns."""
    parts = []
    for mask in range(1, 32):
        used = [(c, p) for i, (c, p) in enumerate(_ITEMS) if mask >> i & 1]
        columns = ", ".join(
            (f"'{p}' || {c}" if mask >> i & 1 else "cast(null as varchar)") + f" as c{i}" for i, (c, p) in enumerate(_ITEMS)
        )
        label = " || '|' || ".join(f"'{p}' || {c}" for c, p in used)
        present = " and ".join(f"{c} is not null" for c, _ in used)
        keys = ", ".join(c for c, _ in used)
        parts.append(
            f"select {mask} as mask, {label} as itens, {columns}, count(*) as n, "
            f"count(*) / (select cast(count(*) as double) from high) as support from high where {present} group by {keys}"
        )
    union = "\nunion all ".join(parts)
    return (
        ", high as materialized (select * from clean where risco_alto = 1),\n"
        f"sets as materialized (select * from ({union}) where support >= {support})\n"
    )


def _items(mask: str) -> str:
    """Label of the items of a set ``s`` that a mask picks; nulls drop out."""
    return "concat_ws('|', " + ", ".join(f"case when ({mask} >> {i}) & 1 = 1 then s.c{i} end" for i in range(5)) + ")"


# sides are found by the equality of their labels
_RULES = (
    _itemset_cte()
    + f""", splits as (select s.support, {_items('m')} as antecedents, {_items('(s.mask - m)')} as consequents
  from sets s join (select unnest(range(1, 31)) as m) t on m & s.mask = m and m < s.mask),
rules as (select antecedents, consequents, {r('s.support', 3)} as support,
  {r('s.support / a.support', 2)} as confidence, {r('s.support / a.support / c.support', 2)} as lift
from splits s join sets a on a.itens = s.antecedents join sets c on c.itens = s.consequents
where s.support / a.support >= 3e-1)
"""
)
_RULE_ORDER = " order by lift desc, confidence desc, support desc, replace(antecedents, '|', ', '), replace(consequents, '|', ', ')"


@query("frequent_itemsets", on_clean(_itemset_cte() + f"select itens, n, {r('support')} as support from sets"))
def frequent_itemsets(data):
    return rules.frequent_itemsets(data.plain, MIN_SUPPORT).select(
        F.array_join("items", "|").alias("itens"), "n", np_round(F.col("support"), 6).alias("support")
    )


@query("association_rules", on_clean(_RULES + "select * from rules" + _RULE_ORDER))
def association_rules(data):
    return rules.association_rules(data.plain, MIN_SUPPORT, MIN_CONFIDENCE).withColumns(
        {side: F.array_join(side, "|") for side in ("antecedents", "consequents")}
    )


@query("basket_itemsets", on_clean(_itemset_cte() + f"select itens, n, {r('support')} as support from sets"))
def basket_itemsets(data):
    """The same itemsets, mined from the item lists by FP-trees."""
    found = baskets.frequent_itemsets(rules.transactions(data.plain), "items", MIN_SUPPORT)
    kinds = F.array(*[F.lit(p) for _, p in _ITEMS])
    place = F.transform("items", lambda x: F.struct(F.array_position(kinds, F.regexp_extract(x, "^[A-Za-z]+_", 0)), x.alias("item")))
    ordered = F.transform(F.array_sort(place), lambda p: p["item"])
    return found.select(F.array_join(ordered, "|").alias("itens"), "n", np_round(F.col("support"), 6).alias("support"))


@query(
    "basket_rules",
    on_clean(
        _RULES
        + """select list_aggregate(list_sort(string_split(antecedents, '|')), 'string_agg', '|') as antecedents,
  list_aggregate(list_sort(string_split(consequents, '|')), 'string_agg', '|') as consequents, support, confidence, lift from rules"""
    ),
)
def basket_rules(data):
    """Rules with consequents of any size, grown level by level from the itemsets of the item lists."""
    found = baskets.frequent_itemsets(rules.transactions(data.plain), "items", MIN_SUPPORT)
    return baskets.association_rules(found, MIN_CONFIDENCE).withColumns(
        {side: F.array_join(side, "|") for side in ("antecedents", "consequents")}
    )


@query(
    "top_rules",
    on_clean(
        _RULES
        + """, text as (select replace(replace(antecedents, '|', ', '), '_', ' ') || ' → '
  || replace(replace(consequents, '|', ', '), '_', ' ') as regra, support, confidence, lift from rules)
select *, cast(lift > 2 as integer) as critica from text order by lift desc, confidence desc, support desc, regra limit 20"""
    ),
)
def top_rules(data):
    return rules.top_rules(rules.association_rules(data.plain, MIN_SUPPORT, MIN_CONFIDENCE), 20)


# --- report lines ---------------------------------------------------------------------


def _best(key: str, n: int) -> str:
    return (
        f"(select {key} as k, avg(risco_alto) as t, row_number() over (order by avg(risco_alto) desc, {key}) as i "
        f"from clean where {key} is not null group by {key} order by t desc, {key} limit {n})"
    )


_DAY = "strftime({x}, '%Y-%m-%d')"
_PERIOD = f"{_DAY.format(x='min(data_ocorrencia)')} || ' → ' || {_DAY.format(x='max(data_ocorrencia)')}"


@query(
    "summary_lines",
    on_clean(
        f"""select 1 as line_no, 'Período analisado: ' || {_PERIOD} as text from clean
union all select 2, 'Proporção de alto risco: ' || {pct_text('avg(risco_alto)')} from clean
union all select 3, 'Bairros mais críticos: ' || string_agg(k || ' (' || {pct_text('t')} || ')', ', ' order by i) from {_best('bairro', 3)}
union all select 4, 'Horários mais arriscados (top 3): ' || string_agg(k || 'h', ', ' order by i) from {_best('hora', 3)}
union all select 5, 'Tipos com maior risco: ' || string_agg(k || ' (' || {pct_text('t')} || ')', ', ' order by i) from {_best('tipo_crime', 3)}"""
    ),
)
def summary_lines(data):
    return report.summary_lines(data.plain)


REPORT_TIME = "2025-01-01 00:00:00"


@query(
    "report_lines",
    on_clean(
        f"""select 1 as line_no, '{report.REPORT_TITLE}' as text
union all select 2, 'Gerado em: {REPORT_TIME}'
union all select 3, 'Período: ' || {_PERIOD} from clean
union all select 4, 'Registros analisados: ' || format('{{:,}}', count(*)) from clean
union all select 5, 'Proporção de alto risco (arma/explosivos): ' || {pct_text('avg(risco_alto)')} from clean
union all select 10, 'Top 5 bairros (maior risco médio):'
union all select cast(10 + i as integer), ' - ' || k || ': ' || {pct_text('t')} from {_best('bairro', 5)}
union all select 100, 'Top 5 tipos de crime (maior risco médio):'
union all select cast(100 + i as integer), ' - ' || k || ': ' || {pct_text('t')} from {_best('tipo_crime', 5)}
"""
        + "".join(f"union all select {300 + i}, '{text}' " for i, text in enumerate(report.NOTES))
    ),
)
def report_lines(data):
    return report.report_lines(data.plain, REPORT_TIME)


@query(
    "recommendation_lines",
    on_clean(
        f"""select cast(9 + i as integer) as line_no, 'Reforço Policial Recomendado' as secao,
  k || ': Taxa de risco ' || {pct_text('t')} || ' - Requer patrulhamento reforçado' as text from {_best('bairro', 3)}
union all select cast(19 + i as integer), 'Horários Críticos',
  lpad(cast(k as varchar), 2, '0') || 'h: Taxa de risco ' || {pct_text('t')} || ' - Aumentar efetivo' from {_best('hora', 3)}
union all select cast(29 + i as integer), 'Protocolos Especiais',
  k || ': Protocolo de alta segurança - Backup obrigatório' from {_best('tipo_crime', 3)} where t > 3e-1"""
    ),
)
def recommendation_lines(data):
    return report.recommendation_lines(data.plain)
