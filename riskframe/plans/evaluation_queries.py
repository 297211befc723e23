"""Evaluation queries on the risk score (deterministic, so SQL checks them)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.numeric import np_round
from riskframe.operators import evaluation as ev
from riskframe.plans.oracle import num, on_scored, r
from riskframe.plans.registry import query

THRESHOLD = 0.6
WINDOW = ["bairro", "ano_mes"]


def _ratio(top, bottom):
    return f"coalesce(({top}) / nullif(cast({bottom} as double), 0), 0e0)"


def _prf(tp="tp", chosen="chosen", pos="positives"):
    return (
        f"{r(_ratio(tp, chosen))} as precision, {r(_ratio(tp, pos))} as recall, "
        f"{r(_ratio(f'2 * {tp}', f'({chosen} + {pos})'))} as f1"
    )


def _cells(t):
    return (
        f"count(*) as n, count(*) filter (where y = 1) as positives, count(*) filter (where score >= {t}) as chosen, "
        f"count(*) filter (where score >= {t} and y = 1) as tp"
    )


_MACRO = "({} + {}) / 2".format(
    _ratio("2 * tp", "(chosen + positives)"), _ratio("2 * (n - chosen - positives + tp)", "(n - chosen + n - positives)")
)
_METRICS = f"{_prf()}, {r(_MACRO)} as f1_macro, positives as support_pos, n as support_total"


@query("eval_metrics", on_scored(f"select {_METRICS} from (select {_cells(num(THRESHOLD))} from pred)"))
def eval_metrics(data):
    return ev.eval_metrics(data.pred, THRESHOLD)


@query(
    "metrics_by_slice",
    on_scored(f"select turno, {_METRICS} from (select turno, {_cells(num(THRESHOLD))} from pred group by turno)"),
)
def metrics_by_slice(data):
    return ev.eval_metrics(data.pred, THRESHOLD, by=["turno"])


@query(
    "confusion_matrix",
    on_scored(
        f"""select cast(a as integer) as y_true, cast(b as integer) as y_pred,
  (select count(*) from pred where y = a and cast(score >= {num(THRESHOLD)} as integer) = b) as n
from (select unnest([0, 1]) as a) cross join (select unnest([0, 1]) as b)"""
    ),
)
def confusion_matrix(data):
    return ev.confusion_matrix(data.pred, THRESHOLD)


@query(
    "roc_auc",
    on_scored(
        f""", ranked as (select y, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2e0 as k from pred),
s as (select sum(k) filter (where y = 1) as ranks, cast(sum(y) as double) as p, cast(sum(1 - y) as double) as q from ranked)
select {r('(ranks - p * (p + 1) / 2) / (p * q)')} as roc_auc from s"""
    ),
)
def roc_auc(data):
    return ev.roc_auc(data.pred)


_CURVE = """, d as (select score, sum(y) as pos, sum(1 - y) as neg from pred group by score),
c as (select score, sum(pos) over w as tp, sum(neg) over w as fp, sum(pos) over () as p, sum(neg) over () as q
  from d window w as (order by score desc rows between unbounded preceding and current row))
"""


@query(
    "roc_curve",
    on_scored(
        _CURVE
        + f"""select {r('score', 9)} as threshold, {r('fp / cast(q as double)')} as fpr, {r('tp / cast(p as double)')} as tpr from c
union all select null, 0e0, 0e0"""
    ),
)
def roc_curve(data):
    return ev.roc_curve(data.pred).withColumn("threshold", np_round(F.col("threshold"), 9))


@query(
    "pr_curve",
    on_scored(
        _CURVE
        + f"""select {r('score', 9)} as threshold, {r('tp / cast(tp + fp as double)')} as precision,
  {r('tp / cast(p as double)')} as recall from c union all select null, 1e0, 0e0"""
    ),
)
def pr_curve(data):
    return ev.pr_curve(data.pred).withColumn("threshold", np_round(F.col("threshold"), 9))


_GRID = "[" + ", ".join(num(t) for t in ev.THRESHOLD_GRID) + "]"


@query(
    "best_threshold",
    on_scored(
        f""", g as (select unnest({_GRID}) as t),
m as (select t, count(*) filter (where score >= t) as chosen, count(*) filter (where score >= t and y = 1) as tp,
  count(*) filter (where y = 1) as positives from g cross join pred group by t)
select t as threshold, {r('f')} as f1 from (select t, {_ratio('2 * tp', '(chosen + positives)')} as f from m)
order by f desc, t limit 1"""
    ),
)
def best_threshold(data):
    return ev.best_threshold(data.pred)


_AT_K = f""", cut as (select quantile_cont(score, 8e-1) as t from pred),
m as (select t, {_cells('t')} from pred cross join cut group by t)
"""


@query(
    "f1_at_k",
    on_scored(
        _AT_K
        + f"""select {r('t')} as threshold, {_prf()}, chosen as selected_count, positives as total_high_risk from m"""
    ),
)
def f1_at_k(data):
    return ev.f1_at_k(data.pred)


_KS = "\nunion all ".join(
    f"select {r(f'{num(k)} * 100')} as k_pct, quantile_cont(score, {num((1 - k) * 100 / 100)}) as t from pred" for k in ev.K_GRID
)


@query(
    "performance_curve",
    on_scored(
        f""", cuts as ({_KS}), m as (select k_pct, {_cells('t')} from cuts cross join pred group by k_pct)
select k_pct, {_prf()} from m"""
    ),
)
def performance_curve(data):
    return ev.shown_curve(data.pred)


@query(
    "operational_gain",
    on_scored(
        _AT_K
        + f""", g as (select n, positives, cast(floor(n * 2e-1) as bigint) as first,
  cast(floor(positives * {_ratio('tp', 'positives')}) as bigint) as caught from m)
select n as total_casos, positives as casos_alto_risco, {r('positives / n * 100')} as taxa_risco_pct,
  first as casos_priorizados, caught as risco_capturado, {r('caught / cast(first as double) * 100')} as eficiencia_pct from g"""
    ),
)
def operational_gain(data):
    return ev.operational_gain(data.pred)


_BY_WINDOW = f""", o as (select *, row_number() over (partition by bairro, ano_mes order by score desc, id_ocorrencia) as i,
  count(*) over (partition by bairro, ano_mes) as n from pred where ano_mes is not null),
m as (select bairro, ano_mes, n, greatest(1, cast(floor(n * 2e-1) as bigint)) as chosen, count(*) filter (where y = 1) as positives,
  count(*) filter (where y = 1 and i <= greatest(1, cast(floor(n * 2e-1) as bigint))) as tp from o group by bairro, ano_mes, n),
bw as (select bairro, ano_mes, n, {_prf()} from m)
"""


@query("f1_at_k_by_window", on_scored(_BY_WINDOW + "select * from bw"))
def f1_at_k_by_window(data):
    return ev.f1_at_k_by_window(data.pred, WINDOW)


@query(
    "f1_at_k_bairro",
    on_scored(
        _BY_WINDOW + f"select bairro, {r('avg(f1)')} as f1_medio from bw group by bairro order by 2 desc, bairro limit 12"
    ),
)
def f1_at_k_bairro(data):
    return ev.f1_at_k_by_place(ev.f1_at_k_by_window(data.pred, WINDOW))


@query("f1_at_k_mean", on_scored(_BY_WINDOW + f"select {r('avg(f1)')} as f1_medio, count(*) as janelas from bw"))
def f1_at_k_mean(data):
    windows = ev.f1_at_k_by_window(data.pred, WINDOW)
    return windows.agg(np_round(F.avg("f1"), 6).alias("f1_medio"), F.count(F.lit(1)).alias("janelas"))
