"""Queries on fitted models.  Those whose data part is deterministic have a SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.numeric import np_round
from riskframe.functions.quantiles import exact_quantiles
from riskframe.operators import aggregates, anomaly, clustering, model_tables, splits
from riskframe.operators import evaluation as ev
from riskframe.operators import supervised as sv
from riskframe.operators.dbscan import dbscan
from riskframe.operators.filters import enough
from riskframe.plans.oracle import LETHAL, on_clean, on_flags, on_scored, r
from riskframe.plans.registry import query
from riskframe.schema import (
    CLUSTER_FLAGS,
    CLUSTER_NUMBERS,
    MODEL_CATEGORIES,
    MODEL_NUMBERS,
)
from riskframe.session import checkpointed, stored

ID = "id_ocorrencia"


# --- shared fitted models (each is fitted once per folder) -----------------------------


def fitted_forest(data):
    return data.memo("forest", lambda: sv.train_forest(data.modelled))


def three_parts(data):
    split = data.memo("split3", lambda: splits.temporal_split_3way(data.modelled))
    train, valid, test = (splits.part(split, name) for name in ("train", "valid", "test"))
    return train, valid, test


def chosen_model(data):
    def build():
        train, valid, _ = three_parts(data)
        return sv.choose_model(train, valid)

    return data.memo("choice", build)


def scaler(data):
    return data.memo("scaler", lambda: clustering.fit_scaler(data.flagged))


def vectors(data, keep=None):
    """Scaled features of all rows; small tables have no unsupervised view."""
    data.memo("enough", lambda: enough(data.kept, "unsupervised analysis"))
    return clustering.vectors(data.flagged, scaler(data), keep)


def pca(data):
    return data.memo("pca", lambda: clustering.fit_pca(vectors(data), scaler(data).names))


def six(df, *columns):
    return df.withColumns({c: np_round(F.col(c), 6) for c in columns})


# --- supervised ------------------------------------------------------------------------

_TRAIN = """, cut as (select quantile_cont(epoch_us(data_ocorrencia), 7e-1) as q from clean),
train as (select clean.* from clean cross join cut where epoch_us(data_ocorrencia) <= q)
"""
_SCALED = ", ".join(
    f"{r(f'coalesce(({c} - (select avg({c}) from train)) / (select stddev_pop({c}) from train), 0e0)')} as {c}" for c in MODEL_NUMBERS
)
_HOT = " + ".join(f"cast({c} in (select {c} from train) as integer)" for c in MODEL_CATEGORIES)


@query("preprocess", on_clean(_TRAIN + f"select id_ocorrencia, {_SCALED}, {_HOT} as categorias from clean"))
def preprocess(data):
    from pyspark.ml.functions import vector_to_array

    train = splits.part(splits.temporal_split(data.modelled), "train")
    prep = sv.Preprocessor(list(MODEL_NUMBERS), list(MODEL_CATEGORIES)).fit(train)
    x = vector_to_array("features")
    ready = prep.transform(data.modelled).withColumn("x", x)
    n = len(MODEL_NUMBERS)
    hot = F.aggregate(F.slice("x", n + 1, len(prep.names) - n), F.lit(0.0), lambda acc, v: acc + v)
    return ready.select(
        ID, *[np_round(F.col("x")[i], 6).alias(c) for i, c in enumerate(MODEL_NUMBERS)], hot.cast("int").alias("categorias")
    )


@query("train_forest")
def train_forest(data):
    model, split = fitted_forest(data)
    return sv.test_metrics(model, splits.part(split, "train"), splits.part(split, "test"))


@query("train_logreg")
def train_logreg(data):
    train, _, test = three_parts(data)
    model = sv.train_models(train, {"LogisticRegression": sv.logistic})["LogisticRegression"]
    return sv.test_metrics(model, train, test)


@query("predict_risk")
def predict_risk(data):
    model, _ = fitted_forest(data)
    return six(model.predict(data.modelled), "probability").select(ID, "bairro", "risco_alto", "probability", "prediction")


# A fixed coefficient table over the scaled numbers and two categories.
_WEIGHTS = {
    "quantidade_vitimas": 0.4, "quantidade_suspeitos": -0.7, "idade_suspeito": 0.05, "hora": 0.3, "tipo_crime_Roubo": 1.1,
    "tipo_crime_Furto": -0.9, "turno_Noite": 0.6, "turno_Tarde": -0.2, model_tables.INTERCEPT: -0.35,
}
_LINEAR_NUMBERS = ["quantidade_vitimas", "quantidade_suspeitos", "idade_suspeito", "hora"]


def _weight_sql(name: str) -> str:
    return f"({_WEIGHTS[name]!r}e0)"


@query(
    "linear_score_fixed",
    on_clean(
        ", m as (select "
        + ", ".join(f"avg({c}) as a_{c}, stddev_pop({c}) as s_{c}" for c in _LINEAR_NUMBERS)
        + " from clean), s as (select id_ocorrencia, "
        + " + ".join(f"coalesce(({c} - a_{c}) / s_{c}, 0e0) * {_weight_sql(c)}" for c in _LINEAR_NUMBERS)
        + f" + case tipo_crime when 'Roubo' then {_weight_sql('tipo_crime_Roubo')} when 'Furto' then {_weight_sql('tipo_crime_Furto')} else 0e0 end"
        + f" + case turno when 'Noite' then {_weight_sql('turno_Noite')} when 'Tarde' then {_weight_sql('turno_Tarde')} else 0e0 end"
        + f" + {_weight_sql(model_tables.INTERCEPT)} as margin from clean cross join m)\n"
        + f"select id_ocorrencia, {r('1e0 / (1e0 + exp(-margin))')} as probability, cast(1e0 / (1e0 + exp(-margin)) >= 5e-1 as integer) as prediction from s"
    ),
)
def linear_score_fixed(data):
    rows = data.modelled
    prep = sv.Preprocessor(list(_LINEAR_NUMBERS), []).fit(rows)
    table = data.spark.createDataFrame(list(_WEIGHTS.items()), "feature string, weight double")
    scored = model_tables.linear_scores(rows, table, {c: prep.scaled(c) for c in _LINEAR_NUMBERS}, ["tipo_crime", "turno"])
    return six(scored, "probability")


@query("prediction_summary")
def prediction_summary(data):
    model, _ = fitted_forest(data)
    return sv.prediction_summary(model.predict(data.modelled))


@query("choose_model")
def choose_model(data):
    return chosen_model(data).table(data.modelled)


@query("chosen_model_metrics")
def chosen_model_metrics(data):
    train, _, test = three_parts(data)
    return sv.test_metrics(chosen_model(data).model, train, test)


@query("chosen_f1_at_k_by_window")
def chosen_f1_at_k_by_window(data):
    """F1@20% per place and month on the chosen model's test probabilities."""
    test = three_parts(data)[2]
    pred = sv.as_predictions(chosen_model(data).model, test, ["bairro", "ano_mes"])
    return ev.f1_at_k_by_window(pred, ["bairro", "ano_mes"])


@query("feature_importance")
def feature_importance(data):
    model, _ = fitted_forest(data)
    return six(sv.feature_importance(model, data.modelled, 12), "importance")


@query("permutation_importance")
def permutation_importance(data):
    return sv.permutation_importance(chosen_model(data).model, three_parts(data)[1])


@query("model_summary")
def model_summary(data):
    return sv.model_summary(fitted_forest(data)[0], data.modelled)


@query("score_new_calls")
def score_new_calls(data):
    calls = data.kept.withColumns(
        {"hora": F.hour("data_ocorrencia"), "dia_semana_idx": F.weekday("data_ocorrencia")}
    )
    scored = sv.score_new_calls(chosen_model(data).model, calls)
    return six(scored, "probability").select(ID, "probability", "decision")


@query("grid_search")
def grid_search(data):
    return sv.grid_search(three_parts(data)[0], parallelism=8)


@query("report_lines_with_metrics")
def report_lines_with_metrics(data):
    from riskframe.operators import report
    from riskframe.plans.table_queries import REPORT_TIME

    row = chosen_model_metrics(data).first().asDict()
    metrics = {k: row[k] for k in ("precision", "recall", "f1", "roc_auc")}
    return report.report_lines(data.modelled, REPORT_TIME, metrics)


# --- clustering ------------------------------------------------------------------------

_FILLED = ", ".join(f"coalesce(cast({c} as double), (select quantile_cont(cast({c} as double), 5e-1) from flags)) as {c}" for c in CLUSTER_NUMBERS)
_MATRIX = f", matrix as (select id_ocorrencia, {_FILLED}, {', '.join(f'cast({c} as double) as {c}' for c in CLUSTER_FLAGS)} from flags)\n"
_NAMES = [*CLUSTER_NUMBERS, *CLUSTER_FLAGS]


@query(
    "cluster_features",
    on_flags(_MATRIX + f"select id_ocorrencia, {', '.join(f'{r(c, 9)} as {c}' for c in _NAMES)} from matrix"),
)
def cluster_features(data):
    table = clustering.feature_table(data.flagged, scaler(data))
    return table.select(ID, *[np_round(F.col(c).cast("double"), 9).alias(c) for c in _NAMES])


@query(
    "scaled_features",
    on_flags(
        _MATRIX
        + "select id_ocorrencia, "
        + ", ".join(
            r(f"({c} - (select avg({c}) from matrix)) / coalesce(nullif((select stddev_pop({c}) from matrix), 0), 1e0)") + f" as z_{c}"
            for c in _NAMES
        )
        + " from matrix"
    ),
)
def scaled_features(data):
    return six(clustering.scaled_table(data.flagged, scaler(data)), *[f"z_{c}" for c in _NAMES])


def sweep(data):
    return data.memo("sweep", lambda: clustering.kmeans_sweep(vectors(data), 8))


@query("kmeans_sweep")
def kmeans_sweep(data):
    return six(sweep(data), "inertia", "silhouette_sq_euclidean", "davies_bouldin")


@query("elbow_choice")
def elbow_choice(data):
    return clustering.elbow_choice(sweep(data))


def kmeans_assigned(data):
    keep = ["risk_score", "risco_alto", "quantidade_suspeitos", "arma_utilizada", "tipo_crime", "bairro", "turno"]
    return data.memo("kmeans", lambda: clustering.kmeans_labels(vectors(data, keep), 4))


@query("kmeans_clusters")
def kmeans_clusters(data):
    return kmeans_assigned(data).select(ID, "cluster")


@query("silhouette")
def silhouette(data):
    labelled = kmeans_assigned(data)
    value = clustering.silhouette(labelled)
    return data.spark.createDataFrame([(4, round(value, 6))], "k int, silhouette_sq_euclidean double")


@query("kmeans_profile")
def kmeans_profile(data):
    return _shown_profile(clustering.cluster_profile(kmeans_assigned(data)))


def _shown_profile(profile):
    return six(profile, "percentage", "avg_risk_score", "high_risk_rate", "avg_suspects", "weapon_rate")


def dbscan_assigned(data):
    """The vectors are written first, as several passes read them."""
    return data.memo("dbscan", lambda: checkpointed(dbscan(stored(vectors(data).drop("features"), "vectors"))))


@query("dbscan_clusters")
def dbscan_clusters(data):
    return dbscan_assigned(data).select(ID, "cluster")


# --- the fixed inputs of these measures are the scaled features themselves -----------------

_Z = (
    _MATRIX
    + ", z as (select id_ocorrencia, "
    + ", ".join(
        f"({c} - (select avg({c}) from matrix)) / coalesce(nullif((select stddev_pop({c}) from matrix), 0), 1e0) as z{i}"
        for i, c in enumerate(_NAMES)
    )
    + " from matrix)\n"
)
_ZS = ", ".join(f"z{i}" for i in range(len(_NAMES)))
_GAP = " + ".join(f"(a.z{i} - b.z{i}) * (a.z{i} - b.z{i})" for i in range(len(_NAMES)))
#: The three flags are 0 or 1, and scaled they lie further apart than the reach: near rows agree in them.
_SAME_FLAGS = " and ".join(f"a.z{_NAMES.index(c)} = b.z{_NAMES.index(c)}" for c in CLUSTER_FLAGS)


@query(
    "dbscan_core",
    on_flags(
        _Z
        + f""", d as materialized (select {_ZS}, count(*) as w from z group by all),
near as (select {', '.join(f'a.z{i}' for i in range(len(_NAMES)))}, sum(b.w) as n
  from d a join d b on {_SAME_FLAGS} where {_GAP} <= 25e-2 group by all)
select id_ocorrencia, cast(n >= 5 as integer) as core from z join near using ({_ZS})"""
    ),
)
def dbscan_core(data):
    return dbscan_assigned(data).select(ID, "core")


@query(
    "pca_covariance",
    on_flags(
        _Z
        + "\nunion all\n".join(
            f"select '{a}' as feature_a, '{b}' as feature_b, {r(f'covar_samp(z{i}, z{j})')} as covariance from z"
            for i, a in enumerate(_NAMES) for j, b in enumerate(_NAMES)
        )
    ),
)
def pca_covariance(data):
    return six(clustering.covariance(vectors(data), _NAMES), "covariance")


@query("clustering_summary")
def clustering_summary(data):
    rows = [
        clustering.clustering_summary(labelled, pca(data), method)
        for labelled, method in ((kmeans_assigned(data), "K-Means"), (dbscan_assigned(data), "DBSCAN"))
    ]
    return six(rows[0].unionByName(rows[1]), "silhouette_sq_euclidean", "silhouette_euclidean", "pca_variance_explained")


@query("pca_coordinates")
def pca_coordinates(data):
    return six(clustering.pca_coordinates(vectors(data), pca(data)), "pca_1", "pca_2").select(ID, "pca_1", "pca_2")


@query("pca_variance")
def pca_variance(data):
    return six(clustering.pca_variance(data.spark, pca(data)), "variancia", "acumulada")


@query("pca_loadings")
def pca_loadings(data):
    return clustering.pca_loadings(data.spark, pca(data))


@query("pca_centers")
def pca_centers(data):
    placed = clustering.pca_coordinates(kmeans_assigned(data), pca(data))
    return six(clustering.pca_centers(placed), "pca_1", "pca_2")


# A fixed assignment (the weekday; noise where the time is unknown) lets SQL check the profile.
_MODE = (
    "(select {c} from assigned m where m.cluster = a.cluster and {c} is not null group by {c} "
    "order by count(*) desc, {c} limit 1) as {k}"
)
_PROFILE = f""", assigned as (select *, coalesce(dia_semana_idx, -1) as cluster from scored),
profile as (select cluster as cluster_id, count(*) as size, count(*) / (select cast(count(*) as double) from assigned) * 100 as percentage,
  avg(risk_score) as avg_risk_score, avg(risco_alto) as high_risk_rate, avg(quantidade_suspeitos) as avg_suspects,
  avg(cast({LETHAL} as double)) as weapon_rate,
  {_MODE.format(c='tipo_crime', k='most_common_crime')}, {_MODE.format(c='bairro', k='most_common_bairro')},
  {_MODE.format(c='turno', k='most_common_shift')}
  from assigned a where cluster <> -1 group by cluster)
"""


def weekday_assignment(data):
    return data.scored.withColumn("cluster", F.coalesce("dia_semana_idx", F.lit(clustering.NOISE)))


@query(
    "cluster_profile",
    on_scored(
        _PROFILE
        + "select cluster_id, size, most_common_crime, most_common_bairro, most_common_shift, "
        + ", ".join(f"{r(c)} as {c}" for c in ("percentage", "avg_risk_score", "high_risk_rate", "avg_suspects", "weapon_rate"))
        + " from profile"
    ),
)
def cluster_profile(data):
    return _shown_profile(clustering.cluster_profile(weekday_assignment(data)))


def _one(x):
    return f"printf('%.1f', {r(f'{x} * 100', 1)})"


@query(
    "cluster_interpretation",
    on_scored(
        _PROFILE
        + f"""select cluster_id,
  case when high_risk_rate * 100 >= 50 and weapon_rate * 100 >= 40 then '{clustering.CRITICAL[0]}'
    when high_risk_rate * 100 >= 30 then '{clustering.ATTENTION[0]}' else '{clustering.STANDARD[0]}' end as profile,
  case when high_risk_rate * 100 >= 50 and weapon_rate * 100 >= 40 then 'Alto risco operacional - ' || {_one('high_risk_rate')}
      || '% com armas letais em ' || {_one('weapon_rate')} || '% dos casos'
    when high_risk_rate * 100 >= 30 then 'Risco elevado - ' || {_one('high_risk_rate')} || '% de situações perigosas'
    else 'Risco moderado/baixo - ' || {_one('high_risk_rate')} || '% de alto risco' end as description,
  case when high_risk_rate * 100 >= 50 and weapon_rate * 100 >= 40 then '{clustering.CRITICAL[2]}'
    when high_risk_rate * 100 >= 30 then '{clustering.ATTENTION[2]}' else '{clustering.STANDARD[2]}' end as recommendation,
  most_common_crime as crime_comum, most_common_bairro as bairro_comum, most_common_shift as turno_comum,
  printf('%.1f', {r('percentage', 1)}) || '% dos casos' as tamanho from profile"""
    ),
)
def cluster_interpretation(data):
    return clustering.cluster_interpretation(clustering.cluster_profile(weekday_assignment(data)))


# The weekday as cluster, and the risk score grouped by weekday modulo k: fixed inputs of the measures.
_FIXED = """, assigned as (select id_ocorrencia, dia_semana_idx as cluster, risk_score as x, hora / 24e0 as y from scored
  where dia_semana_idx is not null)
"""


def fixed_points(data):
    """Labelled 2-D points that SQL can rebuild."""
    from pyspark.ml.functions import array_to_vector

    rows = data.scored.where(F.col("dia_semana_idx").isNotNull())
    x = F.array(F.col("risk_score"), F.col("hora") / F.lit(24.0))
    rows = rows.select(ID, F.col("dia_semana_idx").alias("cluster"), x.alias("x"))
    return rows.withColumn("features", array_to_vector("x"))


@query(
    "silhouette_fixed",
    on_scored(
        _FIXED
        + f""", s as (select cluster, count(*) as n, sum(x) as sx, sum(y) as sy, sum(x * x + y * y) as q from assigned group by cluster),
d as (select a.id_ocorrencia, a.cluster = s.cluster as own, s.n,
    (s.n * (a.x * a.x + a.y * a.y) - 2 * (a.x * s.sx + a.y * s.sy) + s.q) as total from assigned a cross join s),
v as (select id_ocorrencia, max(n) filter (where own) as n, max(total / greatest(n - 1, 1)) filter (where own) as inner_mean,
    min(total / n) filter (where not own) as outer_mean from d group by id_ocorrencia)
select {r('avg(case when n = 1 then 0e0 else (outer_mean - inner_mean) / greatest(outer_mean, inner_mean) end)')} as silhouette_sq_euclidean from v"""
    ),
)
def silhouette_fixed(data):
    value = clustering.silhouette(fixed_points(data))
    return six(data.spark.createDataFrame([(value,)], "silhouette_sq_euclidean double"), "silhouette_sq_euclidean")


@query(
    "silhouette_euclidean_sample",
    on_scored(
        _FIXED
        + f""", sample as materialized (select * from assigned order by md5('{clustering.SEED}:' || id_ocorrencia), id_ocorrencia limit {clustering.SILHOUETTE_ROWS}),
sizes as (select cluster, count(*) as n from sample group by cluster),
d as (select a.id_ocorrencia, a.cluster = b.cluster as own, b.cluster, sum(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) as total
  from sample a cross join sample b group by all),
v as (select id_ocorrencia, max(n) filter (where own) as n, max(total / greatest(n - 1, 1)) filter (where own) as inner_mean,
    min(total / n) filter (where not own) as outer_mean from d join sizes using (cluster) group by id_ocorrencia)
select count(*) as n, {r('avg(case when n = 1 or greatest(outer_mean, inner_mean) = 0 then 0e0 else (outer_mean - inner_mean) / greatest(outer_mean, inner_mean) end)')}
  as silhouette_euclidean from v"""
    ),
)
def silhouette_euclidean_sample(data):
    found = clustering.silhouette_sample(fixed_points(data))
    return six(found.agg(F.count(F.lit(1)).alias("n"), F.avg("s").alias("silhouette_euclidean")), "silhouette_euclidean")


@query(
    "davies_bouldin_fixed",
    on_scored(
        _FIXED
        + f""", c as (select cluster, avg(x) as cx, avg(y) as cy from assigned group by cluster),
s as (select cluster, cx, cy, avg(sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy))) as spread from assigned join c using (cluster) group by all),
w as (select a.cluster, max((a.spread + b.spread) / sqrt((a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy))) as worst
  from s a join s b on a.cluster <> b.cluster group by a.cluster)
select {r('avg(worst)')} as davies_bouldin from w"""
    ),
)
def davies_bouldin_fixed(data):
    points = fixed_points(data)
    means = points.groupBy("cluster").agg(F.avg(F.col("x")[0]).alias("x"), F.avg(F.col("x")[1]).alias("y")).orderBy("cluster")
    value = clustering.davies_bouldin(points, [(m["x"], m["y"]) for m in means.collect()])
    return six(data.spark.createDataFrame([(value,)], "davies_bouldin double"), "davies_bouldin")


_SWEEP = ", sweep as (" + " union all ".join(
    f"select {k} as k, sum(v) as inertia from (select count(*) * var_pop(risk_score) as v from scored where dia_semana_idx is not null "
    f"group by dia_semana_idx % {k})"
    for k in range(1, 8)
) + ")\n"


@query(
    "elbow_fixed",
    on_scored(
        _SWEEP
        + """, b as (select k, inertia - 2 * lag(inertia, 1) over (order by k) + lag(inertia, 2) over (order by k) as bend from sweep)
select cast(max_by(k, bend) as integer) as optimal_k, cast(1 as integer) as best_silhouette_k from b where bend is not null"""
    ),
)
def elbow_fixed(data):
    """The bend rule on inertias of fixed groups: weekday modulo k."""
    rows = data.scored.where(F.col("dia_semana_idx").isNotNull())
    rows = rows.select("risk_score", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("k"), "dia_semana_idx")
    groups = rows.groupBy("k", (F.col("dia_semana_idx") % F.col("k")).alias("g")).agg(
        (F.count(F.lit(1)) * F.var_pop("risk_score")).alias("v")
    )
    sweep = groups.groupBy("k").agg(F.sum("v").alias("inertia")).withColumn("silhouette_sq_euclidean", F.lit(0.0))
    return clustering.elbow_choice(sweep)


# --- outliers --------------------------------------------------------------------------

_KEEP = ["risco_alto", "tipo_crime", "bairro", "arma_utilizada", "turno", "quantidade_suspeitos", "quantidade_vitimas"]


def flagged_anomalies(data):
    return data.memo("anomalies", lambda: anomaly.detect_anomalies(vectors(data, _KEEP)))


@query("isolation_forest")
def isolation_forest(data):
    return six(flagged_anomalies(data), "anomaly_score").select(ID, "anomaly_score", "is_anomaly")


@query("anomaly_histogram")
def anomaly_histogram(data):
    return aggregates.histogram(flagged_anomalies(data), "anomaly_score", 30, group="is_anomaly")


@query("forest_anomaly_stats")
def forest_anomaly_stats(data):
    return anomaly.anomaly_stats(flagged_anomalies(data))


@query("top_anomalies")
def top_anomalies(data):
    return six(anomaly.top_anomalies(flagged_anomalies(data)), "anomaly_score").select(ID, "anomaly_score", *_KEEP)


# Three fixed trees over the scaled features: (tree, node, feature, cut, left, right, depth).
_TREES = [
    (0, 0, 2, 0.1, 1, 2, 0.0), (0, 1, 5, -0.3, 3, 4, 1.0), (0, 2, 0, 0.4, 5, 6, 1.0), (0, 3, -1, 0.0, 3, 3, 5.25),
    (0, 4, -1, 0.0, 4, 4, 4.5), (0, 5, -1, 0.0, 5, 5, 2.0), (0, 6, 3, 1.2, 7, 8, 2.0), (0, 7, -1, 0.0, 7, 7, 3.0), (0, 8, -1, 0.0, 8, 8, 3.75),
    (1, 0, 6, 0.5, 1, 2, 0.0), (1, 1, -1, 0.0, 1, 1, 6.5), (1, 2, 4, -0.9, 3, 4, 1.0), (1, 3, -1, 0.0, 3, 3, 2.0), (1, 4, -1, 0.0, 4, 4, 4.0),
    (2, 0, -1, 0.0, 0, 0, 3.5),
]
_PATH_NORM = 8.0


@query(
    "isolation_score_fixed",
    "with recursive "
    + on_flags(
        _Z
        + f""", nodes(tree, node, feature, cut, lower, upper, depth) as (values {', '.join(f"({t}, {n}, {f}, {c!r}e0, {a}, {b}, {d!r}e0)" for t, n, f, c, a, b, d in _TREES)}),
rows as (select id_ocorrencia, [{_ZS}] as x from z),
walk(id_ocorrencia, x, tree, node) as (
  select id_ocorrencia, x, tree, 0 from rows cross join (select distinct tree from nodes)
  union all
  select w.id_ocorrencia, w.x, w.tree, case when w.x[n.feature + 1] <= n.cut then n.lower else n.upper end
  from walk w join nodes n on w.tree = n.tree and w.node = n.node where n.feature >= 0)
select id_ocorrencia, {r(f"pow(2e0, -avg(depth) / {_PATH_NORM!r}e0)")} as anomaly_score
from walk join nodes using (tree, node) where feature < 0 group by id_ocorrencia"""
    ).removeprefix("with "),
)
def isolation_score_fixed(data):
    nodes = data.spark.createDataFrame(_TREES, anomaly.NODE_SCHEMA)
    return six(anomaly.score_with(vectors(data).drop("features"), nodes, _PATH_NORM), "anomaly_score").select(ID, "anomaly_score")


# A fixed flag (the top tenth of the risk score) lets SQL check the statistics.
_ODD = """, odd as (select *, cast(risk_score > (select quantile_cont(risk_score, 9e-1) from scored) as integer) as is_anomaly from scored)
"""


def score_outliers(data):
    cut = exact_quantiles(data.scored, ["risk_score"], [0.9])["risk_score"][0]
    return data.scored.withColumn("is_anomaly", (F.col("risk_score") > F.lit(cut)).cast("int"))


@query(
    "anomaly_stats",
    on_scored(
        _ODD
        + f""", s as (select count(*) filter (where is_anomaly = 1) as total_anomalies, count(*) as n,
  avg(risco_alto) filter (where is_anomaly = 1) as a, avg(risco_alto) filter (where is_anomaly = 0) as b from odd)
select total_anomalies, {r('total_anomalies / cast(n as double) * 100')} as anomaly_percentage, {r('a')} as anomalies_high_risk_rate,
  {r('b')} as normal_high_risk_rate, {r('(a - b) * 100')} as risk_gap_pct from s"""
    ),
)
def anomaly_stats(data):
    stats = anomaly.anomaly_stats(score_outliers(data))
    return six(stats, "anomaly_percentage", "anomalies_high_risk_rate", "normal_high_risk_rate", "risk_gap_pct")


@query(
    "anomaly_histogram_fixed",
    on_scored(
        _ODD
        + f""", l as (select is_anomaly, min(risk_score) as lo, (max(risk_score) - min(risk_score)) / 30 as width from odd group by is_anomaly),
b as (select is_anomaly, least(cast(floor((risk_score - lo) / width) as integer), 29) as faixa, count(*) as n
  from odd join l using (is_anomaly) group by all),
f as (select l.*, cast(i as integer) as faixa from l cross join range(30) t(i))
select is_anomaly, faixa, {r('lo + width * faixa')} as inicio, coalesce(n, 0) as n from f left join b using (is_anomaly, faixa)"""
    ),
)
def anomaly_histogram_fixed(data):
    return aggregates.histogram(score_outliers(data), "risk_score", 30, group="is_anomaly")


@query(
    "anomaly_groups",
    on_scored(
        _ODD
        + "\nunion all\n".join(
            f"select * from (select '{c}' as grupo, {c} as chave, count(*) as qtd from odd where is_anomaly = 1 "
            f"group by {c} order by qtd desc, {c} limit 5)"
            for c in ("tipo_crime", "bairro")
        )
    ),
)
def anomaly_groups(data):
    return anomaly.anomaly_groups(score_outliers(data))
