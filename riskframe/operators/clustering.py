"""Feature matrix, scaling, k-means, PCA and cluster profiles."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.functions.layout import spread
from riskframe.functions.numeric import md5_rank, np_round
from riskframe.functions.quantiles import exact_quantiles
from riskframe.operators import lloyd
from riskframe.operators.filters import enough
from riskframe.schema import CLUSTER_FLAGS, CLUSTER_NUMBERS, CRIME, ID, LABEL, LETHAL_WEAPONS, PLACE, SHIFT, WEAPON
from riskframe.session import checkpointed, ship_package

SEED = 42
NOISE = -1
#: Rows of the sample on which Euclidean silhouettes are measured, at most.
SILHOUETTE_ROWS = 5_000

# --- fixed values: wording of the cluster profiles --------------------------------
CRITICAL = (
    "🔴 CLUSTER CRÍTICO",
    "Alto risco operacional - %.1f%% com armas letais em %.1f%% dos casos",
    "Requer protocolo de máxima segurança e backup obrigatório",
)
ATTENTION = (
    "🟡 CLUSTER DE ATENÇÃO",
    "Risco elevado - %.1f%% de situações perigosas",
    "Manter vigilância e considerar backup preventivo",
)
STANDARD = (
    "🟢 CLUSTER PADRÃO",
    "Risco moderado/baixo - %.1f%% de alto risco",
    "Abordagem padrão com cautela normal",
)
# --- end of fixed values ------------------------------------------------------------


@dataclass
class Scaler:
    """Median fill and population scaling, both as literals."""

    names: list[str]
    medians: dict[str, float]
    moments: dict[str, tuple[float, float]]

    def filled(self, name: str) -> Column:
        value = F.col(name).cast("double")
        median = self.medians.get(name)
        return value if median is None else F.coalesce(value, F.lit(median))

    def scaled(self, name: str) -> Column:
        mean, deviation = self.moments[name]
        return (self.filled(name) - F.lit(mean)) / F.lit(deviation)


def fit_scaler(df: DataFrame) -> Scaler:
    """``df`` is scored and flagged; medians are those of the rows passed in."""
    numbers = [c for c in CLUSTER_NUMBERS if c in df.columns]
    names = numbers + [c for c in CLUSTER_FLAGS if c in df.columns]
    if not names:
        raise ValueError("no numeric feature available")
    plain = Scaler(names, {}, {})
    row = df.agg(*_moments(plain, names), *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"n_{c}") for c in numbers]).first()
    gaps = [c for c in numbers if row[f"n_{c}"]]
    moments = {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in names if c not in gaps}
    medians = {c: v[0] for c, v in exact_quantiles(df, gaps, [0.5]).items() if v[0] is not None} if gaps else {}
    if gaps:  # filling a gap moves the mean and the spread
        row = df.agg(*_moments(Scaler(names, medians, {}), gaps)).first()
        moments |= {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in gaps}
    return Scaler(names, medians, moments)


def _moments(scaler: Scaler, names: list[str]) -> list[Column]:
    means = [F.avg(scaler.filled(c)).alias(f"m_{c}") for c in names]
    return means + [F.stddev_pop(scaler.filled(c)).alias(f"s_{c}") for c in names]


def feature_table(df: DataFrame, scaler: Scaler) -> DataFrame:
    return df.select(ID, *[scaler.filled(c).alias(c) for c in scaler.names])


def scaled_table(df: DataFrame, scaler: Scaler, keep: list[str] | None = None) -> DataFrame:
    return df.select(ID, *(keep or []), *[scaler.scaled(c).alias(f"z_{c}") for c in scaler.names])


def vectors(df: DataFrame, scaler: Scaler, keep: list[str] | None = None) -> DataFrame:
    """Id, kept columns, the scaled features as array ``x`` and as vector ``features``."""
    x = F.array(*[scaler.scaled(c) for c in scaler.names])
    return df.select(ID, *(keep or []), x.alias("x")).withColumn("features", array_to_vector("x"))


def unsupervised_vectors(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Scaled features of scored and flagged rows; raises on data too small for an unsupervised analysis."""
    return vectors(df, fit_scaler(enough(df, "unsupervised analysis")), keep)


def squared_distance(x: Column, center: Column) -> Column:
    parts = F.zip_with(x, center, lambda a, b: (a - b) * (a - b))
    return F.aggregate(parts, F.lit(0.0), lambda acc, v: acc + v)


def kmeans(vecs: DataFrame, k: int, seed: int = SEED, starts: int = 1) -> lloyd.Fit:
    """Lloyd iterations until the squared moves of all centres sum to at most 1e-4.

    Of several ``starts`` the one with the least inertia is taken.
    """
    return lloyd.kmeans_fits(vecs, [k], seed, starts)[0][0]


def ordered_centers(model) -> list[int]:
    """New label of each centre: centres numbered in lexicographic order."""
    centers = [tuple(c) for c in model.clusterCenters()]
    order = sorted(range(len(centers)), key=lambda i: centers[i])
    rank = {old: new for new, old in enumerate(order)}
    return [rank[i] for i in range(len(centers))]


def kmeans_labels(vecs: DataFrame, k: int = 4, seed: int = SEED, starts: int = 1) -> DataFrame:
    """``vecs`` with ``cluster``; centres are numbered in lexicographic order."""
    fit = kmeans(vecs, k, seed, starts)
    order = np.argsort(ordered_centers(fit))
    return lloyd.Fit(fit.centers[order]).transform(vecs)


def davies_bouldin(labelled: DataFrame, centers: list) -> float:
    """Mean over clusters of the worst (spread + spread) / centre distance."""
    table = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centers])
    gap = F.sqrt(squared_distance(F.col("x"), F.element_at(table, F.col("cluster") + 1)))
    return _davies_bouldin({r["cluster"]: r["s"] for r in labelled.groupBy("cluster").agg(F.avg(gap).alias("s")).collect()}, centers)


def _davies_bouldin(spreads: dict[int, float], centers: list) -> float:
    """``spreads``: mean distance to the centre of every cluster that has rows."""
    used = sorted(spreads)
    if len(used) < 2:
        return 0.0
    worst = []
    for i in used:
        ratios = []
        for j in used:
            distance = float(np.linalg.norm(np.asarray(centers[i]) - np.asarray(centers[j])))
            if i != j:
                ratios.append((spreads[i] + spreads[j]) / distance if distance else math.inf)
        worst.append(max(ratios))
    return float(np.mean(worst))


def silhouette(labelled: DataFrame) -> float:
    """Mean silhouette on squared Euclidean distances (computed from cluster sums, linear cost).

    0 if there is only one cluster, or noise.
    """
    ends = labelled.agg(F.min("cluster").alias("low"), F.max("cluster").alias("high")).first()
    if ends["low"] == ends["high"] or ends["low"] == NOISE:
        return 0.0
    return ClusteringEvaluator(featuresCol="features", predictionCol="cluster").evaluate(labelled)


def silhouette_sample(labelled: DataFrame, rows: int = SILHOUETTE_ROWS, seed: int = SEED) -> DataFrame:
    """(id, cluster, s): Euclidean silhouettes of a seeded sample of at most ``rows`` rows, against that sample.

    The sample is broadcast and every block of it summed against all of it, so no pair becomes a row.  A row alone in its
    cluster has 0, and so has every row if the sample has one cluster.
    """
    rank = md5_rank(F.col(ID), seed)
    sample = checkpointed(labelled.select(ID, "cluster", "x").orderBy(rank, ID).limit(rows))
    held = sample.orderBy(ID).toPandas()
    if not len(held):
        return sample.select(ID, "cluster", F.lit(0.0).alias("s"))
    kinds, code = np.unique(held["cluster"].to_numpy(), return_inverse=True)
    shared = labelled.sparkSession.sparkContext.broadcast((np.stack(held["x"].to_numpy()), code, kinds))
    id_type = dict(sample.dtypes)[ID]
    ship_package(labelled.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        points, code, kinds = shared.value
        sizes = np.bincount(code, minlength=len(kinds))
        member = np.eye(len(kinds))[code]
        for batch in batches:
            if not len(batch):
                continue
            x, own = np.stack(batch["x"].to_numpy()), np.searchsorted(kinds, batch["cluster"].to_numpy())
            sums = np.empty((len(x), len(kinds)))
            for at in range(0, len(x), 128):
                part = x[at : at + 128]
                squares = np.zeros((len(part), len(points)))
                for i in range(points.shape[1]):
                    squares += (part[:, i, None] - points[None, :, i]) ** 2
                sums[at : at + 128] = np.sqrt(squares) @ member
            rows = np.arange(len(x))
            inside = sums[rows, own] / np.maximum(sizes[own] - 1, 1)
            mean = sums / sizes
            mean[rows, own] = np.inf
            outside = mean.min(axis=1)
            worse = np.maximum(inside, outside)
            scored = (sizes[own] > 1) & np.isfinite(outside) & (worse > 0)
            s = np.where(scored, (outside - inside) / np.where(scored, worse, 1.0), 0.0)
            yield pd.DataFrame({ID: batch[ID], "cluster": batch["cluster"], "s": s})

    return spread(sample).mapInPandas(run, f"{ID} {id_type}, cluster int, s double")


def silhouette_euclidean(labelled: DataFrame, rows: int = SILHOUETTE_ROWS, seed: int = SEED) -> float:
    """Mean Euclidean silhouette of a seeded sample; 0 if there is only one cluster, or noise."""
    ends = labelled.agg(F.min("cluster").alias("low"), F.max("cluster").alias("high")).first()
    if ends["low"] == ends["high"] or ends["low"] == NOISE:
        return 0.0
    return float(silhouette_sample(labelled, rows, seed).agg(F.avg("s")).first()[0])


def clustering_summary(labelled: DataFrame, pca: Components, method: str) -> DataFrame:
    """One row: number of clusters, silhouettes, variance kept by two components."""
    clusters = labelled.where(F.col("cluster") != NOISE).agg(F.count_distinct("cluster").alias("n")).first()["n"]
    row = (method, clusters, float(silhouette(labelled)), silhouette_euclidean(labelled), float(sum(pca.ratios[:2])))
    schema = "method string, n_clusters long, silhouette_sq_euclidean double, silhouette_euclidean double, pca_variance_explained double"
    return labelled.sparkSession.createDataFrame([row], schema)


def kmeans_sweep(vecs: DataFrame, max_clusters: int = 8, seed: int = SEED, starts: int = 1) -> DataFrame:
    """Inertia, silhouette and Davies-Bouldin index for every k that the row count allows.

    All k are fitted in the same passes over the rows.
    """
    enough(vecs, "cluster sweep")
    n = vecs.count()
    ks = list(range(2, min(max_clusters + 1, max(3, n // 5))))
    rows = []
    for k, (fit, m) in zip(ks, lloyd.kmeans_fits(vecs, ks, seed, starts, measures=True)):
        spreads = {i: m.spread[i] / m.n[i] for i in np.flatnonzero(m.n)}
        rows.append((k, fit.inertia, float(m.silhouette), _davies_bouldin(spreads, fit.centers)))
    return vecs.sparkSession.createDataFrame(
        rows, "k int, inertia double, silhouette_sq_euclidean double, davies_bouldin double"
    )


def elbow_choice(sweep: DataFrame) -> DataFrame:
    """Suggested k: two rows after the start of the strongest bend of the inertia.

    With fewer than three k values, the one with the best silhouette.
    """
    by_k = Window.orderBy("k")  # one row per k
    bend = F.col("inertia") - 2 * F.lag("inertia", 1).over(by_k) + F.lag("inertia", 2).over(by_k)
    rows = sweep.withColumn("bend", bend)
    return rows.agg(
        F.coalesce(
            F.max_by("k", F.when(F.col("bend").isNotNull(), F.struct(F.col("bend"), -F.col("k")))),
            F.max_by("k", F.struct(F.col("silhouette_sq_euclidean"), -F.col("k"))),
        ).alias("optimal_k"),
        F.max_by("k", F.struct(F.col("silhouette_sq_euclidean"), -F.col("k"))).alias("best_silhouette_k"),
    )


# --- PCA ------------------------------------------------------------------------------


@dataclass
class Components:
    names: list[str]
    loadings: np.ndarray  # features x components, largest absolute loading positive
    ratios: list[float]

    def coordinate(self, component: int) -> Column:
        weights = [F.col("x")[i] * F.lit(float(w)) for i, w in enumerate(self.loadings[:, component])]
        out = weights[0]
        for w in weights[1:]:
            out = out + w
        return out


def covariance(vecs: DataFrame, names: list[str]) -> DataFrame:
    """(feature_a, feature_b, covariance) of all pairs of components of ``x``, in one pass of co-moments."""
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    x = F.col("x")
    row = vecs.agg(*[F.covar_samp(x[i], x[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    found = {(i, j): row[f"c{i}_{j}"] for i, j in pairs}
    rows = [(a, b, found[min(i, j), max(i, j)]) for i, a in enumerate(names) for j, b in enumerate(names)]
    return vecs.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, covariance double")


def fit_pca(vecs: DataFrame, names: list[str], components: int | None = None) -> Components:
    """Principal components: the eigenvectors of the covariance matrix, largest variance first."""
    place = {n: i for i, n in enumerate(names)}
    matrix = np.zeros((len(names), len(names)))
    for r in covariance(vecs, names).collect():  # a row per pair of features
        matrix[place[r["feature_a"]], place[r["feature_b"]]] = r["covariance"] or 0.0
    values, loadings = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")
    values, loadings = np.maximum(values[order], 0.0), loadings[:, order]
    strongest = np.abs(loadings).argmax(axis=0)
    signs = np.sign(loadings[strongest, range(loadings.shape[1])])
    ratios = values / values.sum() if values.sum() else values
    kept = components or len(names)
    return Components(names, (loadings * np.where(signs == 0, 1, signs))[:, :kept], [float(v) for v in ratios[:kept]])


def pca_coordinates(vecs: DataFrame, pca: Components) -> DataFrame:
    return vecs.withColumns({"pca_1": pca.coordinate(0), "pca_2": pca.coordinate(1)})


def pca_variance(spark, pca: Components, enough: float = 0.90) -> DataFrame:
    """Share of variance per component, running sum, and how many reach ``enough``."""
    running = np.cumsum(pca.ratios)
    reached = int(np.argmax(running >= enough)) + 1
    rows = [(i + 1, float(v), float(c), reached) for i, (v, c) in enumerate(zip(pca.ratios, running))]
    return spark.createDataFrame(rows, "componente int, variancia double, acumulada double, n_componentes_90 int")


def pca_loadings(spark, pca: Components, shown: int = 3) -> DataFrame:
    shown = min(shown, pca.loadings.shape[1])
    rows = [(n, *[float(v) for v in pca.loadings[i, :shown]]) for i, n in enumerate(pca.names)]
    schema = "feature string, " + ", ".join(f"PC{i + 1} double" for i in range(shown))
    frame = spark.createDataFrame(rows, schema)
    return frame.withColumns({f"PC{i + 1}": np_round(F.col(f"PC{i + 1}"), 3) for i in range(shown)})


def pca_centers(placed: DataFrame) -> DataFrame:
    return placed.groupBy("cluster").agg(
        F.avg("pca_1").alias("pca_1"), F.avg("pca_2").alias("pca_2")
    ).orderBy("cluster")


# --- profiles -------------------------------------------------------------------------


def cluster_profile(assigned: DataFrame) -> DataFrame:
    """Size, means and most common values per cluster; noise (-1) counts only in the total.

    Common values are found from counts per (cluster, value), never from a collected group.
    """
    lethal = F.coalesce(F.col(WEAPON).isin(LETHAL_WEAPONS), F.lit(False)).cast("double")
    sums = assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.avg(LABEL).alias("high_risk_rate"),
        F.avg("quantidade_suspeitos").alias("avg_suspects"),
        F.avg(lethal).alias("weapon_rate"),
    )
    everything = Window.partitionBy()  # one row per cluster
    sums = sums.withColumn("percentage", F.col("size") / F.sum("size").over(everything) * 100)
    kinds = {"most_common_crime": CRIME, "most_common_bairro": PLACE, "most_common_shift": SHIFT}
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("v")) for k, c in kinds.items()])
    values = assigned.where(F.col("cluster") != NOISE).select("cluster", F.explode(pairs).alias("p")).select("cluster", "p.*")
    counts = values.where(F.col("v").isNotNull()).groupBy("cluster", "kind", "v").agg(F.count(F.lit(1)).alias("n"))
    modes = counts.groupBy("cluster").agg(
        *[
            F.min_by("v", F.when(F.col("kind") == k, F.struct(-F.col("n"), F.col("v")))).alias(k)
            for k in kinds
        ]
    )
    joined = sums.where(F.col("cluster") != NOISE).join(modes, "cluster", "left")
    columns = [
        F.col("cluster").alias("cluster_id"), "size", "percentage", "avg_risk_score", "high_risk_rate",
        "avg_suspects", "weapon_rate", *[F.coalesce(k, F.lit("N/A")).alias(k) for k in kinds],
    ]
    return joined.select(*columns).orderBy("cluster_id")


def cluster_interpretation(profile: DataFrame) -> DataFrame:
    risk, weapon = F.col("high_risk_rate") * 100, F.col("weapon_rate") * 100
    shown_risk, shown_weapon = np_round(risk, 1), np_round(weapon, 1)
    critical, attention = (risk >= 50) & (weapon >= 40), risk >= 30

    def choose(index):
        def text(words, *values):
            return F.format_string(words[index], *values) if values else F.lit(words[index])

        described = index == 1
        return (
            F.when(critical, text(CRITICAL, *((shown_risk, shown_weapon) if described else ())))
            .when(attention, text(ATTENTION, *((shown_risk,) if described else ())))
            .otherwise(text(STANDARD, *((shown_risk,) if described else ())))
        )

    return profile.select(
        "cluster_id",
        choose(0).alias("profile"),
        choose(1).alias("description"),
        choose(2).alias("recommendation"),
        F.col("most_common_crime").alias("crime_comum"),
        F.col("most_common_bairro").alias("bairro_comum"),
        F.col("most_common_shift").alias("turno_comum"),
        F.format_string("%.1f%% dos casos", np_round(F.col("percentage"), 1)).alias("tamanho"),
    )
