"""Invariants of fitted models; DBSCAN against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from riskframe.operators import anomaly, clustering, splits
from riskframe.operators import supervised as sv
from riskframe.operators.components import connected_components
from riskframe.operators.dbscan import dbscan
from riskframe.plans import model_queries as mq


def brute_dbscan(ids, x, eps, min_points):
    near = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= min_points
    labels, number = np.full(len(x), -1), 0
    for i in np.argsort(ids):
        if labels[i] != -1 or not core[i]:
            continue
        labels[i], stack = number, [i]
        while stack:
            j = stack.pop()
            if core[j]:
                for k in np.flatnonzero(near[j] & (labels == -1)):
                    labels[k] = number
                    stack.append(k)
        number += 1
    return labels


def check_dbscan(spark, ids, x, eps, min_points, leaf_points=None):
    df = spark.createDataFrame([(int(i), [float(v) for v in p]) for i, p in zip(ids, x)], "id_ocorrencia long, x array<double>")
    found = dbscan(df, eps, min_points, leaf_points).select("id_ocorrencia", "cluster", "core").collect()
    got = {r[0]: r[1] for r in found}
    assert [got[i] for i in ids] == list(brute_dbscan(ids, x, eps, min_points))
    near = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1) <= eps * eps
    core = {r[0]: r[2] for r in found}
    assert [core[i] for i in ids] == (near.sum(1) >= min_points).astype(int).tolist()


@pytest.mark.parametrize("case", ["blobs", "dense", "copies"])
def test_dbscan_equals_brute_force(spark, case):
    rng = np.random.default_rng(7)
    if case == "blobs":
        x = np.vstack([rng.normal(0, 0.4, (110, 2)), rng.normal(4, 0.4, (110, 2)), rng.uniform(-3, 8, (60, 2))])
        eps = 0.5
    elif case == "dense":
        x, eps = rng.uniform(0, 1.6, (280, 4)), 0.45
    else:  # a third of all rows are one vector
        x, eps = np.vstack([np.zeros((90, 3)), rng.integers(0, 4, (180, 3)) * 0.3]), 0.31
    check_dbscan(spark, rng.permutation(len(x)), x, eps, 5)


@pytest.mark.parametrize("case", ["plane", "sheets"])
def test_dbscan_down_the_box_trees(spark, case):
    """Leaves of few points: nearly every undecided pair walks down the trees."""
    rng = np.random.default_rng(11)
    if case == "plane":
        x, eps = np.vstack([rng.uniform(0, 2, (220, 2)), rng.uniform(4, 9, (40, 2))]), 0.6
    else:  # two full sheets of cells that touch at a few points alone
        x = np.vstack([np.c_[rng.uniform(0, 1, 130), rng.uniform(0, 0.2, 130)], np.c_[rng.uniform(0, 1, 130), rng.uniform(0.75, 0.95, 130)]])
        eps = 0.57
    check_dbscan(spark, rng.permutation(len(x)), x, eps, 5, leaf_points=3)


def test_dbscan_with_shuffled_joins(spark, monkeypatch):
    """No broadcast, and every key counts as hot."""
    from riskframe.functions import lookup

    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 2)
    monkeypatch.setattr(lookup, "SMALL_ROWS", 0)
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(0, 0.4, (80, 2)), rng.normal(3, 0.4, (80, 2)), rng.uniform(-2, 5, (30, 2))])
    check_dbscan(spark, rng.permutation(len(x)), x, 0.5, 5)


def test_dbscan_on_incidents(spark, data):
    rows = mq.vectors(data).select("id_ocorrencia", "x").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    check_dbscan(spark, ids, x, 1.0, 5)


def test_components(spark):
    nodes = spark.range(1, 60).withColumnRenamed("id", "node")
    chain = spark.range(1, 40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {r[0]: r[1] for r in connected_components(nodes, chain).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: i for i in range(41, 60)}}


def test_kmeans_invariants(data):
    vecs = mq.vectors(data)
    labelled = clustering.kmeans_labels(vecs, 3).cache()
    sizes = [r["count"] for r in labelled.groupBy("cluster").count().collect()]
    assert len(sizes) == 3 and sum(sizes) == data.clean.count()
    again = clustering.kmeans_labels(vecs, 3)
    assert labelled.select("id_ocorrencia", "cluster").exceptAll(again.select("id_ocorrencia", "cluster")).count() == 0


def test_sweep_bounds_and_elbow(spark, data):
    tiny = mq.vectors(data).limit(12)
    assert [r["k"] for r in clustering.kmeans_sweep(tiny, 8).collect()] == [2]
    rows = [(2, 100.0, 0.3, 1.0), (3, 60.0, 0.5, 1.0), (4, 50.0, 0.4, 1.0), (5, 45.0, 0.2, 1.0)]
    schema = "k int, inertia double, silhouette_sq_euclidean double, davies_bouldin double"
    choice = clustering.elbow_choice(spark.createDataFrame(rows, schema)).first()
    assert (choice["optimal_k"], choice["best_silhouette_k"]) == (4, 3)
    two = clustering.elbow_choice(spark.createDataFrame(rows[:2], schema)).first()
    assert two["optimal_k"] == 3


def test_davies_bouldin_matches_numpy(data):
    vecs = mq.vectors(data).cache()
    model = clustering.kmeans(vecs, 3)
    labelled = model.transform(vecs)
    rows = labelled.select("x", "cluster").collect()
    x, labels = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    centers = model.clusterCenters()
    s = [np.linalg.norm(x[labels == i] - centers[i], axis=1).mean() for i in range(3)]
    worst = [max((s[i] + s[j]) / np.linalg.norm(centers[i] - centers[j]) for j in range(3) if j != i) for i in range(3)]
    assert clustering.davies_bouldin(labelled, centers) == pytest.approx(np.mean(worst))


def test_pca_invariants(data):
    fitted = mq.pca(data)
    assert sum(fitted.ratios) == pytest.approx(1.0)
    assert np.allclose(fitted.loadings.T @ fitted.loadings, np.eye(len(fitted.names)), atol=1e-8)
    x = np.array([r[0] for r in mq.vectors(data).select("x").collect()])
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert fitted.ratios == pytest.approx(list(values / values.sum()))


def test_isolation_forest(spark, data):
    flagged = mq.flagged_anomalies(data)
    n = flagged.count()
    assert flagged.where("is_anomaly = 1").count() <= 0.1 * n
    assert flagged.where("is_anomaly = 1").count() >= 0.08 * n
    rows = [(i, [float(i % 7) / 7, float(i % 11) / 11]) for i in range(500)] + [(999, [9.0, 9.0])]
    odd = anomaly.anomaly_scores(spark.createDataFrame(rows, "id_ocorrencia long, x array<double>"), trees=20)
    assert odd.orderBy(F.desc("anomaly_score")).first()["id_ocorrencia"] == 999
    scores = [r["anomaly_score"] for r in odd.collect()]
    assert 0 < min(scores) and max(scores) <= 1


def test_forest_samples_have_the_right_size(spark):
    df = spark.range(5000).select(F.col("id").alias("id_ocorrencia"), F.array(F.col("id").cast("double")).alias("x"))
    for trees, size in ((10, 256), (30, 256)):
        counts = anomaly.tree_samples(df, trees, size).groupBy("tree").count().collect()
        assert [r["count"] for r in counts] == [size] * trees


@pytest.fixture(scope="module")
def small_forest(data):
    return sv.train_forest(data.clean, trees=10, depth=5)


def test_forest_learns(data, small_forest):
    model, split = small_forest
    row = sv.test_metrics(model, splits.part(split, "train"), splits.part(split, "test")).first()
    assert row["roc_auc"] > 0.7 and row["train_size"] + row["test_size"] == data.clean.count()
    importance = {r[0]: r[1] for r in sv.feature_importance(model, data.clean).collect()}
    assert sum(importance.values()) == pytest.approx(1.0) and set(importance) == set(model.preprocessor.names)


def test_unknown_categories_are_zeros(data, small_forest):
    prep = small_forest[0].preprocessor
    strange = data.clean.limit(1).withColumn("bairro", F.lit("nowhere"))
    values = prep.transform(strange).first()["features"].toArray()
    places = [i for i, n in enumerate(prep.names) if n.startswith("bairro_")]
    assert len(values) == len(prep.names) and not values[places].any()


def test_permutation_importance_of_unused_feature_is_zero(data, small_forest):
    model, split = small_forest
    got = {r[0]: r[1] for r in sv.permutation_importance(model, splits.part(split, "test"), repeats=3, top=None).collect()}
    unused = [n for n, v in zip(model.preprocessor.names, model.classifier.featureImportances.toArray()) if v == 0]
    assert all(got.get(n, 0.0) == 0.0 for n in unused)
    assert max(got.values()) > 0


def test_new_calls_with_missing_columns(spark, small_forest):
    calls = spark.createDataFrame([(1, None, 2.0)], "id_ocorrencia long, bairro string, quantidade_suspeitos double")
    row = sv.score_new_calls(small_forest[0], calls).first()
    assert 0 <= row["probability"] <= 1 and row["decision"] in ("ALTO RISCO", "Baixo risco")


def test_grid_search(data):
    got = sv.grid_search(data.clean, trees=(3,), depths=(2, 4), min_leaf=(1,), folds=2).collect()
    assert [r["max_depth"] for r in got] == [2, 4] and sum(r["best"] for r in got) >= 1


def test_too_few_rows_to_train(data):
    from riskframe.operators.filters import TooFewRows

    with pytest.raises(TooFewRows):
        sv.train_forest(data.clean.limit(20))
