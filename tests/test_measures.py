"""K-means in shared passes, silhouettes, covariance, outlier scores and size guards, against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from riskframe.operators import anomaly, clustering, filters, lloyd
from riskframe.operators import supervised as sv

ROW = "id_ocorrencia long, cluster int, x array<double>"


def frame(spark, x, labels=None, parts=3):
    labels = np.zeros(len(x), dtype=int) if labels is None else labels
    rows = [(i, int(c), [float(v) for v in p]) for i, (c, p) in enumerate(zip(labels, x))]
    return spark.createDataFrame(rows, ROW).repartition(parts)


def plain_lloyd(x, centers):
    passes = 0
    while True:
        gap = ((x[:, None, :] - centers[None]) ** 2).sum(-1)
        label = gap.argmin(1)
        new = np.array([x[label == i].mean(0) if (label == i).any() else c for i, c in enumerate(centers)])
        passes, shift, centers = passes + 1, ((new - centers) ** 2).sum(), new
        if shift <= lloyd.TOLERANCE:
            return centers, passes


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(5)
    return np.vstack([rng.normal(c, 0.6, (90, 3)) for c in ((0, 0, 0), (3, 0, 1), (0, 4, 2), (5, 5, 5))])


def test_all_k_share_the_passes_and_equal_single_fits(spark, points, monkeypatch):
    packed = lloyd.blocks(frame(spark, points)).cache()
    starts = [lloyd.plus_plus(points, k, np.random.default_rng(k)) for k in (2, 3, 4, 5, 7)]
    calls = []
    single = lloyd.improved
    monkeypatch.setattr(lloyd, "improved", lambda packed, fits: calls.append(len(fits)) or single(packed, fits))
    together = lloyd.converge(packed, starts)
    want = [plain_lloyd(points, c) for c in starts]
    assert len(calls) == max(p for _, p in want) == max(f.passes for f in together) and calls[0] == 5
    measures = lloyd.measured(packed, together)
    for fit, m, (centers, passes), start in zip(together, measures, want, starts):
        assert fit.passes == passes and np.allclose(fit.centers, centers)
        alone = lloyd.converge(packed, [start])[0]
        assert np.allclose(alone.centers, fit.centers)
        gap = ((points[:, None, :] - centers[None]) ** 2).sum(-1)
        assert m.inertia.sum() == pytest.approx(gap.min(1).sum())
        label = gap.argmin(1)
        assert m.n.tolist() == np.bincount(label, minlength=len(centers)).tolist()
        assert m.silhouette == pytest.approx(plain_silhouette(points, label, squared=True).mean())
    packed.unpersist()


def plain_silhouette(x, label, squared=False):
    gap = ((x[:, None, :] - x[None]) ** 2).sum(-1)
    gap = gap if squared else np.sqrt(gap)
    out = np.zeros(len(x))
    for i in range(len(x)):
        own = label == label[i]
        if own.sum() > 1:
            a = gap[i, own].sum() / (own.sum() - 1)
            b = min(gap[i, label == c].mean() for c in set(label.tolist()) - {label[i]})
            out[i] = (b - a) / max(a, b) if max(a, b) else 0.0
    return out


def test_sweep_equals_the_evaluator(spark, points):
    vecs = frame(spark, points).drop("cluster")
    row = {r["k"]: r for r in clustering.kmeans_sweep(vecs, 4).collect()}
    fit = clustering.kmeans(vecs, 4)
    from pyspark.ml.functions import array_to_vector

    labelled = fit.transform(vecs).withColumn("features", array_to_vector("x"))
    assert row[4]["silhouette_sq_euclidean"] == pytest.approx(clustering.silhouette(labelled))
    assert row[4]["davies_bouldin"] == pytest.approx(clustering.davies_bouldin(labelled, fit.clusterCenters()))


def test_a_centre_without_rows_stays(spark):
    x = np.array([[0.0], [1.0], [10.0]])
    fit = lloyd.converge(lloyd.blocks(frame(spark, x)), [np.array([[0.0], [100.0]])])[0]
    assert fit.centers[1, 0] == 100.0 and fit.centers[0, 0] == pytest.approx(11 / 3)


@pytest.mark.parametrize("rows", [1000, 100])
def test_euclidean_silhouettes(spark, points, rows):
    rng = np.random.default_rng(1)
    label = rng.integers(0, 3, len(points))
    label[7] = 9  # alone in its cluster
    df = frame(spark, points, label)
    got = {r["id_ocorrencia"]: r["s"] for r in clustering.silhouette_sample(df, rows).collect()}
    ids = np.array(sorted(got))
    assert len(ids) == min(rows, len(points))
    assert [got[i] for i in ids] == pytest.approx(plain_silhouette(points[ids], label[ids]).tolist())
    if rows >= len(points):
        assert clustering.silhouette_euclidean(df) == pytest.approx(plain_silhouette(points, label).mean())


def test_silhouette_of_one_cluster_noise_and_nothing(spark, points):
    assert clustering.silhouette_euclidean(frame(spark, points)) == 0.0
    noisy = np.r_[[-1], np.ones(len(points) - 1, dtype=int)]
    assert clustering.silhouette_euclidean(frame(spark, points, noisy)) == 0.0
    assert clustering.silhouette_sample(frame(spark, points).limit(0)).count() == 0


def test_covariance_and_components(spark, points):
    names = ["a", "b", "c"]
    df = frame(spark, points)
    got = {(r[0], r[1]): r[2] for r in clustering.covariance(df, names).collect()}
    want = np.cov(points.T)
    assert all(got[a, b] == pytest.approx(want[i, j]) for i, a in enumerate(names) for j, b in enumerate(names))
    pca = clustering.fit_pca(df, names)
    assert np.allclose(pca.loadings.T @ pca.loadings, np.eye(3))
    assert np.allclose(pca.loadings.T @ want @ pca.loadings, np.diag(np.array(pca.ratios) * np.trace(want)))
    assert (np.abs(pca.loadings).max(axis=0) == pca.loadings.max(axis=0)).all()
    two = clustering.fit_pca(df, names, 2)
    assert two.loadings.shape == (3, 2) and sum(two.ratios) < 1


def test_scores_of_a_node_table(spark):
    nodes = [(0, 0, 0, 1.0, 1, 2, 0.0), (0, 1, -1, 0.0, 0, 0, 3.0), (0, 2, 1, 0.5, 3, 4, 1.0), (0, 3, -1, 0.0, 0, 0, 2.0), (0, 4, -1, 0.0, 0, 0, 5.0)]
    nodes += [(1, 0, -1, 0.0, 0, 0, 4.0)]
    x = np.array([[1.0, 9.0], [1.1, 0.5], [2.0, 0.6]])
    got = anomaly.score_with(frame(spark, x), spark.createDataFrame(nodes, anomaly.NODE_SCHEMA), 4.0)
    paths = [(3 + 4) / 2, (2 + 4) / 2, (5 + 4) / 2]
    assert [r["anomaly_score"] for r in got.orderBy("id_ocorrencia").collect()] == pytest.approx([2 ** (-p / 4.0) for p in paths])


@pytest.mark.parametrize("purpose,fewest", [("model training", 50), ("model view", 101), ("performance curve", 51), ("unsupervised analysis", 50), ("cluster sweep", 4)])
def test_guards(spark, purpose, fewest):
    assert filters.enough(spark.range(fewest), purpose).count() == fewest
    with pytest.raises(filters.TooFewRows, match=purpose):
        filters.enough(spark.range(fewest - 1), purpose)


def test_small_data_raise_where_they_are_used(spark, data):
    from riskframe.operators import evaluation

    with pytest.raises(filters.TooFewRows):
        clustering.kmeans_sweep(frame(spark, np.zeros((3, 2))))
    with pytest.raises(filters.TooFewRows):
        evaluation.shown_curve(data.pred.limit(50))
    assert evaluation.shown_curve(data.pred.limit(51)).count() == 21
    with pytest.raises(filters.TooFewRows):
        sv.trained_view(data.modelled.limit(100))
    with pytest.raises(filters.TooFewRows):
        clustering.unsupervised_vectors(data.flagged.limit(49))


def test_time_column_of_another_name_keeps_its_text(spark):
    from riskframe.operators import prep
    from riskframe.sources.incidents import with_time_column

    df = spark.createDataFrame([(1, "31/12/2024 10:00"), (2, "01/02/2024 11:30")], "id_ocorrencia long, data_registro string")
    raw = with_time_column(df)
    clean = prep.clean(raw, {}, time_format=prep.fit_time_format(raw))
    assert sorted(str(r[0]) for r in clean.select(F.col("data_ocorrencia")).collect()) == ["2024-02-01 11:30:00", "2024-12-31 10:00:00"]
