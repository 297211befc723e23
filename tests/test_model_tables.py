"""Models as tables: forests read by prefix and truncation, linear models by join."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from riskframe.operators import evaluation, model_tables, splits
from riskframe.operators import supervised as sv


@pytest.fixture(scope="module")
def grown(data):
    return sv.train_forest(data.modelled, trees=8, depth=7, min_leaf=2)


def test_node_table_scores_as_the_forest(spark, data, grown):
    model, split = grown
    ready = model.preprocessor.transform(splits.part(split, "test"))
    rows = model.score_features(ready).select(vector_to_array("features").alias("x"), "probability").collect()
    x, want = np.array([r["x"] for r in rows]), np.array([r["probability"] for r in rows])
    forest = model_tables.Forest.of(model_tables.forest_nodes(spark, model.classifier).toPandas())
    assert len(forest.roots) == 8
    got = np.mean([forest.shares(x, t, [7])[7] for t in range(8)], axis=0)
    assert got == pytest.approx(want)
    root = forest.shares(x, 0, [0])[0]
    assert len(set(root.tolist())) == 1  # no step taken: the share of all training rows


def test_prefix_and_truncation_of_one_forest(spark, data, grown):
    model, split = grown
    ready = model.preprocessor.transform(splits.part(split, "test"))
    nodes = model_tables.forest_nodes(spark, model.classifier)
    forest = model_tables.Forest.of(nodes.toPandas())
    rows = ready.select(vector_to_array("features").alias("x"), "risco_alto").collect()
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    counts = model_tables.smaller_forests(ready.repartition(3), nodes, [3, 8], [2, 7], "risco_alto").collect()
    for t in (3, 8):
        for d in (2, 7):
            said = np.mean([forest.shares(x, k, [d])[d] for k in range(t)], axis=0) >= 0.5
            for a in (0, 1):
                for b in (0, 1):
                    found = [r["n"] for r in counts if (r["trees"], r["depth"], r["y"], r["prediction"]) == (t, d, a, b)]
                    assert found == [int(((y == a) & (said == b)).sum())]


def test_grid_scores_are_near_those_of_single_fits(data):
    """A shallower forest read from a deep one scores about as one that was grown to that depth."""
    df = data.modelled
    got = {(r["n_estimators"], r["max_depth"]): r["f1_macro"] for r in sv.grid_search(df, (5, 10), (4, 8), (2,), folds=2).collect()}
    assert len(got) == 4
    fold = (sv.hash_rank(F.col("id_ocorrencia"), sv.SEED) % 2).cast("int")
    ready = sv.Preprocessor(list(sv.MODEL_NUMBERS), list(sv.MODEL_CATEGORIES)).fit(df).transform(df).withColumns({"fold": fold, sv.WEIGHT: F.lit(1.0)})
    scores = []
    for held in (0, 1):
        fit = sv.forest(10, 4, 2).fit(ready.where(F.col("fold") != held))
        pred = fit.transform(ready.where(F.col("fold") == held)).select(F.col("risco_alto").alias("y"), F.col("prediction").alias("score"))
        scores.append(evaluation.eval_metrics(pred, 0.5).first()["f1_macro"])
    assert got[10, 4] == pytest.approx(sum(scores) / 2, abs=0.12)


def test_macro_f1_of_counts(spark):
    rows = [(1, 1.0)] * 5 + [(1, 0.0)] * 3 + [(0, 1.0)] * 2 + [(0, 0.0)] * 7
    want = evaluation.eval_metrics(spark.createDataFrame(rows, "y int, score double"), 0.5).first()["f1_macro"]
    assert sv._macro_f1({(1, 1): 5, (1, 0): 3, (0, 1): 2, (0, 0): 7}) == pytest.approx(want, abs=1e-6)
    assert sv._macro_f1({(0, 0): 4}) == 0.5


def test_coefficient_table_scores_as_the_model(spark, data):
    train = data.modelled
    model = sv.train_models(train, {"LogisticRegression": sv.logistic})["LogisticRegression"]
    want = {r[0]: r[1] for r in model.predict(train).select("id_ocorrencia", "probability").collect()}
    table = model_tables.linear_table(spark, model)
    prep = model.preprocessor
    got = model_tables.linear_scores(train, table, {c: prep.scaled(c) for c in prep.numbers}, prep.categories)
    found = {r["id_ocorrencia"]: r["probability"] for r in got.collect()}
    assert found.keys() == want.keys()
    assert all(found[i] == pytest.approx(p) for i, p in want.items())


def test_unknown_and_missing_categories_weigh_nothing(spark):
    table = spark.createDataFrame([("a", 2.0), ("c_x", 1.0), (model_tables.INTERCEPT, -1.0)], "feature string, weight double")
    df = spark.createDataFrame([(1, 1.0, "x"), (2, None, "x"), (3, 1.0, "never seen"), (4, None, None)], "id_ocorrencia long, a double, c string")
    got = {r[0]: r[1] for r in model_tables.linear_scores(df, table, {"a": F.col("a")}, ["c"]).select("id_ocorrencia", "probability").collect()}
    assert got == pytest.approx({i: 1 / (1 + np.exp(-m)) for i, m in ((1, 2.0), (2, 0.0), (3, 1.0), (4, -1.0))})
