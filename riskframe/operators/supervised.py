"""Supervised models of the high-risk label on MLlib."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.functions.layout import spread, tasks
from riskframe.functions.numeric import as_number, hash_rank, np_round, safe_ratio
from riskframe.operators import evaluation, model_tables
from riskframe.operators.deep_forest import DeepForest, DeepForestModel
from riskframe.operators.filters import enough
from riskframe.operators.level_forest import LevelForest
from riskframe.operators.splits import class_weights, part, temporal_split
from riskframe.schema import COMPACT_CATEGORIES, ID, IGNORED, LABEL, MODEL_CATEGORIES, MODEL_NUMBERS
from riskframe.session import checkpointed, ship_package, use_checkpoint_dir

SEED = 42
#: Depth up to which a forest is grown level by level.
LEVEL_DEPTH = 10
FEATURES = "features"
WEIGHT = "peso"


@dataclass
class Preprocessor:
    """Standardised numbers and one-hot categories; unknown categories are all zeros.

    Scaling uses the population deviation and enters as literals.  A missing number
    becomes the training mean, that is 0 after scaling.
    """

    numbers: list[str]
    categories: list[str]
    moments: dict[str, tuple[float, float]] = field(default_factory=dict)
    indexer: Model | None = None
    encoder: Model | None = None

    def fit(self, train: DataFrame) -> Preprocessor:
        self.numbers = [c for c in self.numbers if c in train.columns]
        self.categories = [c for c in self.categories if c in train.columns]
        if not self.numbers and not self.categories:
            raise ValueError("no feature column found")
        if self.numbers:
            row = train.agg(
                *[F.avg(c).alias(f"m_{c}") for c in self.numbers],
                *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in self.numbers],
            ).first()
            self.moments = {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in self.numbers}
        if self.categories:
            self.indexer = StringIndexer(
                inputCols=self.categories,
                outputCols=[f"{c}_ix" for c in self.categories],
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ).fit(train)
            # the last index is the slot of unknown values, which dropLast removes
            self.encoder = OneHotEncoder(
                inputCols=self.indexer.getOutputCols(), outputCols=[f"{c}_1h" for c in self.categories]
            ).fit(self.indexer.transform(train.select(*self.categories).limit(1)))
        return self

    @property
    def names(self) -> list[str]:
        labels = self.indexer.labelsArray if self.indexer else []
        return self.numbers + [f"{c}_{v}" for c, values in zip(self.categories, labels) for v in values]

    def scaled(self, name: str) -> Column:
        mean, deviation = self.moments[name]
        return F.coalesce((F.col(name).cast("double") - F.lit(mean)) / F.lit(deviation), F.lit(0.0))

    def transform(self, df: DataFrame) -> DataFrame:
        out = df.withColumns({f"{c}_sc": self.scaled(c) for c in self.numbers})
        inputs = [f"{c}_sc" for c in self.numbers]
        if self.categories:
            out = self.encoder.transform(self.indexer.transform(out))
            inputs += self.encoder.getOutputCols()
            out = out.drop(*self.indexer.getOutputCols())
        return VectorAssembler(inputCols=inputs, outputCol=FEATURES).transform(out).drop(*inputs)


@dataclass
class RiskModel:
    """A fitted classifier with its preprocessing and decision threshold."""

    name: str
    preprocessor: Preprocessor
    classifier: Model
    threshold: float = 0.5

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` and the 0/1 ``prediction`` at the threshold."""
        return self.score_features(self.preprocessor.transform(df)).drop(FEATURES)

    def score_features(self, df: DataFrame) -> DataFrame:
        scored = self.classifier.transform(df).drop("rawPrediction", "prediction")
        return scored.withColumn("probability", vector_to_array("probability")[1]).withColumn(
            "prediction", (F.col("probability") >= self.threshold).cast("int")
        )


def _weighted(df: DataFrame) -> DataFrame:
    weights = {r[LABEL]: r["peso"] for r in class_weights(df).collect()}
    expr = F
    for value, weight in weights.items():
        expr = expr.when(F.col(LABEL) == value, weight)
    return df.withColumn(WEIGHT, expr.otherwise(1.0))


def forest(trees: int = 200, depth: int = 10, min_leaf: int = 5) -> LevelForest | DeepForest:
    """A forest grown level by level, or in tasks below its big nodes if it is deeper than ``LEVEL_DEPTH``."""
    kind = LevelForest if depth <= LEVEL_DEPTH else DeepForest
    return kind(trees, depth, min_leaf, FEATURES, LABEL, WEIGHT, SEED)


def logistic(rows: int) -> LogisticRegression:
    """L2 penalty of strength 1 on the summed loss, hence 1/rows on the mean loss."""
    return LogisticRegression(
        featuresCol=FEATURES,
        labelCol=LABEL,
        weightCol=WEIGHT,
        maxIter=1000,
        tol=1e-5,
        regParam=1.0 / max(rows, 1),
        standardization=False,
    )


def train_models(
    train: DataFrame, makers: dict, numbers: list[str] = MODEL_NUMBERS, categories: list[str] = MODEL_CATEGORIES
) -> dict[str, RiskModel]:
    """Fit several classifiers on the same prepared rows; ``makers``: name -> fn(row count)."""
    use_checkpoint_dir(train.sparkSession)  # the forest checkpoints its cached node ids
    columns = [c for c in [ID, LABEL, *numbers, *categories] if c in train.columns]
    rows = spread(train.select(*columns)).persist(StorageLevel.MEMORY_AND_DISK)
    preprocessor = Preprocessor(list(numbers), list(categories)).fit(rows)
    ready = preprocessor.transform(_weighted(rows)).select(ID, FEATURES, LABEL, WEIGHT)
    ready = ready.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        count = ready.count()
        return {name: RiskModel(name, preprocessor, make(count).fit(ready)) for name, make in makers.items()}
    finally:
        ready.unpersist()
        rows.unpersist()


def train_forest(df: DataFrame, trees: int = 200, depth: int = 10, min_leaf: int = 5, **features) -> tuple[RiskModel, DataFrame]:
    """Forest on the earlier rows; returns the model and the split frame."""
    enough(df, "model training")
    split = temporal_split(df)
    makers = {"RandomForest": lambda n: forest(trees, depth, min_leaf)}
    return train_models(part(split, "train"), makers, **features)["RandomForest"], split


def trained_view(df: DataFrame, **forest) -> tuple[RiskModel, DataFrame]:
    """The forest of a view over filtered rows; raises if the filters leave too few."""
    return train_forest(enough(df, "model view"), **forest)


def as_predictions(model: RiskModel, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Narrow prediction rows, written once: evaluation passes do not score the rows again."""
    return checkpointed(evaluation.predictions(model.predict(spread(df)), "probability", keep=keep))


def test_metrics(model: RiskModel, train: DataFrame, test: DataFrame) -> DataFrame:
    """One row: metrics on the test part and the sizes of both parts."""
    pred = as_predictions(model, test)
    auc = evaluation.roc_auc(pred).first()["roc_auc"]
    row = evaluation.eval_metrics(pred, model.threshold).first()
    sizes = (train.count(), row["support_total"])
    values = (model.name, model.threshold, row["precision"], row["recall"], row["f1"], auc, *sizes)
    schema = "model string, threshold double, precision double, recall double, f1 double, roc_auc double, train_size long, test_size long"
    return df_of(train, [values], schema)


def df_of(like: DataFrame, rows: list, schema: str) -> DataFrame:
    return like.sparkSession.createDataFrame(rows, schema)


def prediction_summary(predicted: DataFrame) -> DataFrame:
    return predicted.agg(
        F.sum(F.col("prediction").cast("long")).alias("high_risk_count"),
        np_round(F.avg("probability"), 6).alias("avg_risk_score"),
    )


@dataclass
class ModelChoice:
    model: RiskModel
    scores: dict[str, tuple[float, float]]  # name -> (threshold, validation F1)

    def table(self, like: DataFrame) -> DataFrame:
        rows = [(n, t, f, int(n == self.model.name)) for n, (t, f) in sorted(self.scores.items())]
        return df_of(like, rows, "model string, threshold double, f1_valid double, chosen int")


def choose_model(
    train: DataFrame,
    valid: DataFrame,
    trees: int = 300,
    depth: int = 30,
    numbers: list[str] = MODEL_NUMBERS,
    categories: list[str] = COMPACT_CATEGORIES,
) -> ModelChoice:
    """Logistic regression against forest by best validation F1; the forest wins ties."""
    makers = {"RandomForest": lambda n: forest(trees, depth, 1), "LogisticRegression": logistic}
    models = train_models(train, makers, numbers, categories)
    scores = {}
    for name, model in models.items():
        best = evaluation.best_threshold(as_predictions(model, valid)).first()
        scores[name] = (best["threshold"], best["f1"]) if best else (0.5, 0.0)
    chosen = "RandomForest" if scores["RandomForest"][1] >= scores["LogisticRegression"][1] else "LogisticRegression"
    models[chosen].threshold = scores[chosen][0]
    return ModelChoice(models[chosen], scores)


def feature_importance(model: RiskModel, like: DataFrame, top: int | None = None) -> DataFrame:
    """Impurity importance of each expanded feature, largest first."""
    values = model.classifier.featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(model.preprocessor.names, values)]
    out = df_of(like, rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")
    return out if top is None else out.limit(top)


def permutation_importance(
    model: RiskModel, df: DataFrame, repeats: int = 10, top: int | None = 20, seed: int = SEED, block_rows: int = 2_000
) -> DataFrame:
    """Drop of F1 when one expanded feature is shuffled, mean over the repeats.

    Rows are dealt into random blocks of about ``block_rows``; inside a block every
    row takes the feature of the next row in a random order.  That is a random
    permutation without a global sort, and no block grows with the data.  Only rows
    whose value really changes are scored again; the others keep their prediction.
    A feature whose value never changes has importance 0.  Vectors are shuffled sparse.
    A forest scores all features of a row at once, in the task that holds the row.
    """
    base = model.score_features(model.preprocessor.transform(df)).select(
        ID, F.col(LABEL).alias("y"), F.col("prediction").alias("old"), F.col(FEATURES).alias("x")
    )
    base = spread(base).persist(StorageLevel.MEMORY_AND_DISK)
    sums = base.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("y") * F.col("old")).alias("tp"),
        F.sum("old").alias("chosen"),
        F.sum("y").alias("positives"),
    ).first()
    blocks = max(1, -(-sums["n"] // block_rows))
    tp, chosen, positives = (F.lit(int(sums[c] or 0)).cast("long") for c in ("tp", "chosen", "positives"))
    runs = base.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    key = F.concat_ws(":", F.col("run"), F.col(ID))
    dealt = runs.withColumns({"block": hash_rank(key, seed) % blocks, "rank": hash_rank(key, seed + 1)})
    dealt = dealt.repartition(tasks(df.sparkSession), "run", "block")
    ring = Window.partitionBy("run", "block").orderBy("rank", ID)
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    donor = F.coalesce(F.lead("x").over(ring), F.first("x").over(whole))
    paired = dealt.withColumn("d", vector_to_array(donor)).withColumn("x", vector_to_array("x"))
    effects = _swap_effects(model, paired.select("run", "y", "old", "x", "d"))
    before = safe_ratio(tp * 2, chosen + positives)
    after = safe_ratio((tp + F.col("d_tp")) * 2, chosen + F.col("d_chosen") + positives)
    # runs in which no value changed have no row and no drop
    means = effects.groupBy("j").agg((F.sum(before - after) / repeats).alias("importance"))
    every = df_of(df, list(enumerate(model.preprocessor.names)), "j int, feature string")
    importance = np_round(F.coalesce("importance", F.lit(0.0)), 6).alias("importance")
    ranked = every.join(F.broadcast(checkpointed(means)), "j", "left").select("feature", importance)  # a row per feature
    base.unpersist()
    ranked = ranked.orderBy(F.col("importance").desc(), "feature")
    return ranked if top is None else ranked.limit(top)


def _swap_effects(model: RiskModel, paired: DataFrame) -> DataFrame:
    """(j, run, d_tp, d_chosen): what changes if rows (run, y, old, x, d) take feature j from ``d``."""
    if isinstance(model.classifier, DeepForestModel):
        sums = paired.mapInPandas(_forest_effects(model, paired.sparkSession), "j int, run int, d_tp long, d_chosen long")
        return sums.groupBy("j", "run").agg(F.sum("d_tp").alias("d_tp"), F.sum("d_chosen").alias("d_chosen"))
    changed = F.filter(F.sequence(F.lit(0), F.size("x") - 1), lambda j: F.col("x")[j] != F.col("d")[j])
    single = paired.withColumn("j", F.explode(changed)).select(
        "run",
        "j",
        "y",
        "old",
        array_to_vector(
            F.transform("x", lambda v, i: F.when(i == F.col("j"), F.col("d")[i]).otherwise(v))
        ).alias(FEATURES),
    )
    change = F.col("prediction") - F.col("old")
    return model.score_features(single).groupBy("j", "run").agg(
        F.sum(change * F.col("y")).alias("d_tp"), F.sum(change).alias("d_chosen")
    )


def _forest_effects(model: RiskModel, spark: SparkSession):
    ship_package(spark)
    shared, threshold = spark.sparkContext.broadcast(model.classifier.scorer()[0]), model.threshold

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = shared.value
        for batch in batches:
            if not len(batch):
                continue
            x, d = (forest.codes(np.stack(batch[c].to_numpy())) for c in ("x", "d"))
            total, added = forest.swapped(x, d)
            now = (total[:, None] + added) / len(forest.roots) >= threshold
            change = now.astype(np.int64) - batch["old"].to_numpy().astype(np.int64)[:, None]
            hits = change * batch["y"].fillna(0).to_numpy().astype(np.int64)[:, None]
            runs = batch["run"].to_numpy()
            for k in np.unique(runs):
                sums = {"d_tp": hits[runs == k].sum(axis=0), "d_chosen": change[runs == k].sum(axis=0)}
                yield pd.DataFrame({"j": np.arange(x.shape[1], dtype=np.int32), "run": np.int32(k), **sums})

    return run


def model_summary(model: RiskModel, like: DataFrame) -> DataFrame:
    classifier = model.classifier
    used = model.preprocessor.numbers + model.preprocessor.categories
    trees = classifier.getNumTrees if hasattr(classifier, "getNumTrees") else None
    depth = classifier.getMaxDepth() if hasattr(classifier, "getMaxDepth") else None
    row = ("trained", model.name, trees, depth, len(used), ", ".join(used[:10]), "balanced")
    return df_of(
        like,
        [row],
        "status string, model_type string, n_estimators int, max_depth int, features_used int, feature_names string, class_weight string",
    )


def score_new_calls(model: RiskModel, calls: DataFrame) -> DataFrame:
    """Score incoming calls: missing categories become a label, missing numbers 0."""
    filled = {c: F.coalesce(F.col(c), F.lit(IGNORED)) if c in calls.columns else F.lit(IGNORED) for c in model.preprocessor.categories}
    for c in model.preprocessor.numbers:
        filled[c] = F.coalesce(as_number(F.col(c)), F.lit(0.0)) if c in calls.columns else F.lit(0.0)
    scored = model.predict(calls.withColumns(filled))
    decision = F.when(F.col("prediction") == 1, "ALTO RISCO").otherwise("Baixo risco")
    return scored.withColumn("decision", decision)


def grid_search(
    df: DataFrame,
    trees: tuple[int, ...] = (100, 200),
    depths: tuple[int, ...] = (10, 20, 30),
    min_leaf: tuple[int, ...] = (1, 2),
    folds: int = 3,
    parallelism: int = 4,
) -> DataFrame:
    """Cross-validated macro F1 of every forest in the grid; folds by seeded id hash.

    One forest is grown per minimum leaf and fold, with the most trees and the greatest depth.  Forests of
    fewer trees are its first trees, and shallower ones stop at its inner nodes.
    """
    use_checkpoint_dir(df.sparkSession)
    preprocessor = Preprocessor(list(MODEL_NUMBERS), list(MODEL_CATEGORIES)).fit(df)
    fold = (hash_rank(F.col(ID), SEED) % folds).cast("int")
    ready = spread(preprocessor.transform(df).select(ID, FEATURES, LABEL, F.lit(1.0).alias(WEIGHT), fold.alias("fold")))
    ready = ready.persist(StorageLevel.MEMORY_AND_DISK)  # every forest of the grid reads it

    def measure(cell: tuple[int, int]) -> list[tuple[int, int, int, float]]:
        leaf, held = cell
        grown = forest(max(trees), max(depths), leaf).fit(ready.where(F.col("fold") != held))
        nodes = grown.forest if isinstance(grown, DeepForestModel) else model_tables.forest_nodes(df.sparkSession, grown)
        counts = model_tables.smaller_forests(ready.where(F.col("fold") == held), nodes, list(trees), list(depths), LABEL)
        held_out: dict[tuple[int, int], dict[tuple[int, int], int]] = {}
        for r in counts.collect():  # four cells of each forest
            held_out.setdefault((r["trees"], r["depth"]), {})[r["y"], r["prediction"]] = r["n"]
        return [(t, d, leaf, _macro_f1(cells)) for (t, d), cells in held_out.items()]

    try:
        ready.count()
        with ThreadPool(parallelism) as pool:  # independent Spark jobs
            cells = [(leaf, k) for leaf in min_leaf for k in range(folds)]
            found = pool.map(inheritable_thread_target(df.sparkSession)(measure), cells)
    finally:
        ready.unpersist()
    scores: dict[tuple[int, int, int], list[float]] = {}
    for t, d, leaf, f1 in chain.from_iterable(found):
        scores.setdefault((t, d, leaf), []).append(f1)
    means = {key: sum(values) / len(values) for key, values in scores.items()}
    best = max(means.values())
    rows = [(t, d, leaf, round(means[t, d, leaf], 6), int(means[t, d, leaf] == best)) for t in trees for d in depths for leaf in min_leaf]
    return df_of(df, rows, "n_estimators int, max_depth int, min_leaf int, f1_macro double, best int")


def _macro_f1(cells: dict[tuple[int, int], int]) -> float:
    """Mean F1 of both classes from the counts by (label, prediction); 0 where it is undefined."""
    out = []
    for c in (0, 1):
        hit = cells.get((c, c), 0)
        wrong = cells.get((c, 1 - c), 0) + cells.get((1 - c, c), 0)
        out.append(2 * hit / (2 * hit + wrong) if hit else 0.0)
    return sum(out) / 2
