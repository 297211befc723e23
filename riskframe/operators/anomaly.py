"""Isolation forest: trees grown in parallel on small samples, rows scored in Arrow batches."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.functions.layout import spread, tasks
from riskframe.functions.numeric import hash_rank, safe_ratio
from riskframe.functions.quantiles import exact_quantiles
from riskframe.operators.patterns import frequent_groups
from riskframe.schema import CRIME, ID, LABEL, PLACE
from riskframe.session import checkpointed, ship_package, stored

TREES = 100
SAMPLE = 256
SEED = 42
EULER_GAMMA = 0.5772156649015329

NODE_SCHEMA = "tree int, node int, feature int, cut double, left int, right int, depth double"


def average_path(n: float) -> float:
    """Expected depth of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def tree_samples(vecs: DataFrame, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """``sample`` rows per tree (all rows if there are fewer), by one rule at every size.

    Each tree ranks all rows by its own seeded hash and takes the smallest.  A row is kept only
    for the trees in which its hash lies below a share that holds a few rows more than
    the sample, so about trees x sample rows are ranked.  If a tree got too few, the share grows.
    """
    n = vecs.count()
    need = min(sample, n)
    share = min(1.0, (sample + 6 * sample**0.5 + 20) / max(n, 1))
    while True:
        limit = F.lit(int(share * 2**52))
        rank = lambda tree: hash_rank(F.concat_ws(":", tree, F.col(ID)), seed)
        kept = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda tree: rank(tree) < limit)
        dealt = vecs.select(ID, "x", F.explode(kept).alias("tree")).repartition(tasks(vecs.sparkSession), "tree")
        draw = Window.partitionBy("tree").orderBy(rank(F.col("tree")), ID)
        placed = dealt.withColumn("place", F.row_number().over(draw)).where(F.col("place") <= sample)
        chosen = checkpointed(placed.select("tree", "x"))  # trees * sample rows at most
        full = chosen.groupBy("tree").count().where(F.col("count") >= need).count()
        if full == trees or share >= 1.0:
            return chosen
        share = min(1.0, share * 2)


def grow_trees(samples: DataFrame, seed: int = SEED) -> DataFrame:
    """One task per tree builds it from its (at most ``sample``) rows."""

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        points = np.vstack(pdf["x"].to_numpy())
        points = points[np.lexsort(points.T[::-1])]
        rng = np.random.default_rng([seed, tree])
        limit = math.ceil(math.log2(max(len(points), 2)))
        nodes, open_nodes = [], [(0, points, 0)]
        count = 1
        while open_nodes:
            node, rows, depth = open_nodes.pop()
            low, high = rows.min(axis=0), rows.max(axis=0)
            varied = np.flatnonzero(high > low)
            if depth >= limit or len(varied) == 0:
                nodes.append((tree, node, -1, 0.0, node, node, depth + average_path(len(rows))))
                continue
            feature = int(rng.choice(varied))
            cut = float(rng.uniform(low[feature], high[feature]))
            below = rows[:, feature] <= cut
            nodes.append((tree, node, feature, cut, count, count + 1, float(depth)))
            open_nodes += [(count, rows[below], depth + 1), (count + 1, rows[~below], depth + 1)]
            count += 2
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "left", "right", "depth"])

    return samples.repartition(tasks(samples.sparkSession), "tree").groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


def anomaly_scores(vecs: DataFrame, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """Add ``anomaly_score`` in 0..1, larger for rows that are easier to isolate."""
    ship_package(vecs.sparkSession)
    grown = grow_trees(tree_samples(vecs, trees, sample, seed), seed)  # <= trees * (2 * sample - 1) nodes
    leaf_rows = min(sample, vecs.limit(sample).count())
    return score_with(vecs, grown, average_path(leaf_rows) or 1.0)


def score_with(vecs: DataFrame, nodes: DataFrame, norm: float) -> DataFrame:
    """Add the score of every row under the trees of a node table; ``norm`` is the path length that scores 0.5.

    ``nodes(tree, node, feature, cut, left, right, depth)``: a row goes left where its feature is at most the cut; a
    leaf has feature -1 and its depth counts the rows it stands for.  Node 0 is the root of every tree.
    """
    ship_package(vecs.sparkSession)
    grown = nodes.toPandas().sort_values(["tree", "node"])
    sizes = grown.groupby("tree")["node"].size()
    offsets = sizes.cumsum().shift(1, fill_value=0)
    base = grown["tree"].map(offsets).to_numpy()
    leaf = grown["feature"].to_numpy() < 0
    forest = {
        "roots": offsets.to_numpy().astype(np.int64),
        "feature": grown["feature"].to_numpy(),
        "cut": grown["cut"].to_numpy(),
        "left": np.where(leaf, grown["node"], grown["left"]).astype(np.int64) + base,
        "right": np.where(leaf, grown["node"], grown["right"]).astype(np.int64) + base,
        "depth": grown["depth"].to_numpy(),
    }
    shared = vecs.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        f = shared.value
        points = np.column_stack([c.to_numpy() for c in columns])
        rows = np.arange(len(points))
        total = np.zeros(len(points))
        for root in f["roots"]:
            at = np.full(len(points), root)
            while True:
                feature = f["feature"][at]
                if (feature < 0).all():
                    break
                value = points[rows, np.maximum(feature, 0)]
                at = np.where(value <= f["cut"][at], f["left"][at], f["right"][at])
            total += f["depth"][at]
        return pd.Series(np.exp2(-total / len(f["roots"]) / norm))

    width = len(vecs.select("x").first()["x"])
    return vecs.withColumn("anomaly_score", score(*[F.col("x")[i] for i in range(width)]))


def flag_anomalies(scored: DataFrame, contamination: float = 0.1) -> DataFrame:
    """Rows whose score is above the exact (1 - contamination) quantile."""
    cut = exact_quantiles(scored, ["anomaly_score"], [1 - contamination])["anomaly_score"][0]
    above = F.col("anomaly_score") > F.lit(cut).cast("double")
    return scored.withColumn("is_anomaly", above.cast("int"))


def detect_anomalies(vecs: DataFrame, contamination: float = 0.1, **forest) -> DataFrame:
    """Vectors are written once, as sampling and scoring read them; so are scores, and later passes read only their columns."""
    rows = stored(spread(vecs.drop("features")), "vectors")
    scored = stored(anomaly_scores(rows, **forest), "anomaly-scores")
    return flag_anomalies(scored, contamination)


def anomaly_stats(flagged: DataFrame) -> DataFrame:
    """Count and share of outliers, and the high-risk rate on both sides."""
    odd = F.col("is_anomaly") == 1
    return flagged.agg(
        F.sum(odd.cast("long")).alias("total_anomalies"),
        (safe_ratio(F.sum(odd.cast("long")), F.count(F.lit(1))) * 100).alias("anomaly_percentage"),
        F.coalesce(F.avg(F.when(odd, F.col(LABEL))), F.lit(0.0)).alias("anomalies_high_risk_rate"),
        F.coalesce(F.avg(F.when(~odd, F.col(LABEL))), F.lit(0.0)).alias("normal_high_risk_rate"),
    ).withColumn(
        "risk_gap_pct", (F.col("anomalies_high_risk_rate") - F.col("normal_high_risk_rate")) * 100
    )


def anomaly_groups(flagged: DataFrame, top: int = 5) -> DataFrame:
    """Most frequent crimes and places among the outliers."""
    odd = flagged.where(F.col("is_anomaly") == 1)
    parts = [
        frequent_groups(odd, [c], top).select(F.lit(c).alias("grupo"), F.col(c).alias("chave"), "qtd") for c in (CRIME, PLACE)
    ]
    return parts[0].unionByName(parts[1])


def top_anomalies(flagged: DataFrame, top: int = 20) -> DataFrame:
    return flagged.orderBy(F.col("anomaly_score").desc(), ID).limit(top)
