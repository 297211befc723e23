"""Evaluation of any score against a 0/1 label.

Input frames carry the label in ``y`` and the score in ``score``.  Metrics that
sort by score first collapse the rows to distinct scores, so ties and hot values
cost one row, and take running totals range by range.  They read ``pred`` more than
once; pass rows that are cheap to read (see ``checkpointed``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.lookup import lookup_join
from riskframe.functions.numeric import count_of, np_round, safe_ratio
from riskframe.functions.quantiles import exact_quantiles
from riskframe.functions.running import running_totals, with_slice
from riskframe.operators.filters import enough
from riskframe.schema import ID, PLACE
from riskframe.session import checkpointed

THRESHOLD_GRID = [0.2 + (0.8 - 0.2) / 60 * i for i in range(60)] + [0.8]
K_GRID = [0.1 + (0.5 - 0.1) / 20 * i for i in range(20)] + [0.5]


def predictions(df: DataFrame, score: str, label: str = "risco_alto", keep: list[str] | None = None) -> DataFrame:
    return df.select(
        ID, *(keep or []), F.col(label).cast("int").alias("y"), F.col(score).cast("double").alias("score")
    )


def precision(tp: Column, chosen: Column) -> Column:
    return safe_ratio(tp, chosen)


def recall(tp: Column, positives: Column) -> Column:
    return safe_ratio(tp, positives)


def f1(tp: Column, chosen: Column, positives: Column) -> Column:
    return safe_ratio(tp * 2, chosen + positives)


def _prf(tp: Column, chosen: Column, positives: Column) -> dict[str, Column]:
    return {
        "precision": np_round(precision(tp, chosen), 6),
        "recall": np_round(recall(tp, positives), 6),
        "f1": np_round(f1(tp, chosen, positives), 6),
    }


def _cells(threshold: float) -> list[Column]:
    chosen, positive = F.col("score") >= threshold, F.col("y") == 1
    return [
        F.count(F.lit(1)).alias("n"),
        count_of(positive).alias("positives"),
        count_of(chosen).alias("chosen"),
        count_of(chosen & positive).alias("tp"),
    ]


def eval_metrics(pred: DataFrame, threshold: float = 0.5, by: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1, macro F1 and support, over all rows or per slice."""
    keys = by or []
    sums = pred.groupBy(*keys).agg(*_cells(threshold))
    n, pos, chosen, tp = (F.col(c) for c in ("n", "positives", "chosen", "tp"))
    true_negative = n - chosen - pos + tp
    negative_f1 = f1(true_negative, n - chosen, n - pos)
    return sums.select(
        *keys,
        *[v.alias(k) for k, v in _prf(tp, chosen, pos).items()],
        np_round((f1(tp, chosen, pos) + negative_f1) / 2, 6).alias("f1_macro"),
        pos.alias("support_pos"),
        n.alias("support_total"),
    )


def confusion_matrix(pred: DataFrame, threshold: float = 0.5) -> DataFrame:
    sums = pred.agg(*_cells(threshold))
    n, pos, chosen, tp = (F.col(c) for c in ("n", "positives", "chosen", "tp"))
    cells = {(0, 0): n - chosen - pos + tp, (0, 1): chosen - tp, (1, 0): pos - tp, (1, 1): tp}
    rows = [
        F.struct(F.lit(y).alias("y_true"), F.lit(p).alias("y_pred"), count.alias("n"))
        for (y, p), count in cells.items()
    ]
    return sums.select(F.explode(F.array(*rows)).alias("c")).select("c.*").orderBy("y_true", "y_pred")


def threshold_counts(pred: DataFrame, thresholds: list[float]) -> DataFrame:
    """Rows chosen (score >= threshold) and hits, for every threshold in one pass.

    Rows are counted between neighbouring thresholds; the few counts are then
    summed from the top.
    """
    cuts = sorted(set(thresholds))
    between = (
        with_slice(pred, "score", cuts, "part")
        .groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y").cast("long")).alias("pos"))
    )
    packed = between.agg(F.collect_list(F.struct("part", "n", "pos")).alias("parts"))  # <= len(cuts) + 1 entries

    def total(field, least):
        kept = F.filter("parts", lambda p: p["part"] >= least)
        return F.aggregate(kept, F.lit(0).cast("long"), lambda acc, p: acc + p[field])

    grid = F.array(*[F.struct(F.lit(t).alias("threshold"), F.lit(float(i + 1)).alias("least")) for i, t in enumerate(cuts)])
    return packed.select("parts", F.explode(grid).alias("g")).select(
        F.col("g.threshold").alias("threshold"),
        total("n", F.col("g.least")).alias("chosen"),
        total("pos", F.col("g.least")).alias("tp"),
        total("pos", F.lit(0.0)).alias("positives"),
        total("n", F.lit(0.0)).alias("n"),
    )


def best_threshold(pred: DataFrame, grid: list[float] = THRESHOLD_GRID) -> DataFrame:
    """The grid threshold with the largest F1, the lowest one on ties."""
    scored = threshold_counts(pred, grid).withColumn("f1", f1(F.col("tp"), F.col("chosen"), F.col("positives")))
    best = scored.orderBy(F.col("f1").desc(), "threshold").limit(1)
    return best.select("threshold", np_round(F.col("f1"), 6).alias("f1"))


def at_top_shares(pred: DataFrame, shares: list[float]) -> DataFrame:
    """Metrics when the rows at or above the (1 - k) quantile of the score are chosen."""
    cuts = exact_quantiles(pred, ["score"], [(1 - k) * 100 / 100 for k in shares])["score"]
    if cuts and cuts[0] is None:
        return pred.sparkSession.createDataFrame(
            [], "k double, threshold double, chosen long, positives long, n long, tp long, "
                "precision double, recall double, f1 double"
        )
    lookup = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(t).alias("threshold")) for k, t in zip(shares, cuts)])
    counts = threshold_counts(pred, cuts)
    wanted = counts.withColumn("s", F.explode(F.filter(lookup, lambda e: e["threshold"] == F.col("threshold"))))
    return wanted.select(
        F.col("s.k").alias("k"),
        "threshold",
        "chosen",
        "positives",
        "n",
        "tp",
        *[v.alias(c) for c, v in _prf(F.col("tp"), F.col("chosen"), F.col("positives")).items()],
    )


def f1_at_k(pred: DataFrame, k: float = 0.2) -> DataFrame:
    out = at_top_shares(pred, [k])
    return out.select(
        np_round(F.col("threshold"), 6).alias("threshold"),
        "precision",
        "recall",
        "f1",
        F.col("chosen").alias("selected_count"),
        F.col("positives").alias("total_high_risk"),
    )


def performance_curve(pred: DataFrame, shares: list[float] = K_GRID) -> DataFrame:
    out = at_top_shares(pred, shares)
    return out.select(np_round(F.col("k") * 100, 6).alias("k_pct"), "precision", "recall", "f1").orderBy("k_pct")


def shown_curve(pred: DataFrame) -> DataFrame:
    """The performance curve; raises on data too small for one."""
    return performance_curve(enough(pred, "performance curve"))


def operational_gain(pred: DataFrame, k: float = 0.2) -> DataFrame:
    """Cases handled first, high-risk cases caught among them, and the yield in percent."""
    out = at_top_shares(pred, [k])
    prioritized = F.floor(F.col("n") * F.lit(k)).cast("long")
    captured = F.floor(F.col("positives") * recall(F.col("tp"), F.col("positives"))).cast("long")
    return out.select(
        F.col("n").alias("total_casos"),
        F.col("positives").alias("casos_alto_risco"),
        np_round(safe_ratio(F.col("positives"), F.col("n")) * 100, 6).alias("taxa_risco_pct"),
        prioritized.alias("casos_priorizados"),
        captured.alias("risco_capturado"),
        np_round(safe_ratio(captured, prioritized) * 100, 6).alias("eficiencia_pct"),
    )


def by_score(pred: DataFrame) -> DataFrame:
    return pred.where(F.col("score").isNotNull()).groupBy("score").agg(
        F.sum(F.col("y").cast("long")).alias("pos"), F.sum((1 - F.col("y")).cast("long")).alias("neg")
    )


def roc_auc(pred: DataFrame) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties half; 0 for one class."""
    totals = running_totals(checkpointed(by_score(pred)), "score", ["neg"])
    wins = F.col("pos").cast("double") * (F.col("before_neg") + F.col("neg") / 2)
    sums = totals.agg(F.sum(wins).alias("wins"), F.sum("pos").alias("p"), F.sum("neg").alias("q"))
    pairs = F.col("p").cast("double") * F.col("q")
    return sums.select(np_round(safe_ratio(F.col("wins"), pairs), 6).alias("roc_auc"))


def _curve(pred: DataFrame) -> DataFrame:
    """Per distinct score: rows at or above it, split by label, with the overall totals."""
    scores = checkpointed(by_score(pred))
    sums = scores.agg(F.sum("pos").alias("p"), F.sum("neg").alias("q")).first()
    totals = running_totals(scores, "score", ["pos", "neg"], descending=True)
    return totals.select(
        "score",
        (F.col("before_pos") + F.col("pos")).alias("tp"),
        (F.col("before_neg") + F.col("neg")).alias("fp"),
        F.lit(sums["p"] or 0).cast("long").alias("p"),
        F.lit(sums["q"] or 0).cast("long").alias("q"),
    )


def roc_curve(pred: DataFrame) -> DataFrame:
    """One point per distinct score, plus the (0, 0) start (threshold null)."""
    points = _curve(pred).select(
        F.col("score").alias("threshold"),
        np_round(safe_ratio(F.col("fp"), F.col("q")), 6).alias("fpr"),
        np_round(safe_ratio(F.col("tp"), F.col("p")), 6).alias("tpr"),
    )
    start = pred.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return points.unionByName(start)


def pr_curve(pred: DataFrame) -> DataFrame:
    """One point per distinct score, plus the (recall 0, precision 1) end (threshold null)."""
    points = _curve(pred).select(
        F.col("score").alias("threshold"),
        np_round(safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")), 6).alias("precision"),
        np_round(safe_ratio(F.col("tp"), F.col("p")), 6).alias("recall"),
    )
    end = pred.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return points.unionByName(end)


def f1_at_k_by_window(pred: DataFrame, window: list[str], k: float = 0.2) -> DataFrame:
    """Metrics of choosing the top ``k`` share of every window (at least one row).

    Rows with equal scores are taken in id order.  The cut of a window falls on one
    score: everything above it is chosen whole, and only the rows tied at that score
    are ordered by id.  Both steps use running totals over value ranges, so a window
    that holds a third of all rows never becomes one task.
    """
    rows = pred.dropna(subset=[*window, "score"])
    scores = checkpointed(
        rows.groupBy(*window, "score").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y").cast("long")).alias("pos"))
    )
    totals = scores.groupBy(*window).agg(F.sum("n").alias("size"), F.sum("pos").alias("positives"))
    totals = totals.withColumn("k", F.greatest(F.lit(1), F.floor(F.col("size") * F.lit(k))).cast("long"))
    ordered = running_totals(scores, "score", ["n", "pos"], group=window, descending=True)
    cut = (
        lookup_join(ordered, totals, window, "inner", spread_by="score")
        .where((F.col("before_n") < F.col("k")) & (F.col("k") <= F.col("before_n") + F.col("n")))
        .withColumn("take", F.col("k") - F.col("before_n"))
    )
    cut = checkpointed(cut)  # one row per window, read twice below
    mixed = cut.where((F.col("take") < F.col("n")) & (F.col("pos") > 0) & (F.col("pos") < F.col("n")))
    ties = lookup_join(rows, mixed.select(*window, "score", "take"), [*window, "score"], "inner", spread_by=ID)
    ties = checkpointed(ties.select(*window, ID, "y", "take"))
    ties = running_totals(ties.withColumn("one", F.lit(1).cast("long")), ID, ["one"], group=window)
    tied_hits = (
        ties.where(F.col("before_one") < F.col("take"))
        .groupBy(*window)
        .agg(F.sum(F.col("y").cast("long")).alias("tied_tp"))
    )
    whole = F.when(F.col("pos") == 0, 0).when(F.col("pos") == F.col("n"), F.col("take")).otherwise(F.col("pos"))
    result = cut.join(tied_hits, window, "left").withColumn(
        "tp",
        F.col("before_pos")
        + F.when(F.col("take") < F.col("n"), F.coalesce("tied_tp", whole)).otherwise(F.col("pos")),
    )
    return result.select(
        *window,
        F.col("size").alias("n"),
        *[v.alias(c) for c, v in _prf(F.col("tp"), F.col("k"), F.col("positives")).items()],
    )


def f1_at_k_by_place(by_window: DataFrame, top: int = 12) -> DataFrame:
    means = by_window.groupBy(PLACE).agg(np_round(F.avg("f1"), 6).alias("f1_medio"))
    return means.orderBy(F.col("f1_medio").desc(), PLACE).limit(top)
