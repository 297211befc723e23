"""Document quality by histogram gradient-boosted trees over statistics of the whole text.

Trees are flattened into arrays of a complete binary tree, so a batch of documents goes down
all levels of all trees by numpy indexing.

Cases: null and empty texts have all statistics 0 and are scored like others; texts of any
length count whole; repeated rows have equal scores; ids with several label rows are good only
if all rows say so; an empty table gives an empty result, and without labelled rows of
both kinds every score is the share of good rows (1 without any); other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import fold_of, workers_ready

FOLDS, HELD_OUT_FOLD = 3, 1
#: Labelled documents that the trees are fitted on, at most.
LABELLED_SAMPLE = 20_000
TREES = 80
DEPTH = 5
BINS = 64
RATE = 0.15
L2 = 1.0
LEAST_HESSIAN = 1.0

_CLASSES = {
    "lower": range(97, 123),
    "upper": range(65, 91),
    "digit": range(48, 58),
    "space": (9, 11, 12, 13, 32),
    "line": (10,),
    "sentence": b".,;:?'\"()-",
    "shout": b"!",
    "bar": b"|",
    "symbol": b"#$%&*+/<=>@[\\]^_`{}~",
    "control": (*range(0, 9), *range(14, 32), 127),
    "beyond": range(128, 256),
}
_CLASS_OF = np.zeros((256, len(_CLASSES)))
for _k, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_bytes), _k] = 1.0

FEATURES = [
    "log_bytes", "log_words", *(f"{name}_share" for name in _CLASSES), "mean_word", "spread_word", "longest_word",
    "distinct_share", "top_word_share", "top_three_share", "repeat_next_share", "short_share", "long_share",
    "capital_share", "all_upper_share", "stop_end_share", "no_letter_share", "words_a_line", "line_repeat_share",
]


def statistics(text: str) -> list[float]:
    data = text.encode()
    if not data:
        return [0.0] * len(FEATURES)
    shares = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256) @ _CLASS_OF / len(data)
    words = text.split()
    n = len(words)
    lines = text.split("\n")
    out = [math.log1p(len(data)), math.log1p(n), *shares.tolist()]
    if not n:
        return out + [0.0] * (len(FEATURES) - len(out))
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
    counts = Counter(words)
    top = sorted(counts.values(), reverse=True)[:3]
    capital = sum(w[0].isupper() for w in words)
    upper = sum(map(str.isupper, words))
    ends = sum(w[-1] in ".,;:?" for w in words)
    bare = n - sum(w[0].isalpha() or w[-1].isalpha() for w in words)
    again = sum(a == b for a, b in zip(words, words[1:]))
    return out + [
        float(sizes.mean()), float(sizes.std()), math.log1p(int(sizes.max())), len(counts) / n, top[0] / n, sum(top) / n,
        again / n, float((sizes <= 3).mean()), float((sizes >= 12).mean()), capital / n, upper / n, ends / n, bare / n,
        math.log1p(n / len(lines)), 1 - len(set(lines)) / len(lines),
    ]


class Trees:
    """Fitted trees as arrays (tree, node); node ``i`` has children ``2i + 1`` and ``2i + 2``."""

    def __init__(self, base: float, feature: np.ndarray, cut: np.ndarray, value: np.ndarray):
        self.base, self.feature, self.cut, self.value = base, feature, cut, value

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row, all trees at once."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))[:, None]
        trees = np.arange(len(self.feature))[None, :]
        if len(self.feature):
            node = np.zeros((len(x), len(self.feature)), dtype=np.int64)
            while True:
                split = self.feature[trees, node]
                inner = split >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(split, 0)] > self.cut[trees, node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += self.value[trees, node].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boost on the logistic loss; every level of a tree takes one histogram pass over the binned rows."""
    share = min(max(float(y.mean()), 1e-6), 1 - 1e-6) if len(y) else 1 - 1e-6
    base = math.log(share / (1 - share))
    nodes = (1 << (depth + 1)) - 1
    feature = np.full((trees, nodes), -1, dtype=np.int64)
    cut, value = np.zeros((trees, nodes)), np.zeros((trees, nodes))
    if len(y) == 0 or y.min() == y.max():
        return Trees(base, feature[:0], cut[:0], value[:0])
    width = x.shape[1]
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(width)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)], axis=1)
    flat = binned + np.arange(width) * BINS
    margin = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        open_rows = np.arange(len(y))
        for level in range(depth + 1):
            first, count = (1 << level) - 1, 1 << level
            local = node[open_rows] - first
            sum_g = np.bincount(local, g[open_rows], count)
            sum_h = np.bincount(local, h[open_rows], count)
            value[t, first : first + count] = -RATE * sum_g / (sum_h + L2)
            if level == depth or not len(open_rows):
                break
            at = (local[:, None] * (width * BINS) + flat[open_rows]).ravel()
            shape = (count, width, BINS)
            left_g = np.bincount(at, np.repeat(g[open_rows], width), count * width * BINS).reshape(shape).cumsum(axis=2)
            left_h = np.bincount(at, np.repeat(h[open_rows], width), count * width * BINS).reshape(shape).cumsum(axis=2)
            right_g, right_h = sum_g[:, None, None] - left_g, sum_h[:, None, None] - left_h
            gain = left_g**2 / (left_h + L2) + right_g**2 / (right_h + L2) - (sum_g**2 / (sum_h + L2))[:, None, None]
            gain[(left_h < LEAST_HESSIAN) | (right_h < LEAST_HESSIAN)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            good = gain.reshape(count, -1)[np.arange(count), best] > 1e-9
            f, b = best // BINS, best % BINS
            for k in np.nonzero(good)[0]:
                feature[t, first + k], cut[t, first + k] = f[k], edges[f[k]][b[k]]
            stay = good[local]
            open_rows, local = open_rows[stay], local[stay]
            node[open_rows] = 2 * node[open_rows] + 1 + (binned[open_rows, f[local]] > b[local])
        margin += value[t, node]
    return Trees(base, feature, cut, value)


def statistics_column():
    def run(text: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in text])

    run.__annotations__ = {"text": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "array<double>")(F.coalesce(F.col("text"), F.lit("")))


def trained(docs: DataFrame, labels: DataFrame, sample: int = LABELLED_SAMPLE) -> Trees:
    """Trees fitted on a bounded sample of labelled documents outside the held-out fold.

    The ids of the sample are broadcast; its statistics are computed where the documents are read.
    """
    learn = fold_of(F.col("doc_id"), FOLDS) != HELD_OUT_FOLD
    known = labels.where(F.col("quality").isNotNull() & learn).groupBy("doc_id").agg(F.min("quality").alias("good"))
    chosen = known.orderBy(F.xxhash64("doc_id")).limit(sample)
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = workers_ready(joined).select("doc_id", "good", statistics_column().alias("x")).orderBy("doc_id", "x").collect()
    x = np.array([r["x"] for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r["good"] for r in rows], dtype=float))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(trained(docs, labels))

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trees = shared.value
        for texts in batches:
            x = np.array([statistics(t) for t in texts], dtype=float).reshape(len(texts), len(FEATURES))
            yield pd.Series(np.concatenate([trees.scores(x[i : i + 2048]) for i in range(0, max(1, len(x)), 2048)]))

    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    column = F.pandas_udf(score, "double")(F.coalesce(F.col("text"), F.lit("")))
    scored = workers_ready(docs).select("doc_id", column.alias("score"))
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
