"""K-means for several numbers of clusters at once.

Rows are packed into blocks of numbers once.  Every pass over the blocks improves all fits that have not converged
yet: a task sums its rows per (fit, cluster), and one small aggregate gives all new centres.  So a sweep
over k takes as many passes as its slowest fit, not the sum of all.  Two more passes give the
measures of all fits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.layout import spread
from riskframe.functions.sampling import hash_sample
from riskframe.schema import ID
from riskframe.session import ship_package

MAX_PASSES = 300
#: Converged when the squared moves of all centres sum to no more than this.
TOLERANCE = 1e-4
#: Rows from which the first centres are drawn, at most.
START_ROWS = 10_000


@dataclass
class Fit:
    """Centres, the sum of squared distances of the rows to them, and the passes it took."""

    centers: np.ndarray
    inertia: float = math.nan
    passes: int = 0

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802  (the name users know)
        return list(self.centers)

    def transform(self, df: DataFrame, output: str = "cluster") -> DataFrame:
        """Add the number of the nearest centre of the array column ``x``; of equally near ones the first."""
        return df.withColumn(output, nearest(F.col("x"), self.centers))


def nearest(x: Column, centers: np.ndarray) -> Column:
    distances = F.array(*[_squared(x, c) for c in centers])
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def _squared(x: Column, center: np.ndarray) -> Column:
    total = F.lit(0.0)
    for i, v in enumerate(center):
        gap = x[i] - F.lit(float(v))
        total = total + gap * gap
    return total


def blocks(vecs: DataFrame) -> DataFrame:
    """(rows, data): the arrays ``x`` as matrices of doubles, some thousand rows each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                matrix = np.ascontiguousarray(np.stack(batch["x"].to_numpy()), dtype="<f8")
                yield pd.DataFrame({"rows": [len(matrix)], "data": [matrix.tobytes()]})

    ship_package(vecs.sparkSession)
    return spread(vecs.select(ID, "x")).mapInPandas(run, "rows long, data binary")


def _matrices(batches: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
    for batch in batches:
        for rows, data in zip(batch["rows"], batch["data"]):
            yield np.frombuffer(data, dtype="<f8").reshape(rows, -1)


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centers], axis=1)


def plus_plus(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` rows, each drawn with odds by its squared distance to the ones before it."""
    centers = [x[rng.integers(len(x))]]
    near = ((x - centers[0]) ** 2).sum(axis=1)
    while len(centers) < k:
        odds = near / near.sum() if near.sum() > 0 else np.full(len(x), 1 / len(x))
        centers.append(x[rng.choice(len(x), p=odds)])
        near = np.minimum(near, ((x - centers[-1]) ** 2).sum(axis=1))
    return np.stack(centers)


def first_centers(vecs: DataFrame, ks: list[int], seed: int, starts: int = 1, rows: int = START_ROWS) -> list[np.ndarray]:
    """For each k in turn, ``starts`` sets of centres, drawn from a bounded sample of the rows and settled on it.

    Centres that have settled on the sample need few passes over all rows.
    """
    sample = hash_sample(vecs.select(ID, "x"), rows, seed).collect()
    x = np.array([r["x"] for r in sample], dtype=float)
    return [settled(x, plus_plus(x, k, np.random.default_rng([seed, k, start]))) for k in ks for start in range(starts)]


def settled(x: np.ndarray, centers: np.ndarray, tolerance: float = TOLERANCE, most: int = MAX_PASSES) -> np.ndarray:
    """Centres after Lloyd iterations on a matrix in memory."""
    norms = (x**2).sum(axis=1)
    for _ in range(most):
        label = (norms[:, None] - 2 * x @ centers.T + (centers**2).sum(axis=1)).argmin(axis=1)
        n = np.bincount(label, minlength=len(centers))
        sums = np.stack([np.bincount(label, c, len(centers)) for c in x.T], axis=1)
        new = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centers)
        shift = ((new - centers) ** 2).sum()
        centers = new
        if shift <= tolerance:
            break
    return centers


def improved(packed: DataFrame, fits: dict[int, np.ndarray]) -> DataFrame:
    """One pass: (fit, cluster, n, s0, s1, ...) with the sums of the rows nearest to each centre."""
    width = next(iter(fits.values())).shape[1]
    names = [f"s{i}" for i in range(width)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {f: np.zeros((len(c), width + 1)) for f, c in fits.items()}
        for x in _matrices(batches):
            for f, centers in fits.items():
                label = _distances(x, centers).argmin(axis=1)
                sums[f][:, 0] += np.bincount(label, minlength=len(centers))
                for i in range(width):
                    sums[f][:, i + 1] += np.bincount(label, x[:, i], len(centers))
        for f, total in sums.items():
            used = np.flatnonzero(total[:, 0])
            frame = pd.DataFrame(total[used, 1:], columns=names)
            yield frame.assign(fit=f, cluster=used, n=total[used, 0].astype(np.int64))[["fit", "cluster", "n", *names]]

    schema = "fit int, cluster int, n long, " + ", ".join(f"{c} double" for c in names)
    found = packed.mapInPandas(run, schema)
    return found.groupBy("fit", "cluster").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names])


def converge(packed: DataFrame, centers: list[np.ndarray], tolerance: float = TOLERANCE, most: int = MAX_PASSES) -> list[Fit]:
    """Move all sets of centres until each has converged.  A centre without rows stays where it is."""
    fits = [Fit(np.array(c, dtype=float)) for c in centers]
    open_fits = set(range(len(fits)))
    for _ in range(most):
        if not open_fits:
            break
        moved = {f: fits[f].centers.copy() for f in open_fits}
        for row in improved(packed, {f: fits[f].centers for f in sorted(open_fits)}).collect():  # a row per centre
            moved[row["fit"]][row["cluster"]] = np.array(row[3:]) / row["n"]
        for f, new in moved.items():
            shift = float(((new - fits[f].centers) ** 2).sum())
            fits[f].centers, fits[f].passes = new, fits[f].passes + 1
            if shift <= tolerance:
                open_fits.discard(f)
    return fits


@dataclass
class Measures:
    """Sums of one fit: rows, sum, squared norms, squared and plain distance to the centre, all per cluster."""

    n: np.ndarray
    total: np.ndarray
    square: np.ndarray
    inertia: np.ndarray
    spread: np.ndarray
    silhouette: float = 0.0


def measured(packed: DataFrame, fits: list[Fit]) -> list[Measures]:
    """Inertia, spread and squared silhouette of all fits, in two passes."""
    centers = [f.centers for f in fits]
    width = centers[0].shape[1]
    names = ["n", "square", "inertia", "spread", *[f"s{i}" for i in range(width)]]

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = [np.zeros((len(c), len(names))) for c in centers]
        for x in _matrices(batches):
            norms = (x**2).sum(axis=1)
            for c, out in zip(centers, found):
                gap = _distances(x, c)
                label = gap.argmin(axis=1)
                own = gap[np.arange(len(x)), label]
                for i, v in enumerate([np.ones(len(x)), norms, own, np.sqrt(own), *x.T]):
                    out[:, i] += np.bincount(label, v, len(c))
        for f, out in enumerate(found):
            yield pd.DataFrame(out, columns=names).assign(fit=f, cluster=np.arange(len(out)))[["fit", "cluster", *names]]

    schema = "fit int, cluster int, " + ", ".join(f"{c} double" for c in names)
    totals = packed.mapInPandas(sums, schema).groupBy("fit", "cluster").agg(*[F.sum(c).alias(c) for c in names])
    dense = [np.zeros((len(c), len(names))) for c in centers]
    for row in totals.collect():  # a row per centre
        dense[row["fit"]][row["cluster"]] = row[2:]
    out = [Measures(d[:, 0], d[:, 4:], d[:, 1], d[:, 2], d[:, 3]) for d in dense]

    def silhouettes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = np.zeros(len(centers))
        for x in _matrices(batches):
            norms = (x**2).sum(axis=1)
            for f, c in enumerate(centers):
                found[f] += _silhouettes(x, norms, _distances(x, c).argmin(axis=1), out[f]).sum()
        yield pd.DataFrame({"fit": np.arange(len(centers)), "total": found})

    scores = packed.mapInPandas(silhouettes, "fit int, total double").groupBy("fit").agg(F.sum("total").alias("total")).collect()
    for row in scores:
        m = out[row["fit"]]
        m.silhouette = row["total"] / m.n.sum() if (m.n > 0).sum() > 1 else 0.0
    return out


def _silhouettes(x: np.ndarray, norms: np.ndarray, label: np.ndarray, m: Measures) -> np.ndarray:
    """Silhouettes on squared distances, from the sums of the clusters."""
    total = norms[:, None] * m.n - 2 * x @ m.total.T + m.square
    rows = np.arange(len(x))
    size = m.n[label]
    inside = total[rows, label] / np.maximum(size - 1, 1)
    mean = np.where(m.n > 0, total / np.maximum(m.n, 1), np.inf)
    mean[rows, label] = np.inf
    outside = mean.min(axis=1)
    worse = np.maximum(inside, outside)
    scored = (size > 1) & np.isfinite(outside) & (worse > 0)
    return np.where(scored, (outside - inside) / np.where(scored, worse, 1.0), 0.0)


def kmeans_fits(vecs: DataFrame, ks: list[int], seed: int, starts: int = 1, measures: bool = False):
    """The best of ``starts`` fits for every k, by inertia; with their measures if wanted.

    The rows are packed once and kept while the fits run.
    """
    packed = blocks(vecs).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fits = converge(packed, first_centers(vecs, ks, seed, starts))
        found = measured(packed, fits) if measures or starts > 1 else [None] * len(fits)
    finally:
        packed.unpersist()
    for fit, m in zip(fits, found):
        if m is not None:
            fit.inertia = float(m.inertia.sum())
    best = [min(range(i * starts, (i + 1) * starts), key=lambda f: fits[f].inertia) if starts > 1 else i for i in range(len(ks))]
    return [(fits[b], found[b]) for b in best]
