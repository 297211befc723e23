"""Hard negatives by inner product, with length buckets and pruning by coordinates.

For every anchor and each of its best rows of the same label (positives), the best rows of another label whose
score lies in a band below the positive's score.  Rows are ordered by length and cut into buckets; a bucket holds
one sorted list of values for each coordinate of its normalised vectors.  For an anchor and the score that a row
must reach, Cauchy-Schwarz ends the search at the first bucket that is too short.  Inside a bucket the needed score
is a least cosine, that is a largest angle, which leaves a feasible range of values in each coordinate.  The ranges
of the anchor's focus coordinates (its largest) are cut out of the sorted lists, and only rows in all of them are
verified, by exact integer products.

Anchors are a stated query set.  They are broadcast in groups of a bounded number; each group takes two passes over
all rows, one for its positives and one for its negatives.  A task keeps the best rows of each anchor over all its
blocks of rows, so it sends as many rows however long its input is.

Cases: rows without a label or vector, or with a null or non-finite component, take no part; equal rows (id, label and
vector) count once, rows that share an id alone are rows of their own; "other" rows are all but the anchor's own; a null id is
never an anchor, and comes last among equal scores; shorter vectors are filled up with zeros; positives with a
score below zero have no band and get no rows; empty tables give an empty result; other columns are ignored.  Scores are
64-bit integers.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.layout import tasks
from riskframe.llm.common import shared_folder, workers_ready, written

SCALE = 256
#: Every so manieth id is an anchor.
ANCHOR_STEP = 100
#: Ids divisible by this get the next of ``LABELS`` labels.
MOVED_STEP, LABELS = 7, 10
POSITIVES, NEGATIVES = 5, 10
#: The band, in hundredths of the positive's score.
LEAST, MOST = 30, 90
#: Anchors, and bytes of their vectors, that are broadcast at once.
ANCHORS_AT_ONCE, ANCHOR_BYTES = 8192, 16 << 20
#: Rows of a bucket at most, and the least length in it against the greatest.
BUCKET, BUCKET_RATIO = 4096, 0.9
FOCUS = 4
#: Share of a bucket from which on one list is no help.
USELESS = 0.7
SLACK = 1e-9

_ROW = "row long, vec_id long, label long, vector array<long>"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def prepared(rows: DataFrame) -> DataFrame:
    """(row, vec_id, label, vector) of the rows that take part, each once; ``row`` is a hash of all of them."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % MOVED_STEP == 0, (label + 1) % LABELS).otherwise(label)
    whole = F.transform("embedding", lambda x: F.floor(SCALE * x.cast("double")).cast("long"))
    found = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & usable)
    return (
        found.select(F.col("vec_id").cast("long").alias("vec_id"), moved.alias("label"), whole.alias("vector"))
        .distinct()
        .select(F.xxhash64("vec_id", "label", "vector").alias("row"), "vec_id", "label", "vector")
    )


# --- one block of rows --------------------------------------------------------------------


@dataclass
class Rows:
    """Some rows in order of length: hashes, ids, whether an id is null, labels, vectors."""

    row: np.ndarray
    ids: np.ndarray
    nulls: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, batch: pd.DataFrame, width: int) -> Rows:
        vectors = np.zeros((len(batch), width), dtype=np.int64)
        sizes = batch["vector"].map(len).to_numpy()
        if (sizes == width).all():
            vectors[:] = np.stack(batch["vector"].to_numpy()) if len(batch) else vectors
        else:
            for k, own in enumerate(batch["vector"]):
                vectors[k, : len(own)] = own
        ids = batch["vec_id"].astype("Int64")
        nulls = ids.isna().to_numpy()
        return cls(batch["row"].to_numpy(), ids.fillna(0).to_numpy(dtype=np.int64), nulls, batch["label"].to_numpy(), vectors)

    def take(self, order: np.ndarray) -> Rows:
        return Rows(self.row[order], self.ids[order], self.nulls[order], self.labels[order], self.vectors[order])


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(float) ** 2).sum(axis=1))


class CoordinateLists:
    """Rows in length buckets, each with its sorted coordinate lists."""

    def __init__(self, rows: Rows, bucket: int = BUCKET, ratio: float = BUCKET_RATIO):
        lengths = _lengths(rows.vectors)
        order = np.argsort(-lengths, kind="stable")
        self.rows, self.lengths = rows.take(order), lengths[order]
        self.width = rows.vectors.shape[1]
        self._floats = self.rows.vectors.astype(float)
        self._largest = int(np.abs(self.rows.vectors).max(initial=0))
        self.edges = [0]
        while self.edges[-1] < len(order):
            low = self.edges[-1]
            close = int(np.searchsorted(-self.lengths, -ratio * self.lengths[low], side="right"))
            self.edges.append(min(len(order), low + bucket, max(close, low + 1)))
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.seen = self.verified = 0

    def _sorted(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """For each coordinate, the ascending values of the bucket's unit vectors and their places."""
        if low not in self._lists:
            units = self._floats[low:high] / np.maximum(self.lengths[low:high, None], 1.0)
            places = np.argsort(units, axis=0, kind="stable")
            self._lists[low] = np.take_along_axis(units, places, axis=0).T.copy(), places.T.astype(np.int32)
        return self._lists[low]

    def candidates(self, low: int, high: int, unit: np.ndarray, cosine: float, focus: int = FOCUS) -> np.ndarray:
        """Places of the bucket's rows that lie in the feasible ranges of the focus coordinates."""
        everything = np.arange(low, high)
        if cosine <= 0:
            return everything
        angle = math.acos(min(1.0, cosine)) + SLACK
        values, places = self._sorted(low, high)
        cut = []
        for f in np.argsort(-np.abs(unit), kind="stable")[:focus]:
            own = math.acos(max(-1.0, min(1.0, float(unit[f]))))
            least, most = math.cos(min(math.pi, own + angle)) - SLACK, math.cos(max(0.0, own - angle)) + SLACK
            a, b = np.searchsorted(values[f], least), np.searchsorted(values[f], most, side="right")
            if b - a <= USELESS * (high - low):
                cut.append(places[f, a:b])
        if not cut:
            return everything
        held = np.zeros(high - low, dtype=np.int32)
        for some in cut:
            held[some] += 1
        return low + np.flatnonzero(held == len(cut))

    def products(self, places: np.ndarray, vector: np.ndarray) -> np.ndarray:
        """Exact inner products; in doubles where these hold every sum."""
        largest = int(np.abs(vector).max(initial=0))
        if self.width * self._largest * largest < 1 << 53:
            whole = len(places) and len(places) == places[-1] - places[0] + 1
            chosen = self._floats[places[0] : places[-1] + 1] if whole else self._floats[places]
            return (chosen @ vector.astype(float)).astype(np.int64)
        return self.rows.vectors[places] @ vector

    def reaching(self, vector: np.ndarray, least: Callable[[], int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and scores, bucket by bucket, among which are all rows with a score of ``least()`` or more."""
        length = math.sqrt(float((vector.astype(float) ** 2).sum()))
        unit = vector / max(length, 1.0)
        for low, high in zip(self.edges[:-1], self.edges[1:]):
            reach, needed = length * self.lengths[low], least()
            if needed > 0 and reach * (1 + SLACK) < needed:
                return
            found = self.candidates(low, high, unit, needed / reach - SLACK if reach else 0.0)
            self.seen += high - low
            self.verified += len(found)
            if len(found):
                yield found, self.products(found, vector)


class Best:
    """The best rows so far with scores in a range: highest score, then smallest id, null last, then hash."""

    def __init__(self, top: int, low: int | None = None, high: int | None = None):
        self.top, self.low, self.high = top, low, high
        self.scores = np.empty(0, dtype=np.int64)
        self.ids, self.rows = self.scores, self.scores
        self.nulls = np.empty(0, dtype=bool)

    @property
    def least(self) -> int:
        """A score below this cannot enter."""
        low = -(1 << 63) if self.low is None else self.low
        return max(low, int(self.scores[-1])) if len(self.scores) == self.top else low

    def add(self, rows: Rows, places: np.ndarray, scores: np.ndarray) -> None:
        enter = scores >= self.least
        if self.high is not None:
            enter &= scores <= self.high
        if not enter.any():
            return
        places = places[enter]
        scores = np.concatenate([self.scores, scores[enter]])
        ids, nulls = np.concatenate([self.ids, rows.ids[places]]), np.concatenate([self.nulls, rows.nulls[places]])
        hashes = np.concatenate([self.rows, rows.row[places]])
        order = np.lexsort((hashes, ids, nulls, -scores))[: self.top]
        self.scores, self.ids, self.nulls, self.rows = scores[order], ids[order], nulls[order], hashes[order]

    def frame(self, **columns: int) -> pd.DataFrame:
        ids = pd.array(self.ids, dtype="Int64")
        ids[self.nulls] = pd.NA
        return pd.DataFrame({**columns, "vec_id": ids, "row": self.rows, "score": self.scores})


# --- passes over all rows -----------------------------------------------------------------


@dataclass
class Anchor:
    anchor_id: int
    row: int
    label: int
    vector: np.ndarray


def add_positives(index: CoordinateLists, anchor: Anchor, best: Best) -> None:
    for places, scores in index.reaching(anchor.vector, lambda: best.least):
        same = (index.rows.labels[places] == anchor.label) & (index.rows.row[places] != anchor.row)
        best.add(index.rows, places[same], scores[same])


def add_negatives(index: CoordinateLists, anchor: Anchor, best: list[Best]) -> None:
    for places, scores in index.reaching(anchor.vector, lambda: min(b.least for b in best)):
        other = index.rows.labels[places] != anchor.label
        for b in best:
            b.add(index.rows, places[other], scores[other])


def band(score: int, least: int = LEAST, most: int = MOST) -> tuple[int, int]:
    """Smallest and largest ``x`` with ``least * score <= 100 * x <= most * score``."""
    return -((-least * score) // 100), (most * score) // 100


def _positives(rows: DataFrame, anchors, width: int, top: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [Best(top) for _ in anchors.value]
        for batch in batches:
            rows = Rows.of(batch, width)
            by_label = {x: CoordinateLists(rows.take(np.flatnonzero(rows.labels == x))) for x in np.unique(rows.labels)}
            for anchor, own in zip(anchors.value, best):
                if anchor.label in by_label:
                    add_positives(by_label[anchor.label], anchor, own)
        for k, own in enumerate(best):
            yield own.frame(anchor=k)

    return rows.mapInPandas(run, "anchor int, vec_id long, row long, score long")


def _negatives(rows: DataFrame, anchors, pairs, width: int, top: int) -> DataFrame:
    """``pairs``: for each anchor, the scores of its positives."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [[Best(top, *band(score)) for score in scores] for scores in pairs.value]
        for batch in batches:
            index = CoordinateLists(Rows.of(batch, width))
            for anchor, own in zip(anchors.value, best):
                wanted = [b for b in own if b.low <= b.high]
                if wanted:
                    add_negatives(index, anchor, wanted)
        for k, own in enumerate(best):
            for p, b in enumerate(own):
                yield b.frame(anchor=k, positive=p)

    return rows.mapInPandas(run, "anchor int, positive int, vec_id long, row long, score long")


def _first(found: DataFrame, keys: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def hard_negatives(
    vectors: DataFrame, anchor_step: int = ANCHOR_STEP, positives: int = POSITIVES, negatives: int = NEGATIVES,
    anchors_at_once: int = ANCHORS_AT_ONCE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    rows = workers_ready(written(prepared(vectors).repartition(tasks(spark), "row"), "vectors"))
    chosen = rows.where(F.col("vec_id") % anchor_step == 0)
    n, width = chosen.count(), rows.agg(F.max(F.size("vector"))).first()[0] or 0
    groups = max(-(-n // anchors_at_once), -(-n * width * 8 // ANCHOR_BYTES))
    out = shared_folder(spark, "negatives")
    spark.createDataFrame([], RESULT).write.parquet(out)
    for g in range(groups):
        mine = chosen.where(F.pmod(F.xxhash64("row"), F.lit(groups)) == g).toPandas()
        if len(mine):
            _mine_group(rows, Rows.of(mine, width), width, positives, negatives).write.mode("append").parquet(out)
    return spark.read.schema(RESULT).parquet(out)


def _mine_group(rows: DataFrame, mine: Rows, width: int, positives: int, negatives: int) -> DataFrame:
    spark = rows.sparkSession
    anchors = [Anchor(*a) for a in zip(mine.ids.tolist(), mine.row.tolist(), mine.labels.tolist(), mine.vectors)]
    shared = spark.sparkContext.broadcast(anchors)
    # at most ``positives`` rows of each broadcast anchor
    found = _first(_positives(rows, shared, width, positives), ["anchor"], positives).orderBy("anchor", "rank").collect()
    scores: list[list[int]] = [[] for _ in anchors]
    pairs = []
    for r in found:
        pairs.append((r["anchor"], len(scores[r["anchor"]]), anchors[r["anchor"]].anchor_id, r["vec_id"], r["score"]))
        scores[r["anchor"]].append(r["score"])
    names = spark.createDataFrame(pairs, "anchor int, positive int, anchor_id long, positive_id long, positive_score long")
    best = _first(_negatives(rows, shared, spark.sparkContext.broadcast(scores), width, negatives), ["anchor", "positive"], negatives)
    named = best.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
    columns = [c.split(" ")[0] for c in RESULT.split(", ")]
    return named.join(F.broadcast(names), ["anchor", "positive"]).select(*columns)


ORACLE_SQL = f"""
with v as (
  select distinct vec_id,
    case when vec_id % {MOVED_STEP} = 0 then (label + 1) % {LABELS} else label end as label,
    list_transform(embedding, lambda x: floor({SCALE} * cast(x as double))) as vector
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select a.vec_id as anchor_id, b.vec_id as vec_id, a.label = b.label as same,
    cast(list_inner_product(a.vector, b.vector) as bigint) as score
  from v a join v b on a.vec_id % {ANCHOR_STEP} = 0 and a.vec_id <> b.vec_id),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from (
    select *, row_number() over (partition by anchor_id order by score desc, vec_id) as k from scores where same)
  where k <= {POSITIVES}),
negatives as (
  select p.anchor_id, p.positive_id, s.vec_id as negative_id, p.positive_score, s.score as negative_score,
    row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as rank
  from positives p join scores s on p.anchor_id = s.anchor_id and not s.same
    and {LEAST} * p.positive_score <= 100 * s.score and 100 * s.score <= {MOST} * p.positive_score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
from negatives where rank <= {NEGATIVES}
"""
