"""Ranked lexical search with norm buckets: the best documents of every item, with exact integer scores.

A document is an impact vector over the terms of the items: ``weight * ((1e9 * tf) div (1000 * tf + 20 * m))`` for
each term, and an item is the set of its terms, so a score is an inner product.  Vectors are ordered by length and
cut into buckets.  A bucket whose longest vector cannot reach the item's current k-th score (Cauchy-Schwarz) ends
the search, as all later ones are shorter.  Inside a bucket the item's heaviest terms are the focus coordinates:
their lists give an exact part of the score, and the rest is at most the length of the vector's light part, which
holds all terms as light as those left, times the square root of their number.  Only vectors that can still reach the k-th
score are scored again, in integers.

The documents are read twice: once for their term counts, which are stored, and once, from these, for the search.
Items are searched in groups of a bounded number of terms, whose vocabulary is broadcast; each group takes passes of its own.

Cases: null and empty texts have no terms and are no part of the statistics; an item is all rows that share its id,
with each term once; an item without terms, or whose terms no document has, gets no rows; equal scores go by
ascending doc_id, null last; repeated documents are documents of their own; empty tables give an empty result; other
columns are ignored.  Scores are 64-bit integers throughout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm.common import shared_folder, texts, workers_ready, written

#: Documents of an item in the result.
TOP = 50
#: Terms of items, repeated over items, and items that one pass searches, about.
GROUP_TERMS, GROUP_ITEMS = 1 << 19, 1 << 14
#: Bytes of text whose words are looked up at once.
BLOCK_BYTES = 1 << 20
#: Documents in the first bucket; each further one has twice as many.
BUCKET = 256
#: Share of an item's terms, the heaviest, that are focus coordinates, at least.
FOCUS = 0.9
#: Shares of all entries, lightest terms first, up to which the length of a vector's light part is kept.
LIGHT = (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5)
#: Above all rounding errors of lengths.
SLACK = 1 + 1e-9

RESULT = "item_id long, rank int, doc_id long, score long"
_DELIMITERS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TABLE = bytes(0x20 if c in set(_DELIMITERS) else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other letters beyond ASCII, A-Z lower-cased."""
    return text.encode().translate(_TABLE).split() if text else []


# --- items --------------------------------------------------------------------------------


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the distinct terms of every item."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item_id, text in zip(batch["item_id"].astype("Int64"), batch["text"]):
                own = [t.decode() for t in dict.fromkeys(terms_of(text))]
                yield pd.DataFrame({"item_id": pd.array([item_id] * len(own), dtype="Int64"), "term": np.array(own, dtype=object)})

    rows = workers_ready(items.select(F.col("item_id").cast("long"), "text"))
    return rows.mapInPandas(run, "item_id long, term string").distinct()


def item_groups(items: DataFrame, group_terms: int = GROUP_TERMS, group_items: int = GROUP_ITEMS) -> Iterator[ItemGroup]:
    pairs = written(item_terms(items), "item-terms")
    n, distinct = pairs.agg(F.count(F.lit(1)), F.count_distinct(F.coalesce("item_id", F.lit(-1)))).first()
    groups = max(-(-n // group_terms), -(-distinct // group_items))
    group = F.pmod(F.xxhash64("item_id"), F.lit(groups))
    for k in range(groups):
        found = pairs.where(group == k).toPandas()
        if len(found):
            yield ItemGroup(found["item_id"].astype("Int64"), found["term"])


class ItemGroup:
    """Some items as sets of numbered terms."""

    def __init__(self, item_ids: pd.Series, terms: pd.Series):
        numbers, names = pd.factorize(terms, sort=True)
        self.vocabulary = {t.encode(): k for k, t in enumerate(names)}
        items, self.item_ids = pd.factorize(item_ids, sort=True, use_na_sentinel=False)
        order = np.lexsort((numbers, items))
        edges = np.flatnonzero(np.diff(items[order])) + 1
        self.terms = np.split(numbers[order], edges)


# --- term counts of documents -------------------------------------------------------------


def _pieces(data: bytes, size: int) -> Iterator[bytes]:
    """``data`` in pieces of about ``size`` bytes, cut at spaces."""
    start = 0
    while len(data) - start > size:
        stop = data.find(b" ", start + size)
        if stop < 0:
            break
        yield data[start:stop]
        start = stop
    yield data[start:]


def term_counts(rows: list[str], vocabulary: dict[bytes, int], size: int = BLOCK_BYTES):
    """Number of all terms of each text; and, ordered by text and number, (text, term number, count) of the known ones."""
    width = max(1, len(vocabulary))
    n = np.zeros(len(rows), dtype=np.int64)
    codes, counts = [], []
    words: list[bytes] = []
    owners: list[tuple[int, int]] = []
    held = 0

    def close() -> None:
        ids = np.fromiter(map(vocabulary.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        owner = np.repeat([o for o, _ in owners], [k for _, k in owners])
        np.add.at(n, [o for o, _ in owners], [k for _, k in owners])
        code, count = np.unique((owner * width + ids)[ids >= 0], return_counts=True)
        codes.append(code)
        counts.append(count)
        words.clear()
        owners.clear()

    for k, text in enumerate(rows):
        for piece in _pieces(text.encode().translate(_TABLE), size):
            found = piece.split()
            if found:
                words += found
                owners.append((k, len(found)))
            held += len(piece)
            if held >= size:
                if words:
                    close()
                held = 0
    if words:
        close()
    if not codes:
        return n, *(np.empty(0, dtype=np.int64) for _ in range(3))
    code, at = np.unique(np.concatenate(codes), return_inverse=True)
    count = np.bincount(at, np.concatenate(counts), len(code)).astype(np.int64)
    return n, code // width, code % width, count


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of the documents with at least one term, written once."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n, text, term, count = term_counts(batch["text"].tolist(), shared.value)
            edges = np.searchsorted(text, np.arange(1, len(batch)))
            terms, tfs = np.split(term.astype(np.int32), edges), np.split(count, edges)
            out = {"doc_id": batch["doc_id"].astype("Int64"), "n": n, "terms": terms, "tfs": tfs}
            yield pd.DataFrame(out)[n > 0]

    rows = workers_ready(texts(docs).select(F.col("doc_id").cast("long"), "text"))
    return written(rows.mapInPandas(run, "doc_id long, n long, terms array<int>, tfs array<long>"), "term-counts")


# --- search -------------------------------------------------------------------------------


def impacts(weights: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    m = 100 - 50 + (50 * n * documents) // length
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


class Best:
    """The best documents of one item so far: highest score first, then smallest id, null last."""

    def __init__(self, top: int):
        self.top = top
        self.scores = np.empty(0, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.int64)
        self.nulls = np.empty(0, dtype=bool)

    @property
    def least(self) -> int:
        """A score below this cannot enter."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        enter = scores >= self.least
        if not enter.any():
            return
        scores, ids, nulls = (np.concatenate([a, b[enter]]) for a, b in zip((self.scores, self.ids, self.nulls), (scores, ids, nulls)))
        order = np.lexsort((ids, nulls, -scores))[: self.top]
        self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]


class NormBuckets:
    """Impact vectors in order of length, with one list for each coordinate."""

    def __init__(
        self, ids: np.ndarray, nulls: np.ndarray, owner: np.ndarray, term: np.ndarray, impact: np.ndarray, weights: np.ndarray, bucket: int = BUCKET
    ):
        squares = np.bincount(owner, impact.astype(float) ** 2, len(ids))
        order = np.argsort(-squares, kind="stable")
        place = np.empty(len(ids), dtype=np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.nulls = ids[order], nulls[order]
        self.norms = np.sqrt(squares[order]) * SLACK
        rank = place[owner]
        weight = weights[term]
        self.limits = np.quantile(weight, LIGHT, method="lower") if len(weight) else np.zeros(len(LIGHT))
        self.light = [
            np.sqrt(np.bincount(rank[weight <= w], impact[weight <= w].astype(float) ** 2, len(ids))) * SLACK for w in self.limits
        ]
        by_row = np.lexsort((term, rank))
        self.row_terms, self.row_impacts = term[by_row], impact[by_row]
        self.row_starts = np.searchsorted(rank[by_row], np.arange(len(ids) + 1))
        by_term = np.lexsort((rank, term))
        self.list_docs, self.list_impacts = rank[by_term], impact[by_term]
        self.list_terms, starts = np.unique(term[by_term], return_index=True)
        self.list_starts = np.append(starts, len(term))
        edges, size = [0], bucket
        while edges[-1] < len(ids):
            edges.append(min(len(ids), edges[-1] + size))
            size *= 2
        self.edges = edges
        self.seen = self.scored = 0

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best, focus: float = FOCUS) -> None:
        """Enter the vectors that belong to the best of the item with these terms."""
        at = np.searchsorted(self.list_terms, terms)
        there = at < len(self.list_terms)
        there[there] = self.list_terms[at[there]] == terms[there]
        terms, at = terms[there], at[there]  # the others are zero in all vectors here
        if not len(terms):
            return
        wanted = np.zeros(len(weights), dtype=bool)
        wanted[terms] = True
        # the lightest terms are left out of the focus, as far as a limit takes few enough of them
        level, left = -1, np.zeros(len(terms), dtype=bool)
        for k, limit in enumerate(self.limits):
            under = weights[terms] <= limit
            if under.sum() <= (1 - focus) * len(terms):
                level, left = k, under
        leading, over = at[~left], math.sqrt(left.sum())
        reach = math.sqrt(len(terms))
        for low, high in zip(self.edges[:-1], self.edges[1:]):
            if reach * self.norms[low] < best.least:
                return
            self.seen += high - low
            bound = np.zeros(high - low)
            for k in leading:
                start, stop = self.list_starts[k], self.list_starts[k + 1]
                a, b = start + np.searchsorted(self.list_docs[start:stop], (low, high))
                bound[self.list_docs[a:b] - low] += self.list_impacts[a:b]
            if level >= 0:
                bound += over * self.light[level][low:high]
            candidates = low + np.flatnonzero(bound * SLACK >= best.least)
            if len(candidates):
                self.scored += len(candidates)
                best.add(self._exact(candidates, wanted), self.ids[candidates], self.nulls[candidates])

    def _exact(self, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        starts, stops = self.row_starts[rows], self.row_starts[rows + 1]
        sizes = stops - starts
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
        value = np.where(wanted[self.row_terms[at]], self.row_impacts[at], 0)
        total = np.concatenate([[0], np.cumsum(value)])
        return total[ends] - total[ends - sizes]


def _searched(found: DataFrame, group: ItemGroup, weights: np.ndarray, documents: int, length: int, top: int) -> DataFrame:
    """(item, score, doc_id, task): the best of each task's documents for every item."""
    shared = found.sparkSession.sparkContext.broadcast((group.terms, weights))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms, weights = shared.value
        best = [Best(top) for _ in terms]
        for batch in batches:
            sizes = batch["terms"].map(len).to_numpy()
            if not sizes.sum():
                continue
            owner = np.repeat(np.arange(len(batch)), sizes)
            term = np.concatenate(batch["terms"].to_numpy()).astype(np.int64)
            impact = impacts(weights[term], np.concatenate(batch["tfs"].to_numpy()), batch["n"].to_numpy()[owner], documents, length)
            nulls = batch["doc_id"].isna().to_numpy()
            ids = batch["doc_id"].astype("Int64").fillna(0).to_numpy(dtype=np.int64)
            buckets = NormBuckets(ids, nulls, owner, term, impact, weights)
            for own, so_far in zip(terms, best):
                buckets.search(own, weights, so_far)
        task = TaskContext.get().partitionId()
        for k, so_far in enumerate(best):
            if len(so_far.scores):
                ids = pd.array(so_far.ids, dtype="Int64")
                ids[so_far.nulls] = pd.NA
                yield pd.DataFrame({"item": k, "score": so_far.scores, "doc_id": ids, "task": task})

    chosen = workers_ready(found.where(F.size("terms") > 0))
    return chosen.mapInPandas(run, "item int, score long, doc_id long, task int")


def _ranked(found: DataFrame, keys: list[Column | str]) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))


def ranked_documents(
    docs: DataFrame, items: DataFrame, top: int = TOP, group_terms: int = GROUP_TERMS, group_items: int = GROUP_ITEMS
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of every item with the highest scores above 0."""
    spark = docs.sparkSession
    out = shared_folder(spark, "ranked")
    spark.createDataFrame([], RESULT).write.parquet(out)
    for group in item_groups(items, group_terms, group_items):
        found = counted(docs, group.vocabulary)
        documents, length = found.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not documents:
            continue
        df = np.zeros(len(group.vocabulary), dtype=np.int64)
        for row in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[row["term"]] = row["count"]
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)
        of_tasks = _searched(found, group, weights, documents, length, top)
        # a task sends at most ``top`` rows of an item; groups of tasks first, so that no window gathers those of all tasks
        some = of_tasks.withColumn("part", F.col("task") % 64).withColumn("_place", _ranked(of_tasks, ["item", "part"]))
        best = some.where(F.col("_place") <= top).withColumn("rank", _ranked(some, ["item"])).where(F.col("rank") <= top)
        names = spark.createDataFrame(
            [(k, None if pd.isna(i) else int(i)) for k, i in enumerate(group.item_ids)], "item int, item_id long"
        )
        best.join(F.broadcast(names), "item").select(*spark.read.parquet(out).columns).write.mode("append").parquet(out)
    return _result(spark, out)


def _result(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESULT).parquet(path)


ORACLE_SQL = r"""
with words as (
  select r, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select row_number() over () as r, doc_id, text from documents)),
wanted as (
  select distinct item_id, term from (
    select item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark)),
lengths as (select r, doc_id, count(*) as n from words group by r, doc_id),
corpus as (select count(*) as docs, cast(sum(n) as bigint) as total from lengths),
counts as (select r, term, count(*) as tf from words group by r, term),
weights as (
  select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) as bigint) as w
  from (select term, count(*) as df from counts group by term), corpus),
scores as (
  select item_id, r, doc_id,
    cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total)))) as bigint) as score
  from wanted join counts using (term) join weights using (term) join lengths using (r), corpus
  group by item_id, r, doc_id)
select item_id, cast(rank as integer) as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank from scores where score > 0)
where rank <= 50
"""
