"""Benchmark decontamination: BM25 index of the test items, searched with block-max WAND.

Every window of every document is a query against the inverted index of the items.  An
item's BM25 score is divided by the score of the item itself, so 1 means that the window
holds all of its words.  Items at or above a share are retrieved; then the question and the
answer of the item must both be covered by word five-grams of the window.

Cases: null and empty texts match nothing; items without words are left out; ties do not
matter, as every item above the share is retrieved; repeated rows are searched as rows of
their own and repeated items once; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import shared_folder, small_batches, workers_ready, written, written_by_small_batches

K1 = 1.2
B = 0.75
#: Share of an item's own score from which on it is retrieved.
SHARE = 0.6
#: Share of the words of the question, and of the answer, that matching shingles must cover.
OVERLAP = 0.6
SHINGLE = 5
#: Postings in a block of the index.
BLOCK = 32
#: Ranges of items in an index whose bounds are checked for many windows at once.
RANGES = 32
#: Words of items that one broadcast index holds, about.  More items take further passes.
INDEX_WORDS = 2_000_000
#: Share of an item's words that count as its answer where no question mark tells.
ANSWER_SHARE = 1 / 3

_WORD = re.compile(r"\w+")
HIT = "item_id long, score double, question_overlap double, answer_overlap double, at long"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def question_words(text: str) -> int:
    """Words up to the last question mark that something follows, or else the leading share."""
    total = len(words_of(text))
    cut = text.rfind("?") + 1
    if cut and 0 < len(words_of(text[:cut])) < total:
        return len(words_of(text[:cut]))
    return max(1, total - int(round(total * ANSWER_SHARE)))


class Postings:
    """Inverted index of items of similar length: impacts as shares of each item's own score."""

    def __init__(self, items: list[tuple[int, list[int], int]], impacts: list[dict[int, float]], window: int):
        self.items = items  # (item_id, word ids, words in the question)
        self.window = window
        lists: dict[int, list[tuple[int, float]]] = {}
        for k, impact in enumerate(impacts):
            for term, share in impact.items():
                lists.setdefault(term, []).append((k, share))
        self.lists = {
            term: (
                [k for k, _ in found],
                [share for _, share in found],
                [max(s for _, s in found[i : i + BLOCK]) for i in range(0, len(found), BLOCK)],
            )
            for term, found in lists.items()
        }
        self.most = {term: max(blocks) for term, (_, _, blocks) in self.lists.items()}
        self.edges = np.linspace(0, len(items), min(RANGES, len(items)) + 1).astype(int)

    def range_bounds(self, terms: int) -> np.ndarray:
        """(term, range of items): the largest impact there; the row after the last term is 0."""
        bounds = np.zeros((terms + 1, len(self.edges) - 1), dtype=np.float32)
        for term, (ids, shares, _) in self.lists.items():
            np.maximum.at(bounds[term], np.searchsorted(self.edges, ids, side="right") - 1, shares)
        return bounds

    def search(self, terms: list[int], share: float, part: int) -> list[tuple[int, float]]:
        """Items of a range whose score reaches ``share`` for this set of words, by block-max WAND."""
        share -= 1e-9
        low, high = int(self.edges[part]), int(self.edges[part + 1])
        cursors = []
        for t in terms:
            if t in self.lists:
                ids = self.lists[t][0]
                at = bisect_left(ids, low)
                if at < len(ids) and ids[at] < high:
                    cursors.append([ids[at], at, *self.lists[t], self.most[t]])
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += c[5]
                if bound >= share:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block_bound, beyond = 0.0, None
            for c in cursors[: pivot + 1]:
                at = _seek(c, item)
                if at < len(c[2]):
                    block_bound += c[4][at // BLOCK]
                    end = c[2][min(len(c[2]), (at // BLOCK + 1) * BLOCK) - 1] + 1
                    beyond = end if beyond is None else min(beyond, end)
            if block_bound < share:
                target = max(item + 1, beyond if beyond is not None else item + 1)
                if pivot + 1 < len(cursors):
                    target = max(item + 1, min(target, cursors[pivot + 1][0]))
                moving = cursors[: pivot + 1]
            elif cursors[0][0] == item:
                score = sum(c[3][c[1]] for c in cursors[: pivot + 1])
                if score >= share:
                    found.append((item, score))
                target, moving = item + 1, cursors[: pivot + 1]
            else:
                target, moving = item, [c for c in cursors[: pivot + 1] if c[0] < item]
            for c in moving:
                c[1] = _seek(c, target)
                c[0] = c[2][c[1]] if c[1] < len(c[2]) and c[2][c[1]] < high else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return found


def _seek(cursor: list, item: int) -> int:
    at, ids = cursor[1], cursor[2]
    while at < len(ids) and ids[at] < item:
        at += 1
    return at


class ItemIndex:
    """Vocabulary and postings by length class; a window has room for two items of its class."""

    def __init__(self, items: list[tuple[int, str]], idf: dict[str, float], mean_words: float):
        self.vocabulary: dict[str, int] = {}
        classes: dict[int, list] = {}
        common: dict[int, float] = {}
        for item_id, text in items:
            words = words_of(text)
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            counts: dict[int, int] = {}
            weights: dict[int, float] = {}
            for w, i in zip(words, ids):
                counts[i] = counts.get(i, 0) + 1
                weights[i] = idf[w]
                common[i] = -idf[w]
            norm = K1 * (1 - B + B * len(words) / mean_words)
            impact = {i: weights[i] * n * (K1 + 1) / (n + norm) for i, n in counts.items()}
            own = sum(impact.values())
            impact = {i: x / own for i, x in impact.items()}
            classes.setdefault((len(words) - 1).bit_length(), []).append(
                ((item_id, ids, question_words(text)), impact)
            )
        self.classes = []
        for size, found in sorted(classes.items()):
            # items with the same commonest words stand together, which makes bounds of ranges and blocks tight
            found.sort(key=lambda x: (sorted(x[1], key=lambda i: -common[i])[:3], x[0][0]))
            self.classes.append(Postings([i for i, _ in found], [m for _, m in found], 2 << size))
        self.bounds = [postings.range_bounds(len(self.vocabulary)) for postings in self.classes]
        self.most = [bounds.max(axis=1) for bounds in self.bounds]

    def hits(self, text: str, share: float, overlap: float) -> list[tuple[int, float, float, float, int]]:
        """(item_id, score, question and answer overlap, first word of the window) of verified items, the best window of each."""
        words = words_of(text)
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        best: dict[int, tuple] = {}
        for postings, bounds, most in zip(self.classes, self.bounds, self.most):
            window, step = postings.window, postings.window // 2
            starts = np.arange(0, max(1, len(ids) - step), step)
            sums = np.concatenate([[0.0], np.cumsum(most[ids])])
            bound = sums[np.minimum(starts + window, len(ids))] - sums[starts]
            for start, part, span, terms in _promising(ids, starts[bound >= share - 1e-5], window, bounds, share):
                for item, score in postings.search(terms, share, part):
                    item_id, own, cut = postings.items[item]
                    asked, answered = _covered(span, own, cut)
                    if asked >= overlap and answered >= overlap and (item_id not in best or score > best[item_id][1]):
                        best[item_id] = (item_id, float(score), asked, answered, start)
        return [best[i] for i in sorted(best)]


def _promising(
    ids: np.ndarray, starts: np.ndarray, window: int, bounds: np.ndarray, share: float
) -> Iterator[tuple[int, int, list[int], list[int]]]:
    """Windows and ranges of items for which the distinct words could reach ``share``:
    (start, range, word ids, distinct known word ids)."""
    if not len(starts):
        return
    padded = np.concatenate([ids, np.full(window, -1, dtype=np.int64)])
    for begin in range(0, len(starts), 256):
        part = starts[begin : begin + 256]
        ordered = np.sort(padded[part[:, None] + np.arange(window)], axis=1)
        first = np.ones(ordered.shape, dtype=bool)
        first[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
        first &= ordered >= 0
        size = first.sum(axis=1)
        known = ordered[first]
        edges = np.cumsum(size) - size
        some = size > 0
        total = np.zeros((len(part), bounds.shape[1]), dtype=np.float32)
        if some.any():
            total[some] = np.add.reduceat(bounds[known], edges[some], axis=0)
        for k, r in zip(*np.nonzero(total >= share - 1e-4)):
            start = int(part[k])
            yield start, int(r), ids[start : start + window].tolist(), known[edges[k] : edges[k] + size[k]].tolist()


def _covered(span: list[int], item: list[int], cut: int) -> tuple[float, float]:
    """Shares of the words before and from ``cut`` that lie in shingles which the span has too."""
    width = min(SHINGLE, len(item))
    there = set(zip(*(span[k:] for k in range(width))))
    covered = [False] * len(item)
    for k, shingle in enumerate(zip(*(item[k:] for k in range(width)))):
        if shingle in there:
            covered[k : k + width] = [True] * width
    asked, answered = covered[:cut], covered[cut:]
    share = lambda part: sum(part) / len(part) if part else 1.0
    return share(asked), share(answered)


def item_indexes(items: DataFrame, index_words: int = INDEX_WORDS) -> Iterator[ItemIndex]:
    """Indexes over all items, each of about ``index_words`` words; statistics are over all items."""
    rows = (
        items.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
        .dropDuplicates(["item_id", "text"])
    )
    rows = workers_ready(rows).withColumn("words", _words_column(F.col("text"))).where(F.size("words") > 0)
    rows = written(rows, "items")
    n, total = rows.agg(F.count(F.lit(1)), F.sum(F.size("words"))).first()
    if not n:
        return
    terms = rows.select("item_id", "text", F.explode(F.array_distinct("words")).alias("term"))
    df = F.count(F.lit(1))
    idf = terms.groupBy("term").agg(F.log(1 + (n - df + 0.5) / (df + 0.5)).alias("idf"))
    parts = max(1, -(-int(total) // index_words))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for k in range(parts):
        chosen = rows.where(part == k)
        weights = chosen.select(F.explode("words").alias("term")).distinct().join(idf, "term").collect()
        found = chosen.select("item_id", "text").orderBy("item_id", "text").collect()
        if found:
            yield ItemIndex([tuple(r) for r in found], {r["term"]: r["idf"] for r in weights}, total / n)


def _words_column(text: Column) -> Column:
    def words(text: pd.Series) -> pd.Series:
        return text.map(words_of)

    words.__annotations__ = {"text": pd.Series, "return": pd.Series}
    return F.pandas_udf(words, "array<string>")(text)


def hits_columns(docs: DataFrame, items: DataFrame, share: float = SHARE, overlap: float = OVERLAP, index_words: int = INDEX_WORDS) -> Iterator[Column]:
    """One column expression for each index: the array of verified hits of ``text``.

    An index is given up when the next one is asked for, so no worker ever holds two.
    """
    spark = docs.sparkSession
    workers_ready(docs)
    for index in item_indexes(items, index_words):
        shared = spark.sparkContext.broadcast(index)
        yield _searcher(shared, share, overlap)(F.coalesce(F.col("text"), F.lit("")))
        shared.unpersist()


def _searcher(shared, share: float, overlap: float):
    def search(text: pd.Series) -> pd.Series:
        index = shared.value
        names = [f.split(" ")[0] for f in HIT.split(", ")]
        return pd.Series([[dict(zip(names, hit)) for hit in index.hits(t, share, overlap)] for t in text])

    search.__annotations__ = {"text": pd.Series, "return": pd.Series}
    hit = ", ".join(field.replace(" ", ":", 1) for field in HIT.split(", "))
    return F.pandas_udf(search, f"array<struct<{hit}>>")


def contaminations(docs: DataFrame, items: DataFrame, share: float = SHARE, overlap: float = OVERLAP, index_words: int = INDEX_WORDS) -> DataFrame:
    """One row per (document, item) found: doc_id, item_id, score, question_overlap, answer_overlap, at.

    ``at`` is the first word of the best window.  Each index takes one pass over the documents, which writes what
    it found; there is no shuffle, as a document is searched where it is read.
    """
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, {HIT}"
    path = shared_folder(docs.sparkSession, "hits")
    docs.sparkSession.createDataFrame([], schema).write.parquet(path)
    for column in hits_columns(docs, items, share, overlap, index_words):
        found = docs.select("doc_id", F.explode(column).alias("hit")).select("doc_id", "hit.*")
        with small_batches(docs.sparkSession):
            found.write.mode("append").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def clean(docs: DataFrame, items: DataFrame, share: float = SHARE, overlap: float = OVERLAP, index_words: int = INDEX_WORDS) -> DataFrame:
    """``docs`` without the rows in which an item was found, all columns as they were.

    Each index takes one pass, whose texts go to Python in small batches and whose rows are written.
    """
    columns = docs.columns
    for column in hits_columns(docs, items, share, overlap, index_words):
        docs = written_by_small_batches(docs.where(F.size(column) == 0).select(*columns), "uncontaminated")
    return docs
