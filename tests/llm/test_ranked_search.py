"""Ranked search: against brute force over all documents, and its buckets and bounds on their own."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from llm_fixture import documents, no_documents, rows
from pyspark.sql import functions as F
from riskframe.llm import ranked_search as rs

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}
ITEM = "item_id long, text string, doc_id string, score double"


def terms(text):
    return _TERM.findall((text or "").translate(UPPER))


def items():
    texts = ["the river, the stone", "quiet AMBER lantern", "Éclair straße niño", "", None, "zzz unknown", "of and the", "one x" + "x" * 4999, "id three no text"]
    out = [(k, t, "x", 1.0) for k, t in enumerate(texts)]
    return out + [out[0], (1, "winter copper", "x", 1.0), (None, "violet", "x", 1.0)]


def expected(docs, wanted, top=rs.TOP):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    queries = {}
    for i, t in wanted:
        queries.setdefault(i, set()).update(terms(t))
    out = []
    for i, own in queries.items():
        found = []
        for d, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            score = 0
            for t in own & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        found.sort(key=lambda x: x[:3])
        out += [(i, k + 1, f[3], -f[0]) for k, f in enumerate(found[:top])]
    return sorted(out, key=str)


def given(spark, wanted=None):
    return spark.createDataFrame(items() if wanted is None else wanted, ITEM)


def test_terms():
    for text in ["A-b_c d9É\x00x y 日本,語", "", None, "  .,", "ÀB c\x7fd{e}f[g]`h@i:j/k"]:
        assert [t.decode() for t in rs.terms_of(text)] == terms(text)


@pytest.mark.parametrize("top", [3, 50])
def test_brute_force(spark, top):
    got = rs.ranked_documents(documents(spark, 5), given(spark), top)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = expected([(r[0], r[1]) for r in rows()], [(r[0], r[1]) for r in items()], top)
    assert sorted([tuple(r) for r in got.collect()], key=str) == want


def test_groups_of_items_change_nothing(spark):
    docs = documents(spark, 2)
    once, often = (rs.ranked_documents(docs, given(spark), 5, terms, some) for terms, some in ((1 << 19, 1 << 14), (3, 2)))
    key = lambda df: sorted([tuple(r) for r in df.collect()], key=str)
    assert key(once) == key(often)


def test_long_texts_are_counted_in_pieces():
    vocabulary = {b"river": 0, b"stone": 1}
    rows_ = ["river stone  river", "", "x" * 100 + " stone", "stone " * 500]
    whole, pieces = (rs.term_counts(rows_, vocabulary, size) for size in (1 << 20, 7))
    for a, b in zip(whole, pieces):
        assert a.tolist() == b.tolist()
    assert whole[0].tolist() == [3, 0, 2, 500] and whole[3].tolist() == [2, 1, 1, 500]


def test_buckets_prune_and_stay_exact():
    rng = np.random.default_rng(1)
    n, size = 3000, 60
    owner = np.repeat(np.arange(n), 20)
    term = np.concatenate([rng.choice(size, 20, replace=False) for _ in range(n)])
    weights = rng.integers(1, 9000, size)
    impact = weights[term] * rng.integers(1, 10 ** rng.integers(2, 6, n)[owner] + 1)
    buckets = rs.NormBuckets(np.arange(n), np.zeros(n, dtype=bool), owner, term, impact, weights, bucket=64)
    assert (np.diff(buckets.norms) <= 0).all()
    dense = np.zeros((n, size), dtype=np.int64)
    dense[owner, term] = impact
    for _ in range(30):
        own = np.sort(rng.choice(size, 8, replace=False))
        best = rs.Best(10)
        buckets.search(own, weights, best)
        score = dense[:, own].sum(axis=1)
        order = np.lexsort((np.arange(n), -score))[:10]
        assert best.ids.tolist() == order.tolist() and best.scores.tolist() == score[order].tolist()
    assert buckets.scored < buckets.seen < 30 * n / 2


def test_planted_copies_come_first(spark):
    text = "solitary gardener counts seven marble fountains before dawn"
    docs = documents(spark).select("doc_id", "text").unionByName(
        spark.range(900, 1000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    )
    got = rs.ranked_documents(docs, given(spark, [(5, text, None, None)])).orderBy("rank").collect()
    assert [r.doc_id for r in got] == list(range(900, 950)) and len({r.score for r in got}) == 1


def test_nothing_to_search(spark):
    assert rs.ranked_documents(no_documents(spark), given(spark)).collect() == []
    assert rs.ranked_documents(documents(spark), given(spark, [])).collect() == []
    assert rs.ranked_documents(documents(spark), given(spark, [(1, None, None, None)])).collect() == []
