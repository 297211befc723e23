"""Hard negatives: against brute force over all rows, and the lists on their own."""

import math

import numpy as np
import pytest
from riskframe.llm import hard_negatives as hn

VECTOR = "vec_id long, embedding array<float>, label int, rank int, score double, row string"


def rows(n=700, width=6, seed=4, lengths=True):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        x = rng.normal(size=width) * (rng.choice([0.2, 1.0, 5.0]) if lengths else 1.0)
        out.append((k, [float(np.float32(v)) for v in x], int(rng.integers(0, 4)), 1, 0.5, "x"))
    out += [out[100], out[3], out[300]]  # repeated rows
    out += [(100, [0.5] * width, 1, 1, 0.5, "x")]  # another row of an anchor's id
    out += [(k, out[k % 5][1], out[k % 5][2], 1, 0.5, "x") for k in range(n, n + 40)]  # equal vectors
    out += [(n + 50, None, 1, 1, 0.5, "x"), (n + 51, [1.0] * width, None, 1, 0.5, "x"), (n + 52, [None] * width, 1, 1, 0.5, "x")]
    out += [(n + 53, [float("nan")] * width, 1, 1, 0.5, "x"), (n + 54, [float("inf")] + [0.0] * (width - 1), 1, 1, 0.5, "x")]
    out += [(n + 55, [], 1, 1, 0.5, "x"), (n + 56, [3.0], 2, 1, 0.5, "x"), (None, [0.25] * width, 1, 1, 0.5, "x"), (None, [0.25] * width, 3, 1, 0.5, "x")]
    return out


def expected(given, width, step=100, positives=5, negatives=10):
    distinct = {}
    for vec_id, x, label, *_ in given:
        if label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        v = tuple(math.floor(256 * t) for t in x)
        distinct[vec_id, label, v] = np.array([*v, *[0] * (width - len(v))], dtype=np.int64)
    key = lambda s, r: (-s, r[0] is None, r[0] or 0)
    out = []
    for a, va in distinct.items():
        if a[0] is None or a[0] % step:
            continue
        scored = [(int(va @ vb), b) for b, vb in distinct.items()]
        same = sorted((x for x in scored if x[1][1] == a[1] and x[1] != a), key=lambda x: key(*x))[:positives]
        other = sorted((x for x in scored if x[1][1] != a[1]), key=lambda x: key(*x))
        for ps, p in same:
            band = [(s, b) for s, b in other if 30 * ps <= 100 * s <= 90 * ps][:negatives]
            out += [(a[0], p[0], k + 1, b[0], ps, s) for k, (s, b) in enumerate(band)]
    return sorted(out, key=str)


def mined(spark, given, parts=3, **more):
    got = hn.hard_negatives(spark.createDataFrame(given, VECTOR).repartition(parts), **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted([tuple(r) for r in got.collect()], key=str)


@pytest.mark.parametrize("lengths", [True, False])
def test_brute_force(spark, lengths):
    given = rows(lengths=lengths)
    want = expected(given, 6)
    assert len(want) > 200 and mined(spark, given) == want


def test_small_blocks_and_groups_of_anchors_change_nothing(spark):
    given = rows(seed=9)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)
    try:
        assert mined(spark, given, 5, anchors_at_once=2) == expected(given, 6)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def index_of(vectors, **more):
    n = len(vectors)
    rows = hn.Rows(np.arange(n), np.arange(n), np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int64), vectors)
    return hn.CoordinateLists(rows, **more)


def test_lists_lose_no_row():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-300, 300, (4000, 8)) * rng.choice([1, 1, 4], (4000, 1))
    index = index_of(vectors, bucket=512)
    for _ in range(40):
        q = rng.integers(-300, 300, 8)
        scores = vectors @ q
        least = int(np.quantile(scores, rng.choice([0.9, 0.99, 0.999])))
        found = {}
        for places, exact in index.reaching(q, lambda: least):
            found |= dict(zip(index.rows.ids[places].tolist(), exact.tolist()))
        assert {k: s for k, s in found.items() if s >= least} == {int(k): int(scores[k]) for k in np.flatnonzero(scores >= least)}
    assert index.verified < 0.8 * index.seen < 0.8 * 40 * 4000


def test_large_components_are_exact():
    vectors = np.array([[1 << 30, 3], [(1 << 30) + 1, -3], [0, 0]])
    index = index_of(vectors)
    q = np.array([(1 << 31) - 1, 7])
    got = {}
    for places, exact in index.reaching(q, lambda: -(1 << 62)):
        got |= dict(zip(index.rows.ids[places].tolist(), exact.tolist()))
    assert got == {k: int(v) for k, v in enumerate(vectors @ q)}


def test_band():
    for score in range(-30, 300):
        low, high = hn.band(score)
        want = [x for x in range(-300, 300) if 30 * score <= 100 * x <= 90 * score]
        assert want == list(range(low, high + 1))


def test_one_hot_vector(spark):
    given = [(k, [0.5, 0.5], k % 2, 1, 0.5, "x") for k in range(1, 900)] + [(1000, [1.0, 0.0], 0, 1, 0.5, "x")]
    assert mined(spark, given, 2) == expected(given, 2)


def test_nothing_to_mine(spark):
    assert mined(spark, [], 1) == []
    assert mined(spark, [(100, [1.0], 1, 1, 0.5, "x")], 1) == []
    assert mined(spark, [(101, [1.0], 1, 1, 0.5, "x"), (102, [1.0], 2, 1, 0.5, "x")], 1) == []
