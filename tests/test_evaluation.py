"""Metrics against plain Python on frames with many ties."""

import numpy as np
import pytest
from riskframe.operators import evaluation as ev


def frame(spark, rows):
    return spark.createDataFrame(rows, "id_ocorrencia long, bairro string, ano_mes string, y int, score double")


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    out = []
    for i in range(600):
        place = "A" if i % 3 else "B"  # one hot window
        month = f"2024-0{1 + i % 3}"
        out.append((i, place, month, int(rng.random() < 0.3), float(rng.integers(0, 6)) / 5))
    return out


@pytest.fixture(scope="module")
def pred(spark, rows):
    return frame(spark, rows).cache()


def prf(tp, chosen, positives):
    p = tp / chosen if chosen else 0.0
    r = tp / positives if positives else 0.0
    f = 2 * tp / (chosen + positives) if chosen + positives else 0.0
    return p, r, f


def test_f1_at_k_by_window(pred, rows):
    want = {}
    for key in {(r[1], r[2]) for r in rows}:
        group = sorted((r for r in rows if (r[1], r[2]) == key), key=lambda r: (-r[4], r[0]))
        k = max(1, int(len(group) * 0.2))
        want[key] = (len(group), *prf(sum(r[3] for r in group[:k]), k, sum(r[3] for r in group)))
    got = {(r[0], r[1]): tuple(r[2:]) for r in ev.f1_at_k_by_window(pred, ["bairro", "ano_mes"]).collect()}
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key], abs=1e-6)


def test_f1_at_k_with_shuffled_joins(pred, rows, monkeypatch):
    from riskframe.functions import lookup

    want = sorted(map(tuple, ev.f1_at_k_by_window(pred, ["bairro", "ano_mes"]).collect()))
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(lookup, "SMALL_ROWS", 0)
    assert sorted(map(tuple, ev.f1_at_k_by_window(pred, ["bairro", "ano_mes"]).collect())) == want


def test_roc_auc_with_ties(pred, rows):
    pos, neg = [r[4] for r in rows if r[3]], [r[4] for r in rows if not r[3]]
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    assert ev.roc_auc(pred).first()[0] == pytest.approx(wins / len(pos) / len(neg), abs=1e-6)


def test_best_threshold_takes_the_first(pred, rows):
    best = max(
        ((prf(sum(r[3] for r in rows if r[4] >= t), sum(r[4] >= t for r in rows), sum(r[3] for r in rows))[2], -t) for t in ev.THRESHOLD_GRID)
    )
    row = ev.best_threshold(pred).first()
    assert (row["threshold"], row["f1"]) == (-best[1], pytest.approx(best[0], abs=1e-6))


def test_performance_curve(pred, rows):
    scores = np.array([r[4] for r in rows])
    y = np.array([r[3] for r in rows])
    curve = ev.performance_curve(pred).collect()
    assert len(curve) == 21
    for row, k in zip(curve, np.linspace(0.1, 0.5, 21)):
        chosen = scores >= np.percentile(scores, (1 - k) * 100)
        assert row["f1"] == pytest.approx(prf(y[chosen].sum(), chosen.sum(), y.sum())[2], abs=1e-6)


def test_one_class(spark):
    one = frame(spark, [(i, "A", "m", 0, i / 10) for i in range(10)])
    assert ev.roc_auc(one).first()[0] == 0.0
    row = ev.eval_metrics(one, 0.5).first()
    assert (row["precision"], row["recall"], row["f1"], row["support_pos"]) == (0.0, 0.0, 0.0, 0)
    assert [r["f1"] for r in ev.f1_at_k_by_window(one, ["bairro"]).collect()] == [0.0]


def test_empty(spark):
    none = frame(spark, [])
    assert ev.f1_at_k_by_window(none, ["bairro"]).count() == 0
    assert ev.performance_curve(none).count() == 0
    assert ev.roc_auc(none).first()[0] == 0.0


def test_curve_ends(pred):
    roc = ev.roc_curve(pred).collect()
    assert max((r["fpr"], r["tpr"]) for r in roc) == (1.0, 1.0) and (None, 0.0, 0.0) in [tuple(r) for r in roc]
    assert len(roc) == 7


def test_gain_without_cases(spark):
    assert ev.operational_gain(frame(spark, [(1, "A", "m", 1, 0.5)])).first()["eficiencia_pct"] == 0.0
