"""Itemsets and rules of item lists of any length, against brute force."""

from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from riskframe.operators import baskets, rules


def brute_itemsets(lists, min_support):
    counts = Counter()
    kept = [sorted({x for x in b if x is not None}) for b in lists]
    kept = [b for b in kept if b]
    for b in kept:
        for size in range(1, len(b) + 1):
            counts.update(combinations(b, size))
    return {s: n for s, n in counts.items() if n / len(kept) >= min_support}, len(kept)


def brute_rules(itemsets, total, min_confidence):
    out = {}
    for s, n in itemsets.items():
        for size in range(1, len(s)):
            for left in combinations(s, size):
                right = tuple(x for x in s if x not in left)
                if (n / total) / (itemsets[left] / total) >= min_confidence:
                    out[left, right] = n / itemsets[left]
    return out


def random_baskets(seed):
    rng = np.random.default_rng(seed)
    lists = [[f"i{int(x)}" for x in rng.zipf(1.6, rng.integers(0, 9)) if x < 15] for _ in range(400)]
    lists += [["i1", "i1", None, "i2"], [None], [], None]  # repeats and nulls
    lists += [["a", "b", "c", "d", "e", "f"]] * 60  # one long set
    return lists


@pytest.mark.parametrize("seed,support,confidence", [(1, 0.05, 0.5), (2, 0.1, 0.2), (3, 0.3, 0.9)])
def test_against_brute_force(spark, seed, support, confidence):
    lists = random_baskets(seed)
    df = spark.createDataFrame([(x,) for x in lists], "held array<string>").repartition(3)
    found = baskets.frequent_itemsets(df, "held", support)
    want, total = brute_itemsets([x or [] for x in lists], support)
    assert {tuple(r["items"]): r["n"] for r in found.collect()} == want
    got = {(tuple(r["antecedents"]), tuple(r["consequents"])): r["confidence"] for r in baskets.association_rules(found, confidence).collect()}
    expected = brute_rules(want, total, confidence)
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - v) <= 0.0051 for k, v in expected.items())
    if support < 0.1:
        assert any(len(right) > 2 for _, right in got)


def test_equal_to_the_five_columns(data):
    plain = data.plain
    cube = {tuple(sorted(r["items"])): r["n"] for r in rules.frequent_itemsets(plain, 0.05).collect()}
    tree = {tuple(r["items"]): r["n"] for r in baskets.frequent_itemsets(rules.transactions(plain), "items", 0.05).collect()}
    assert cube == tree
    a = rules.association_rules(plain, 0.05, 0.3)
    b = baskets.association_rules(baskets.frequent_itemsets(rules.transactions(plain), "items", 0.05), 0.3)
    key = lambda df: {(tuple(sorted(r[0])), tuple(sorted(r[1]))): tuple(r[2:]) for r in df.collect()}
    assert key(a) == key(b)


def test_no_baskets(spark):
    df = spark.createDataFrame([([None],), (None,)], "held array<string>")
    found = baskets.frequent_itemsets(df, "held", 0.1)
    assert found.count() == 0 and baskets.association_rules(found).count() == 0


def test_few_high_risk_rows_have_no_rules(spark):
    columns = "bairro string, tipo_crime string, risco_alto int"
    enough = [("A", "Roubo", 1)] * 5 + [(None, None, 1)] * 5
    assert rules.frequent_itemsets(spark.createDataFrame(enough, columns), 0.1).count() == 3
    assert rules.frequent_itemsets(spark.createDataFrame(enough[1:], columns), 0.1).count() == 0
    assert rules.frequent_itemsets(spark.createDataFrame([("A", "Roubo", 1)] * 4 + [(None, None, 1)] * 9, columns), 0.1).count() == 0
