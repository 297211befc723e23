"""Context-tree weighting, quality trees and the toxicity network: brute force, gradients, held-out accuracy."""

import math
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from llm_fixture import documents, no_documents, rows, text_of
from pyspark.sql import functions as F
from riskframe.llm import ctw, quality_gbt, toxicity_gru
from riskframe.llm.common import table

SF = "/root/testdata/sf0.001"


class PlainTree:
    """Context-tree weighting by recursion over dictionaries."""

    def __init__(self, texts, depth):
        self.depth, self.n, self.below_of = depth, Counter(), defaultdict(set)
        for t in texts:
            s = bytes(depth) + t + b"\0"
            for i in range(depth, len(s)):
                for d in range(depth + 1):
                    for k in range(8):
                        self.n[s[i - d : i], 1 << k | s[i] >> (8 - k), s[i] >> (7 - k) & 1] += 1
        for context, node, _ in self.n:
            if context:
                self.below_of[context[1:], node].add(context)

    def kt(self, context, node):
        a, b = self.n[context, node, 0], self.n[context, node, 1]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @lru_cache(None)
    def below(self, context, node):
        return sum(self.block(c, node) for c in self.below_of[context, node])

    @lru_cache(None)
    def block(self, context, node):
        own = self.kt(context, node)
        return own if len(context) == self.depth else float(np.logaddexp(own, self.below(context, node))) - math.log(2)

    def score(self, text):
        s, total = bytes(self.depth) + text + b"\0", 0.0
        for i in range(self.depth, len(s)):
            for k in range(8):
                node, bit, p = 1 << k | s[i] >> (8 - k), s[i] >> (7 - k) & 1, None
                for d in range(self.depth, -1, -1):
                    context = s[i - d : i]
                    a, b = self.n[context, node, 0], self.n[context, node, 1]
                    if a + b == 0 and d:
                        continue
                    own = ((b if bit else a) + 0.5) / (a + b + 1)
                    if p is not None and a + b:
                        gap = max(-700, min(700, self.below(context, node) - self.kt(context, node)))
                        own = own / (1 + math.exp(gap)) + p * (1 - 1 / (1 + math.exp(gap)))
                    p = own
                total += math.log10(p)
        return total


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def test_scores_against_recursion(spark):
    docs = [r for r in rows() if len(text_of(r)) < 1000]
    frame = spark.createDataFrame([r[:2] for r in docs], "doc_id long, text string").repartition(3)
    got = ctw.scores(frame, chunk_bytes=2000).collect()
    train = [text_of(r).encode() for r in docs if not held_out(r[0])]
    tree = PlainTree(train, ctw.DEPTH)
    counts = Counter(w for t in train for w in [*t.lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for r in docs:
        tokens = [*text_of(r).encode().lower().split(), None]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        want.append((str(r[0]), held_out(r[0]), len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 6), round(tree.score(text_of(r).encode()), 6)))
    have = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got]
    assert sorted(have) == sorted(want)


def test_scores_of_whole_fixture_and_of_nothing(spark):
    assert ctw.scores(documents(spark)).count() == len(rows())
    assert ctw.scores(no_documents(spark)).count() == 0


def test_held_out_rows_cost_few_bits(spark):
    row = ctw.scores(table(spark, SF, "documents")).where("held_out").agg(F.avg("bits_per_byte")).first()
    assert row[0] < 2.6


def test_blocks_cut_inside_texts_lose_nothing():
    data = [b"abracadabra  of the\tend", b"", b"xyz" * 50, bytes(range(256)), b" \n ", b"one"]
    for size in (1, 7, 64, 1 << 20):
        grams, at = [[] for _ in data], Counter()
        for keys, sizes, owners in ctw.gram_blocks(data, 5, size):
            assert len(keys) == sizes.sum() and sizes.max() <= size
            for owner, part in zip(owners, np.split(keys, np.cumsum(sizes)[:-1])):
                grams[owner] += part.tolist()
        for d, found in zip(data, grams):
            padded = bytes(5) + d + b"\0"
            assert found == [int.from_bytes(padded[i : i + 6], "big") for i in range(len(d) + 1)]
        words = [[] for _ in data]
        for block, sizes, owners in ctw.word_blocks(data, size):
            for owner, n in zip(owners, sizes):
                words[owner] += block[:n]
                block = block[n:]
        assert words == [d.lower().split() for d in data]


def test_a_text_of_50_mb_stays_within_memory():
    """Beyond the text itself a worker holds blocks and distinct keys only."""
    import subprocess
    import sys

    code = """
import resource
import numpy as np
from riskframe.llm import ctw
words = b" ".join(b"w%d" % (k * k % 5003) for k in range(20000))
text = words * (50_000_000 // len(words))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
tally = ctw.Tally()
ctw.count_keys(tally, [text], np.array([True]))
keys, counts = tally.merged()
found = ctw._scored([text], [(keys, np.log10(counts + 1.0))], 1, 1)
assert found["n_tokens"][0] > 7_000_000
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""
    grown = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=300)
    assert int(grown.stdout) < 400_000  # KB


def test_equal_rows_are_dealt_over_chunks(spark):
    docs = spark.range(600).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same row of words").alias("text"))
    got = ctw.scores(docs, 1000).collect()
    assert len(got) == 600 and len({(r.doc_id, r.score, r.n_tokens) for r in got}) == 1


def test_statistics_of_awkward_texts():
    for r in rows():
        values = quality_gbt.statistics(text_of(r))
        assert len(values) == len(quality_gbt.FEATURES) and np.isfinite(values).all()


def test_trees_learn_a_rule_and_flatten():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 6))
    y = ((x[:, 0] > 0.3) ^ (x[:, 4] < -0.2)).astype(float)
    trees = quality_gbt.fit(x[:3000], y[:3000], trees=40)
    assert ((trees.scores(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.97

    def walk(row):  # one row at a time down every tree
        total = trees.base
        for feature, cut, value in zip(trees.feature, trees.cut, trees.value):
            node = 0
            while feature[node] >= 0:
                node = 2 * node + 1 + (row[feature[node]] > cut[node])
            total += value[node]
        return 1 / (1 + math.exp(-total))

    assert np.allclose(trees.scores(x[:50]), [walk(r) for r in x[:50]])
    assert (quality_gbt.fit(x[:5], np.ones(5)).scores(x[:3]) > 0.99).all()


def test_quality_on_held_out_rows(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    found = quality_gbt.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (found["predicted"] == found["quality"]).mean() > 0.95


def test_scores_of_awkward_rows(spark):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)] + [(3, None, None)], "doc_id long, quality int, toxic int")
    for scores in (quality_gbt.quality_scores, toxicity_gru.toxicity_scores):
        got = scores(documents(spark), labels).collect()
        assert len(got) == len(rows()) and all(0 <= r.score <= 1 for r in got)
        assert scores(no_documents(spark), labels).count() == 0
        assert scores(documents(spark), labels.limit(0)).count() == len(rows())


def test_gradients_against_differences():
    rng = np.random.default_rng(2)
    net = toxicity_gru.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = ["", "alpha", "bet,a", "gamma!", "délta", "x"]
    word, (slot, begins) = toxicity_gru.word_slots(words), toxicity_gru.gram_slots(words)
    at, mask = rng.integers(0, 6, (5, 7)), np.ones((5, 7))
    mask[1, 4:], mask[3, 1:] = 0, 0
    label, weight = np.array([1, 0, 1, 0, 1.0]), np.array([1, 2, 1, 1, 0.5])

    def loss():
        z = net.run(net._inputs(word, slot, begins)[0], at, mask)
        return float((weight * (np.logaddexp(0, z) - label * z)).mean())

    g, _ = net.gradients(word, slot, begins, at, mask, label, weight)
    for name, grad in g.items():
        if isinstance(grad, tuple):
            dense = np.zeros_like(net.p[name])
            np.add.at(dense, grad[0], grad[1])
            grad = dense
        flat, value = grad.ravel(), net.p[name].ravel()
        for k in np.argsort(-np.abs(flat))[:4]:
            keep = value[k]
            value[k] = keep + 1e-4
            up = loss()
            value[k] = keep - 1e-4
            down = loss()
            value[k] = keep
            assert flat[k] == pytest.approx((up - down) / 2e-4, rel=0.05, abs=1e-5), name


def test_network_finds_insults_anywhere_in_long_texts():
    rng = np.random.default_rng(4)
    plain = [f"word{i}" for i in range(200)]

    def text(n, bad):
        words = list(rng.choice(plain, n))
        for _ in range(3 if bad else 0):
            words[rng.integers(n)] = rng.choice(["blorgish", "Blorg,", "blorger!"])
        return " ".join(words)

    texts = [text(int(n), k % 2) for k, n in enumerate(rng.integers(20, 200, 300))]
    net = toxicity_gru.fit(texts, [k % 2 for k in range(300)], epochs=8)
    score = toxicity_gru.Scorer(net, remembered=50).scores
    assert (score([text(60, 0) for _ in range(40)]) < 0.3).mean() > 0.9
    late = [" ".join(rng.choice(plain, 900)) + " blorgish blorg word1" for _ in range(20)]
    assert (score(late) >= 0.3).mean() > 0.9
    assert (toxicity_gru.Scorer(net).scores(late) == score(late)).all()  # forgetting words changes nothing


def test_windows_cover_every_word():
    for n in (0, 1, 63, 64, 65, 120, 121, 1000):
        starts = toxicity_gru._windows(n)
        assert len(starts) and {i for s in starts for i in range(s, min(n, s + toxicity_gru.WINDOW))} == set(range(n))


def test_broadcast_of_frequent_keys_changes_nothing(spark, monkeypatch):
    docs = table(spark, SF, "documents")
    read = lambda: sorted((r.doc_id, round(r.score, 6), round(r.base_score, 6), r.n_known) for r in ctw.scores(docs, 100_000).collect())
    many = read()
    monkeypatch.setattr(ctw.frequent_values, "__defaults__", (50,))
    assert read() == many
    monkeypatch.setattr(ctw.frequent_values, "__defaults__", (0,))
    assert read() == many
