"""SimHash by generalised pigeonhole and BM25 decontamination: against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_fixture import documents, no_documents, rows, text_of
from pyspark.sql import functions as F
from riskframe.llm import decontam, simhash_gph


def plain_fingerprint(text: str) -> int:
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps: list[int], radius: int = 4) -> list[int]:
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_documents_against_brute_force(spark):
    got = simhash_gph.near_duplicates(documents(spark)).collect()
    fps = [plain_fingerprint(text_of(r)) for r in rows()]
    label = components(fps)
    lowest = {}
    for r, c in zip(rows(), label):
        if r[0] is not None:
            lowest[c] = min(lowest.get(c, r[0]), r[0])
    want = sorted((str(r[0]), f"{f:016x}", str(lowest.get(c))) for r, f, c in zip(rows(), fps, label))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


def clustered(seed: int, centres: int, each: int) -> list[int]:
    rng = random.Random(seed)
    out = set()
    for _ in range(centres):
        at = rng.getrandbits(64)
        for _ in range(each):
            at2 = at
            for b in rng.sample(range(64), rng.randint(0, 5)):
                at2 ^= 1 << b
            out.add(at2)
    return sorted(out)


@pytest.mark.parametrize("full", [8, 4096])
def test_links_connect_what_brute_force_connects(spark, full):
    fps = clustered(3, 25, 60)  # a small limit makes crowded values split again and again
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = simhash_gph.all_links(df, full=full).collect()
    at = {f: i for i, f in enumerate(signed)}
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for e in edges:
        a, b = find(at[e.a]), find(at[e.b])
        root[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(fps))] == components(fps)


def test_thresholds_keep_the_pigeonhole(spark):
    fps = np.array(clustered(4, 5, 40), dtype=np.uint64)
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    for count in (2, 3, 5, 8):
        total, both = simhash_gph.bit_counts(df)
        plan = simhash_gph.Plan(simhash_gph.correlated_groups(total, both, count)).learn(df, total)
        assert sorted(b for g in plan.groups for b in g) == list(range(64))
        allotted, _ = plan.thresholds(fps)
        assert ((allotted + 1).sum(axis=1) == simhash_gph.RADIUS + 1).all() and allotted.min() >= -1


def test_keep_one_keeps_one_of_each_component(spark):
    docs = documents(spark)
    kept = simhash_gph.keep_one(docs)
    assert kept.columns == docs.columns
    left = {plain_fingerprint(text_of(r)) for r in kept.collect()}
    label = components([plain_fingerprint(text_of(r)) for r in rows()])
    assert len(left) == len(set(label))
    assert simhash_gph.keep_one(no_documents(spark)).count() == 0
    assert simhash_gph.near_duplicates(no_documents(spark)).count() == 0


def index_of(items):
    df = Counter(w for _, t in items for w in set(decontam.words_of(t)))
    n = len(items)
    idf = {w: math.log(1 + (n - c + 0.5) / (c + 0.5)) for w, c in df.items()}
    return decontam.ItemIndex(items, idf, sum(len(decontam.words_of(t)) for _, t in items) / n)


def test_block_max_wand_finds_what_exhaustive_scoring_finds():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(60)], k=rng.randint(3, 40)))) for i in range(300)]
    index = index_of(items)
    for _ in range(100):
        terms = sorted(set(rng.choices(range(len(index.vocabulary)), k=25)))
        for p in index.classes:
            got = sorted((i, round(s, 9)) for part in range(len(p.edges) - 1) for i, s in p.search(terms, 0.5, part))
            scores = Counter()
            for t in terms:
                for i, s in zip(*p.lists.get(t, ((), (), ()))[:2]):
                    scores[i] += s
            assert got == sorted((i, round(s, 9)) for i, s in scores.items() if s >= 0.5 - 1e-9)


ITEMS = [
    (1, "Which river runs past the old copper lantern in the winter harbour? The quiet amber one of the violet meadow it was"),
    (2, "seven grey herons stood upon the frozen pond while nobody in the village noticed their silent patient watch"),
    (3, None),
    (4, ""),
    (5, "short item"),
]


def planted(spark):
    long = " ".join(f"filler{i}" for i in range(3000))
    texts = [
        (1, f"{long} {ITEMS[0][1]} {long}"),
        (2, ITEMS[1][1].upper().replace(" ", " ,\n")),
        (3, " ".join(ITEMS[1][1].split()[:9])),  # the question alone
        (4, " ".join(sorted(ITEMS[1][1].split()))),  # the words, not the text
        (5, None),
        (6, ""),
        (7, "filler short item filler"),
        (8, f"{ITEMS[0][1]} and {ITEMS[1][1]}"),
        (8, f"{ITEMS[0][1]} and {ITEMS[1][1]}"),
    ]
    return spark.createDataFrame(texts, "doc_id long, text string").withColumn("item_id", F.lit(9)).withColumn("hit", F.lit(1))


@pytest.mark.parametrize("index_words", [decontam.INDEX_WORDS, 20])
def test_planted_items_are_found(spark, index_words):
    items = spark.createDataFrame([*ITEMS, ITEMS[0]], "item_id long, text string")
    got = decontam.contaminations(planted(spark), items, index_words=index_words).collect()
    want = [(1, 1), (2, 2), (7, 5), (8, 1), (8, 1), (8, 2), (8, 2)]
    assert sorted((r.doc_id, r.item_id) for r in got) == want
    left = decontam.clean(planted(spark), items, index_words=index_words)
    assert sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 6]
    assert left.columns == ["doc_id", "text", "item_id", "hit"]


def test_no_items_and_no_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminations(planted(spark), none).count() == 0
    assert decontam.clean(planted(spark), none).count() == 9
    some = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontam.contaminations(no_documents(spark), some).count() == 0


def test_cleaned_rows_are_written_by_small_batches(spark, monkeypatch):
    """The pass that sends whole texts to Python runs inside, under its own batch size, and not where the result is written."""
    from riskframe.llm import common

    sizes = []
    write = common.written
    monkeypatch.setattr(common, "written", lambda df, purpose: (sizes.append(int(spark.conf.get(common._BATCH_SETTING))), write(df, purpose))[1])
    docs = spark.createDataFrame([(1, "what is the tallest hill of all the north land? it is old rock hill"), (2, "nothing to see"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "what is the tallest hill of all the north land? it is old rock hill")], "item_id long, text string")
    kept = decontam.clean(docs, items)
    assert common.BATCH_BYTES in sizes
    assert "ArrowEvalPython" not in kept._jdf.queryExecution().toString()
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
