"""The near-duplicate stage of the pipeline: against brute force on five-word shingles."""

import random

import corpus_pipeline
import pytest
from llm_fixture import documents, no_documents, rows, text_of
from riskframe.llm import near_copies, simhash_gph


def plain_set(text: str) -> frozenset:
    words = text.encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain_components(texts: list[str]) -> list[int]:
    sets, label = [plain_set(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if a == b or 5 * both >= 4 * (len(a) + len(b) - both):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def edited(words: list[str], at: list[int]) -> str:
    return " ".join(f"{w}x{k}" if k in at else w for k, w in enumerate(words))


def copies() -> list[str]:
    """Groups of texts with a few words changed: similarities on both sides of 0.8."""
    rng = random.Random(7)
    out = []
    for _ in range(12):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(60, 300))]
        out += [edited(words, rng.sample(range(len(words)), rng.randint(0, 6))) for _ in range(6)]
    return out


@pytest.mark.parametrize("full", [3, near_copies.FULL])
def test_keep_one_against_brute_force(spark, full):
    texts = copies()
    label = plain_components(texts)
    assert len(set(label)) < len(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = near_copies.keep_one(df, full)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(label))


def test_stage_drops_copies_far_apart_in_bits(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(5000)}" for _ in range(120)]
    a, b = " ".join(words), edited(words, [40, 90])
    assert (simhash_gph.fingerprint(a) ^ simhash_gph.fingerprint(b)).bit_count() > simhash_gph.RADIUS
    df = spark.createDataFrame([(2, b), (1, a), (3, edited(words, range(0, 120, 9)))], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()) == [1, 3]


def test_awkward_documents(spark):
    docs = documents(spark)
    kept = near_copies.keep_one(docs)
    assert kept.columns == docs.columns
    want = {plain_set(text_of(rows()[i])) for i in set(plain_components([text_of(r) for r in rows()]))}
    left = [plain_set(t) for t in {(r[0], text_of(r)): text_of(r) for r in kept.collect()}.values()]
    assert len(left) == len(want)
    assert near_copies.keep_one(no_documents(spark)).count() == 0


def test_stage_drops_copies_near_in_bits(spark):
    """Op4's links hold in the stage, also where the shingle sets share less than 0.8."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(5000)}" for _ in range(200)]
    body = " ".join(words)
    near = next(
        t for n in range(1, 200) for t in [edited(words, rng.sample(range(200), 5 + n % 4))]
        if (simhash_gph.fingerprint(t) ^ simhash_gph.fingerprint(body)).bit_count() <= simhash_gph.RADIUS
        and plain_components([body, t]) == [0, 1]
    )
    df = spark.createDataFrame([(1, body), (2, near)], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()] == [1]
