"""Streaming exact dedup, packing, sharding, membership: against plain Python."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_fixture import documents, no_documents, rows, text_of
from pyspark.sql import functions as F
from riskframe.llm import membership, packing, sharding, stream_dedup

UPPER = {c: c + 32 for c in range(65, 91)}


def expected_groups():
    groups = defaultdict(list)
    for r in rows():
        groups[text_of(r).translate(UPPER)].append(r[0])
    return groups


@pytest.mark.parametrize("weak", [False, True])
def test_exact_duplicates(spark, weak):
    # one hex digit as digest: almost every hit is a collision and must be told apart by its bytes
    digest = (lambda c: F.substring(stream_dedup.sha256(c), 1, 1)) if weak else stream_dedup.sha256
    got = stream_dedup.exact_duplicates(documents(spark), digest).collect()
    assert len(got) == len(rows())
    groups = expected_groups()
    kept = sorted(r.keep_id is None and -1 or r.keep_id for r in got if r.kept)
    assert kept == sorted(max((-1 if i is None else i) for i in ids) for ids in groups.values())
    sizes = sorted(r.group_size for r in got)
    assert sizes == sorted(len(ids) for ids in groups.values() for _ in ids)
    if not weak:
        shas = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
        for r in got:
            ids = shas[r.text_sha256]
            assert r.doc_id in ids and r.keep_id == max(ids, key=lambda i: -1 if i is None else i)


def test_exact_keep_one(spark):
    docs = documents(spark)
    kept = stream_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((text_of(r).translate(UPPER), -1 if r[0] is None else r[0]) for r in kept.collect())
    assert got == sorted((t, max(-1 if i is None else i for i in ids)) for t, ids in expected_groups().items())


def test_several_batches_give_one_state(spark):
    found = stream_dedup.arrivals(documents(spark, 7))
    once, often = (stream_dedup.streamed_state(found, n) for n in (100, 1))
    key = lambda df: sorted((r.digest, str(r.keep_id), r.n) for r in df.collect())
    assert key(once) == key(often)


def test_nothing_in(spark):
    empty = no_documents(spark)
    assert stream_dedup.exact_duplicates(empty).count() == 0
    assert stream_dedup.keep_one(empty).count() == 0
    assert packing.packed_documents(empty).count() == 0
    assert sharding.shard_documents(empty).count() == 0


def test_membership_is_exact(spark):
    docs = documents(spark)
    keys = spark.createDataFrame([(i,) for i in range(0, 60, 2)], "k long")
    for bits in (64, 1 << 20):  # a full map lets every row through to the join
        left = membership.without(docs, F.col("doc_id"), keys, bits)
        assert left.columns == docs.columns
        got = sorted(str(r.doc_id) for r in left.collect())
        assert got == sorted(str(r[0]) for r in rows() if r[0] is None or r[0] % 2 or r[0] >= 60)


def test_token_ids_equal_those_of_the_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    mine = packing.WordTokenizer(remembered=50)
    extra = ["  lead", "trail  ", "\n\nx", "x\n\n", " \n a", "a \n", "it's we'll 1234 $%^ é b c", "a  b", " \n b", " ", "\n"]
    for text in [text_of(r) for r in rows()] + extra:
        assert mine.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_queries_give_the_added_token_one_id(spark, tmp_path):
    import corpus_pipeline
    import public_tokenizers
    from riskframe.llm import entries
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    mine = packing.WordTokenizer(remembered=50, added=True)
    end = "<|endoftext|>"
    texts = [end, end * 3, f" {end} ", f"one document.{end}Next one", f"a \n{end}\n\n b", f"a  {end}  b {end}", f"x\x00{end}y", f"a<|{end}|>b", end[:-1]]
    for text in texts + [text_of(r) for r in rows()]:
        assert mine.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    assert len(mine.ids(texts[3])) == 6
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID], dtype="<u4")
        want.append((i, 0, len(ids), zlib.crc32(ids.tobytes()), len(ids)))
    for got in (entries.op9_best_fit_packing(spark, str(tmp_path)), corpus_pipeline.pack(spark, docs, "")):
        assert sorted(map(tuple, got.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect())) == want


def test_packing_is_whole_and_tight(spark):
    got = packing.packed_documents(documents(spark)).toPandas()
    tokenizer = packing.WordTokenizer()
    want = []
    for r in rows():
        ids = np.append(tokenizer.ids(text_of(r)), 1).astype("<u4")
        for a in range(0, len(ids), packing.WINDOW):
            piece = ids[a : a + packing.WINDOW]
            want.append((str(r[0]), a, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
    have = [(str(None if d is None or d != d else int(d)), s, n, c, t) for d, s, n, c, t in got[["doc_id", "start", "length", "ids_crc32", "doc_tokens"]].itertuples(index=False)]
    assert sorted(have) == sorted(want)
    for _, part in got.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part["offset"].tolist() == [0, *part["length"].cumsum().tolist()[:-1]]
        assert part["length"].sum() <= packing.WINDOW


def test_best_fit_against_a_plain_search():
    rng = np.random.default_rng(1)
    for window in (16, 100, 2048):
        lengths = sorted(rng.integers(1, window + 1, 400).tolist(), reverse=True)
        bins, offsets = packing.best_fit(lengths, window)
        used = {}
        for n, b, o in zip(lengths, bins, offsets):
            room = [window - u for u in used.values() if window - u >= n]
            if b in used:
                assert window - used[b] == min(room)
            else:
                assert not room
            assert used.get(b, 0) == o
            used[b] = o + n
    assert packing.best_fit([], 8) == ([], [])


def jump(key: int, shards: int) -> int:
    key, b, j = key & (2**64 - 1), -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & (2**64 - 1)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_shards_follow_the_published_loop(spark):
    keys = [0, 1, 2, 2**40 + 3, 2**62 + 5, -1, -(2**63), *range(100, 400)]
    df = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.jump_shards(F.col("k"), 24).alias("j"))
    for r in df.collect():
        assert (r.j.shard, r.j.grown_shard) == (jump(r.k, 24), jump(r.k, 25))


def test_sharded_rows(spark):
    got = sharding.shard_documents(documents(spark), slot_parts=4).collect()
    assert len(got) == len(rows())
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted((str(r[0]), len(text_of(r).encode()) + 8, zlib.crc32(text_of(r).encode())) for r in rows())
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want


def test_long_texts_reach_python_in_small_batches(spark, monkeypatch):
    """Each step that sends whole texts to Python is written under the small bound, which holds for mapInPandas."""
    import pandas as pd
    from riskframe.llm import common, near_copies, simhash_gph

    def lengths(batches):
        for batch in batches:
            yield pd.DataFrame({"n": [len(batch)]})

    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 200_000).alias("text")).coalesce(1)
    sizes = [r["n"] for r in common.written_by_small_batches(docs.mapInPandas(lengths, "n long"), "lengths").collect()]
    assert sum(sizes) == 40 and max(sizes) <= 6

    seen = []
    bound = lambda df, purpose: seen.append((purpose, spark.conf.get(common._BATCH_SETTING, None))) or df
    monkeypatch.setattr(common, "written", bound)
    few = docs.limit(1)
    packing.packed_documents(few)
    near_copies.shingled(few)
    near_copies.shingle_sets(few, spark.createDataFrame([], "row long, node long"))
    simhash_gph.fingerprints(few)
    assert [p for p, _ in seen] == ["pieces", "shingled", "shingle-sets", "fingerprints"]
    assert {int(size) for _, size in seen} == {common.BATCH_BYTES}
