"""Token files: bits, random access, and the whole query against the tokenizers library."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_fixture import documents, no_documents, rows, text_of
from riskframe.llm import token_files
from riskframe.llm.common import shared_folder


@pytest.mark.parametrize("bits", [1, 2, 3, 7, 8, 11, 15, 16, 17, 24, 31, 32])
def test_bits_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 63, 64, 65, 1000):
        ids = rng.integers(0, 1 << bits, n, dtype=np.uint64).astype("<u4")
        data = token_files.pack_bits(ids, bits)
        assert len(data) == -(-n // 64) * bits * 8
        assert np.array_equal(token_files.unpack_bits(data, bits, 0, n), ids)
        for _ in range(20):
            a, b = sorted(rng.integers(0, n + 1, 2).tolist())
            assert np.array_equal(token_files.unpack_bits(data, bits, a, b - a), ids[a:b])


def test_bits_are_the_fewest():
    assert [token_files.bits_for(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def test_random_access():
    rng = np.random.default_rng(3)
    ids = [rng.integers(0, 50257, n).astype("<u4") for n in (0, 1, 500, 64, 3000, 0, 129)]
    found = token_files.TokenFile(token_files.file_bytes(ids, [5, None, 7, 8, 8, 9, 10], 16, 2, 11, block=128))
    everything = np.concatenate(ids)
    assert (found.documents, found.ids, found.part, found.before) == (7, len(everything), 2, 11)
    assert found.nulls.tolist() == [False, True] + [False] * 5
    for k, own in enumerate(ids):
        assert np.array_equal(found.document(k), own)
    for _ in range(200):
        a, b = sorted(rng.integers(0, len(everything) + 1, 2).tolist())
        assert np.array_equal(found.read(a, b - a), everything[a:b])
    with pytest.raises(IndexError):
        found.read(0, len(everything) + 1)
    with pytest.raises(ValueError):
        token_files.TokenFile(b"x" * 64)


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))


def test_word_ids_equal_the_tokenizer(tokenizer):
    import public_tokenizers

    own = token_files.WordIds(public_tokenizers.path(token_files.VOCABULARY), remembered=50)
    rng = random.Random(5)
    parts = ["a", "word", "new", "lower", " of", " the", "It's", " ", "  ", "\n", "\n\n", "\t", "\r\n", "é", "日本", "<|endoftext|>", "12", "!?", " ", " ", "\x00", "\x1c"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 14))) for _ in range(20000)]
    own._WHOLE = 60
    for start in range(0, len(texts), 250):
        part = texts[start : start + 250]
        for text, got in zip(part, own.ids(pa.array(["skipped", *part]).slice(1)), strict=True):
            assert got.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    assert own.ids(pa.array([], type=pa.string())) == []


def expected(tokenizer):
    found = [(r[0], [*tokenizer.encode(text_of(r), add_special_tokens=False).ids, 0]) for r in rows()]
    return [(d, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())) for d, ids in found]


def in_order(got):
    """Documents lie one after the other, ids ascending with null first."""
    got = sorted(got, key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    numbers = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert numbers == sorted(numbers)


def test_whole_query(spark, tokenizer):
    got = token_files.stored_tokens(documents(spark)).collect()
    in_order(got)
    key = lambda found: sorted((-1 if d is None else d, n, c) for d, n, c in found)
    assert key((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == key(expected(tokenizer))


def test_many_small_files_hold_the_same(spark, tokenizer):
    path = shared_folder(spark, "small-token-files")
    token_files.write_token_files(documents(spark), path, file_ids=300, part_bytes=5000)
    in_order(token_files.token_digest(spark, path).collect())
    got = token_files.file_documents(spark, path, with_ids=True).collect()
    assert len({r.part for r in got}) > 8
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens
    key = lambda found: sorted((-1 if d is None else d, n, c) for d, n, c in found)
    assert key((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == key(expected(tokenizer))


def test_a_repeated_id_is_spread(spark):
    from pyspark.sql import functions as F

    docs = spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same row").alias("text"))
    path = shared_folder(spark, "hot-token-files")
    token_files.write_token_files(docs, path)
    sizes = [r["count"] for r in token_files.file_documents(spark, path).groupBy("part").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 2000
    in_order(token_files.token_digest(spark, path).collect())


def test_no_documents(spark):
    assert token_files.stored_tokens(no_documents(spark)).collect() == []


def test_words_between_runs_of_white_space_are_remembered():
    import public_tokenizers

    own = token_files.WordIds(public_tokenizers.path(token_files.VOCABULARY))
    own.ids(pa.array(["one of two\nthree, four  of\n\nfive.", ", , “,"]))
    calls = []
    own._encode = lambda text, encode=own._encode: calls.append(text) or encode(text)
    again = ["one of  two\n\nfive.", "one\nthree of two “,"]
    got = own.ids(pa.array(again))
    assert not "".join(calls).count("two") and not "".join(calls).count("five")
    assert [g.tolist() for g in got] == [own._tokenizer.encode(t, add_special_tokens=False).ids for t in again]


def test_white_space_at_a_join_is_not_taken_together(tokenizer):
    import public_tokenizers

    own = token_files.WordIds(public_tokenizers.path(token_files.VOCABULARY))
    texts = ["a\nb\r\n", "x\n᠎y", "\n<|endoftext|> \n", "c \n", "  ", "  z\n \n"] * 2
    texts += [" ".join(texts), "\n".join(texts)]
    assert [g.tolist() for g in own.ids(pa.array(texts))] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
