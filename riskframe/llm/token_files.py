"""Token ids in binary files of fixed bit width, with random access.

Every document becomes its byte-level BPE ids and one end id.  Ids are stored in the fewest bits that hold
every id of the vocabulary, 64 ids in as many 64-bit words as an id has bits, so numpy packs and unpacks whole
lanes at once.  A file is

    header      magic, bits of an id, ids in a block, ids, documents, part, ids of the part before this file
    documents   first id of each document and the end; ids of the documents; which of these ids are null
    blocks      byte offset of each block in the payload, and the end
    payload     packed blocks

Documents lie in ascending order of id over all parts and files; a part is one task's range of ids.  Files are
written by Spark's own file sink, so a lost task leaves none behind, into any store that Spark reaches, and they
are read back as binary files.

Cases: null and empty texts have the end id alone; a null id comes before all others; rows with equal id are
ordered by the hash of their text, and equal rows are stored as rows of their own; a document is never cut over
two files, however long; an empty table gives no documents; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.functions.layout import tasks
from riskframe.functions.lookup import lookup_join
from riskframe.llm.common import shared_folder, small_batches, texts, workers_ready, written

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
#: Ids of a block, a multiple of 64.
BLOCK = 4096
#: Ids after which a file is closed.
FILE_IDS = 1 << 23
#: Bytes of text in a part, about.
PART_BYTES = 64 << 20
#: Words of a generation whose ids a Python worker remembers.
WORDS_REMEMBERED = 250_000

MAGIC = b"IDBITS01"
#: Stands after every file, as the sink ends each record with it.
TRAILER = "END-OF-IDS"
_HEADER = struct.Struct("<8sIIQQQQ")
_LANES = 64


# --- bits ---------------------------------------------------------------------------------


def bits_for(vocabulary_size: int) -> int:
    """The fewest bits that hold the ids 0 .. vocabulary_size - 1."""
    return max(1, (vocabulary_size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` below 2**bits; id ``i`` stands in bits ``i * bits`` and on, lowest bit first."""
    groups = -(-len(ids) // _LANES)
    lanes = np.zeros(groups * _LANES, dtype=np.uint64)
    lanes[: len(ids)] = ids
    lanes = lanes.reshape(groups, _LANES)
    words = np.zeros((groups, bits), dtype=np.uint64)
    for lane in range(_LANES):
        word, shift = divmod(lane * bits, 64)
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return words.astype("<u8", copy=False).tobytes()


def unpack_bits(data, bits: int, start: int, count: int) -> np.ndarray:
    """Ids ``start`` .. ``start + count`` of packed ``data``; reads only the words that hold them."""
    if count <= 0:
        return np.empty(0, dtype="<u4")
    first, last = start // _LANES, -(-(start + count) // _LANES)
    words = np.frombuffer(data, dtype="<u8", offset=first * bits * 8, count=(last - first) * bits).reshape(-1, bits)
    lanes = np.empty((last - first, _LANES), dtype="<u4")
    mask = np.uint64((1 << bits) - 1)
    for lane in range(_LANES):
        word, shift = divmod(lane * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        lanes[:, lane] = value & mask
    return lanes.reshape(-1)[start - first * _LANES :][:count]


def file_bytes(ids: list[np.ndarray], doc_ids: list[int | None], bits: int, part: int, before: int, block: int = BLOCK) -> bytes:
    """One file: the ids of some documents of ``part``, which has ``before`` ids ahead of them."""
    starts = np.zeros(len(ids) + 1, dtype="<u8")
    np.cumsum([len(i) for i in ids], out=starts[1:])
    total = int(starts[-1])
    joined = np.concatenate(ids) if ids else np.empty(0, dtype="<u4")
    payload = [pack_bits(joined[at : at + block], bits) for at in range(0, total, block)]
    offsets = np.zeros(len(payload) + 1, dtype="<u8")
    np.cumsum([len(p) for p in payload], out=offsets[1:])
    header = _HEADER.pack(MAGIC, bits, block, total, len(ids), part, before)
    numbers = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    nulls = np.array([d is None for d in doc_ids], dtype=np.uint8)
    return b"".join([header, starts.tobytes(), numbers.tobytes(), nulls.tobytes(), offsets.tobytes(), *payload])


class TokenFile:
    """A file in memory or a memory map of it.  Nothing is unpacked before it is asked for."""

    def __init__(self, data):
        self._data = memoryview(data)
        magic, self.bits, self.block, self.ids, self.documents, self.part, self.before = _HEADER.unpack_from(self._data)
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        at = _HEADER.size
        self.starts = np.frombuffer(self._data, "<u8", self.documents + 1, at).astype(np.int64)
        at += 8 * (self.documents + 1)
        self.doc_ids = np.frombuffer(self._data, "<i8", self.documents, at)
        at += 8 * self.documents
        self.nulls = np.frombuffer(self._data, np.uint8, self.documents, at).astype(bool)
        at += self.documents
        blocks = -(-self.ids // self.block)
        self.offsets = np.frombuffer(self._data, "<u8", blocks + 1, at).astype(np.int64)
        self._payload = at + 8 * (blocks + 1)

    def read(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from position ``start`` of the file on."""
        if start < 0 or count < 0 or start + count > self.ids:
            raise IndexError(f"ids {start} .. {start + count} of a file of {self.ids}")
        found = []
        while count:
            block, inside = divmod(start, self.block)
            take = min(count, self.block - inside)
            whole = min(count, self.ids - start) // self.block if not inside else 0
            if whole > 1 and self.block % _LANES == 0:  # full blocks follow each other without a gap
                take = whole * self.block
            low = self._payload + int(self.offsets[block])
            found.append(unpack_bits(self._data[low:], self.bits, inside, take))
            start, count = start + take, count - take
        return np.concatenate(found) if found else np.empty(0, dtype="<u4")

    def document(self, k: int) -> np.ndarray:
        return self.read(int(self.starts[k]), int(self.starts[k + 1] - self.starts[k]))


# --- ids of texts -------------------------------------------------------------------------


#: Bytes that no white space begins with: ASCII signs, and lead bytes of letters beyond it.
_BLACK = np.zeros(256, dtype=bool)
_BLACK[33:127] = _BLACK[0xC3:0xE1] = _BLACK[0xE4:0xF5] = True
#: Letters and digits of ASCII.
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = True


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin.  ``data``: their UTF-8 bytes end to end; ``starts``: where each text begins, and the end.

    Only places at which the splitting pattern cuts anyway, whatever stands around them (see ``WordIds``).
    """
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[starts] = True
    after, before = np.append(data[1:], np.uint8(0)), np.append(np.uint8(0), data[:-1])
    at = np.flatnonzero((data == 32) | (data == 10))
    inner = ~edge[at + 1] & _BLACK[after[at]]
    begins = (before[at] > 32) & (before[at] < 127)
    signs = np.flatnonzero((data == 44) | (data == 46))
    last, lead = before[signs], before[np.maximum(signs - 1, 0)]
    letter = (last >= 0x80) & (last <= 0xBF) & (lead >= 0xC3) & (lead <= 0xC8) & ~((lead == 0xC3) & ((last == 0x97) | (last == 0xB7)))
    edge[at[inner | begins]] = True
    edge[signs[_ALNUM[last] | letter]] = True
    edge[len(data)] = False
    return np.flatnonzero(edge)


class WordIds:
    """Ids of a text by the tokenizers library, remembered word by word.

    The splitting pattern of this vocabulary never crosses from a letter or number to another sign, nor from a
    character to white space, and the last space or line feed of white space stands with or before the character behind it.
    So a text may be cut before white space, before such a space or line feed, and before a comma or full stop behind a
    letter or number.  Texts that hold an added token go through the tokenizer whole, as white space before one counts as
    the end of a text.  Words are remembered in two generations, so those in use outlive the rare ones.
    """

    #: Bytes from which on a text goes through the tokenizer whole, as its pieces would not fit an array.
    _WHOLE = 1 << 28

    def __init__(self, path: str, remembered: int = WORDS_REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self.size = self._tokenizer.get_vocab_size()
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        # a token's text has one character for each of its bytes
        self._bytes = np.array([len(self._tokenizer.id_to_token(i) or "") for i in range(self.size)], dtype=np.int64)
        self._remembered = remembered
        self._words: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of new words.  Those that begin with a space or line feed are encoded as one text."""
        joined, single = [], []
        for w in words:
            sure = w[0] in " \n" and ("!" <= w[1:2] <= "~" or "\u00c0" <= w[1:2] < "\u1000" or w[1:2] >= "\u4000")  # as _BLACK
            (joined if sure else single).append(w)
        text = "".join(joined)
        ids = self._encode(text)
        sizes = list(map(len, joined if text.isascii() else map(str.encode, joined)))
        ends = np.searchsorted(np.cumsum(self._bytes[ids]), np.cumsum(sizes), side="left") + 1
        data, edges = ids.tobytes(), [0, *(4 * ends).tolist()]
        self._words.update((w, data[a:b]) for w, a, b in zip(joined, edges, edges[1:]))
        self._words.update((w, self._encode(w).tobytes()) for w in single)

    def _found(self, words: list[str]) -> list[bytes]:
        """Ids of each word."""
        if len(self._words) > self._remembered:
            self._older, self._words = self._words, {}
        known, older = self._words, self._older
        found = list(map(known.get, words))
        new = [k for k, ids in enumerate(found) if ids is None]
        if new:
            fresh = []
            for k in new:
                w = words[k]
                ids = older.get(w)
                if ids is None:
                    fresh.append(k)
                else:
                    found[k] = known[w] = ids
            self._learn([words[k] for k in fresh])
            for k in fresh:
                found[k] = known[words[k]]
        return found

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text.  Texts are cut and their distinct pieces found by arrays, without an object per piece."""
        held = np.zeros(len(texts), dtype=bool)
        for token in self._added:
            held |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        out = self._cut(pc.if_else(held, "", texts) if held.any() else texts)
        for k in np.flatnonzero(held).tolist():
            out[k] = self._encode(texts[k].as_py())
        return out

    def _cut(self, texts: pa.Array) -> list[np.ndarray]:
        if not pc.sum(pc.binary_length(texts)).as_py():
            return [np.empty(0, dtype="<u4") for _ in range(len(texts))]
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
        buffer = texts.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
        offsets = offsets - offsets[0]
        begins = cuts(np.frombuffer(buffer, dtype=np.uint8), offsets)
        edges = np.append(begins, len(buffer)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.string(), len(begins), [None, pa.py_buffer(edges), buffer]).dictionary_encode()
        ids = pa.array(self._found(pieces.dictionary.to_pylist()), pa.binary()).take(pieces.indices)
        ends = np.frombuffer(ids.buffers()[1], dtype=np.int32)[: len(ids) + 1] // 4
        found = np.frombuffer(ids.buffers()[2], dtype="<u4")
        at = ends[np.searchsorted(begins, offsets)].tolist()
        return [found[a:b] for a, b in zip(at, at[1:])]

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text, whatever its length."""
        long = np.flatnonzero(pc.binary_length(texts).to_numpy(zero_copy_only=False) >= self._WHOLE)
        if not len(long):
            return self.batch(texts)
        out, start = [], 0
        for k in [*long.tolist(), len(texts)]:
            out += self.batch(texts.slice(start, k - start))
            out += [self._encode(texts[k].as_py())] if k < len(texts) else []
            start = k + 1
        return out


@lru_cache(maxsize=1)
def word_ids(vocabulary: str) -> WordIds:
    """One tokenizer in a Python worker: what a task has learnt helps the next one."""
    import public_tokenizers

    return WordIds(public_tokenizers.path(vocabulary))


# --- files in Spark -----------------------------------------------------------------------


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    file_ids: int = FILE_IDS,
    part_bytes: int = PART_BYTES,
) -> None:
    """Write all of ``docs(doc_id, text)`` to files below ``path``, in ascending order of doc_id.

    One shuffle, of the texts, by ranges of (doc_id, hash of the text, row), so rows that share an id are spread too.
    """
    rows = workers_ready(texts(docs)).select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("_tie"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(tasks(docs.sparkSession), -(-size // part_bytes))
    order = ["doc_id", "_tie", "_row"]
    ranged = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(parts, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_ids(vocabulary)
        bits, end = bits_for(tokenizer.size), np.array([end_id], dtype="<u4")
        part, before = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        held = 0
        for batch in batches:
            for doc_id, own in zip(batch["doc_id"].to_pylist(), tokenizer.ids(batch["text"])):
                ids.append(np.append(own, end))
                doc_ids.append(doc_id)
                held += len(ids[-1])
                if held >= file_ids:
                    yield _row_of(file_bytes(ids, doc_ids, bits, part, before))
                    ids, doc_ids, held, before = [], [], 0, before + held
        if doc_ids:
            yield _row_of(file_bytes(ids, doc_ids, bits, part, before))

    files = ranged.sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(run, "file binary")
    sink = files.select(F.col("file").cast("string").alias("value")).write
    with small_batches(docs.sparkSession):
        sink.option("maxRecordsPerFile", 1).option("lineSep", TRAILER).option("compression", "none").text(path)


def _row_of(data: bytes) -> pa.RecordBatch:
    return pa.record_batch([pa.array([data], type=pa.binary())], names=["file"])


def _files(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return workers_ready(found.where("length > 0").select("content"))


def file_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents as the files hold them: part, at (ids of the part before the document), doc_id, n_tokens, ids_crc32
    and, if wanted, ids (little-endian unsigned 32-bit integers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                found = TokenFile(content.as_buffer())
                for low in range(0, found.documents, 4096):
                    yield _documents(found, range(low, min(found.documents, low + 4096)), with_ids)

    schema = "part long, at long, doc_id long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return _files(spark, path).mapInArrow(run, schema)


def _documents(found: TokenFile, chosen: range, with_ids: bool) -> pa.RecordBatch:
    low, high = int(found.starts[chosen.start]), int(found.starts[chosen.stop])
    ids = found.read(low, high - low)
    starts = found.starts[chosen.start : chosen.stop + 1]
    data = [ids[a - low : b - low].tobytes() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
    n = len(chosen)
    span = slice(chosen.start, chosen.stop)
    columns = {
        "part": pa.array(np.full(n, found.part, dtype=np.int64)),
        "at": pa.array(starts[:-1] + found.before),
        "doc_id": pa.array(found.doc_ids[span].astype(np.int64), mask=found.nulls[span]),
        "n_tokens": pa.array(np.diff(starts)),
        "ids_crc32": pa.array([zlib.crc32(d) for d in data], type=pa.int64()),
    }
    if with_ids:
        columns["ids"] = pa.array(data, type=pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    with small_batches(spark):
        found = written(file_documents(spark, path), "token-documents")
    sizes = found.groupBy("part").agg(F.sum("n_tokens").alias("ids"))
    # one row per part, of which there are as many as tasks
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("first"))
    placed = lookup_join(found, written(firsts, "token-parts"), ["part"], "inner", spread_by="at")
    return placed.select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def stored_tokens(docs: DataFrame) -> DataFrame:
    """Write ``docs`` to token files in the shared folder and digest what the files hold."""
    path = shared_folder(docs.sparkSession, "token-files")
    write_token_files(docs, path)
    return token_digest(docs.sparkSession, path)
