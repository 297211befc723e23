"""Best-fit-decreasing packing of token ids into training windows.

Each document becomes its byte-level BPE ids and one end id.  It is cut into full windows
and a rest.  Rests are packed, longest first, each into the open window with the tightest
room; a segment tree indexed by remaining room finds it.  Groups of a bounded number of
pieces are packed apart, so packing runs in parallel and survives lost tasks.

Cases: null and empty texts give the end id alone; ties in length are ordered by id, start
and checksum; repeated rows are packed as rows of their own; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import texts, workers_ready, written_by_small_batches

WINDOW = 2048
END_ID = 1
#: Rests that are packed together, about.
PIECES_PER_GROUP = 8192
#: Words whose ids a Python worker remembers at most.
WORDS_REMEMBERED = 400_000
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Text that the tokenizer file lists as an added token, and its id.
ADDED, ADDED_ID = "<|endoftext|>", 50256

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PACKED = f"{_PIECES}, sequence_id long, offset long"


class WordTokenizer:
    """Byte-level BPE ids of a text, remembered word by word.

    The splitting pattern of this vocabulary never crosses from a non-space to a space, so a text
    may be cut before each space or line feed that stands between two other characters.  Texts with
    longer runs of white space go through the tokenizer whole.  With ``added``, as the tokenizer file does by
    default, ``ADDED`` is one id wherever it stands and the parts around it are encoded apart; without, it is text.
    """

    def __init__(self, vocabulary: str = VOCABULARY, remembered: int = WORDS_REMEMBERED, added: bool = False):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(vocabulary), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._encoding = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._remembered = remembered
        self._added = added
        self._words: dict[str, bytes | None] = {}

    def _encode(self, text: str) -> bytes:
        return np.array(self._encoding.encode_ordinary(text), dtype="<u4").tobytes()

    def ids(self, text: str) -> np.ndarray:
        if not self._added or ADDED not in text:
            return self._plain_ids(text)
        added = np.array([ADDED_ID], dtype="<u4")
        found = [ids for part in text.split(ADDED) for ids in (self._plain_ids(part), added)]
        return np.concatenate(found[:-1])

    def _plain_ids(self, text: str) -> np.ndarray:
        if "\x00" in text:
            return np.frombuffer(self._encode(text), dtype="<u4")
        pieces = text.replace(" ", "\x00 ").replace("\n", "\x00\n").split("\x00")
        known = self._words
        if len(known) > self._remembered:
            known.clear()
        found = list(map(known.get, pieces))
        if None in found:
            for at, value in enumerate(found):
                if value is None:
                    piece = pieces[at]
                    cut = at > 0 and (len(piece) < 2 or piece[1].isspace())
                    if cut or (at == 0 and piece[-1:].isspace()):
                        return np.frombuffer(self._encode(text), dtype="<u4")
                    found[at] = known[piece] = self._encode(piece) if piece else b""
        return np.frombuffer(b"".join(found), dtype="<u4")


def cut(ids: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(start, length, crc32 of the ids) of the full windows and the rest."""
    data = ids.astype("<u4", copy=False)
    return [
        (start, len(piece), zlib.crc32(piece.tobytes()))
        for start in range(0, len(data), window)
        for piece in [data[start : start + window]]
    ]


def pieces(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, added: bool = False) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = WordTokenizer(added=added)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.concatenate([tokenizer.ids(text), end])
                out += [(doc_id, *piece, len(ids)) for piece in cut(ids, window)]
            yield pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]).astype(
                {"doc_id": "Int64"}
            )

    return workers_ready(texts(docs).select(F.col("doc_id").cast("long"), "text")).mapInPandas(run, _PIECES)


def best_fit(lengths: list[int], window: int = WINDOW) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, in the given order; lengths lie in 1..window.

    ``tree`` is a segment tree over remaining room 0..window: a node is true if an open
    bin has room in its range.  The tightest bin for ``n`` is the first true leaf at or
    right of ``n``.
    """
    leaves = 1 << window.bit_length()
    tree = bytearray(2 * leaves)
    open_bins: list[list[int]] = [[] for _ in range(leaves)]
    bins: list[int] = []
    offsets: list[int] = []
    count = 0
    for n in lengths:
        node = n + leaves
        while not tree[node]:
            while node & 1:
                node >>= 1
            if not node:
                break
            node += 1
        if node:
            while node < leaves:
                node = 2 * node if tree[2 * node] else 2 * node + 1
            room = node - leaves
            at = open_bins[room].pop()
            if not open_bins[room]:
                _set(tree, node, 0)
        else:
            room, at = window, count
            count += 1
        bins.append(at)
        offsets.append(window - room)
        left = room - n
        if left:
            if not open_bins[left]:
                _set(tree, left + leaves, 1)
            open_bins[left].append(at)
    return bins, offsets


def _set(tree: bytearray, node: int, value: int) -> None:
    while node:
        if tree[node] == value:
            return
        tree[node] = value
        if not value and tree[node ^ 1]:
            return
        node >>= 1


def pack(found: DataFrame, window: int = WINDOW, per_group: int = PIECES_PER_GROUP) -> DataFrame:
    """Sequence and offset of every piece.  ``found`` should be a table, as it is read twice."""
    groups = max(1, -(-found.count() // per_group))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(
            ["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable"
        )
        bins, offsets = best_fit(rows["length"].tolist(), window)
        rows["sequence_id"] = int(key[0]) * (1 << 32) + np.array(bins, dtype=np.int64)
        rows["offset"] = np.array(offsets, dtype=np.int64)
        return rows.drop(columns="pack").astype({"doc_id": "Int64"})

    group = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)).alias("pack")
    return workers_ready(found.select("*", group)).groupBy("pack").applyInPandas(run, _PACKED)


def packed_documents(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, added: bool = False) -> DataFrame:
    """One row per piece: its place in its document and its place in its sequence."""
    return pack(written_by_small_batches(pieces(docs, window, end_id, added), "pieces"), window)
