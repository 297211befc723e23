"""Language-model scores by context-tree weighting over bytes.

A text is its UTF-8 bytes and one end mark (byte 0); before its start stand ``DEPTH`` zero
bytes.  Each byte is eight binary decisions.  Each decision has a Krichevsky-Trofimov estimate
in each context of 0..DEPTH preceding bytes, and the tree mixes the estimates of all depths by
their weighted block probabilities over the training texts.  A context that training never
reached does not take part.

Work is done once per distinct gram (context and byte), not per position: the grams and words
of a chunk of documents meet the model in joins on 64-bit keys, and come back as the chunk's own
dictionary.  Values of a bounded number of frequent keys are broadcast, and only the rare
keys of a chunk take part in the join.  Words are keyed by 62 bits of XXH64.

Texts become arrays in blocks of bounded size.  A long text is cut inside, grams with the bytes before the
cut and words at white space, so a worker's memory follows the distinct keys of its rows and not their lengths.
Depths 0 to 2 of the tree are summed over all tasks; a subtree below three context bytes lies in one task and has at
most 256**3 grams, whatever the input.

Cases: null and empty texts have the end mark alone; without training texts every byte costs
eight bits; repeated rows have equal scores and are dealt over all chunks; an empty table gives an empty result; other
columns are ignored.  The documents are read twice and must come in the same partitions both times, as a table
does; a key without a value raises an error.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import fold_of, texts, workers_ready, written

DEPTH = 5
FOLDS, HELD_OUT_FOLD = 7, 2
#: Bytes of text that share one dictionary, about.
CHUNK_BYTES = 8 << 20
#: Bytes of text that are turned into arrays at once.
BLOCK_BYTES = 1 << 20
#: Distinct keys that a task gathers before it sends them on.
KEYS_AT_ONCE = 1 << 20
#: Keys whose values are broadcast, at most: the most frequent ones, which no dictionary then has to ask for.
FREQUENT = 1 << 20
#: Grams whose part of the tree is computed at once, about.
SLICE_GRAMS = 1 << 16

WORD_BIT = 1 << 62
END_KEY = WORD_BIT  # the end token among the words
_SPACE = re.compile(rb"[\x09-\x0D\x20]")


def word_keys(words: list[bytes]) -> np.ndarray:
    """Keys with bit 62 set, so that they differ from all grams; the end token has one of its own."""
    import xxhash

    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    return np.maximum(hashes & np.uint64(WORD_BIT - 1), np.uint64(1)).astype(np.int64) | WORD_BIT


def gram_blocks(
    data: Iterable[bytes], depth: int = DEPTH, size: int | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, sizes, owners), block by block: the (depth + 1)-gram ending at each byte, in pieces of texts.

    ``sizes`` are the positions of each piece and ``owners`` the numbers of their texts.
    """
    size = size or BLOCK_BYTES
    pieces, owners, held = [], [], 0
    for k, d in enumerate(data):
        padded = b"".join([bytes(depth), d, b"\x00"])
        for at in range(0, len(d) + 1, size):
            pieces.append(padded[at : at + size + depth])
            owners.append(k)
            held += len(pieces[-1]) - depth
            if held >= size:
                yield _gram_keys(pieces, depth), np.array([len(p) - depth for p in pieces]), np.array(owners)
                pieces, owners, held = [], [], 0
    if pieces:
        yield _gram_keys(pieces, depth), np.array([len(p) - depth for p in pieces]), np.array(owners)


def _gram_keys(pieces: list[bytes], depth: int) -> np.ndarray:
    joined = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    n = len(joined) - depth
    keys = np.zeros(n, dtype=np.int64)
    for j in range(depth + 1):
        keys <<= 8
        keys |= joined[j : j + n]
    ends = np.cumsum([len(p) for p in pieces])[:-1]
    return np.delete(keys, (ends[:, None] - depth + np.arange(depth)).ravel())  # windows over two pieces


def word_blocks(data: Iterable[bytes], size: int | None = None) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """(words, sizes, owners), block by block: lower-cased words, how many each piece of a text has, and its text."""
    size = size or BLOCK_BYTES
    words, sizes, owners, held = [], [], [], 0
    for k, d in enumerate(data):
        start = 0
        while start < len(d):
            cut = _SPACE.search(d, start + size)
            stop = cut.start() if cut else len(d)
            found = d[start:stop].lower().split()
            words += found
            sizes.append(len(found))
            owners.append(k)
            held += stop - start
            start = stop
            if held >= size:
                yield words, np.array(sizes), np.array(owners)
                words, sizes, owners, held = [], [], [], 0
    if sizes:
        yield words, np.array(sizes), np.array(owners)


class Tally:
    """Counts of keys, merged whenever the unmerged ones outgrow the merged."""

    def __init__(self):
        self._keys, self._counts = [], []
        self._merged = self._loose = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._keys.append(keys)
        self._counts.append(counts)
        self._loose += len(keys)
        if self._loose > max(self._merged, KEYS_AT_ONCE):
            self.merged()

    @property
    def distinct(self) -> int:
        """Keys of the last merge, a lower bound of the distinct ones."""
        return self._merged

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self._keys:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        found = _summed(np.concatenate(self._keys), np.concatenate(self._counts))
        self._keys, self._counts = [found[0]], [found[1]]
        self._merged, self._loose = len(found[0]), 0
        return found


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, dtype=int)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, dtype=int)
    return keys[first], np.diff(np.append(first, len(keys)))


def count_keys(tally: Tally, data: list[bytes], training: np.ndarray) -> None:
    """Add all keys of the texts, with how often each occurs in those of ``training``."""
    for keys, sizes, owners in gram_blocks(data):
        train = np.repeat(training[owners], sizes)
        tally.add(*_distinct(keys[train]))
        rest = _distinct(keys[~train])[0]
        tally.add(rest, np.zeros(len(rest), dtype=np.int64))
    for words, sizes, owners in word_blocks(data):
        known, others, at = Counter(), set(), 0
        for size, owner in zip(sizes.tolist(), owners.tolist()):
            (known if training[owner] else others).update(words[at : at + size])
            at += size
        others -= known.keys()
        tally.add(word_keys([*known, *others]), np.array([*known.values(), *[0] * len(others)], dtype=np.int64))
    tally.add(np.array([END_KEY]), np.array([int(training.sum())]))


def _portions(batches: Iterator[pd.DataFrame], size: int = 4 << 20) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Texts and training flags of the batches, in portions of about ``size`` bytes."""
    data, training, total = [], [], 0
    for batch in batches:
        for text, train in zip(batch["text"], batch["training"]):
            data.append(text.encode())
            training.append(bool(train))
            total += len(data[-1])
            if total >= size:
                yield data, np.array(training)
                data, training, total = [], [], 0
    if data:
        yield data, np.array(training)


def corpus_counts(rows: DataFrame) -> DataFrame:
    """(key, n) of every gram and word of all rows (text, training), with its count in training."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tally = Tally()
        for data, training in _portions(batches):
            count_keys(tally, data, training)
            if tally.distinct > KEYS_AT_ONCE:
                yield _frame(*tally.merged())
                tally = Tally()
        keys, counts = tally.merged()
        if len(keys):
            yield _frame(keys, counts)

    found = workers_ready(rows.select("text", "training")).mapInPandas(run, "key long, n long")
    return found.groupBy("key").agg(F.sum("n").alias("n"))


def _frame(keys: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"key": keys, "n": counts})


# --- the tree -----------------------------------------------------------------------------


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after a shift by eight; exact to about 1e-12 for x >= 0.5."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the KT block probability."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1) - np.log(np.pi)


def _mixed_block(own: np.ndarray, below: np.ndarray) -> np.ndarray:
    return np.logaddexp(own, below) - np.log(2)


class Levels:
    """Nodes of depths ``top``..DEPTH above some grams.  A node is a context and the bits of the byte so far."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, top: int, depth: int = DEPTH):
        self.top, self.depth = top, depth
        n = len(grams)
        byte = grams & 255
        self.byte = byte
        reverse = np.zeros(n, dtype=np.int64)  # the context with its latest byte first
        for d in range(1, depth + 1):
            reverse = (reverse << 8) | ((grams >> (8 * d)) & 255)
        counts = counts.astype(float)
        self.node: dict[tuple[int, int], np.ndarray] = {}  # node of each gram
        self.first: dict[tuple[int, int], np.ndarray] = {}  # a gram of each node
        self.zeros: dict[tuple[int, int], np.ndarray] = {}
        self.ones: dict[tuple[int, int], np.ndarray] = {}
        for d in range(top, depth + 1):
            code = ((reverse >> (8 * (depth - d))) << 8) | byte
            order = np.argsort(code, kind="stable")
            ordered, weight = code[order], counts[order]
            for k in range(8):
                prefix = ordered >> (8 - k)
                new = np.concatenate([[True], prefix[1:] != prefix[:-1]])
                begin = np.nonzero(new)[0]
                bit = (ordered >> (7 - k)) & 1
                at = np.empty(n, dtype=np.int64)
                at[order] = np.cumsum(new) - 1
                one = np.add.reduceat(weight * bit, begin)
                self.node[d, k], self.first[d, k] = at, order[begin]
                self.ones[d, k], self.zeros[d, k] = one, np.add.reduceat(weight, begin) - one
        self.own: dict[tuple[int, int], np.ndarray] = {}
        self.below: dict[tuple[int, int], np.ndarray] = {}
        self.block: dict[tuple[int, int], np.ndarray] = {}
        for d in range(depth, top - 1, -1):
            for k in range(8):
                own = self.own[d, k] = log_kt(self.zeros[d, k], self.ones[d, k])
                if d == depth:
                    self.block[d, k] = own
                    continue
                parent = self.node[d, k][self.first[d + 1, k]]
                below = self.below[d, k] = np.bincount(parent, self.block[d + 1, k], len(own))
                self.block[d, k] = _mixed_block(own, below)

    def mixed(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For bit ``k`` of each gram: its probability mixed over depths top..DEPTH, and whether training reached any of them."""
        bit = (self.byte >> (7 - k)) & 1
        p, seen = np.zeros(len(bit)), np.zeros(len(bit), dtype=bool)
        for d in range(self.depth, self.top - 1, -1):
            at = self.node[d, k]
            zeros, ones = self.zeros[d, k][at], self.ones[d, k][at]
            own = (np.where(bit == 1, ones, zeros) + 0.5) / (zeros + ones + 1)
            if d < self.depth:
                share = 1 / (1 + np.exp(np.clip(self.below[d, k] - self.own[d, k], -700, 700)))[at]
                own = np.where(seen, share * own + (1 - share) * p, own)
            reached = zeros + ones > 0
            p = np.where(reached, own, p)
            seen |= reached
        return p, seen


class Root:
    """Depths 0, 1 and 2 of the tree.

    ``at`` numbers the nodes of depth 2 that training reached: two context bytes, the latest last, and the node
    of the byte (1..255), 65,536 x 255 at most.  Depths 0 and 1 are dense.
    """

    def __init__(self, at: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        order = np.argsort(at)
        self.at, self.zeros2, self.ones2, below = at[order], zeros[order], ones[order], below[order]
        own = log_kt(self.zeros2, self.ones2)
        self.share2 = _share(own, below)
        upper = self.at & 0xFFFF
        dense = [np.bincount(upper, x, 1 << 16).astype(float).reshape(256, 256) for x in (self.zeros2, self.ones2, _mixed_block(own, below))]
        self.zeros, self.ones, below = dense
        own = log_kt(self.zeros, self.ones)
        self.share = _share(own, below)
        block = np.where(self.zeros + self.ones > 0, _mixed_block(own, below), 0.0)
        self.zeros0, self.ones0 = self.zeros.sum(axis=0), self.ones.sum(axis=0)
        self.share0 = _share(log_kt(self.zeros0, self.ones0), block.sum(axis=0))

    def mixed(self, context: np.ndarray, node: np.ndarray, bit: np.ndarray, p: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """``p`` of the deeper levels mixed with depths 2, 1 and 0."""
        wanted = (context << 8) | node
        at = np.minimum(np.searchsorted(self.at, wanted), max(len(self.at) - 1, 0))
        if len(self.at):
            reached = self.at[at] == wanted
            own = (np.where(bit == 1, self.ones2[at], self.zeros2[at]) + 0.5) / (self.zeros2[at] + self.ones2[at] + 1)
            own = np.where(seen, self.share2[at] * own + (1 - self.share2[at]) * p, own)
            p, seen = np.where(reached, own, p), seen | reached
        latest = context & 255
        zeros, ones = self.zeros[latest, node], self.ones[latest, node]
        own = (np.where(bit == 1, ones, zeros) + 0.5) / (zeros + ones + 1)
        share = self.share[latest, node]
        own = np.where(seen, share * own + (1 - share) * p, own)
        reached = zeros + ones > 0
        p, seen = np.where(reached, own, p), seen | reached
        zeros, ones = self.zeros0[node], self.ones0[node]
        own = (np.where(bit == 1, ones, zeros) + 0.5) / (zeros + ones + 1)
        share = self.share0[node]
        return np.where(seen, share * own + (1 - share) * p, own)


def _share(own: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Weight of a node's own estimate against those below it."""
    return 1 / (1 + np.exp(np.clip(below - own, -700, 700)))


#: Context bytes by which grams are dealt: a task has whole subtrees from this depth on.
TOP = 3


def _subtrees(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and counts of the batches, some whole subtrees at a time."""
    parts = [(b["key"].to_numpy(), b["n"].to_numpy()) for b in batches]
    if not parts:
        return
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    context = (keys >> 8) & ((1 << 8 * TOP) - 1)
    order = np.argsort(context, kind="stable")
    keys, counts, context = keys[order], counts[order], context[order]
    edges = np.append(np.flatnonzero(context[1:] != context[:-1]) + 1, len(keys))
    start = 0
    while start < len(keys):
        stop = int(edges[np.searchsorted(edges, min(start + SLICE_GRAMS, len(keys)))])
        yield keys[start:stop], counts[start:stop]
        start = stop


def _by_context(grams: DataFrame) -> DataFrame:
    return workers_ready(grams).repartition(F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * TOP) - 1)))


def fit_root(grams: DataFrame) -> Root:
    """Sum the subtrees for the nodes of depth 2, of which text has some 100,000."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for keys, counts in _subtrees(batches):
            levels = Levels(keys, counts, TOP)
            for k in range(8):
                gram = levels.first[TOP, k]
                zeros, ones = levels.zeros[TOP, k], levels.ones[TOP, k]
                at = (((keys[gram] >> 8) & 0xFFFF) << 8) | (1 << k) | ((keys[gram] & 255) >> (8 - k))
                reached = zeros + ones > 0
                node, back = np.unique(at[reached], return_inverse=True)
                sums = [np.bincount(back, x[reached], len(node)) for x in (zeros, ones, levels.block[TOP, k])]
                yield pd.DataFrame({"at": node, "zeros": sums[0], "ones": sums[1], "below": sums[2]})

    found = (
        _by_context(grams).mapInPandas(run, "at int, zeros double, ones double, below double")
        .groupBy("at").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("below").alias("below")).toArrow()
    )
    return Root(found["at"].to_numpy().astype(np.int64), *(found[c].to_numpy() for c in ("zeros", "ones", "below")))


def gram_values(grams: DataFrame, root: Root) -> DataFrame:
    """(key, value): log10 probability of the last byte of every gram after its context."""
    shared = grams.sparkSession.sparkContext.broadcast(root)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for keys, counts in _subtrees(batches):
            levels, top = Levels(keys, counts, TOP), shared.value
            value, byte, context = np.zeros(len(keys)), keys & 255, (keys >> 8) & 0xFFFF
            for k in range(8):
                p, seen = levels.mixed(k)
                value += np.log10(top.mixed(context, (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1, p, seen))
            yield pd.DataFrame({"key": keys, "value": value})

    return _by_context(grams).mapInPandas(run, "key long, value double")


# --- scores -------------------------------------------------------------------------------


def scores(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    rows = texts(docs).withColumn("held_out", fold_of(F.col("doc_id"), FOLDS) == HELD_OUT_FOLD)
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    counts = written(corpus_counts(rows.withColumn("training", ~F.col("held_out"))), "counts")
    is_word = F.col("key") >= WORD_BIT
    known = F.sum(F.when(F.col("n") > 0, 1).otherwise(0))
    tokens, distinct = counts.where(is_word).agg(F.sum("n"), known).first()
    tokens, distinct = int(tokens or 0), int(distinct or 0)
    grams = counts.where(~is_word)
    words = counts.where(is_word).select("key", F.log10(F.col("n") + 1.0).alias("value"))
    model = written(gram_values(grams, fit_root(grams)).unionByName(words), "model")
    frequent = rows.sparkSession.sparkContext.broadcast(frequent_values(counts, model))

    salt = F.monotonically_increasing_id()  # equal rows go to different chunks
    chunk = F.pmod(F.xxhash64("doc_id", "text", salt), F.lit(chunks)).cast("int").alias("chunk")
    dealt = workers_ready(rows.select("doc_id", "text", "held_out", chunk))

    def dictionary(rows: pd.DataFrame) -> pd.DataFrame:
        tally = Tally()
        count_keys(tally, [t.encode() for t in rows["text"]], np.zeros(len(rows), dtype=bool))
        keys, _ = tally.merged()
        rare = keys[~_among(keys, frequent.value[0])]
        return pd.DataFrame({"chunk": rows["chunk"].iloc[0], "key": rare})

    def scored(rows: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(values["key"].to_numpy())
        keys, value = values["key"].to_numpy()[order], values["value"].to_numpy()[order]
        found = _scored([t.encode() for t in rows["text"]], [frequent.value, (keys, value)], tokens, distinct)
        out = pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64"), "held_out": rows["held_out"]})
        return out.assign(**found, train_tokens=tokens)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, bits_per_byte double, train_tokens long"
    keys = dealt.groupBy("chunk").applyInPandas(dictionary, "chunk int, key long")
    answered = keys.join(model, "key").select("chunk", "key", "value")
    result = dealt.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInPandas(scored, schema)
    return result.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )


def frequent_values(counts: DataFrame, model: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and values of the most frequent keys, ``most`` at most.

    A count from which on they are few enough is read from the number of keys by (quarter
    octave of the) count, a table of some hundred rows.
    """
    level = F.floor(4 * F.log2(F.col("n").cast("double"))).cast("int")
    sizes = counts.where("n > 0").groupBy(level.alias("level")).count().collect()
    total, least = 0, None
    for row in sorted(sizes, key=lambda r: -r["level"]):
        total += row["count"]
        if total > most:
            break
        least = row["level"]
    if least is None:
        return np.empty(0, dtype=np.int64), np.empty(0)
    found = model.join(counts.where((F.col("n") > 0) & (level >= least)).select("key"), "key").toArrow()
    keys, values = found["key"].to_numpy(), found["value"].to_numpy()
    order = np.argsort(keys)
    return keys[order], values[order]


def _among(wanted: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted), dtype=bool)
    return keys[np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)] == wanted


def _scored(data: list[bytes], lookups: list[tuple[np.ndarray, np.ndarray]], tokens: int, distinct: int) -> dict[str, np.ndarray]:
    def of(wanted: np.ndarray) -> np.ndarray:
        out = np.full(len(wanted), np.nan)
        for keys, value in lookups:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                hit = keys[at] == wanted
                out[hit] = value[at[hit]]
        if np.isnan(out).any():
            raise RuntimeError("keys without a value: the documents came in other partitions when they were read again")
        return out

    texts = len(data)
    score, total = np.zeros(texts), np.zeros(texts)
    n, known = np.zeros(texts, dtype=np.int64), np.zeros(texts, dtype=np.int64)
    for keys, sizes, owners in gram_blocks(data):
        order = np.argsort(keys)
        ordered = keys[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        value = np.empty(len(keys))
        value[order] = of(ordered[new])[np.cumsum(new) - 1]
        np.add.at(score, owners, np.add.reduceat(value, np.cumsum(sizes) - sizes))
    for words, sizes, owners in word_blocks(data):
        if words:
            index = {w: k for k, w in enumerate(dict.fromkeys(words))}
            worth = of(word_keys(list(index)))
            each = worth[np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=len(words))]
            owner = np.repeat(owners, sizes)
            total += np.bincount(owner, each, texts)
            known += np.bincount(owner, each > 0, texts).astype(np.int64)
            np.add.at(n, owners, sizes)
    end = float(of(np.array([END_KEY]))[0]) if texts else 0.0
    sizes = np.array([len(d) + 1 for d in data])
    return {
        "n_tokens": n + 1,
        "n_known": known + (end > 0),
        "base_score": total + end - (n + 1) * np.log10(tokens + distinct + 1),
        "score": score,
        "bits_per_byte": -score / np.log10(2) / sizes,
    }
