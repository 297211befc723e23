"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

Each word enters as a word embedding plus the mean embedding of its character n-grams.  Two
gated recurrences read a window of words in both directions, attention pools their states
into one logit.  All overlapping windows of a text are scored; the text has the score of its
worst window.

A bounded sample gives the weights to start from.  Then all windows of all labelled documents
outside the held-out fold are scored, the gradients of those the network is not sure of are summed over the tasks
in several rounds, and the threshold comes from the highest logits of all these documents.

Cases: null and empty texts are one window without words; words of any length count with all
their n-grams; repeated rows have equal scores; ids with several label rows are toxic if any
row says so; an empty table gives an empty result, and without labelled rows of both kinds
every score is 0; other columns are ignored.
"""

from __future__ import annotations

import pickle
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.lookup import lookup_join
from riskframe.functions.quantiles import exact_quantiles
from riskframe.llm.common import fold_of, workers_ready, written

WINDOW = 64
STRIDE = 56
WORD_SLOTS = 1 << 14
GRAM_SLOTS = 1 << 15
DIM = 16
HIDDEN = 8
GRAMS = (3, 4)
#: Epochs over a full sample; fewer windows take more, up to a bound.
EPOCHS, MOST_EPOCHS, FULL_WINDOWS = 4, 8, 8_000
BATCH = 128
THRESHOLD = 0.3
FOLDS, HELD_OUT_FOLD = 4, 2
#: Labelled documents of each kind that give the first weights, and windows of one of them, at most.
TOXIC_SAMPLE = 1200
CLEAN_SAMPLE = 2800
WINDOWS_PER_DOCUMENT = 12
#: Rounds over the windows of all labelled documents at most, the least gain of a further one, their rates, and the error
#: below which a window's gradient counts as nought.
ROUNDS, LEAST_GAIN, ROUND_RATE, ROUND_ROW_RATE = 12, 0.02, 0.005, 0.08
LEAST_ERROR = 0.02
#: Quantiles of the highest logits of clean and of toxic texts; the score between them is the threshold.
CLEAN_SHARE, TOXIC_SHARE = 0.995, 0.02
#: Labelled ids that are broadcast at most; more are joined by a shuffle.
BROADCAST_LABELS = 1 << 18
#: Pieces in which gradients are summed.
SLICES = 32
#: Words whose inputs a Python worker remembers at most.
WORDS_REMEMBERED = 150_000

_EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def words_of(text: str) -> list[str]:
    return text.lower().split()


def _core(word: str) -> bytes:
    return (word.strip(_EDGES) or word).encode()


def word_slots(words: list[str]) -> np.ndarray:
    return np.array([zlib.crc32(_core(w)) % WORD_SLOTS for w in words], dtype=np.int64)


def gram_slots(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the character n-grams of each word with its edges marked, end to end, and where each word's begin."""
    cores = [b"\x02" + _core(w) + b"\x03" for w in words]
    sizes = np.array([len(c) for c in cores], dtype=np.int64)
    data = np.frombuffer(b"".join(cores) + b"\x00" * 3, dtype=np.uint8).astype(np.uint32)
    n = int(sizes.sum())
    word_of = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)  # bytes up to the end of the word
    slots, owners = [], []
    with np.errstate(over="ignore"):
        for width in GRAMS:
            code = np.full(n, width, dtype=np.uint32)
            for k in range(width):
                code = code * np.uint32(0x01000193) ^ data[k : n + k]
                code = code ^ (code >> np.uint32(15))
            whole = left >= width
            slots.append(((code * np.uint32(0x9E3779B1)) >> np.uint32(17))[whole] % GRAM_SLOTS)
            owners.append(word_of[whole])
    slot, owner = np.concatenate(slots), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return slot[order].astype(np.int64), np.searchsorted(owner[order], np.arange(len(words) + 1))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _windows(count: int) -> np.ndarray:
    """First words of the windows that cover ``count`` words; one window at least."""
    return np.arange(0, max(1, count - (WINDOW - STRIDE)), STRIDE)


class Network:
    """Weights and the forward pass; direction 0 reads forwards, 1 backwards."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)

        def weights(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        self.p = {
            "word": weights(WORD_SLOTS, DIM, scale=0.1),
            "gram": weights(GRAM_SLOTS, DIM, scale=0.1),
            "w": weights(2, DIM, 3 * HIDDEN, scale=0.4),
            "u": weights(2, HIDDEN, 3 * HIDDEN, scale=0.3),
            "b": np.zeros((2, 3 * HIDDEN), dtype=np.float32),
            "a": weights(2 * HIDDEN, 2 * HIDDEN, scale=0.3),
            "v": weights(2 * HIDDEN, scale=0.3),
            "o": weights(2 * HIDDEN, scale=0.3),
            "c": np.zeros(1, dtype=np.float32),
        }

    def inputs(self, words: list[str]) -> np.ndarray:
        """Gate inputs of words, (direction, word, gates): all that does not depend on the neighbours."""
        slot, begins = gram_slots(words)
        return self._inputs(word_slots(words), slot, begins)[0]

    def _inputs(self, word: np.ndarray, slot: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.diff(begins)
        sums = np.zeros((len(word), DIM), dtype=np.float32)
        full = sizes > 0
        if full.any():
            sums[full] = np.add.reduceat(self.p["gram"][slot], begins[:-1][full], axis=0)
        x = self.p["word"][word] + sums / np.maximum(sizes, 1)[:, None]
        return x @ self.p["w"] + self.p["b"][:, None, :], x

    def run(self, gates: np.ndarray, at: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Logits of windows.  ``at``: (window, position) rows of ``gates``; ``mask``: 1 where there is a word."""
        n, length = at.shape
        states = np.empty((2, length, n, HIDDEN), dtype=np.float32)
        steps = at.T
        filled = mask.all(axis=0)
        for d in range(2):
            h = np.zeros((n, HIDDEN), dtype=np.float32)
            u = self.p["u"][d]
            for t in range(length) if d == 0 else range(length - 1, -1, -1):
                x = gates[d].take(steps[t], axis=0)
                uh = h @ u
                zr = _sigmoid(x[:, : 2 * HIDDEN] + uh[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                new = np.tanh(x[:, 2 * HIDDEN :] + r * uh[:, 2 * HIDDEN :])
                if keep is not None:
                    keep.append((d, t, h, z, r, new, uh[:, 2 * HIDDEN :], mask[:, t : t + 1]))
                h = new + z * (h - new) if filled[t] else h + mask[:, t : t + 1] * (1 - z) * (new - h)
                states[d, t] = h
        both = np.concatenate([states[0], states[1]], axis=2).transpose(1, 0, 2)
        hidden = np.tanh(both @ self.p["a"])
        energy = hidden @ self.p["v"] - 1e4 * (1 - mask)
        energy = np.exp(energy - energy.max(axis=1, keepdims=True))
        share = energy / energy.sum(axis=1, keepdims=True)
        pooled = np.einsum("nt,nth->nh", share, both)
        if keep is not None:
            keep.append((both, hidden, share, pooled))
        return pooled @ self.p["o"] + self.p["c"]

    def gradients(self, word, slot, begins, at, mask, label, weight) -> tuple[dict, np.ndarray]:
        """Gradients of the weighted logistic loss, by hand."""
        p = self.p
        gates, x = self._inputs(word, slot, begins)
        keep: list = []
        logit = self.run(gates, at, mask, keep)
        both, hidden, share, pooled = keep.pop()
        d_logit = ((_sigmoid(logit) - label) * weight / len(label)).astype(np.float32)
        g = {"o": pooled.T @ d_logit, "c": np.array([d_logit.sum()])}
        d_pooled = d_logit[:, None] * p["o"]
        d_share = np.einsum("nh,nth->nt", d_pooled, both)
        d_energy = share * (d_share - (share * d_share).sum(axis=1, keepdims=True))
        g["v"] = np.einsum("nt,nth->h", d_energy, hidden)
        d_hidden = d_energy[:, :, None] * p["v"] * (1 - hidden**2)
        g["a"] = np.einsum("nth,ntk->hk", both, d_hidden)
        d_both = share[:, :, None] * d_pooled[:, None, :] + d_hidden @ p["a"].T
        d_gates = np.zeros_like(gates)
        g["u"] = np.zeros_like(p["u"])
        d_h = [np.zeros((len(label), HIDDEN), dtype=np.float32) for _ in range(2)]
        for d, t, h, z, r, new, uh, m in reversed(keep):
            out = d_h[d] + d_both[:, t, d * HIDDEN : (d + 1) * HIDDEN]
            d_new = out * m * (1 - z) * (1 - new**2)
            d_z = out * m * (h - new) * z * (1 - z)
            d_r = d_new * uh * r * (1 - r)
            d_x = np.concatenate([d_z, d_r, d_new], axis=1)
            d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
            g["u"][d] += h.T @ d_u
            d_h[d] = out * (1 - m * (1 - z)) + d_u @ p["u"][d].T
            np.add.at(d_gates[d], at[:, t], d_x)
        g["b"] = d_gates.sum(axis=1)
        g["w"] = x.T @ d_gates
        d_x = (d_gates @ p["w"].transpose(0, 2, 1)).sum(axis=0)
        sizes = np.diff(begins)
        g["word"] = (word, d_x)
        g["gram"] = (slot, np.repeat(d_x / np.maximum(sizes, 1)[:, None], sizes, axis=0))
        return g, logit


class _Trainer:
    """Adam for dense weights, Adagrad for the rows of the embedding tables."""

    def __init__(self, network: Network, rate: float = 0.01, row_rate: float = 0.08):
        self.network, self.p, self.rate, self.row_rate, self.step = network, network.p, rate, row_rate, 0
        self.m = {k: np.zeros_like(v) for k, v in network.p.items() if k not in ("word", "gram")}
        self.s = {k: np.zeros_like(v) for k, v in network.p.items()}

    def apply(self, gradients: dict) -> None:
        self.step += 1
        for k, g in gradients.items():
            if isinstance(g, tuple):
                rows, back = np.unique(g[0], return_inverse=True)
                total = np.zeros((len(rows), DIM), dtype=np.float32)
                np.add.at(total, back, g[1])
                self.s[k][rows] += total**2
                self.p[k][rows] -= self.row_rate * total / (np.sqrt(self.s[k][rows]) + 1e-6)
            else:
                self.m[k] += 0.1 * (g - self.m[k])
                self.s[k] += 0.001 * (g * g - self.s[k])
                m, s = self.m[k] / (1 - 0.9**self.step), self.s[k] / (1 - 0.999**self.step)
                self.p[k] -= (self.rate * m / (np.sqrt(s) + 1e-8)).astype(np.float32)


def _slots(words: list[str], at_once: int = 1 << 14) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word slots, n-gram slots end to end, and where each word's begin; in parts, as the way there takes more room."""
    slots, sizes = [], [np.zeros(1, dtype=np.int64)]
    for i in range(0, len(words), at_once):
        slot, begins = gram_slots(words[i : i + at_once])
        slots.append(slot.astype(np.int32))
        sizes.append(np.diff(begins))
    return word_slots(words), np.concatenate(slots), np.cumsum(np.concatenate(sizes))


def _all_inputs(network: Network, word: np.ndarray, slot: np.ndarray, begins: np.ndarray, at_once: int = 1 << 14) -> np.ndarray:
    out = np.empty((2, len(word), 3 * HIDDEN), dtype=np.float32)
    for a in range(0, len(word), at_once):
        b = min(a + at_once, len(word))
        out[:, a:b] = network._inputs(word[a:b], slot[begins[a] : begins[b]], begins[a : b + 1] - begins[a])[0]
    return out


def _cut(highest: np.ndarray, toxic: np.ndarray) -> float:
    """Logit between the worst windows of nearly all clean and of nearly all toxic texts; the score there is the threshold."""
    return float((np.quantile(highest[toxic == 0], CLEAN_SHARE) + np.quantile(highest[toxic == 1], TOXIC_SHARE)) / 2)


def training_windows(text: str, seed: int = 7, most: int = WINDOWS_PER_DOCUMENT) -> list[str]:
    """The windows of a text that the network learns from: all, or ``most`` of them drawn by a seed of the text's own."""
    words = words_of(text)
    starts = _windows(len(words))
    if len(starts) > most:
        rng = np.random.default_rng([seed, zlib.crc32(text.encode())])
        starts = np.sort(rng.choice(starts, most, replace=False))
    return [" ".join(words[s : s + WINDOW]) for s in starts.tolist()]


def fit(texts: list[str], toxic: list[int], epochs: int | None = None, seed: int = 7) -> Network:
    """A network fitted to whole texts."""
    return fit_windows([training_windows(t, seed) for t in texts], toxic, epochs, seed)


def fit_windows(windows: list[list[str]], toxic: list[int], epochs: int | None = None, seed: int = 7) -> Network:
    """A network fitted to the labels of texts, each given by some of its windows, and its threshold."""
    trainer, highest = start(windows, toxic, epochs, seed)
    trainer.p["c"] -= np.float32(_cut(highest, np.array(toxic)) - np.log(THRESHOLD / (1 - THRESHOLD)))
    return trainer.network


def start(windows: Iterable[list[str]], toxic: list[int], epochs: int | None = None, seed: int = 7) -> tuple[_Trainer, np.ndarray]:
    """A trainer with the network fitted to the labels of texts, each given by some of its windows, and the texts' highest logits.

    Which windows of a toxic text are toxic is not known.  The first epoch takes those of texts of
    two windows at most; later ones take the windows that score as toxic, and the highest of
    each text.  A clean text is clean in all of its windows.  Few windows take more epochs.
    """
    rng = np.random.default_rng(seed)
    network = Network(seed)
    index: dict[str, int] = {"": 0}
    ids, sizes, owners = array("i"), array("i"), array("i")
    for k, own in enumerate(windows):
        for window in own:
            row = [index.setdefault(w, len(index)) for w in window.split()] or [0]
            ids.extend(row)
            sizes.append(len(row))
            owners.append(k)
    owner, size = np.array(owners), np.array(sizes)
    if epochs is None:
        epochs = int(np.clip(round(EPOCHS * FULL_WINDOWS / max(len(size), 1)), EPOCHS, MOST_EPOCHS))
    word, slot, begins = _slots(list(index))
    del index
    label = np.array(toxic, dtype=np.float32)[owner]
    at = np.zeros((len(size), WINDOW), dtype=np.int32)
    at[np.arange(WINDOW) < size[:, None]] = ids
    del ids

    def filled(part) -> np.ndarray:
        return (np.arange(WINDOW) < size[part][:, None]).astype(np.float32)

    chosen = (label == 0) | (np.bincount(owner)[owner] <= 2)
    trainer = _Trainer(network)
    logits = np.zeros(len(at), dtype=np.float32)
    for _ in range(epochs):
        order = rng.permutation(np.nonzero(chosen)[0])
        balance = np.where(label[order] > 0, 0.5 / max(label[order].mean(), 1e-6), 0.5 / max(1 - label[order].mean(), 1e-6))
        for begin in range(0, len(order), BATCH):
            part = order[begin : begin + BATCH]
            used, local = np.unique(at[part], return_inverse=True)
            sizes = begins[used + 1] - begins[used]
            spans = np.repeat(begins[used] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
            edge = np.concatenate([[0], np.cumsum(sizes)])
            g, logits[part] = network.gradients(
                word[used], slot[spans], edge, local.reshape(len(part), -1), filled(part), label[part],
                np.sqrt(balance[begin : begin + BATCH]).astype(np.float32),
            )
            trainer.apply(g)
        gates = _all_inputs(network, word, slot, begins)
        for first in range(0, len(at), 1024):
            part = slice(first, first + 1024)
            logits[part] = network.run(gates, at[part], filled(part))
        del gates
        highest = np.full(len(toxic), -np.inf)
        np.maximum.at(highest, owner, logits)
        chosen = (label == 0) | (logits > 0) | (logits >= highest[owner])
    return trainer, highest


class Scorer:
    """Scores texts; remembers the gate inputs of words, up to a bound."""

    def __init__(self, network: Network, remembered: int = WORDS_REMEMBERED, at_once: int = 4096):
        self.network, self.remembered, self.at_once = network, remembered, at_once
        self._clear()

    def _clear(self) -> None:
        self._index: dict[str, int] = {"": 0}
        self._gates = self.network.inputs([""])

    def scores(self, texts: list[str]) -> np.ndarray:
        return _sigmoid(self.logits(texts))

    def logits(self, texts: list[str]) -> np.ndarray:
        """The logit of the worst window of each text."""
        out = np.full(len(texts), -np.inf)
        for group, owner, _, logit in self.windows(texts):
            np.maximum.at(out, np.array([k for k, _ in group])[owner], logit)
        return out

    def windows(self, texts: list[str]) -> Iterator[tuple[list[tuple[int, list[str]]], np.ndarray, np.ndarray, np.ndarray]]:
        """Of groups of texts, (number, words) of each, and of all their windows the place in the group, the first word and the logit."""
        group: list[tuple[int, list[str]]] = []
        count = 0
        for k, text in enumerate(texts):
            words = words_of(text)
            group.append((k, words))
            count += len(words)
            if count >= 1 << 18:
                yield group, *self._windows(group)
                group, count = [], 0
        if group:
            yield group, *self._windows(group)

    def _windows(self, group: list[tuple[int, list[str]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self._index) > self.remembered:
            self._clear()
        index, known = self._index, len(self._index)
        ids = [np.array([index.setdefault(w, len(index)) for w in words] or [0], dtype=np.int64) for _, words in group]
        if len(index) > known:
            fresh = list(index)[known:]
            made = [self.network.inputs(fresh[i : i + 8192]) for i in range(0, len(fresh), 8192)]
            self._gates = np.concatenate([self._gates, *made], axis=1)
        starts = [_windows(len(row)) for row in ids]
        owner = np.repeat(np.arange(len(group)), [len(s) for s in starts])
        base = np.cumsum([0, *(len(row) for row in ids[:-1])])
        starts = np.concatenate(starts)
        first = starts + base[owner]
        size = np.minimum(np.array([len(row) for row in ids])[owner] - starts, WINDOW)
        flat = np.concatenate([*ids, np.zeros(WINDOW, dtype=np.int64)])
        order = np.argsort(size, kind="stable")
        logit = np.empty(len(order))
        for begin in range(0, len(order), self.at_once):
            part = order[begin : begin + self.at_once]
            length = int(size[part].max())
            at = flat[first[part][:, None] + np.arange(length)]
            mask = (np.arange(length) < size[part][:, None]).astype(np.float32)
            logit[part] = self.network.run(self._gates, at, mask)
        return owner, starts, logit


def unsure_windows(scorer: Scorer, texts: list[str], toxic: np.ndarray) -> tuple[list[str], list[int]]:
    """Windows of whole texts that the network is not sure of, and their labels.

    A clean text is clean in all of its windows; of a toxic one those that score as toxic and the highest are.
    """
    windows, labels = [], []
    for group, owner, first, logit in scorer.windows(texts):
        highest = np.full(len(group), -np.inf)
        np.maximum.at(highest, owner, logit)
        label = toxic[[k for k, _ in group]][owner]
        counts = (label == 0) | (logit > 0) | (logit >= highest[owner])
        for i in np.flatnonzero(counts & (np.abs(_sigmoid(logit) - label) > LEAST_ERROR)).tolist():
            windows.append(" ".join(group[owner[i]][1][first[i] : first[i] + WINDOW]))
            labels.append(int(label[i]))
    return windows, labels


class GradientSum:
    """Sum over windows of the gradients of the weighted loss, and of the loss."""

    def __init__(self, network: Network, weights: tuple[float, float]):
        self.network, self.weights, self.loss = network, np.array(weights, dtype=np.float32), 0.0
        self.g = {k: np.zeros(v.shape) for k, v in network.p.items()}

    def add(self, windows: list[str], toxic: np.ndarray, at_once: int = 512) -> None:
        for i in range(0, len(windows), at_once):
            self._add([w.split() for w in windows[i : i + at_once]], toxic[i : i + at_once].astype(np.float32))

    def _add(self, rows: list[list[str]], label: np.ndarray) -> None:
        index: dict[str, int] = {"": 0}
        at = np.zeros((len(rows), WINDOW), dtype=np.int32)
        mask = np.zeros((len(rows), WINDOW), dtype=np.float32)
        for k, row in enumerate(rows):
            at[k, : len(row)] = [index.setdefault(w, len(index)) for w in row]
            mask[k, : max(len(row), 1)] = 1
        weight = self.weights[label.astype(int)]
        found, logit = self.network.gradients(*_slots(list(index)), at, mask, label, weight * len(rows))
        self.loss += float((weight * (np.logaddexp(0, logit) - label * logit)).sum())
        for k, g in found.items():
            if isinstance(g, tuple):
                np.add.at(self.g[k], g[0], g[1])
            else:
                self.g[k] += g

    def pieces(self) -> Iterator[tuple[int, bytes]]:
        whole = np.concatenate([[self.loss], *(self.g[k].ravel() for k in sorted(self.g))])
        for k, piece in enumerate(np.array_split(whole, SLICES)):
            yield k, piece.tobytes()


def gradients_of(network: Network, pieces: dict[int, bytes]) -> tuple[dict, float]:
    """What ``Trainer.apply`` takes, and the loss, from all summed pieces."""
    whole = np.concatenate([np.frombuffer(pieces[k]) for k in range(SLICES)])
    found, at = {}, 1
    for k in sorted(network.p):
        shape, size = network.p[k].shape, network.p[k].size
        g = whole[at : at + size].reshape(shape)
        at += size
        if k in ("word", "gram"):
            rows = np.flatnonzero(g.any(axis=1))
            found[k] = (rows, g[rows].astype(np.float32))
        else:
            found[k] = g
    return found, float(whole[0])


def known_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the labelled documents outside the held-out fold, a row an id."""
    learn = fold_of(F.col("doc_id"), FOLDS) != HELD_OUT_FOLD
    return labels.where(F.col("toxic").isNotNull() & learn).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def learning_rows(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(text, toxic) of every row of ``docs`` that has a known label."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return lookup_join(rows, known, ["doc_id"], "inner", spread_by="text", max_rows=BROADCAST_LABELS).select("text", "toxic")


def training_rows(docs: DataFrame, known: DataFrame, toxic_sample: int = TOXIC_SAMPLE, clean_sample: int = CLEAN_SAMPLE) -> DataFrame:
    """(doc_id, text, toxic) of a bounded sample of the documents with known labels, the same on every run.

    The ids of the sample (``toxic_sample + clean_sample`` at most) are broadcast.
    """
    first = F.xxhash64("doc_id")
    chosen = known.where("toxic = 1").orderBy(first).limit(toxic_sample).unionByName(
        known.where("toxic = 0").orderBy(first).limit(clean_sample)
    )
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = rows.join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))


def started(docs: DataFrame, known: DataFrame, **bounds: int) -> _Trainer | None:
    """A trainer fitted to the bounded sample.  Windows are chosen where the texts are, so the driver gets a bounded number of words."""

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            windows = ["\n".join(training_windows(t)) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"].astype("int32"), "windows": windows})

    rows = workers_ready(training_rows(docs, known, **bounds))
    id_type = dict(rows.dtypes)["doc_id"]
    found = rows.mapInPandas(choose, f"doc_id {id_type}, toxic int, windows string").collect()
    found.sort(key=lambda r: r["doc_id"], reverse=True)
    toxic = [r["toxic"] for r in reversed(found)]
    # each row is dropped as soon as its words are numbered
    return start((found.pop()["windows"].split("\n") for _ in toxic), toxic)[0] if 0 < sum(toxic) < len(toxic) else None


def unsure(rows: DataFrame, network: Network) -> DataFrame:
    """(window, toxic) of all windows of ``rows(text, toxic)`` that the network is not sure of."""
    shared = rows.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for batch in batches:
            windows, toxic = unsure_windows(scorer, batch["text"].tolist(), batch["toxic"].to_numpy())
            # stated types: pandas takes a column without values, as in a batch it is sure of, for numbers
            yield pd.DataFrame({"window": np.array(windows, dtype=object), "toxic": np.array(toxic, dtype=np.int32)})

    return workers_ready(rows).mapInPandas(run, "window string, toxic int")


def summed_gradients(windows: DataFrame, network: Network, weights: tuple[float, float]) -> tuple[dict, float]:
    """Gradients and loss summed over all of ``windows(window, toxic)``, piece by piece in the tasks."""
    shared = windows.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = GradientSum(shared.value, weights)
        for batch in batches:
            total.add(batch["window"].tolist(), batch["toxic"].to_numpy())
        yield pd.DataFrame(list(total.pieces()), columns=["k", "piece"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b) for b in group["piece"])
        return pd.DataFrame({"k": group["k"].iloc[:1], "piece": [total.tobytes()]})

    pieces = workers_ready(windows).mapInPandas(run, "k int, piece binary").groupBy("k").applyInPandas(add, "k int, piece binary")
    found = gradients_of(network, {r["k"]: r["piece"] for r in pieces.collect()})  # the size of the network
    shared.destroy()
    return found


def trained(docs: DataFrame, known: DataFrame, rounds: int = ROUNDS, **bounds: int) -> Network | None:
    """The network after ``rounds`` over all documents with known labels; the one with the least loss on what the first was not sure of."""
    trainer = started(docs, known, **bounds)
    if trainer is None:
        return None
    windows = written(unsure(learning_rows(docs, known), trainer.network), "unsure-windows")
    sizes = {r["toxic"]: r["count"] for r in windows.groupBy("toxic").count().collect()}
    if not sizes:
        return trainer.network
    n = sum(sizes.values())
    weights = tuple((0.5 * n / sizes[k]) ** 0.5 / n if k in sizes else 0.0 for k in (0, 1))
    trainer.rate, trainer.row_rate = ROUND_RATE, ROUND_ROW_RATE
    best, least, held = b"", np.inf, {}
    for _ in range(rounds):
        gradients, loss = summed_gradients(windows, trainer.network, weights)
        if loss < least:
            gain = 1 - loss / least
            best, least, held = pickle.dumps(trainer), loss, gradients
            if gain < LEAST_GAIN:
                break
        else:  # back, and on with smaller steps
            rate, row_rate = trainer.rate / 2, trainer.row_rate / 2
            trainer = pickle.loads(best)
            trainer.rate, trainer.row_rate = rate, row_rate
            best = pickle.dumps(trainer)
        trainer.apply(held)
    return pickle.loads(best).network


@dataclass
class Judge:
    """The network and the logit at which a text counts as toxic."""

    network: Network | None
    known: DataFrame

    def logit(self, spark) -> Column:
        """Highest logit of the column ``text`` (null: empty)."""
        if self.network is None:
            return F.lit(None).cast("double")
        shared = spark.sparkContext.broadcast(self.network)

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            scorer = Scorer(shared.value)
            for texts in batches:
                yield pd.Series(scorer.logits(texts.tolist()))

        run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return F.pandas_udf(run, "double")(F.coalesce(F.col("text"), F.lit("")))

    def score(self, judged: DataFrame) -> Column:
        """Score of the column ``_logit`` of ``judged``; the threshold is that of all its rows with known labels."""
        if self.network is None:
            return F.lit(0.0)
        rows = lookup_join(judged.select("doc_id", "_logit"), self.known, ["doc_id"], "inner", spread_by="_logit", max_rows=BROADCAST_LABELS)
        highest = written(rows.select("toxic", "_logit"), "known-logits")
        ends = [
            exact_quantiles(highest.where(F.col("toxic") == kind), ["_logit"], [share])["_logit"][0]
            for kind, share in ((0, CLEAN_SHARE), (1, TOXIC_SHARE))
        ]
        cut = sum(ends) / 2 - float(np.log(THRESHOLD / (1 - THRESHOLD))) if None not in ends else 0.0
        return 1 / (1 + F.exp(F.lit(cut) - F.col("_logit")))


def judge(docs: DataFrame, labels: DataFrame, **bounds: int) -> Judge:
    known = written(known_labels(labels), "known-labels")
    return Judge(trained(docs, known, **bounds), known)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    by = judge(docs, labels)
    judged = written(workers_ready(docs).select("doc_id", by.logit(docs.sparkSession).alias("_logit")), "toxicity")
    scored = judged.select("doc_id", by.score(judged).alias("score"))
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that score at or above the threshold, all columns as they were."""
    by = judge(docs, labels)
    judged = written(workers_ready(docs).withColumn("_logit", by.logit(docs.sparkSession)), "toxicity")
    return judged.where(by.score(judged) < THRESHOLD).drop("_logit")
