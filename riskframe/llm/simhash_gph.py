"""SimHash near-duplicates with the generalised pigeonhole.

The 64 bits are grouped into partitions of correlated bits.  Two fingerprints that differ in
at most ``r`` bits agree up to ``t_i`` bits in at least one partition ``i`` whenever the
``t_i + 1`` sum to ``r + 1``.  Every fingerprint gets its own thresholds (-1: partition not
probed), by dynamic programming on the candidates estimated for it, so frequent values are
avoided.  Values are probed, candidates verified, and links reduced to a spanning forest
inside each task, so a group of copies never becomes pairs of rows.

Cases: null and empty texts have fingerprint 0 and link like others; fewer than four words
are one shingle; repeated rows have equal results; a component of null ids alone has a null
component_id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.lookup import spread_join
from riskframe.llm.common import texts, workers_ready, written, written_by_small_batches
from riskframe.llm.membership import without
from riskframe.operators.components import connected_components

SHINGLE = 4
SEED = 42
RADIUS = 4
BITS = 64
#: Bits in a block of the histograms that candidate counts are estimated from.
BLOCK_BITS = 8
#: Rows of one probed value that are compared with each other at once; fuller values are split first.
FULL = 4096
#: Cost of sending one probe, in comparisons of two fingerprints.
PROBE_COST = 100.0
#: Fingerprints on which the number of partitions is chosen.  It decides speed alone.
PLAN_SAMPLE = 2000
PARTITION_COUNTS = range(2, 9)


def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    """XXH64 hashes of the word shingles in order; fewer words than ``shingle`` are one, no words none."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return np.empty(0, dtype="<u8")
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    hashed = xxhash.xxh64_intdigest
    return np.array([hashed(joined[a:b], SEED) for a, b in spans], dtype="<u8")


def fingerprint(text: str) -> int:
    """Majority bits of the XXH64 hashes of the word shingles, as a signed 64-bit number."""
    hashes = shingle_hashes(text, SHINGLE)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, text_hash), written once.  ``text_hash`` tells rows with the same id apart."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "fp": np.array([fingerprint(t) for t in batch["text"]], dtype=np.int64),
                    "text_hash": batch["text_hash"],
                }
            )

    rows = texts(docs).select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    return written_by_small_batches(workers_ready(rows).mapInPandas(run, "doc_id long, fp long, text_hash long"), "fingerprints")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how often each two bits are set together (64 x 64, over all)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            bits = _bits(batch["fp"].to_numpy())
            total, both = total + len(bits), both + bits.T @ bits
        if total:
            at = np.arange(BITS * BITS)
            yield pd.DataFrame({"at": np.append(at, -1), "n": np.append(both.ravel(), total).astype(np.int64)})

    rows = workers_ready(fps).mapInPandas(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    found = {r["at"]: r["n"] for r in rows}
    both = np.array([found.get(i, 0) for i in range(BITS * BITS)], dtype=float).reshape(BITS, BITS)
    return found.get(-1, 0), both


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)


def correlated_groups(total: int, both: np.ndarray, groups: int) -> list[list[int]]:
    """Bits dealt into ``groups`` of nearly equal size, each grown by the bit that correlates most with it."""
    p = np.diag(both) / max(total, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    strength = np.abs((both / max(total, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(strength, 0)
    free, out = set(range(BITS)), []
    for g in range(groups):
        size = BITS // groups + (g < BITS % groups)
        left = sorted(free)
        group = [left[int(np.argmax(strength[np.ix_(left, left)].max(axis=1)))]]
        free.discard(group[0])
        while len(group) < size:
            left = sorted(free)
            group.append(left[int(np.argmax(strength[np.ix_(left, group)].sum(axis=1)))])
            free.discard(group[-1])
        out.append(group)
    return out


class Plan:
    """Partitions, their block histograms and the threshold allocation."""

    def __init__(self, groups: list[list[int]], radius: int = RADIUS):
        self.groups = groups
        self.radius = radius
        self.masks = [_mask(g) for g in groups]
        self.blocks = [[g[i : i + BLOCK_BITS] for i in range(0, len(g), BLOCK_BITS)] for g in groups]
        self.near: list[list[np.ndarray]] = []
        self.total = 0

    def learn(self, fps: DataFrame, total: int) -> Plan:
        """Count the values of every block over all fingerprints (2**BLOCK_BITS counts a block)."""
        flat = [b for blocks in self.blocks for b in blocks]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            counts = np.zeros((len(flat), 1 << BLOCK_BITS), dtype=np.int64)
            for batch in batches:
                values = batch["fp"].to_numpy().astype(np.uint64)
                for k, block in enumerate(flat):
                    counts[k] += np.bincount(_packed(values, block), minlength=1 << BLOCK_BITS)
            k, v = np.nonzero(counts)
            yield pd.DataFrame({"block": k, "value": v, "n": counts[k, v]})

        rows = (
            workers_ready(fps).mapInPandas(run, "block int, value int, n long")
            .groupBy("block", "value").agg(F.sum("n").alias("n")).collect()
        )
        counts = np.zeros((len(flat), 1 << BLOCK_BITS))
        for r in rows:
            counts[r["block"], r["value"]] = r["n"]
        shares = iter(_shares_by_distance(counts[k] / max(total, 1), len(b), self.radius) for k, b in enumerate(flat))
        self.near = [[next(shares) for _ in blocks] for blocks in self.blocks]
        self.total = total
        return self

    def candidates(self, values: np.ndarray, i: int) -> np.ndarray:
        """Estimated fingerprints within 0..radius bits of each value in partition ``i`` (blocks taken as independent)."""
        found = np.zeros((len(values), self.radius + 1))
        found[:, 0] = 1.0
        for block, near in zip(self.blocks[i], self.near[i]):
            share = near[_packed(values, block)]
            found = np.stack(
                [sum(found[:, a] * share[:, d - a] for a in range(d + 1)) for d in range(self.radius + 1)], axis=1
            )
        return self.total * np.cumsum(found, axis=1)

    def thresholds(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per fingerprint: threshold of each partition (-1: skip), and the estimated cost."""
        need, n = self.radius + 1, len(values)
        best = np.full((n, need + 1), np.inf)
        best[:, 0] = 0.0
        taken = []
        for i, group in enumerate(self.groups):
            probes = np.cumsum([comb(len(group), t) for t in range(self.radius + 1)])
            cost = self.candidates(values, i) + PROBE_COST * probes
            cost = np.concatenate([np.full((n, 1), PROBE_COST), cost], axis=1)  # share t + 1; 0: index row alone
            nxt, arg = np.full_like(best, np.inf), np.zeros((n, need + 1), dtype=np.int64)
            for have in range(need + 1):
                for share in range(min(have, len(group) + 1) + 1):
                    total = best[:, have - share] + cost[:, share]
                    better = total < nxt[:, have]
                    nxt[better, have], arg[better, have] = total[better], share
            best = nxt
            taken.append(arg)
        out, have = np.empty((n, len(self.groups)), dtype=np.int64), np.full(n, need)
        for i in range(len(self.groups) - 1, -1, -1):
            share = taken[i][np.arange(n), have]
            out[:, i], have = share - 1, have - share
        return out, best[:, need]


def _mask(bits: list[int]) -> np.uint64:
    return np.uint64(sum(1 << b for b in bits))


def _packed(values: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(values), dtype=np.int64)
    for k, b in enumerate(bits):
        out |= ((values >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
    return out


def _shares_by_distance(shares: np.ndarray, width: int, radius: int) -> np.ndarray:
    """For each value: the share of values at 0..radius differing bits."""
    near = np.zeros((len(shares), radius + 1))
    near[:, 0] = shares
    at = np.arange(len(shares))
    for b in range(width):
        shifted = near[at ^ (1 << b)]
        near[:, 1:] = near[:, 1:] + shifted[:, :-1]
    return near


def plan_for(fps: DataFrame, radius: int = RADIUS) -> Plan:
    """The number of partitions with the least estimated cost, with its partitions and histograms."""
    total, both = bit_counts(fps)
    sample = fps.orderBy(F.xxhash64("fp")).limit(PLAN_SAMPLE).toPandas()["fp"].to_numpy().astype(np.uint64)
    best, cheapest = None, np.inf
    uniform = np.full(1 << BLOCK_BITS, 0.0)
    for count in PARTITION_COUNTS:
        plan = Plan(correlated_groups(total, both, count), radius)
        plan.total = total
        plan.near = []
        for blocks in plan.blocks:
            row = []
            for block in blocks:
                shares = uniform.copy()
                shares[: 1 << len(block)] = 1.0 / (1 << len(block))
                row.append(_shares_by_distance(shares, len(block), radius))
            plan.near.append(row)
        cost = plan.thresholds(sample)[1].mean() if len(sample) else 0.0
        if cost < cheapest:
            best, cheapest = plan, cost
    return best.learn(fps, total)


def _mixed(key: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash; equal inputs meet, and a chance meeting only adds a candidate."""
    with np.errstate(over="ignore"):
        x = key.astype(np.uint64) + np.uint64(salt + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_ROWS = "key long, fp long, indexed boolean, used long"


def probes(fps: DataFrame, plan: Plan) -> DataFrame:
    """Index rows (one for each partition) and probe rows (values within the threshold) of every fingerprint."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["fp"].to_numpy().astype(np.uint64)
            allotted, _ = plan.thresholds(values)
            for i, (group, mask) in enumerate(zip(plan.groups, plan.masks)):
                own = values & mask
                yield _probe_rows(_mixed(own, i), values, True, mask)
                for distance in range(1, plan.radius + 1):
                    far = allotted[:, i] >= distance
                    if far.any():
                        for flips in combinations(group, distance):
                            yield _probe_rows(_mixed(own[far] ^ _mask(list(flips)), i), values[far], False, mask)

    return workers_ready(fps).mapInPandas(run, _ROWS)


def _probe_rows(key: np.ndarray, fps: np.ndarray, indexed: bool, used) -> pd.DataFrame:
    used = np.broadcast_to(np.asarray(used, dtype=np.uint64), fps.shape)
    return pd.DataFrame(
        {"key": key.view(np.int64), "fp": fps.view(np.int64), "indexed": indexed, "used": np.ascontiguousarray(used).view(np.int64)}
    )


def split_rows(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Refine full values: the bits not used so far are cut into ``radius + 1`` parts, and a pair
    within the radius agrees in at least one of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for used, part in batch.groupby("used"):
                done = int(used) & ((1 << BITS) - 1)
                left = [b for b in range(BITS) if not done >> b & 1]
                fps, keys = part["fp"].to_numpy().astype(np.uint64), part["key"].to_numpy().astype(np.uint64)
                for j in range(radius + 1):
                    mask = _mask(left[j :: radius + 1])
                    key = _mixed(keys ^ _mixed(fps & mask, j), 1000 + j)
                    yield _probe_rows(key, fps, True, mask | np.uint64(done)).assign(indexed=part["indexed"].to_numpy())

    return workers_ready(rows).mapInPandas(run, _ROWS)


def links(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): a spanning forest, task by task, of all verified links among rows with equal keys."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            rows = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            keys = rows["key"].to_numpy()
            whole = int(np.searchsorted(keys, keys[-1]))
            kept = rows.iloc[whole:]
            if whole:
                yield _forest(*_verified(rows.iloc[:whole], radius))
        if kept is not None:
            yield _forest(*_verified(kept, radius))

    dealt = rows.repartition("key").sortWithinPartitions("key", F.desc("indexed"))
    return workers_ready(dealt.select("key", "fp", "indexed")).mapInPandas(run, "a long, b long")


def _verified(rows: pd.DataFrame, radius: int, at_once: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (indexed, any) with equal keys that differ in at most ``radius`` bits."""
    keys, fps = rows["key"].to_numpy(), rows["fp"].to_numpy().astype(np.uint64)
    indexed = rows["indexed"].to_numpy(dtype=bool)
    at = np.arange(len(keys))
    ends = np.searchsorted(keys, keys, side="right")
    partners = np.where(indexed, ends - at - 1, 0)  # rows after this one with the same key
    first = at[partners > 0]
    partners = partners[first]
    found_a, found_b = [], []
    start = 0
    steps = np.cumsum(partners)
    while start < len(first):
        done = steps[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(steps, done + at_once, side="right")))
        n = partners[start:stop]
        left = np.repeat(first[start:stop], n)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
        near = np.bitwise_count(fps[left] ^ fps[right]) <= radius
        found_a.append(fps[left[near]])
        found_b.append(fps[right[near]])
        start = stop
    empty = np.empty(0, dtype=np.uint64)
    return np.concatenate([empty, *found_a]), np.concatenate([empty, *found_b])


def _forest(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """Links from each node to the root of its tree, by smallest labels and pointer jumping."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        ru, rv = root[u], root[v]
        apart = ru != rv
        if not apart.any():
            break
        u, v, ru, rv = u[apart], v[apart], ru[apart], rv[apart]
        np.minimum.at(root, np.maximum(ru, rv), np.minimum(ru, rv))
        while True:
            jumped = root[root]
            if (jumped == root).all():
                break
            root = jumped
    far = root != np.arange(len(nodes))
    values = nodes.view(np.int64)
    return pd.DataFrame({"a": values[far], "b": values[root[far]]})


def all_links(fps: DataFrame, radius: int = RADIUS, full: int = FULL) -> DataFrame:
    """Links that connect exactly the fingerprints connected by differences of at most ``radius`` bits.

    Values with more than ``full`` rows are split on bits not used so far, until none is left
    (with ``b`` bits left, a value holds 2**b fingerprints at most, so this ends).
    """
    rows = probes(fps, plan_for(fps, radius))
    out = []
    while True:
        rows = written(rows, "probes")
        crowded = written(rows.groupBy("key").count().where(F.col("count") > full).select("key"), "full-values")
        if crowded.isEmpty():
            out.append(links(rows, radius))
            break
        out.append(links(rows.join(crowded, "key", "left_anti"), radius))
        rows = split_rows(rows.join(crowded, "key", "left_semi"), radius)
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return written(found.distinct(), "links")


def labelled(rows: DataFrame, radius: int = RADIUS, full: int = FULL) -> DataFrame:
    """fp, root, component_id for every distinct fingerprint of ``rows``: a fingerprint that stands for
    the component, and the smallest doc_id in it."""
    firsts = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    edges = all_links(firsts.select("fp"), radius, full)
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    members = connected_components(nodes, edges).withColumnRenamed("node", "fp").join(firsts, "fp")
    lowest = members.groupBy("component").agg(F.min("first_id").alias("component_id"))
    linked = members.join(lowest, "component").select("fp", "component", "component_id")
    return firsts.join(linked, "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("root"), F.coalesce("component_id", "first_id").alias("component_id")
    )


def near_duplicates(docs: DataFrame, radius: int = RADIUS, full: int = FULL) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    rows = fingerprints(docs)
    labels = written(labelled(rows, radius, full), "components")
    joined = spread_join(rows, labels, ["fp"], "inner", spread_by="doc_id")
    return joined.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest id, all columns as they were."""
    rows = fingerprints(docs)
    labels = written(labelled(rows, radius), "components")
    return first_of_each(docs, spread_join(rows, labels, ["fp"], "inner", spread_by="doc_id"))


def first_of_each(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """``docs`` with the row of the smallest id for each ``root`` of ``placed(doc_id, text_hash, root)``."""
    placed = written(placed.select("doc_id", "text_hash", "root"), "placed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    kept = placed.groupBy("root").agg(first).select(F.xxhash64("first.doc_id", "first.text_hash").alias("row"))
    every = placed.select(F.xxhash64("doc_id", "text_hash").alias("row")).distinct()
    gone = written(every.join(kept, "row", "left_anti"), "dropped")
    row = F.xxhash64("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))))
    return without(docs, row, gone)
