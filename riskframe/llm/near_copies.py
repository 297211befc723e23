"""Near copies among documents: five-word shingles with a Jaccard similarity of 0.8 or more.

MinHash bands propose, exact similarity decides.  Documents with equal shingle sets are one node.
Nodes that share a band are compared by their whole sets inside one task, which sends on a spanning
forest, so a group of near copies never becomes pairs of rows.  Bands with the same nodes are one cell.  A full band is
cut into parts, which are compared each on their own; then the nodes outside its largest component meet all parts, so a
task stays bounded, a large group of near copies is shipped once, and no pair of the band is left out.

A pair at similarity ``s`` shares no band with probability ``(1 - s**ROWS)**BANDS``: 5e-5 at 0.8,
6e-9 at 0.87.

Cases: null and empty texts are equal to each other; fewer than five words are one shingle; A-Z and
a-z are equal; rows with equal id and text stay or go together; an empty table gives an empty result; further columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.lookup import spread_join
from riskframe.llm.common import texts, workers_ready, written, written_by_small_batches
from riskframe.llm.membership import mark_likely
from riskframe.llm.simhash_gph import _forest, _mixed, first_of_each, shingle_hashes
from riskframe.operators.components import connected_components

SHINGLE = 5
#: Similarity from which on two documents are near copies, as a fraction.
SIMILAR = (4, 5)
BANDS, ROWS = 25, 5
#: Members, and shingles in all members, of one part of a band.
FULL, FULL_SHINGLES = 8192, 1 << 22

_RANDOM = np.random.default_rng(42)
_FLIPS = _RANDOM.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32)
_FACTORS = _RANDOM.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32) | np.uint32(1)


def shingle_set(text: str) -> np.ndarray:
    """The distinct shingle hashes, ascending."""
    return np.unique(shingle_hashes(text, SHINGLE))


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(high), 4096):
        least = np.minimum(least, ((high[at : at + 4096] ^ _FLIPS) * _FACTORS).min(axis=1))
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """One key for each band of each row of min-hashes."""
    parts = least.reshape(-1, BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for r in range(ROWS):
        key = _mixed(key ^ parts[:, :, r], r)
    return key.view(np.int64)


def shingled(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, node, size, bands), written once; ``node`` stands for the shingle set."""
    import xxhash

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nodes, sizes, least = [], [], []
            for text in batch["text"]:
                found = shingle_set(text)
                nodes.append(xxhash.xxh64_intdigest(found.tobytes()))
                sizes.append(len(found))
                least.append(min_hashes(found))
            if nodes:
                yield pd.DataFrame(
                    {
                        "doc_id": batch["doc_id"].astype("Int64"),
                        "text_hash": batch["text_hash"],
                        "node": np.array(nodes, dtype=np.uint64).view(np.int64),
                        "size": sizes,
                        "bands": list(bands(np.stack(least))),
                    }
                )

    rows = texts(docs).select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    out = "doc_id long, text_hash long, node long, size long, bands array<long>"
    return written_by_small_batches(workers_ready(rows).mapInPandas(run, out), "shingled")


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the documents that stand for the nodes of ``wanted(row, node)``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"node": batch["node"], "shingles": [shingle_set(t).tobytes() for t in batch["text"]]})

    rows = texts(docs).select(F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("row"), "text")
    likely = mark_likely(rows, F.col("row"), wanted.select("row")).where("_likely").select("row", "text")
    found = likely.dropDuplicates(["row"]).join(wanted, "row").select("node", "text")
    return written_by_small_batches(workers_ready(found).mapInPandas(run, "node long, shingles binary"), "shingle-sets")


def links(rows: DataFrame) -> DataFrame:
    """(a, b): a spanning forest, part by part, of all similar nodes among ``rows(cell, node, shingles)`` of a cell."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            rows = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            last = rows["cell"].iloc[-1] if len(rows) else None
            whole = int(np.searchsorted(rows["cell"].to_numpy(), last)) if len(rows) else 0
            kept = rows.iloc[whole:]
            if whole:
                yield _forests(rows.iloc[:whole])
        if kept is not None and len(kept):
            yield _forests(kept)

    dealt = rows.repartition("cell").sortWithinPartitions("cell").select("cell", "node", "shingles")
    return workers_ready(dealt).mapInPandas(run, "a long, b long")


def _forests(rows: pd.DataFrame) -> pd.DataFrame:
    cells, nodes = rows["cell"].to_numpy(), rows["node"].to_numpy()
    sets = [np.frombuffer(s, dtype=np.uint64) for s in rows["shingles"]]
    edges = np.append(np.flatnonzero(np.diff(cells)) + 1, len(cells))
    a, b, start = [], [], 0
    for end in edges.tolist():
        for i, j in similar(sets[start:end]):
            a.append(nodes[start + i])
            b.append(nodes[start + j])
        start = end
    return _forest(np.array(a, dtype=np.int64).view(np.uint64), np.array(b, dtype=np.int64).view(np.uint64))


def similar(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect exactly the sets connected by similarities of ``SIMILAR`` or more.

    Breadth first: each set that was reached is compared with all that were not.
    """
    top, bottom = SIMILAR
    sizes = np.array([len(s) for s in sets])
    if len(sets) < 2:
        return []
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    own = [at[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist())]
    held = np.zeros(len(values), dtype=np.int64)
    left = np.arange(len(sets))
    out, queue = [], []
    items, owner = at, np.repeat(left, sizes)
    while len(left):
        if not queue:
            queue, left = [int(left[0])], left[1:]
        u = queue.pop()
        near = left[(bottom * np.minimum(sizes[left], sizes[u])) >= top * np.maximum(sizes[left], sizes[u])]
        if not len(near):
            continue
        held[own[u]] = 1
        shared = np.bincount(owner, held[items], minlength=len(sets))[near]
        held[own[u]] = 0
        hit = near[bottom * shared >= top * (sizes[u] + sizes[near] - shared)]
        if len(hit):
            out += [(u, v) for v in hit.tolist()]
            queue += hit.tolist()
            free = np.zeros(len(sets), dtype=bool)
            left = np.setdiff1d(left, hit, assume_unique=True)
            free[left] = True
            still = free[owner]
            items, owner = items[still], owner[still]
    return out


def member_lists(placed: DataFrame, full: int = FULL) -> DataFrame:
    """(key, parts) of the bands of ``placed(key, node, size)`` that two nodes share, each list of nodes once.

    Most pairs share several bands, and nothing is won by comparing the same nodes twice.  Lists are equal if they
    agree in their length and two sums of hashes that do not depend on the order, 96 bits in all.
    """
    parts = F.ceil(F.greatest(F.count("*") / full, F.sum("size") / FULL_SHINGLES, F.lit(1))).cast("int").alias("parts")
    marks = F.bit_xor(F.xxhash64("node")).alias("x"), F.sum(F.hash("node").cast("long")).alias("s")
    shared = placed.groupBy("key").agg(F.count("*").alias("n"), parts, *marks).where("n > 1")
    return shared.groupBy("n", "x", "s").agg(F.min("key").alias("key"), F.first("parts").alias("parts")).select("key", "parts")


def _part(parts: Column) -> Column:
    return F.pmod(F.xxhash64("node"), parts).cast("int")


def _up_to(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), parts - 1))


def cross_cells(members: DataFrame, edges: DataFrame, full: int = FULL) -> DataFrame:
    """(cell, node): where nodes of different parts of a full band still have to meet.

    ``edges`` connect what is similar within the parts.  Nodes of the band's largest component are connected
    already, so only the others, the loose nodes, meet every part.
    """
    ends = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    component = F.coalesce("component", "node").alias("component")
    placed = written(members.join(connected_components(ends, edges), "node", "left").select("key", "parts", "node", "size", component), "placed")
    counts = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    largest = counts.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("largest"))
    loose = written(placed.join(largest, "key").where("component != largest").select("key", "parts", "node", "size"), "loose")
    rows = F.ceil(F.greatest(F.count("*") / full, F.sum("size") / FULL_SHINGLES)).cast("int").alias("rows")
    dealt = written(loose.groupBy("key").agg(rows), "loose-bands")
    one = loose.join(dealt, "key").select("key", "node", _part(F.col("rows")).alias("row"), _up_to(F.col("parts")).alias("part"))
    all_ = placed.join(dealt, "key").select("key", "node", _part(F.col("parts")).alias("part"), _up_to(F.col("rows")).alias("row"))
    return one.unionByName(all_).select(F.xxhash64("key", "row", "part").alias("cell"), "node").distinct()


def labelled(docs: DataFrame, rows: DataFrame, full: int = FULL) -> DataFrame:
    """node, root for every node of ``rows``: a node that stands for the component."""
    row = F.min(F.xxhash64("doc_id", "text_hash")).alias("row")
    nodes = written(rows.groupBy("node").agg(row, F.first("size").alias("size"), F.first("bands").alias("bands")), "nodes")
    placed = nodes.select("node", "size", F.explode("bands").alias("key"))
    lists = written(member_lists(placed, full), "member-lists")
    members = written(placed.join(lists, "key").select("key", "parts", "node", "size"), "members")
    wanted = written(members.select("node").distinct().join(nodes, "node").select("row", "node"), "wanted")
    sets = shingle_sets(docs, wanted)
    cells = members.select(F.xxhash64("key", _part(F.col("parts"))).alias("cell"), "node")
    edges = written_by_small_batches(links(cells.join(sets, "node")).distinct(), "links")
    crowded = members.where("parts > 1")
    if crowded.limit(1).count():
        cells = cross_cells(crowded, edges, full)
        edges = edges.unionByName(written_by_small_batches(links(cells.join(sets, "node")).distinct(), "cross-links"))
    ends = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    return nodes.select("node").join(connected_components(ends, edges), "node", "left").select(
        "node", F.coalesce("component", "node").alias("root")
    )


def keep_one(docs: DataFrame, full: int = FULL) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest id, all columns as they were."""
    rows = shingled(docs)
    labels = written(labelled(docs, rows, full), "components")
    placed = spread_join(rows.select("doc_id", "text_hash", "node"), labels, ["node"], "inner", spread_by="doc_id")
    return first_of_each(docs, placed)
