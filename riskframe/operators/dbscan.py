"""Exact DBSCAN on a grid.

Equal vectors are counted once.  Cells are small enough that all points of a cell
are neighbours of each other, so pairs inside a cell are never formed, however many
rows share it.  Neighbouring cells are compared by the bounding boxes of their
points; where the boxes cannot decide, a cell with many points is cut into a tree of smaller
boxes, and the same test runs down the tree.  Single points are compared only between
leaves, which hold a bounded number of points, so the point lists of two full cells never meet.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.functions.lookup import lookup_join, spread_join
from riskframe.functions.running import running_totals
from riskframe.operators.clustering import NOISE, squared_distance
from riskframe.operators.components import connected_components
from riskframe.schema import ID
from riskframe.session import checkpointed

COARSE_DIMENSIONS = 3
#: Points of a leaf of the box trees, at most.
LEAF_POINTS = 64


def dbscan(vecs: DataFrame, eps: float = 0.5, min_points: int = 5, leaf_points: int | None = None) -> DataFrame:
    """``vecs(id, x, ...)`` -> the same rows with ``cluster`` (noise is -1) and ``core`` (1 for core points).

    A point counts itself.  Clusters are numbered by their smallest core id; a border
    point goes to the lowest-numbered cluster among its core neighbours.
    """
    width = len(vecs.select("x").first()["x"]) if vecs.limit(1).count() else 1
    side = eps / math.sqrt(width) * (1 - 1e-9)
    limit = F.lit(eps * eps)

    distinct = vecs.groupBy("x").agg(F.count(F.lit(1)).alias("w"), F.min(ID).alias("p"))
    distinct = checkpointed(distinct.withColumn("cell", F.transform("x", lambda v: F.floor(v / side))))
    cells = checkpointed(_cells(distinct, width))
    points = checkpointed(
        lookup_join(distinct, cells.select("cell", "c"), ["cell"], "inner", spread_by="p").select("p", "x", "w", "c")
    )
    tree = _box_tree(points, cells, width, leaf_points or LEAF_POINTS)
    pairs = checkpointed(_neighbour_cells(cells, width, limit))

    # cells whose certain neighbours already make every point of them a core point
    certain = pairs.where("sure").groupBy("a").agg(F.sum("weight_b").alias("near_weight"))
    counted = lookup_join(cells.select(F.col("c").alias("a"), "weight"), certain, ["a"], "left")
    counted = counted.withColumn("known", F.col("weight") + F.coalesce("near_weight", F.lit(0)))
    counted = checkpointed(counted.select("a", "known", (F.col("known") >= min_points).alias("core_cell")))
    core_cells = counted.where("core_cell").select(F.col("a").alias("c"))
    open_cells = counted.where(~F.col("core_cell")).select(F.col("a").alias("c"), "known")  # < min_points points each

    # points of open cells against the points of undecided neighbour cells
    open_points = lookup_join(points, open_cells, ["c"], "inner", spread_by="p").select(
        F.col("c").alias("a"), F.col("p").alias("p_open"), F.col("x").alias("x_open"), "known"
    )
    open_points = checkpointed(open_points)
    maybe = pairs.where(~F.col("sure")).select("a", "b")
    asked = spread_join(open_points, maybe, ["a"], "inner", spread_by="p_open").select("a", F.col("b").alias("c"), "p_open", "x_open")
    asked = lookup_join(asked, open_cells.select("c", F.lit(True).alias("c_open")), ["c"], "left")
    near = checkpointed(
        _met(asked.withColumn("c_open", F.coalesce("c_open", F.lit(False))), tree, limit).groupBy("a", "p_open", "c").agg(
            F.sum("w").alias("w"),
            F.collect_set(F.when(F.col("c_open"), F.col("p"))).alias("open_hits"),  # an open cell has few points
            F.first("c_open").alias("c_open"),
        )
    )
    found = near.groupBy("p_open").agg(F.sum("w").alias("found"))
    judged = open_points.select("a", "p_open", "known").join(found, "p_open", "left")
    judged = checkpointed(
        judged.select(
            "a", "p_open", (F.col("known") + F.coalesce("found", F.lit(0)) >= min_points).alias("core")
        )
    )
    open_core = judged.where("core").select("a", F.col("p_open").alias("p"))

    nodes = checkpointed(
        core_cells.select(F.col("c").alias("node"), F.col("c").alias("first_core")).unionByName(
            open_core.groupBy(F.col("a").alias("node")).agg(F.min("p").alias("first_core"))
        )
    )
    hits = near.where("c_open").select("a", "p_open", F.col("c").alias("b"), F.explode("open_hits").alias("p"))
    core_hits = hits.join(open_core.select("p"), "p", "left_semi").select("a", "p_open", "b")
    links = checkpointed(near.where(~F.col("c_open")).select("a", "p_open", F.col("c").alias("b")).unionByName(core_hits))

    sure_edges = _between(pairs.where("sure").where(F.col("a") < F.col("b")).select("a", "b"), nodes)
    open_edges = links.join(open_core.select(F.col("p").alias("p_open")), "p_open", "left_semi").select("a", "b")
    first = checkpointed(connected_components(nodes, sure_edges.unionByName(open_edges)))

    # undecided pairs of two core cells matter only across different components
    component = first.select(F.col("node"), "component")
    undecided = maybe.where(F.col("a") < F.col("b"))
    undecided = _between(undecided, core_cells.withColumnRenamed("c", "node"))
    undecided = lookup_join(undecided, component.toDF("a", "comp_a"), ["a"], "inner")
    undecided = lookup_join(undecided, component.toDF("b", "comp_b"), ["b"], "inner")
    undecided = undecided.where(F.col("comp_a") != F.col("comp_b")).select("a", "b", "comp_a", "comp_b")
    touching = _touching(checkpointed(undecided), tree, limit)
    second = connected_components(
        component.select(F.col("component").alias("node")), touching.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b"))
    )
    merged = lookup_join(first, second.toDF("component", "final"), ["component"], "inner", spread_by="node")
    merged = lookup_join(merged, nodes, ["node"], "inner").select("node", "final", "first_core")
    order = merged.groupBy("final").agg(F.min("first_core").alias("start"), F.lit(1).cast("long").alias("one"))
    numbered = running_totals(order, "start", ["one"]).select("final", F.col("before_one").cast("int").alias("number"))
    cell_number = checkpointed(lookup_join(merged, numbered, ["final"], "inner", spread_by="node").select("node", "number"))

    # border points: lowest cluster among the own cell, certain cells and single neighbours
    border = judged.where(~F.col("core")).select("a", "p_open")
    sure_side = pairs.where("sure").select("a", "b")
    reach = (
        border.select("p_open", F.col("a").alias("node"))
        .unionByName(border.join(sure_side, "a").select("p_open", F.col("b").alias("node")))
        .unionByName(links.join(border.select("p_open"), "p_open", "left_semi").select("p_open", F.col("b").alias("node")))
    )
    border_number = lookup_join(reach, cell_number, ["node"], "inner", spread_by="p_open").groupBy("p_open").agg(
        F.min("number").alias("number")
    )
    open_core_number = lookup_join(open_core.withColumnRenamed("a", "node"), cell_number, ["node"], "inner", spread_by="p")
    single = border_number.select(F.col("p_open").alias("p"), "number").unionByName(open_core_number.select("p", "number"))

    full = lookup_join(core_cells, cell_number.withColumnRenamed("node", "c"), ["c"], "inner")
    by_cell = lookup_join(points, full, ["c"], "left", spread_by="p")
    by_point = by_cell.join(single.withColumnRenamed("number", "single"), "p", "left")
    by_point = by_point.join(open_core.select("p", F.lit(1).alias("own_core")), "p", "left")
    core = F.when(F.col("number").isNotNull(), 1).otherwise(F.coalesce("own_core", F.lit(0)))
    labelled = by_point.select("x", F.coalesce("number", "single", F.lit(NOISE)).alias("cluster"), core.alias("core"))
    return lookup_join(vecs, checkpointed(labelled), ["x"], "left", spread_by=ID)


def _boxed(points: DataFrame, by: list[str], width: int) -> DataFrame:
    """Weight, number of points and bounding box of each group of points."""
    x = F.col("x")
    boxed = points.groupBy(*by).agg(
        F.min("p").alias("c"),
        F.sum("w").alias("weight"),
        F.count(F.lit(1)).alias("n"),
        *[F.min(x[i]).alias(f"lo{i}") for i in range(width)],
        *[F.max(x[i]).alias(f"hi{i}") for i in range(width)],
    )
    lo, hi = (F.array(*[f"{side}{i}" for i in range(width)]).alias(side) for side in ("lo", "hi"))
    return boxed.select(*by, "c", "weight", "n", lo, hi)


def _cells(points: DataFrame, width: int) -> DataFrame:
    """Cell id (its smallest point), weight, number of points and their bounding box."""
    return _boxed(points, ["cell"], width)


@dataclass
class BoxTree:
    """Boxes inside the cells.  ``nodes(node, parent, lo, hi, weight, n)``: the box of a cell has the cell's hash as node.

    ``points(p, x, w, leaf)``: every point with the leaf that holds it.
    """

    nodes: DataFrame
    points: DataFrame
    leaf_points: int
    split: bool  # whether any cell has more points than a leaf


def _root(cell: str) -> Column:
    return F.xxhash64(cell)


def _box_tree(points: DataFrame, cells: DataFrame, width: int, leaf_points: int) -> BoxTree:
    """Cut every box with more than ``leaf_points`` points in half along its widest side, until none is left."""
    level = cells.select(_root("c").alias("node"), F.lit(None).cast("long").alias("parent"), "lo", "hi", "weight", "n")
    nodes, held = level, points.select("p", "x", "w", _root("c").alias("leaf"))
    split = False
    while True:
        spans = F.zip_with("hi", "lo", lambda h, l: h - l)
        dim = F.array_position(spans, F.array_max(spans)).cast("int")
        full = level.where(F.col("n") > leaf_points).select(F.col("node").alias("leaf"), dim.alias("dim"), "lo", "hi")
        full = full.select("leaf", "dim", (F.element_at("lo", F.col("dim")) / 2 + F.element_at("hi", F.col("dim")) / 2).alias("middle"), F.element_at("hi", F.col("dim")).alias("top"))
        full = checkpointed(full)
        if full.isEmpty():
            return BoxTree(checkpointed(nodes) if split else nodes, held, leaf_points, split)
        split = True
        value = F.element_at("x", F.col("dim"))
        upper = (value > F.col("middle")) | ((F.col("middle") >= F.col("top")) & (value >= F.col("top")))
        moved = lookup_join(held, full, ["leaf"], "left", spread_by="p")
        cut = F.col("dim").isNotNull()
        moved = checkpointed(
            moved.select("p", "x", "w", F.when(cut, F.col("leaf")).alias("parent"), F.when(cut, F.xxhash64("leaf", upper)).otherwise(F.col("leaf")).alias("leaf"))
        )
        held = moved.drop("parent")
        fresh = _boxed(moved.where(F.col("parent").isNotNull()), ["leaf", "parent"], width)
        level = checkpointed(fresh.select(F.col("leaf").alias("node"), "parent", "lo", "hi", "weight", "n"))
        nodes = nodes.unionByName(level)


def _children(frontier: DataFrame, tree: BoxTree, node: str, keep: list[str], spread_by: str) -> DataFrame:
    """``frontier`` one step down: its nodes replaced by their children."""
    below = tree.nodes.where(F.col("parent").isNotNull()).select(F.col("parent").alias(node), F.col("node").alias("_child"))
    down = lookup_join(frontier.select(*keep, node), below, [node], "inner", spread_by=spread_by)
    return down.select(*keep, F.col("_child").alias(node))


def _met(asked: DataFrame, tree: BoxTree, limit: Column) -> DataFrame:
    """(a, p_open, c, c_open, w, p) of what lies within reach of the points of ``asked(a, p_open, x_open, c, c_open)``.

    Whole boxes within reach count with their weight and no single point; cells that are open are small and count by point.
    """
    keep = ["a", "p_open", "x_open", "c", "c_open"]
    frontier = asked.select(*keep, _root("c").alias("node"))
    whole = None
    if tree.split:
        whole, leaves = [], []
        while True:
            boxes = tree.nodes.select("node", "lo", "hi", "weight", "n")
            nearest, farthest = _point_box_distances("x_open")
            tried = lookup_join(frontier, boxes, ["node"], "inner", spread_by="p_open").where(nearest <= limit)
            tried = checkpointed(tried.select(*keep, "node", "weight", "n", ((farthest <= limit) & ~F.col("c_open")).alias("sure")))
            whole.append(tried.where("sure").select("a", "p_open", "c", "c_open", F.col("weight").alias("w"), F.lit(None).alias("p")))
            leaves.append(tried.where(~F.col("sure") & (F.col("n") <= tree.leaf_points)).select(*keep, "node"))
            deeper = tried.where(~F.col("sure") & (F.col("n") > tree.leaf_points))
            if deeper.isEmpty():
                break
            frontier = _children(deeper, tree, "node", keep, "p_open")
        frontier = reduce(DataFrame.unionByName, leaves)
        whole = reduce(DataFrame.unionByName, whole)
    compared = lookup_join(tree.points.withColumnRenamed("leaf", "node"), frontier, ["node"], "inner", spread_by="p").where(
        squared_distance(F.col("x"), F.col("x_open")) <= limit
    )
    compared = compared.select("a", "p_open", "c", "c_open", "w", "p")
    return compared if whole is None else compared.unionByName(whole.withColumn("p", F.col("p").cast(dict(compared.dtypes)["p"])))


def _point_box_distances(point: str) -> tuple[Column, Column]:
    """Squared smallest and largest distance of a point to the points of a box."""
    below, above = F.zip_with("lo", point, lambda l, v: l - v), F.zip_with(point, "hi", lambda v, h: v - h)

    def total(parts):
        return F.aggregate(parts, F.lit(0.0), lambda acc, v: acc + v * v)

    return total(F.zip_with(below, above, lambda p, q: F.greatest(p, q, F.lit(0.0)))), total(F.zip_with(below, above, lambda p, q: F.greatest(-p, -q)))


def _neighbour_cells(cells: DataFrame, width: int, limit: Column) -> DataFrame:
    """Pairs (a, b) of different cells, both ways, whose boxes come within reach.

    Values of a dimension fall into segments divided by gaps wider than the reach;
    neighbours agree in all segments (an equality key).  The dimensions with the most
    occupied positions also get a coarse index that differs by at most one.
    """
    reach = math.ceil(math.sqrt(width)) + 1
    positions = cells.select(F.posexplode("cell").alias("dim", "at")).distinct()
    along = Window.partitionBy("dim").orderBy("at")
    starts = positions.withColumn("gap", F.col("at") - F.lag("at").over(along))
    summary = starts.groupBy("dim").agg(
        F.collect_list(F.when(F.col("gap") > reach, F.col("at"))).alias("starts"), F.count(F.lit(1)).alias("n")
    ).collect()  # one row per dimension
    by_dim = {r["dim"]: r for r in summary}
    widest = sorted(by_dim, key=lambda d: (-(by_dim[d]["n"] / (len(by_dim[d]["starts"]) + 1)), d))[:COARSE_DIMENSIONS]
    widest = [d for d in widest if by_dim[d]["n"] > 1]

    def segment(dim):
        cuts = sorted(by_dim[dim]["starts"])
        if not cuts:
            return F.lit(0)
        array = F.array(*[F.lit(c).cast("long") for c in cuts])
        return F.size(F.filter(array, lambda s: s <= F.col("cell")[dim]))

    keyed = cells.withColumn("seg", F.array(*[segment(d) for d in sorted(by_dim)]))
    keyed = keyed.withColumns({f"g{i}": F.floor(F.col("cell")[d] / F.lit(reach)) for i, d in enumerate(widest)})
    coarse = [f"g{i}" for i in range(len(widest))]
    right = keyed.select("seg", *coarse, *[F.col(c).alias(f"{c}_b") for c in ("c", "weight", "lo", "hi", "cell")])
    left = keyed.select("seg", *coarse, *[F.col(c).alias(f"{c}_a") for c in ("c", "weight", "lo", "hi", "cell")])
    for g in coarse:
        left = left.withColumn("step", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).withColumn(g, F.col(g) + F.col("step"))
    left = left.drop("step")
    close = F.forall(F.zip_with("cell_a", "cell_b", lambda p, q: F.abs(p - q)), lambda d: d <= reach)
    joined = spread_join(left, right, ["seg", *coarse], "inner", spread_by="c_a").where((F.col("c_a") != F.col("c_b")) & close)
    nearest, farthest = _box_distances()
    return joined.where(nearest <= limit).select(
        F.col("c_a").alias("a"), F.col("c_b").alias("b"), F.col("weight_b"), (farthest <= limit).alias("sure")
    )


def _box_distances() -> tuple[Column, Column]:
    """Squared smallest and largest distance between points of two boxes."""
    up = F.zip_with("hi_a", "lo_b", lambda h, l: h - l)
    down = F.zip_with("hi_b", "lo_a", lambda h, l: h - l)

    def total(parts):
        return F.aggregate(parts, F.lit(0.0), lambda acc, v: acc + v * v)

    gaps = F.zip_with(up, down, lambda p, q: F.greatest(-p, -q, F.lit(0.0)))
    spans = F.zip_with(up, down, lambda p, q: F.greatest(F.abs(p), F.abs(q)))
    return total(gaps), total(spans)


def _between(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends among the nodes."""
    keep = nodes.select("node")
    kept = lookup_join(edges, keep.withColumnRenamed("node", "a"), ["a"], "inner", spread_by="b")
    return lookup_join(kept, keep.withColumnRenamed("node", "b"), ["b"], "inner", spread_by="a").select("a", "b")


def _touching(undecided: DataFrame, tree: BoxTree, limit: Column) -> DataFrame:
    """Pairs of core cells that have two points within reach.

    The pairs walk down their box trees together, the fuller box first; a pair is done with its first two boxes
    that lie wholly within reach.  Only leaves compare points.
    """
    keep = ["a", "b"]
    frontier = undecided.select(*keep, _root("a").alias("node_a"), _root("b").alias("node_b"))
    sure = None
    if tree.split:
        found, leaves = [], []
        while True:
            for side in ("a", "b"):
                own = tree.nodes.select(F.col("node").alias(f"node_{side}"), *[F.col(k).alias(f"{k}_{side}") for k in ("lo", "hi", "n")])
                frontier = lookup_join(frontier, own, [f"node_{side}"], "inner", spread_by="b" if side == "a" else "a")
            nearest, farthest = _box_distances()
            tried = checkpointed(frontier.where(nearest <= limit).select(*keep, "node_a", "node_b", "n_a", "n_b", (farthest <= limit).alias("sure")))
            found.append(tried.where("sure").select(*keep).distinct())
            rest = tried.where(~F.col("sure")).join(found[-1], keep, "left_anti")
            small = F.greatest("n_a", "n_b") <= tree.leaf_points
            leaves.append(rest.where(small).select(*keep, "node_a", "node_b"))
            deeper = checkpointed(rest.where(~small))
            if deeper.isEmpty():
                break
            first = F.col("n_a") >= F.col("n_b")
            frontier = _children(deeper.where(first), tree, "node_a", [*keep, "node_b"], "b").unionByName(
                _children(deeper.where(~first), tree, "node_b", [*keep, "node_a"], "a")
            )
        sure = checkpointed(reduce(DataFrame.unionByName, found).distinct())
        frontier = reduce(DataFrame.unionByName, leaves).join(sure, keep, "left_anti")
    frontier = checkpointed(frontier)

    def facing(own: str, other: str) -> DataFrame:
        """Points of one side that lie within reach of the other side's box."""
        boxes = tree.nodes.select(F.col("node").alias(f"node_{other}"), "lo", "hi")
        far = lookup_join(frontier, boxes, [f"node_{other}"], "inner", spread_by=own).withColumnRenamed(f"node_{own}", "leaf")
        at = lookup_join(tree.points, far, ["leaf"], "inner", spread_by="p")
        at = at.where(_point_box_distances("x")[0] <= limit)
        return at.select(*keep, F.col("leaf").alias(f"node_{own}"), f"node_{other}", F.col("x").alias(f"x_{own}"), F.col("p").alias(f"p_{own}"))

    met = lookup_join(facing("a", "b"), facing("b", "a").drop("p_b"), [*keep, "node_a", "node_b"], "inner", spread_by="p_a")
    met = met.where(squared_distance(F.col("x_a"), F.col("x_b")) <= limit).groupBy(*keep).agg(F.count(F.lit(1)).alias("n")).select(*keep)
    return lookup_join(undecided, met if sure is None else met.unionByName(sure), keep, "inner")
