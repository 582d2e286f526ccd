"""Exact nearest neighbours of every point, by a tree of boxes held in tables.

Points are split level by level: a node with more than ``leaf_rows`` points is cut at the means of its ``CUTS`` widest
inputs (by variance) at once. A node's box holds the smallest and largest value of each input. The far corner of a
large enough box bounds how far away a point's neighbours can be, and a first pass inside the own leaf bounds
it closely. Then every point walks down the tree, into those boxes only that lie within its bound, and
is sent once to each leaf that is left.

Every level is a join with the table of its nodes; nothing about nodes comes to the driver. No pairs are
emitted, only the best k per point and leaf, and no task holds more than one leaf and one slice of its visitors,
so a leaf that many visit means more tasks, not larger ones.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderrisk.session import cut_lineage

LEAF_ROWS = 256
CUTS = 3
# Visitors of a leaf that meet it in one task, and those whose distances are worked out together.
SLICE_ROWS = 4096
_BATCH = 256

_FOUND_COLUMNS = ["id", "nid", "dist", "nvec", "nmult"]


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.array(column.tolist(), dtype=float).reshape(len(column), width)


def _best(left: pd.DataFrame, right: pd.DataFrame, k: int, width: int) -> pd.DataFrame:
    """The k nearest rows of ``right`` for each row of ``left``, the row itself left out.

    Rows of ``left`` may have a ``limit``, beyond which nothing is looked for. Squared distances from a matrix product
    are fast but inexact, so they only pick candidates, with more slack than their error; the candidates'
    distances are then worked out directly.
    """
    # Sorted by id, so that equal distances are settled the same way everywhere.
    right = right.sort_values("id")
    a, b = _matrix(left["vec"], width), _matrix(right["vec"], width)
    left_ids, right_ids = left["id"].to_numpy(), right["id"].to_numpy()
    vectors, mults = right["vec"].to_numpy(), right["mult"].to_numpy()
    a_norm, b_norm = (a * a).sum(axis=1), (b * b).sum(axis=1)
    last = min(k, len(b)) - 1
    limit = left["limit"].to_numpy(float) * (1 + 1e-9) + 1e-12 if "limit" in left else np.full(len(a), np.inf)
    parts = []
    for start in range(0, len(a), _BATCH):
        rows = slice(start, start + _BATCH)
        ids = left_ids[rows]
        rough = a_norm[rows, None] + b_norm[None, :] - 2.0 * (a[rows] @ b.T)
        rough[ids[:, None] == right_ids[None, :]] = np.inf
        slack = 1e-9 * (1.0 + a_norm[rows] + b_norm.max())
        near = (rough <= (limit[rows] ** 2 + slack)[:, None]) & np.isfinite(rough)
        many = np.flatnonzero(near.sum(axis=1) > k)
        if len(many):
            near[many] &= rough[many] <= (np.partition(rough[many], last, axis=1)[:, last] + slack[many])[:, None]
        row, col = np.nonzero(near)
        gaps = a[rows][row] - b[col]
        dist = np.sqrt((gaps * gaps).sum(axis=1))
        within = dist <= limit[rows][row]
        row, col, dist = row[within], col[within], dist[within]
        order = np.lexsort((col, dist, row))
        row, col, dist = row[order], col[order], dist[order]
        first = np.searchsorted(row, np.arange(len(ids)))
        keep = np.arange(len(row)) - first[row] < k
        row, col = row[keep], col[keep]
        parts.append(
            pd.DataFrame(
                {
                    "id": ids[row],
                    "nid": right_ids[col],
                    "dist": dist[keep],
                    "nvec": vectors[col],
                    "nmult": mults[col],
                }
            )
        )
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=_FOUND_COLUMNS)


def _top(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("id").orderBy("dist", "nid"))
    return found.withColumn("_place", place).where(F.col("_place") <= k)


def _far_corner() -> Column:
    """How far the corner of a point's box is that lies farthest from it."""
    return F.expr("sqrt(aggregate(sequence(0, size(vec) - 1), 0D, (total, i) -> total + pow(greatest(vec[i] - low[i], high[i] - vec[i]), 2)))")


def _nodes(points: DataFrame, width: int, leaf_rows: int) -> DataFrame:
    """(parent, node, n, low, high, cuts, is_leaf): one aggregate over the points of a level."""
    values = [F.col("vec")[i] for i in range(width)]
    sums = points.groupBy("parent", "node", "parent_n").agg(
        F.count(F.lit(1)).alias("n"),
        *[f(v).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max), ("mean", F.avg), ("wide", F.var_pop)) for i, v in enumerate(values)],
    )

    def all_of(name: str) -> Column:
        return F.array(*[F.col(f"{name}{i}") for i in range(width)])

    wide = F.array(*[F.struct((-F.col(f"wide{i}")).alias("wide"), F.lit(i).alias("input"), F.col(f"mean{i}").alias("mean")) for i in range(width)])
    # Points that rounding keeps together for good stay one leaf.
    is_leaf = (F.col("n") <= leaf_rows) | (F.col("n") == F.col("parent_n"))
    cuts = F.slice(F.array_sort(wide), 1, CUTS)
    return cut_lineage(sums.select("parent", "node", "n", all_of("low").alias("low"), all_of("high").alias("high"), cuts.alias("cuts"), is_leaf.alias("is_leaf")))


def box_tree(points: DataFrame, k: int, width: int, leaf_rows: int = LEAF_ROWS) -> tuple[DataFrame, list[DataFrame]]:
    """(id, vec, mult, limit, leaf) and, level by level from the root, the nodes (parent, node, n, low, high, is_leaf).

    ``points`` has distinct vectors. limit is no smaller than the distance of a point's k-th neighbour.
    """
    none, far = F.lit(-1).cast("bigint"), F.lit(float("inf"))
    left = points.select("id", "vec", "mult", far.alias("limit"), none.alias("parent"), F.lit(0).cast("bigint").alias("node"), none.alias("parent_n"))
    settled: list[DataFrame] = []
    levels: list[DataFrame] = []
    while True:
        nodes = _nodes(left, width, leaf_rows)
        levels.append(nodes.drop("cuts"))
        leaves = nodes.where("is_leaf").select("node")
        settled.append(left.join(leaves, "node", "left_semi").select("id", "vec", "mult", "limit", F.col("node").alias("leaf")))
        large = nodes.where("not is_leaf")
        if not large.head(1):
            break
        going = left.select("id", "vec", "mult", "limit", "node").join(large.drop("parent", "is_leaf"), "node")
        corner = F.when(F.col("n") > k, _far_corner())
        side = F.expr("aggregate(cuts, 0, (code, c) -> 2 * code + if(vec[c.input] > c.mean, 1, 0))")
        child = F.xxhash64("node", F.lit(len(levels)), side)
        left = going.select("id", "vec", "mult", F.least("limit", corner).alias("limit"), F.col("node").alias("parent"), child.alias("node"), F.col("n").alias("parent_n"))
        left = cut_lineage(left)
    placed = settled[0]
    for more in settled[1:]:
        placed = placed.unionByName(more)
    return cut_lineage(placed), levels


def _flat(table: pa.Table, name: str) -> np.ndarray:
    return pa.concat_arrays(table[name].chunks).flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def _dealt(rows: DataFrame, by: str) -> tuple[DataFrame, DataFrame]:
    """(by, slices), and ``rows`` with ``slice``: no slice of the rows with equal ``by`` holds many more than ``SLICE_ROWS``."""
    load = cut_lineage(rows.groupBy(by).agg(F.ceil(F.count(F.lit(1)) / SLICE_ROWS).cast("int").alias("slices")))
    return load, rows.join(load, by).withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int"))


def _each_slice(rows: DataFrame, load: DataFrame, by: str) -> DataFrame:
    return rows.join(load, by).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))


def _boxes_met(points: pa.Table, boxes: pa.Table) -> pa.Table:
    """The points of one node beside each of its children whose box lies within their bound."""
    names = ["id", "vec", "home", "limit"]
    at, child = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if points.num_rows and boxes.num_rows:
        vectors, limit = _flat(points, "vec"), points["limit"].to_numpy()
        low, high = _flat(boxes, "low"), _flat(boxes, "high")
        met = np.zeros((len(vectors), len(low)), bool)
        for i in range(len(low)):
            apart = np.maximum(np.maximum(low[i] - vectors, vectors - high[i]), 0.0)
            # A little slack keeps rounding from hiding a neighbour on the border.
            met[:, i] = np.sqrt((apart * apart).sum(axis=1)) * (1 - 1e-9) - 1e-12 <= limit
        at, child = np.nonzero(met)
    held = points.select(names).take(pa.array(at))
    found = boxes.select(["child", "is_leaf"]).take(pa.array(child))
    return pa.table([*held.columns, *found.columns], names=[*names, "node", "is_leaf"])


def visits(bounded: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(id, vec, limit, leaf): the leaves, but for its own, whose box lies within a point's bound.

    ``bounded`` has (id, vec, home, limit), home being the point's own leaf.
    """
    kind = bounded.schema["id"].dataType.simpleString()
    schema = f"id {kind}, vec array<double>, home bigint, limit double, node bigint, is_leaf boolean"
    going = cut_lineage(bounded.withColumn("node", F.lit(-1).cast("bigint")))
    found: list[DataFrame] = []
    for nodes in levels:
        children = nodes.select(F.col("parent").alias("node"), F.col("node").alias("child"), "low", "high", "is_leaf")
        load, points = _dealt(going, "node")
        boxes = _each_slice(children, load, "node")
        points = points.select("id", "vec", "home", "limit", "node", "slice").groupBy("node", "slice")
        met = cut_lineage(points.cogroup(boxes.groupBy("node", "slice")).applyInArrow(_boxes_met, schema))
        found.append(met.where("is_leaf and node != home").select("id", "vec", "limit", F.col("node").alias("leaf")))
        going = met.where("not is_leaf").drop("is_leaf")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _found_schema(points: DataFrame) -> str:
    kind = points.schema["id"].dataType.simpleString()
    return f"id {kind}, nid {kind}, dist double, nvec array<double>, nmult bigint"


def within_leaves(placed: DataFrame, k: int, width: int) -> tuple[DataFrame, DataFrame]:
    """The k nearest points of each point in its own leaf, and every point with the bound that they give."""

    def inside(group: pd.DataFrame) -> pd.DataFrame:
        return _best(group, group, k, width)

    near = placed.select("id", "vec", "mult", "leaf").groupBy("leaf").applyInPandas(inside, _found_schema(placed))
    near = cut_lineage(near)
    bound = near.groupBy("id").agg(F.count(F.lit(1)).alias("_n"), F.max("dist").alias("_far"))
    limit = F.least("limit", F.when(F.col("_n") >= k, F.col("_far")))
    return near, placed.join(bound, "id", "left").select("id", "vec", F.col("leaf").alias("home"), limit.alias("limit"))


def nearest_distinct(points: DataFrame, k: int, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(id, nid, dist, nvec, nmult, _place): the k nearest other points of each point.

    ``points`` has (id, vec, mult) with distinct vectors and ids. No points give no rows.
    """
    points = cut_lineage(points.select("id", "vec", F.col("mult").cast("bigint").alias("mult")))
    first = points.select(F.size("vec")).head()
    if not first:
        return points.sparkSession.createDataFrame([], f"{_found_schema(points)}, _place int")
    width = first[0]
    placed, levels = box_tree(points, k, width, leaf_rows)
    near, bounded = within_leaves(placed, k, width)
    sent = cut_lineage(visits(bounded, levels))
    # A leaf with many visitors is there once for each slice of them.
    load, guests = _dealt(sent, "leaf")
    hosts = _each_slice(placed, load, "leaf")

    def across(guests: pd.DataFrame, residents: pd.DataFrame) -> pd.DataFrame:
        if guests.empty or residents.empty:
            return pd.DataFrame(columns=_FOUND_COLUMNS)
        return _best(guests, residents, k, width)

    keys = ["leaf", "slice"]
    # Most visits find nothing within the limit, and send nothing on.
    left = guests.select("id", "vec", "limit", *keys).groupBy(*keys)
    far = left.cogroup(hosts.select("id", "vec", "mult", *keys).groupBy(*keys)).applyInPandas(across, _found_schema(points))
    return _top(near.unionByName(far), k)


def nearest_neighbours(points: DataFrame, k: int, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Adds ``neighbours``: the vectors of the k nearest other rows, nearest first.

    ``points`` has one row per distinct vector (id, vec, mult, ...), where ``mult`` rows share the
    vector. A vector that occurs more than once is its own neighbour at distance 0.
    """
    points = cut_lineage(points)
    found = nearest_distinct(points, k, leaf_rows)
    # At most k entries per point.
    lists = found.groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("_place", "nvec", "nmult"))).alias("_near")
    )
    own = F.array_repeat(F.col("vec"), F.least(F.col("mult") - 1, F.lit(k)).cast("int"))
    others = F.flatten(
        F.transform("_near", lambda x: F.array_repeat(x["nvec"], F.least(x["nmult"], F.lit(k)).cast("int")))
    )
    none = F.array().cast("array<array<double>>")
    return (
        points.join(lists, "id", "left")
        .withColumn("neighbours", F.slice(F.concat(own, F.coalesce(others, none)), 1, k))
        .drop("_near")
    )
