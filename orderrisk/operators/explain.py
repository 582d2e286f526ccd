"""Exact contributions of each input to the log-odds of a boosted-tree model.

A subset of the inputs on a leaf's path reaches the leaf with the product of one factor per input: whether
the row agrees with the path, if the input is known, else the share of the cover that follows the path.
The Shapley weight of a subset of size k among m inputs is the integral of t^k (1 - t)^(m - 1 - k) over 0
to 1, so the sum over all subsets is the integral of a product of m - 1 linear factors. A Gauss-Legendre
rule of m / 2 points gives it exactly, with memory in proportion to the depth, for any depth. Short paths are tabled.
(Path-dependent tree Shapley values: Lundberg et al. 2020.)
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .features import FEATURES
from .trees import TreeModel, matrix, vector

# Rows and leaves that are worked out together, to bound the memory of a task.
_ROWS = 64
_LEAVES = 1024
# Longest paths whose contributions are tabled (2^m ways for each leaf), and rows that look theirs up together.
_TABLED = 6
_LOOKED_UP = 128
# Bins of an input's values within which its interactions are looked for.
BINS = 20


@dataclass(frozen=True)
class Leaves:
    """Leaves whose paths have as many distinct inputs: one row a leaf.

    Per input an interval (low, high] and the share of the cover that follows the path; per leaf its value.
    """

    inputs: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    values: np.ndarray


def leaves_of(model: TreeModel) -> tuple[list[Leaves], float]:
    """All leaves by the length of their paths, and the model's expected log-odds."""
    found: dict[int, list[tuple[dict, float]]] = {}
    base = model.base
    for root in model.roots.tolist():
        # (node, per input: low, high, share of the cover that follows the path)
        stack: list[tuple[int, dict]] = [(root, {})]
        while stack:
            at, path = stack.pop()
            i = int(model.inputs[at])
            if i < 0:
                base += model.values[at] * model.covers[at] / model.covers[root]
                if path:
                    found.setdefault(len(path), []).append((path, model.values[at]))
                continue
            for child, is_left in ((int(model.left[at]), True), (int(model.right[at]), False)):
                low, high, share = path.get(i, (-np.inf, np.inf, 1.0))
                low, high = (low, min(high, model.thresholds[at])) if is_left else (max(low, model.thresholds[at]), high)
                stack.append((child, {**path, i: (low, high, share * model.covers[child] / model.covers[at])}))
    return [stacked(held[i : i + _LEAVES]) for held in found.values() for i in range(0, len(held), _LEAVES)], float(base)


def stacked(leaves: list[tuple[dict, float]]) -> Leaves:
    parts = np.array([[path[i] for i in path] for path, _ in leaves], float)
    return Leaves(np.array([list(path) for path, _ in leaves]), *np.moveaxis(parts, 2, 0), np.array([v for _, v in leaves], float))


def weighed(agrees: np.ndarray, held: Leaves) -> np.ndarray:
    """(row, leaf, place on its path): contributions for rows that agree with a path or not."""
    at, weights = np.polynomial.legendre.leggauss((held.inputs.shape[1] + 1) // 2)
    total = np.zeros(np.broadcast_shapes(agrees.shape, held.share.shape))
    for t, weight in zip((at + 1) / 2, weights / 2, strict=True):
        factors = np.maximum((1 - t) * held.share + t * agrees, 1e-300)
        total += weight * factors.prod(axis=2, keepdims=True) / factors
    return held.values[:, None] * (agrees - held.share) * total


def contributions(x: np.ndarray, groups: list[Leaves]) -> np.ndarray:
    """Per row and input the sum over all leaves."""
    return prepared(groups)(x)


def prepared(groups: list[Leaves]) -> Callable[[np.ndarray], np.ndarray]:
    """``contributions`` for many batches of rows.

    A row agrees with a path of m inputs in one of 2^m ways, and a leaf's contributions follow from that. For short paths
    all ways are worked out first, and rows look theirs up. The intervals of all paths are compared with a row once each.
    """
    short = [held for held in groups if held.inputs.shape[1] <= _TABLED]
    paths = [np.stack([held.inputs, held.low, held.high], axis=2).reshape(-1, 3) for held in short]
    spans, place = np.unique(np.concatenate(paths), axis=0, return_inverse=True) if paths else (np.zeros((0, 3)), np.zeros(0, np.int64))
    place, spanned = place.ravel(), spans[:, 0].astype(np.int64)
    tables = []
    for held in short:
        leaves, m = held.inputs.shape
        mine, place = place[: leaves * m].reshape(leaves, m), place[leaves * m :]
        ways = (np.arange(1 << m)[:, None, None] >> np.arange(m)) & 1
        # One table after the other, by leaf and place on its path.
        table = np.ascontiguousarray(weighed(ways.astype(float), held).transpose(1, 2, 0)).ravel()
        lines = []
        for i in np.unique(held.inputs):
            leaf, at = np.nonzero(held.inputs == i)
            lines.append((int(i), leaf, ((leaf * m + at) << m)[:, None]))
        tables.append((mine, table, lines))

    def looked_up(x: np.ndarray, out: np.ndarray) -> None:
        values = np.ascontiguousarray(x.T)[spanned]
        agrees = ((values > spans[:, 1:2]) & (values <= spans[:, 2:])).astype(np.uint8)
        for mine, table, lines in tables:
            way = np.zeros((len(mine), len(x)), np.uint8)
            for j in range(mine.shape[1]):
                way |= agrees[mine[:, j]] << np.uint8(j)
            for i, leaf, base in lines:
                out[:, i] += table.take(way[leaf] + base).sum(axis=0)

    def found(x: np.ndarray) -> np.ndarray:
        out = np.zeros(x.shape)
        if tables:
            for start in range(0, len(x), _LOOKED_UP):
                looked_up(x[start : start + _LOOKED_UP], out[start : start + _LOOKED_UP])
        for held in groups:
            if held.inputs.shape[1] <= _TABLED:
                continue
            order = np.argsort(held.inputs.ravel(), kind="stable")
            present, starts = np.unique(held.inputs.ravel()[order], return_index=True)
            for start in range(0, len(x), _ROWS):
                rows = x[start : start + _ROWS][:, held.inputs]
                part = weighed(((rows > held.low) & (rows <= held.high)).astype(float), held)
                out[start : start + _ROWS, present] += np.add.reduceat(part.reshape(len(rows), -1)[:, order], starts, axis=1)
        return out

    return found


def tree_shap(model: TreeModel, rows: DataFrame, key: str = "order_id") -> DataFrame:
    """(key, feature, value, contribution, base_value): one row per order and input.

    The contributions of an order and the base value add up to its log-odds.
    """
    groups, base = leaves_of(model)
    shared = rows.sparkSession.sparkContext.broadcast(groups)
    kind = rows.schema[key].dataType.simpleString()
    doubles = pa.list_(pa.float64())

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contributed = prepared(shared.value)
        for batch in batches:
            x = matrix(batch.column(1))
            found = contributed(x)
            columns = [batch.column(0), pa.array(list(x), doubles), pa.array(list(found), doubles)]
            yield pa.RecordBatch.from_arrays(columns, [key, "x", "c"])

    explained = rows.select(key, vector(model.names).alias("x")).mapInArrow(explain, f"`{key}` {kind}, x array<double>, c array<double>")
    names = F.array(*[F.lit(name) for name in model.names])
    zipped = F.arrays_zip(names.alias("feature"), F.col("x").alias("value"), F.col("c").alias("contribution"))
    return explained.select(key, F.inline(zipped)).toDF(key, "feature", "value", "contribution").withColumn("base_value", F.lit(base))


def shap_importance(shap: DataFrame) -> DataFrame:
    """Mean absolute contribution per input, ranked; the top 5 and the top quartile are marked."""
    means = shap.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs"))
    ranked = means.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("mean_abs").desc(), "feature"))
    )
    limit = F.percentile("mean_abs", 0.75).over(Window.partitionBy())
    return ranked.select(
        "feature",
        "mean_abs",
        "rank",
        (F.col("rank") <= 5).alias("top5"),
        (F.col("mean_abs") >= limit).alias("highlight"),
    )


def shap_interactions(shap: DataFrame, top: int | None = 3, bins: int = BINS, key: str = "order_id") -> DataFrame:
    """(feature, interacts_with, strength): the other input that tells most about a top input's contribution, its own value known.

    The input's values are cut into ``bins`` of equal width. Within each bin the contribution is correlated with every other
    input; strength is the mean of the absolute correlations, weighted by rows. Ties go to the first name.
    """
    chosen = _chosen(shap, top).select(key, "feature", "value", "contribution")
    # One row per input.
    ends = shap.groupBy("feature").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    share = (F.col("value") - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0))
    binned = chosen.join(F.broadcast(ends), "feature").withColumn("bin", F.least(F.coalesce((share * bins).cast("int"), F.lit(0)), F.lit(bins - 1)))
    others = shap.select(key, F.col("feature").alias("other"), F.col("value").alias("other_value"))
    pairs = binned.join(others, key).where("feature != other")
    spread = pairs.groupBy("feature", "other", "bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.covar_pop("contribution", "other_value").alias("both"),
        (F.var_pop("contribution") * F.var_pop("other_value")).alias("apart"),
    )
    link = F.when(F.col("apart") > 1e-18, F.abs("both") / F.sqrt("apart")).otherwise(F.lit(0.0))
    strength = spread.groupBy("feature", "other").agg(F.round(F.sum(link * F.col("n")) / F.sum("n"), 9).alias("strength"))
    best = F.min(F.struct((-F.col("strength")).alias("less"), "other"))
    return strength.groupBy("feature").agg(best.alias("b")).select("feature", F.col("b.other").alias("interacts_with"), (-F.col("b.less")).alias("strength"))


def _chosen(shap: DataFrame, top: int | None) -> DataFrame:
    ranks = shap_importance(shap).select("feature", "rank")
    chosen = ranks if top is None else ranks.where(F.col("rank") <= top)
    # One row per input at most.
    return shap.drop("base_value").join(F.broadcast(chosen), "feature")


def shap_dependence(shap: DataFrame, top: int | None = 3, interactions: bool = True) -> DataFrame:
    """(feature, rank, order, value, contribution) of the top inputs, all inputs for None, and interacts_with if asked for."""
    rows = _chosen(shap, top)
    # One row per input at most.
    return rows.join(F.broadcast(shap_interactions(shap, top).drop("strength")), "feature", "left") if interactions else rows


def shap_local(shap: DataFrame, scored: DataFrame, order, key: str = "order_id", shown: int = 10) -> DataFrame:
    """The first caught and the first missed fraud, each with its largest contributions.

    ``scored`` has (key, is_fraud, pred, prob); ``order`` says which row comes first. With more
    inputs than ``shown``, the smallest share one line, so that ``shown`` lines remain.
    """
    case = F.when(F.col("pred") == 1, F.lit("true_positive")).otherwise(F.lit("false_negative"))
    first = (
        scored.where(F.col("is_fraud") == 1)
        .groupBy(case.alias("case"))
        .agg(F.min_by(F.struct(key, "prob"), F.struct(order, F.col(key))).alias("_first"))
        .select("case", F.col("_first")[key].alias(key), F.col("_first")["prob"].alias("prob"))
    )
    alone = len(FEATURES) if len(FEATURES) <= shown else shown - 1
    others = f"{len(FEATURES) - alone} other features"
    # Two rows: one per case.
    lines = shap.join(F.broadcast(first), key).withColumn(
        "place",
        F.row_number().over(Window.partitionBy("case").orderBy(F.abs("contribution").desc(), "feature")),
    )
    grouped = F.col("place") > alone
    return (
        lines.withColumns(
            {
                "feature": F.when(grouped, F.lit(others)).otherwise(F.col("feature")),
                "value": F.when(~grouped, F.col("value")),
                "place": F.least("place", F.lit(alone + 1)),
            }
        )
        .groupBy("case", key, "prob", "base_value", "place", "feature")
        .agg(F.max("value").alias("value"), F.sum("contribution").alias("contribution"))
    )
