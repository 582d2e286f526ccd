"""Decision trees as flat arrays: scoring in batches, importance, saving and loading."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows that walk down all trees together.
_BATCH = 512
_ARRAYS = {"roots": "<i8", "inputs": "<i8", "thresholds": "<f8", "left": "<i8", "right": "<i8", "values": "<f8", "covers": "<f8", "gains": "<f8"}


@dataclass(frozen=True)
class TreeModel:
    """All nodes of all trees, children behind their parents.

    A row goes left if its input is at most the threshold. A leaf has input -1 and is its own child; its value counts
    towards the margin. ``covers`` is the weight of the training rows in a node. ``link`` says what the margin means:
    "logistic" for log-odds, "mean" for the sum of the trees' probabilities.
    """

    names: list[str]
    link: str
    base: float
    depth: int
    roots: np.ndarray
    inputs: np.ndarray
    thresholds: np.ndarray
    left: np.ndarray
    right: np.ndarray
    values: np.ndarray
    covers: np.ndarray
    gains: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        for start in range(0, len(x), _BATCH):
            part = x[start : start + _BATCH]
            row = np.arange(len(part))[:, None]
            at = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            for _ in range(self.depth):
                at = np.where(part[row, self.inputs[at]] <= self.thresholds[at], self.left[at], self.right[at])
            out[start : start + _BATCH] = self.base + self.values[at].sum(axis=1)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self._linked(self.margins(x))

    def _linked(self, margin: np.ndarray) -> np.ndarray:
        if self.link == "mean":
            return margin / max(1, len(self.roots))
        return 1.0 / (1.0 + np.exp(-margin))

    @cached_property
    def kept_leaves(self) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray] | None:
        """Per input the thresholds and, by their intervals, which leaves of each tree the input leaves open; each tree's values by leaf.

        Leaves of a tree are bits of a word; over all inputs one bit stays, that of the leaf a row ends in. None if a tree has
        more leaves than a word has bits. (Lucchese et al. 2015.)
        """
        below = np.zeros(len(self.inputs), np.uint64)
        leaf = self.inputs < 0
        owner = np.repeat(np.arange(len(self.roots)), np.diff(np.append(self.roots, len(self.inputs))))
        number = np.cumsum(leaf) - 1
        if not len(self.roots) or np.bincount(owner[leaf]).max() > 64:
            return None
        bit = number - number[leaf][np.searchsorted(owner[leaf], np.arange(len(self.roots)))][owner]
        below[leaf] = np.uint64(1) << bit[leaf].astype(np.uint64)
        # Children are behind their parents.
        for i in np.flatnonzero(~leaf)[::-1].tolist():
            below[i] = below[self.left[i]] | below[self.right[i]]
        values = np.zeros((len(self.roots), 64))
        values[owner[leaf], bit[leaf]] = self.values[leaf]
        thresholds, masks = [], []
        for f in range(len(self.names)):
            nodes = np.flatnonzero(self.inputs == f)
            cuts = np.unique(self.thresholds[nodes])
            kept = np.repeat(below[self.roots][:, None], len(cuts) + 1, axis=1)
            for i, k in zip(nodes.tolist(), np.searchsorted(cuts, self.thresholds[nodes]).tolist(), strict=True):
                kept[owner[i], : k + 1] &= ~below[self.right[i]]
                kept[owner[i], k + 1 :] &= ~below[self.left[i]]
            thresholds.append(cuts)
            masks.append(np.ascontiguousarray(kept.T))
        return thresholds, masks, values

    def replaced(self, x: np.ndarray) -> Iterator[Callable[[np.ndarray], np.ndarray]]:
        """Per input, in order, a function from other values of it to the probabilities of the rows with them.

        Only the input's own part is looked up again. The same numbers as :meth:`probability` of whole changed rows.
        """
        if self.kept_leaves is None:

            def scored_whole(f: int, other: np.ndarray) -> np.ndarray:
                copies = x.copy()
                copies[:, f] = other
                return self.probability(copies)

            yield from (partial(scored_whole, f) for f in range(len(self.names)))
            return
        thresholds, masks, values = self.kept_leaves
        first = np.arange(len(self.roots)) * 64

        def kept(f: int, other: np.ndarray) -> np.ndarray:
            return masks[f][np.searchsorted(thresholds[f], other, "left")]

        # What the inputs behind each one leave open, and in ``before`` those in front of it.
        behind = [np.full((len(x), len(self.roots)), ~np.uint64(0))]
        for f in range(len(self.names) - 1, 0, -1):
            behind.append(behind[-1] & kept(f, x[:, f]))
        before = np.full((len(x), len(self.roots)), ~np.uint64(0))
        for f in range(len(self.names)):
            rest = before & behind.pop()

            def looked_up(other: np.ndarray, f: int = f, rest: np.ndarray = rest) -> np.ndarray:
                bit = (rest & kept(f, other)).astype(float).view(np.int64) >> 52
                return self._linked(self.base + values.take(bit - 1023 + first).sum(axis=1))

            yield looked_up
            before &= kept(f, x[:, f])

    def importance(self) -> np.ndarray:
        """Share of the total gain per input."""
        split = self.inputs >= 0
        total = np.bincount(self.inputs[split], self.gains[split], len(self.names))
        return total / (total.sum() or 1.0)

    def scored(self, rows: DataFrame, *keep: str) -> DataFrame:
        """``keep`` and prob of each row."""
        kinds = [rows.schema[c].dataType.simpleString() for c in keep]
        shared = rows.sparkSession.sparkContext.broadcast(self)
        names = [*keep, "prob"]

        def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                prob = shared.value.probability(matrix(part.column(len(keep))))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(prob)], names)

        schema = ", ".join(f"`{c}` {k}" for c, k in zip(names, [*kinds, "double"], strict=True))
        return rows.select(*keep, vector(self.names).alias("_x")).mapInArrow(score, schema)


def vector(names: list[str]):
    return F.array(*[F.col(f"`{name}`").cast("double") for name in names])


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of inputs. A missing input has no way down a tree and is refused."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    if np.isnan(values).any():
        raise ValueError("a row has a missing input")
    return values.reshape(len(column), -1)


def grown(names: list[str], link: str, base: float, trees: list[dict[str, list]]) -> TreeModel:
    """A model from trees given as lists (input, threshold, left, right, value, cover, gain) with node 0 as root."""
    starts = np.cumsum([0, *(len(t["input"]) for t in trees)])
    column = {c: np.concatenate([np.asarray(t[c], float) for t in trees]) if trees else np.zeros(0) for c in ("input", "threshold", "left", "right", "value", "cover", "gain")}
    owner = np.repeat(np.arange(len(trees)), np.diff(starts))
    leaf = column["input"] < 0
    own = np.arange(len(owner))
    left, right = (np.where(leaf, own, column[c].astype(np.int64) + starts[owner]) for c in ("left", "right"))
    level = np.zeros(len(owner), np.int64)
    for i in np.flatnonzero(~leaf).tolist():
        level[left[i]] = level[right[i]] = level[i] + 1
    value = np.where(leaf, column["value"], 0.0)
    return TreeModel(
        names, link, float(base), int(level.max(initial=0)), starts[:-1], column["input"].astype(np.int64), column["threshold"], left, right, value, column["cover"], column["gain"]
    )


def save(model: TreeModel, path: str) -> None:
    """One row: the numbers as they are, the arrays as bytes."""
    row = (model.names, model.link, model.base, model.depth, *[np.ascontiguousarray(getattr(model, c), t).tobytes() for c, t in _ARRAYS.items()])
    schema = "names array<string>, link string, base double, depth int, " + ", ".join(f"{c} binary" for c in _ARRAYS)
    SparkSession.active().createDataFrame([row], schema).write.mode("overwrite").parquet(path)


def load(path: str) -> TreeModel:
    row = SparkSession.active().read.parquet(path).head()
    arrays = [np.frombuffer(bytes(row[c]), t) for c, t in _ARRAYS.items()]
    return TreeModel(list(row["names"]), row["link"], row["base"], row["depth"], *arrays)
