"""Second-order histogram boosting.

Inputs are binned once, at exact quantiles of a sample of bounded size that depends on the keys alone, into byte
matrices, one per piece of rows; inputs with few bins share a byte. For each level of a tree every piece sums gradients, curvatures
and rows per node, input and bin, of one child of each split only; the sums of many pieces meet in a shuffle first, and the driver
sees one histogram per group of pieces. It picks the splits with the largest regularised gain. Gradients are whole numbers of a
small unit, so sums are exact and a model does not depend on how its rows were dealt.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderrisk.functions.hashing import hash60
from orderrisk.session import cut_lineage, drop_table

from .trees import TreeModel, grown, matrix, vector

BINS = 256
#: Rows of a piece, and rows that the bins' quantiles are taken from.
PIECE_ROWS = 1 << 15
SAMPLE_ROWS = 200_000
#: Trees after which the margins are written anew, so that a lost executor costs at most as many.
REFRESH = 25
#: Bytes of histograms that the driver sums without their meeting in tasks.
MEETING = 1 << 25
_BLOCK = (np.uint8, np.uint8, "<f8")


def cut_points(train: DataFrame, names: list[str], rows: int, bins: int = BINS, sample_rows: int = SAMPLE_ROWS, key: str = "order_id") -> list[np.ndarray]:
    """Per input the values after which a new bin begins, ascending; fewer than ``bins``."""
    share = min(1.0, sample_rows / max(rows, 1))
    sample = train.where(hash60(F.col(key), "bins") < F.lit(int(share * (1 << 60))))
    at = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    columns = [F.col(f"`{n}`").cast("double") for n in names]
    found = sample.agg(*[F.percentile(c, at).alias(f"p{i}") for i, c in enumerate(columns)], *[F.max(c).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    out = []
    for i in range(len(names)):
        cuts = np.unique(np.array(found[f"p{i}"] or [], float))
        out.append(cuts[cuts < found[f"m{i}"]] if len(cuts) else cuts)
    return out


def bundles(sizes: list[int], most: int = BINS) -> list[list[int]]:
    """Inputs that share a column of bytes: the product of their numbers of bins is at most ``most``."""
    out: list[list[int]] = []
    for i, size in enumerate(sizes):
        room = [b for b in out if np.prod([sizes[j] for j in b]) * size <= most]
        if room:
            room[0].append(i)
        else:
            out.append([i])
    return out


def strides(bundle: list[int], sizes: list[int]) -> list[int]:
    """What a bin of each input counts in the bundle's code; the last input counts one."""
    return [int(np.prod([sizes[j] for j in bundle[k + 1 :]], dtype=np.int64)) for k in range(len(bundle))]


def packed(
    train: DataFrame, names: list[str], cuts: list[np.ndarray], pieces: int, key: str = "order_id", label: str = "is_fraud", piece_rows: int = PIECE_ROWS, together: list[list[int]] | None = None
) -> DataFrame:
    """(keys, labels, bins, margins): blocks of at most ``piece_rows`` rows, bins input after input, margins 0.

    Inputs of one list of ``together`` share a column of codes. Keys that are no whole numbers are there by their hash.
    """
    sizes = [len(c) + 1 for c in cuts]
    together = together or [[i] for i in range(len(cuts))]

    def coded(x: np.ndarray, bundle: list[int]) -> np.ndarray:
        return sum(np.searchsorted(cuts[i], x[:, i], "left") * stride for i, stride in zip(bundle, strides(bundle, sizes), strict=True)).astype(np.uint8)

    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        x = np.concatenate([matrix(part.column(2)) for part in parts])
        keys, labels = (np.concatenate([part.column(c).to_numpy() for part in parts]) for c in (0, 1))
        blobs = [keys.astype("<i8"), labels.astype(np.uint8), np.concatenate([coded(x, bundle) for bundle in together]), np.zeros(len(x))]
        return pa.RecordBatch.from_arrays([pa.array([b.tobytes()], pa.binary()) for b in blobs], ["keys", "labels", "bins", "margins"])

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in parts:
            for start in range(0, batch.num_rows, piece_rows):
                part = batch.slice(start, piece_rows)
                if held and sum(h.num_rows for h in held) + part.num_rows > piece_rows:
                    yield block(held)
                    held = []
                held.append(part)
        if held:
            yield block(held)

    whole = train.schema[key].dataType.simpleString() in ("bigint", "int")
    number = F.col(key).cast("long") if whole else F.xxhash64(key)
    rows = train.select(number.alias(key), F.col(label).cast("int"), vector(names).alias("x"))
    dealt = rows.repartition(pieces, key).sortWithinPartitions(key)
    return cut_lineage(dealt.mapInArrow(pack, "keys binary, labels binary, bins binary, margins binary"))


def held_blocks(table: DataFrame, pieces: int) -> RDD:
    """The blocks of a written table as tuples of bytes, in few partitions for each core: every pass reads all of them."""
    parts = min(pieces, 2 * table.sparkSession.sparkContext.defaultParallelism)
    return table.rdd.map(lambda r: tuple(map(bytes, r))).coalesce(max(1, parts)).persist(StorageLevel.MEMORY_AND_DISK)


@dataclass
class Growing:
    """One tree while it grows; node 0 is the root and children come behind their parents."""

    input: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, at: int, last_bin: int, gain: float) -> tuple[int, int]:
        children = len(self.input), len(self.input) + 1
        self.input[node], self.bin[node], self.gain[node], (self.left[node], self.right[node]) = at, last_bin, gain, children
        for child in children:
            for column, value in ((self.input, -1), (self.bin, 0), (self.left, child), (self.right, child), (self.value, 0.0), (self.cover, 0.0), (self.gain, 0.0)):
                column.append(value)
        return children

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(c) for c in (self.input, self.bin, self.left, self.right, self.value))

    def shape(self) -> tuple[np.ndarray, ...]:
        """What rows need to find their way, in few bytes."""
        return tuple(np.array(c, np.int32) for c in (self.input, self.bin, self.left, self.right))

    def listed(self, cuts: list[np.ndarray]) -> dict[str, list]:
        threshold = [float(cuts[i][b]) if i >= 0 else 0.0 for i, b in zip(self.input, self.bin, strict=True)]
        return {"input": self.input, "threshold": threshold, "left": self.left, "right": self.right, "value": self.value, "cover": self.cover, "gain": self.gain}


def steps(tree: tuple[np.ndarray, ...], together: list[list[int]], sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Per node the column that it looks at, and per node and code the next node.

    Tasks work this out from :meth:`Growing.shape`: a pass carries the trees since the margins were last written, so they must be small.
    """
    inputs, last, left, right = tree
    column = np.zeros(len(inputs), np.int64)
    following = np.repeat(np.arange(len(inputs))[:, None], BINS, axis=1)
    code = np.arange(BINS)
    where = {i: (b, stride) for b, bundle in enumerate(together) for i, stride in zip(bundle, strides(bundle, sizes), strict=True)}
    for node, i in enumerate(inputs.tolist()):
        if i >= 0:
            column[node], stride = where[i]
            following[node] = np.where(code // stride % sizes[i] <= last[node], left[node], right[node])
    return column, following.ravel()


def walked(way: tuple[np.ndarray, np.ndarray], codes: np.ndarray, n: int, depth: int) -> np.ndarray:
    """The node that each of ``n`` rows reaches in ``depth`` steps; ``codes`` holds column after column."""
    column, following = way
    at = following[codes[column[0] * n : (column[0] + 1) * n]] if depth else np.zeros(n, np.int64)
    row = np.arange(n)
    for _ in range(depth - 1):
        at = following[at * BINS + codes[column[at] * n + row]]
    return at


def summed(found: RDD, bytes_each: int) -> np.ndarray:
    """The sum of the arrays, one a partition. Beyond ``MEETING`` bytes they meet in tasks first, and about the root of their number comes to the driver."""
    return found.reduce(np.add) if found.getNumPartitions() * bytes_each <= MEETING else found.treeReduce(np.add, 2)


def apart(hist: np.ndarray, together: list[list[int]], sizes: list[int]) -> np.ndarray:
    """Sums per input and bin, from (node, all columns' codes, sum)."""
    out: dict[int, np.ndarray] = {}
    start = 0
    for bundle in together:
        shape = [sizes[i] for i in bundle]
        end = start + int(np.prod(shape))
        held = hist[:, start:end].reshape(len(hist), *shape, hist.shape[2])
        for k, i in enumerate(bundle):
            out[i] = held.sum(axis=tuple(a + 1 for a in range(len(shape)) if a != k))
        start = end
    return np.concatenate([out[i] for i in range(len(sizes))], axis=1)


def best_splits(hist: np.ndarray, sizes: list[int], l2: float, min_curvature: float, min_rows: int, unit: float) -> list[tuple]:
    """Per node (gain, input, last bin on the left, left sums, right sums, whole sums), gain 0 where nothing is gained.

    ``hist`` is (node, all inputs' bins, [gradient, curvature, rows]) in whole units. Ties go to the first input and bin.
    """
    starts = np.cumsum([0, *sizes])
    own = np.arange(len(hist))
    whole = hist[:, : starts[1]].sum(axis=1)
    gain, place, last = np.zeros(len(hist)), np.full(len(hist), -1), np.zeros(len(hist), np.int64)
    on_left, on_right = whole.copy(), whole.copy()

    def score(sums: np.ndarray) -> np.ndarray:
        return (sums[..., 0] / unit) ** 2 / (sums[..., 1] / unit + l2 + 1e-12)

    for i, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
        if b - a < 2:
            continue
        left = np.cumsum(hist[:, a:b], axis=1)[:, :-1]
        right = whole[:, None] - left
        fits = (np.minimum(left[..., 1], right[..., 1]) >= min_curvature * unit) & (np.minimum(left[..., 2], right[..., 2]) >= max(min_rows, 1))
        gains = np.where(fits, score(left) + score(right) - score(whole)[:, None], -np.inf)
        at = gains.argmax(axis=1)
        found = gains[own, at]
        better = (found > gain + 1e-9 * np.abs(gain)) & (found > 1e-6)
        gain, place, last = np.where(better, found, gain), np.where(better, i, place), np.where(better, at, last)
        on_left, on_right = (np.where(better[:, None], side[own, at], old) for side, old in ((left, on_left), (right, on_right)))
    return list(zip(gain.tolist(), place.tolist(), last.tolist(), on_left, on_right, whole, strict=True))


def fit(
    train: DataFrame,
    names: list[str],
    class_weights: tuple[float, float] = (1.0, 1.0),
    rounds: int = 200,
    depth: int = 6,
    step: float = 0.3,
    l2: float = 1.0,
    min_curvature: float = 1.0,
    min_rows: int = 1,
    bins: int = BINS,
    key: str = "order_id",
    label: str = "is_fraud",
    pieces: int | None = None,
) -> TreeModel:
    """Boosted trees on the logistic loss, whose rows weigh as their class says.

    Each split maximises G_l² / (H_l + l2) + G_r² / (H_r + l2) - G² / (H + l2) over gradient sums G and curvature sums H;
    a leaf adds -step G / (H + l2). A missing input is refused; no rows give a model without trees.
    """
    rows = train.count()
    if not rows:
        return grown(names, "logistic", 0.0, [])
    cuts = cut_points(train, names, rows, bins, key=key)
    pieces = pieces or -(-rows // PIECE_ROWS)
    sizes = [len(c) + 1 for c in cuts]
    together = bundles(sizes)
    table = packed(train, names, cuts, pieces, key, label, together=together).select("labels", "bins", "margins")
    counts = {r[label]: r["count"] for r in train.groupBy(label).count().collect()}
    mass = [class_weights[c] * counts.get(c, 0) for c in (0, 1)]
    base = float(np.log(mass[1] / mass[0])) if all(mass) else 0.0
    widths = [int(np.prod([sizes[i] for i in bundle])) for bundle in together]
    starts = np.cumsum([0, *widths])[:-1]
    # A block's sums in this unit stay below 2**53 and are exact.
    unit = 2.0 ** min(32, 52 - int(np.ceil(np.log2(PIECE_ROWS))) - max(0, int(np.ceil(np.log2(max(*class_weights, 1.0))))))
    weight = np.array(class_weights)
    # Where a side must hold some curvature it holds a row, so rows are only counted if more of them are asked for.
    counted = min_rows > 1 or min_curvature * unit < 1
    kinds = 3 if counted else 2

    def level_pass(shape: tuple, slot_of: np.ndarray, slots: int, level: int):
        def sums(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
            way = steps(shape, together, sizes)
            total = np.zeros((slots, sum(widths), kinds), np.int64)
            for block in blocks:
                y, codes, margin = (np.frombuffer(b, t) for b, t in zip(block, _BLOCK, strict=True))
                n = len(y)
                slot, rows_of = np.zeros(n, np.int64), slice(None)
                if level:
                    slot = slot_of[walked(way, codes, n, level)]
                    rows_of = np.flatnonzero(slot >= 0)
                    slot, y, margin = slot[rows_of], y[rows_of], margin[rows_of]
                p = 1.0 / (1.0 + np.exp(-(base + margin)))
                w = weight[y]
                values = [np.rint(v * unit) for v in (w * (p - y), w * p * (1.0 - p))] + [None] * (kinds - 2)
                for b, (width, start) in enumerate(zip(widths, starts, strict=True)):
                    place = slot * width + codes[b * n : (b + 1) * n][rows_of]
                    for c, v in enumerate(values):
                        total[:, start : start + width, c] += np.bincount(place, v, slots * width).reshape(slots, width).astype(np.int64)
            yield total

        return sums

    def advance(shape: tuple, value: np.ndarray):
        def add(blocks: Iterator[tuple]) -> Iterator[tuple]:
            way = steps(shape, together, sizes)
            for labels, codes, margins in blocks:
                moved = np.frombuffer(margins, "<f8") + value[walked(way, np.frombuffer(codes, np.uint8), len(labels), depth)]
                yield labels, codes, moved.tobytes()

        return add

    # Every level reads the blocks again; what does not fit in memory comes from disk, and from the table if an executor is lost.
    state, older = held_blocks(table, pieces), None
    grown_trees: list[Growing] = []
    for turn in range(rounds):
        tree, frontier = Growing(), [0]
        # The children of a split lie side by side. The one with less curvature is summed, the other is what it leaves of its parent.
        asked, above = [0], None
        for level in range(depth):
            slot_of = np.full(len(tree.input), -1)
            slot_of[asked] = np.arange(len(asked))
            total = summed(state.mapPartitions(level_pass(tree.shape(), slot_of, len(asked), level)), len(asked) * sum(widths) * kinds * 8)
            if older is not None:
                older.unpersist()
                older = None
            if level:
                rest = above - total
                first = np.array([a == f for a, f in zip(asked, frontier[::2], strict=True)])[:, None, None]
                total = np.stack([np.where(first, total, rest), np.where(first, rest, total)], axis=1).reshape(len(frontier), *total.shape[1:])
            hist = apart(total, together, sizes)
            if not counted:
                hist = np.concatenate([hist, hist[..., 1:]], axis=2)
            found = best_splits(hist, sizes, l2, min_curvature, min_rows, unit)
            below, asked, parents = [], [], []
            for at_slot, (node, (gain, at, last, left, right, whole)) in enumerate(zip(frontier, found, strict=True)):
                if not level:
                    tree.cover[0] = whole[1] / unit
                    tree.value[0] = -step * (whole[0] / unit) / (whole[1] / unit + l2 + 1e-12)
                if at < 0:
                    continue
                children = tree.split(node, at, last, gain)
                for child, part in zip(children, (left, right), strict=True):
                    tree.cover[child] = part[1] / unit
                    tree.value[child] = -step * (part[0] / unit) / (part[1] / unit + l2 + 1e-12)
                below += children
                asked.append(children[int(right[1] < left[1])])
                parents.append(at_slot)
            frontier, above = below, total[parents]
            if not frontier:
                break
        grown_trees.append(tree)
        if turn + 1 < rounds:
            older, state = state, state.mapPartitions(advance(tree.shape(), np.array(tree.value))).persist(StorageLevel.MEMORY_AND_DISK)
            if len(grown_trees) % REFRESH == 0:
                written = cut_lineage(train.sparkSession.createDataFrame(state, table.schema, verifySchema=False))
                for gone in (older, state):
                    gone.unpersist()
                drop_table(table)
                table, older = written, None
                state = held_blocks(table, pieces)
    state.unpersist()
    if older is not None:
        older.unpersist()
    drop_table(table)
    return grown(names, "logistic", base, [t.listed(cuts) for t in grown_trees])
