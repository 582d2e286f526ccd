"""Random forests from binned pieces of rows.

How often a row counts in a tree is a Poisson draw from a hash of (key, tree), and which inputs a node may split on is drawn from
a hash of (tree, path). Sums are whole numbers. So a forest is the same however its rows were dealt, and pieces follow the
data. Trees grow in groups: nodes of very many rows level by level, by summed histograms, as in boosting; the rows of a node that
fit one task meet in it, and it grows the rest of the tree. A row moves as a few bytes, and a node's rows lie side by side.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from orderrisk.session import drop_table, forget_shuffles

from .boosting import BINS, PIECE_ROWS, Growing, bundles, cut_points, held_blocks, packed, strides, summed
from .permuting import _mixed
from .trees import TreeModel, grown

#: Trees that grow together at least, nodes whose histograms one pass sums, and bytes of a node's rows that one task may grow on.
TOGETHER = 20
SLOTS = 512
LOCAL_BYTES = 1 << 26
#: Rows counted at a time, and nodes whose splits are found at a time.
_ROWS = 1 << 16
_NODES = 64
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate(([1.0], np.arange(1.0, 16.0)))))
_U = np.uint64
# The draws from which on a row counts once more, by their 53 bits; and by the upper 12 bits how often a row counts, -1 if that is not enough to tell.
_STEPS = np.ceil(_POISSON * (1 << 53)).astype(np.int64)
_UPPER = np.searchsorted(_STEPS, np.arange(1 << 12) << 41, "right")
_UPPER = np.where(np.searchsorted(_STEPS, (np.arange(1, (1 << 12) + 1) << 41) - 1, "right") > _UPPER, -1, _UPPER)


def times(keys: np.ndarray, tree: int) -> np.ndarray:
    """How often each row counts in a tree: Poisson with mean 1."""
    with np.errstate(over="ignore"):
        return _times(keys.astype(np.uint64) * _U(0x9FB21C651E98DF25), tree)


def _times(spread: np.ndarray, tree: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        drawn = _mixed(spread + _mixed(np.full(1, tree + 1, np.uint64)))
    out = _UPPER[drawn >> _U(52)]
    unsure = np.flatnonzero(out < 0)
    out[unsure] = np.searchsorted(_STEPS, (drawn[unsure] >> _U(11)).astype(np.int64), "right")
    return out


def drawn_inputs(tree: np.ndarray, path: np.ndarray, inputs: int, per_split: int) -> np.ndarray:
    """The inputs that a node may split on, one row a node; ``path`` is 1 for a root and 2 p or 2 p + 1 below p."""
    with np.errstate(over="ignore"):
        seed = _mixed(tree.astype(np.uint64) * _U(0xD6E8FEB86659FD93) + path.astype(np.uint64))
        order = _mixed(seed[:, None] + np.arange(1, inputs + 1, dtype=np.uint64)[None])
    return np.argsort(order, axis=1, kind="stable")[:, :per_split]


@dataclass
class Layout:
    """Where the inputs lie in the bytes of a row: a code for each bundle of inputs, padding, and last twice the times it counts plus its label.

    Rows are (row, word) arrays of whole words, so that choosing some of them moves words.
    """

    together: list[list[int]]
    sizes: list[int]

    def __post_init__(self):
        self.words = len(self.together) // 8 + 1
        self.column = np.zeros(len(self.sizes), np.int64)
        # Per input the bin that a code stands for.
        self.bin_of = np.zeros((len(self.sizes), BINS), np.int64)
        self.shape: list[tuple[int, int, int]] = [(0, 0, 0)] * len(self.sizes)
        for c, bundle in enumerate(self.together):
            for i, stride in zip(bundle, strides(bundle, self.sizes), strict=True):
                self.column[i] = c
                self.bin_of[i] = np.arange(BINS) // stride % self.sizes[i]
                held = int(np.prod([self.sizes[j] for j in bundle]))
                self.shape[i] = (held // (stride * self.sizes[i]), self.sizes[i], stride)

    def rows(self, labels: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """All rows of a block, each counted no times; ``codes`` holds column after column."""
        out = np.zeros((len(labels), 8 * self.words), np.uint8)
        out[:, : len(self.together)] = codes.reshape(len(self.together), -1).T
        out[:, -1] = labels
        return out.view(np.uint64)

    def drawn(self, rows: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The rows that count, with how often they do."""
        some = np.flatnonzero(count)
        out = rows.take(some, axis=0)
        out.view(np.uint8)[:, -1] |= count[some].astype(np.uint8) << 1
        return out

    def parts(self, rows: np.ndarray, at: int, last_bin: int, sides: tuple[bool, bool] = (True, True)) -> list[np.ndarray | None]:
        """The rows on the asked sides of a split."""
        left = (self.bin_of[at] <= last_bin)[rows.view(np.uint8)[:, self.column[at]]]
        return [rows.take(np.flatnonzero(side), axis=0) if asked else None for asked, side in zip(sides, (left, ~left), strict=True)]

    def histogram(self, rows: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        """(allowed input, bin, class): how often a node's rows count."""
        columns = self.column[allowed]
        found = {c: np.zeros(2 * BINS) for c in columns.tolist()}
        for start in range(0, len(rows), _ROWS):
            part = rows[start : start + _ROWS].view(np.uint8)
            last = part[:, -1].astype(np.int64)
            label, count = last & 1, (last >> 1).astype(float)
            for c, held in found.items():
                held += np.bincount(2 * part[:, c].astype(np.int64) + label, count, 2 * BINS)
        out = np.zeros((len(allowed), BINS, 2), np.int64)
        for j, (i, c) in enumerate(zip(allowed.tolist(), columns.tolist(), strict=True)):
            outer, size, stride = self.shape[i]
            codes = found[c][: 2 * outer * size * stride]
            out[j, :size] = codes.reshape(size, 2) if outer == stride == 1 else codes.reshape(outer, size, stride, 2).sum(axis=(0, 2))
        return out

    def counts(self, rows: np.ndarray) -> np.ndarray:
        """How often rows of each class count."""
        last = rows.view(np.uint8)[:, -1]
        return np.bincount(last & 1, last >> 1, 2).astype(np.int64)


def gini_splits(hist: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per slot the gain of weighted purity, the allowed input's place, the last bin on the left, and the counts on the left."""

    def purity(mass: np.ndarray) -> np.ndarray:
        whole = mass.sum(axis=-1)
        return (mass**2).sum(axis=-1) / np.where(whole > 0, whole, 1.0)

    left = np.cumsum(hist, axis=2)[:, :, :-1]
    whole = hist[:, :1].sum(axis=2, keepdims=True)
    right = whole - left
    gains = purity(left * weights) + purity(right * weights) - purity(whole * weights)
    gains = np.where((left.sum(axis=-1) > 0) & (right.sum(axis=-1) > 0), gains, -np.inf).reshape(len(hist), -1)
    best = gains.argmax(axis=1)
    at, last = np.divmod(best, BINS - 1)
    own = np.arange(len(hist))
    return gains[own, best], at, last, left[own, at, last]


@dataclass
class Tree(Growing):
    """A growing tree with each node's path and how often rows of each class count in it."""

    path: list[int] = field(default_factory=lambda: [1])
    counts: list[np.ndarray] = field(default_factory=lambda: [np.zeros(2, np.int64)])

    def open_nodes(self, nodes: list[int], depth: int) -> list[int]:
        return [i for i in nodes if self.counts[i].all() and self.path[i].bit_length() <= depth]

    def divide(self, node: int, at: int, last_bin: int, gain: float, left: np.ndarray) -> list[int]:
        children = list(self.split(node, at, last_bin, gain))
        self.path += [2 * self.path[node], 2 * self.path[node] + 1]
        self.counts += [left, self.counts[node] - left]
        return children


def _divided(trees: dict[int, Tree], slots: list[tuple[int, int]], allowed: np.ndarray, hist: np.ndarray, weights: np.ndarray) -> dict[int, list[int]]:
    """Splits every node of ``slots`` (tree, node) that gains; the new nodes of each tree."""
    below: dict[int, list[int]] = {t: [] for t in trees}
    gains, at, last, left = gini_splits(hist, weights)
    for i, (t, node) in enumerate(slots):
        if gains[i] > 1e-9:
            below[t] += trees[t].divide(node, int(allowed[i, at[i]]), int(last[i]), float(gains[i]), left[i])
    return below


def grown_locally(tree_no: int, path: int, rows: np.ndarray, layout: Layout, depth: int, per_split: int, weights: np.ndarray) -> Tree:
    """The rest of a tree below one node, from all its rows."""
    tree = Tree(path=[path], counts=[layout.counts(rows)])
    held = {i: rows for i in tree.open_nodes([0], depth)}
    del rows
    while held:
        below: dict[int, np.ndarray] = {}
        nodes = list(held)
        for start in range(0, len(nodes), _NODES):
            some = nodes[start : start + _NODES]
            allowed = drawn_inputs(np.full(len(some), tree_no), np.array([tree.path[i] for i in some]), len(layout.sizes), per_split)
            hist = np.stack([layout.histogram(held[i], inputs) for i, inputs in zip(some, allowed, strict=True)])
            _divided({0: tree}, [(0, i) for i in some], allowed, hist, weights)
            for i in some:
                mine = held.pop(i)
                if tree.input[i] < 0:
                    continue
                children = (tree.left[i], tree.right[i])
                going = set(tree.open_nodes(list(children), depth))
                parts = layout.parts(mine, tree.input[i], tree.bin[i], (children[0] in going, children[1] in going))
                below.update((c, part) for c, part in zip(children, parts, strict=True) if part is not None)
        held = below
    return tree


def fit(
    train: DataFrame,
    names: list[str],
    class_weights: tuple[float, float] = (1.0, 1.0),
    count: int = 200,
    depth: int = 12,
    per_split: int | None = None,
    key: str = "order_id",
    label: str = "is_fraud",
    pieces: int | None = None,
    local_rows: int | None = None,
) -> TreeModel:
    """``count`` trees of at most ``depth`` levels, each on a Poisson sample of the rows; probabilities are means over trees.

    ``per_split`` inputs, the root of their number if not given, may split a node. Rows of a node meet in one task if they count at
    most ``local_rows`` times, by default what :data:`LOCAL_BYTES` hold. A missing input is refused; no rows give a model without trees.
    """
    rows = train.count()
    if not rows:
        return grown(names, "mean", 0.0, [])
    per_split = per_split or max(1, int(len(names) ** 0.5))
    pieces = pieces or -(-rows // PIECE_ROWS)
    cuts = cut_points(train, names, rows, key=key)
    sizes = [len(c) + 1 for c in cuts]
    layout = Layout(bundles(sizes), sizes)
    local_rows = LOCAL_BYTES // (8 * layout.words) if local_rows is None else local_rows
    table = packed(train, names, cuts, pieces, key, label, together=layout.together).select("keys", "labels", "bins")
    state = held_blocks(table, pieces)
    weights = np.array(class_weights)
    done: list[dict[str, np.ndarray]] = []
    # A small node may be a whole tree: as many grow together as keep all cores busy.
    cores = train.sparkSession.sparkContext.defaultParallelism
    together = -(-TOGETHER // cores) * cores
    for start in range(0, count, together):
        trees = {t: Tree() for t in range(start, min(start + together, count))}
        small = {(t, 0): rows for t in trees if rows <= local_rows}
        large = [(t, 0) for t in trees if rows > local_rows]
        while large:
            frontier: dict[int, list[int]] = {t: [] for t in trees}
            for at in range(0, len(large), SLOTS):
                slots = large[at : at + SLOTS]
                allowed = drawn_inputs(np.array([t for t, _ in slots]), np.array([trees[t].path[i] for t, i in slots]), len(names), per_split)
                shapes = {t: trees[t].arrays() for t in dict(slots)}
                total = summed(state.mapPartitions(_sums(shapes, slots, allowed, layout)), allowed.size * BINS * 16)
                for (t, i), hist in zip(slots, total, strict=True):
                    trees[t].counts[i] = hist[0].sum(axis=0)
                going = [k for k, (t, i) in enumerate(slots) if trees[t].open_nodes([i], depth)]
                below = _divided(trees, [slots[k] for k in going], allowed[going], total[going], weights)
                for t, some in below.items():
                    frontier[t] += some
            nodes = [(t, i) for t, some in frontier.items() for i in trees[t].open_nodes(some, depth)]
            mass = {(t, i): int(trees[t].counts[i].sum()) for t, i in nodes}
            small.update((node, n) for node, n in mass.items() if n <= local_rows)
            large = [node for node, n in mass.items() if n > local_rows]
        if small:
            parts = min(len(small), max(3 * cores, -(-2 * sum(small.values()) // max(1, local_rows))))
            place = _dealt(small, parts)
            paths = {(t, i): trees[t].path[i] for t, i in small}
            shapes = {t: trees[t].arrays() for t, _ in small}
            sent = state.mapPartitions(_rows_of(shapes, list(small), layout)).partitionBy(parts, place.__getitem__)
            for (t, i), made in sent.mapPartitions(_finish(paths, layout, depth, per_split, weights)).collect():
                _graft(trees[t], i, *(np.frombuffer(b, k) for b, k in zip(made, _PARTS.values(), strict=True)))
            del sent
            forget_shuffles(train.sparkSession)
        # Flat arrays from here on: lists of all trees' nodes would fill the driver.
        done += [_compact(tree, cuts, weights) for tree in trees.values()]
    state.unpersist()
    drop_table(table)
    return grown(names, "mean", 0.0, done)


def _dealt(sizes: dict[tuple[int, int], int], parts: int) -> dict[tuple[int, int], int]:
    """A part for each node: the largest nodes first, each to the part with the fewest rows so far."""
    out, room = {}, [(0, p) for p in range(parts)]
    for node, n in sorted(sizes.items(), key=lambda item: (-item[1], item[0])):
        held, p = heapq.heappop(room)
        out[node] = p
        heapq.heappush(room, (held + n, p))
    return out


def _compact(tree: Tree, cuts: list[np.ndarray], weights: np.ndarray) -> dict[str, np.ndarray]:
    """A finished tree with its covers and values."""
    mass = np.array(tree.counts) * weights
    whole = mass.sum(axis=1)
    listed = {**tree.listed(cuts), "cover": whole, "value": mass[:, 1] / np.where(whole > 0, whole, 1.0)}
    return {c: np.asarray(v, np.int32 if c in ("input", "left", "right") else float) for c, v in listed.items()}


_PARTS = {"input": "<i4", "bin": "<i4", "left": "<i4", "right": "<i4", "gain": "<f8", "counts": "<i8"}


def _drawn_rows(blocks: Iterator[tuple], shapes: dict[int, tuple], nodes: list[tuple[int, int]], layout: Layout) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """The rows of each of ``nodes``, block by block: they go down their tree side by side."""
    on_way = {}
    for t, (inputs, _, left, right, _) in shapes.items():
        asked = np.zeros(len(inputs), np.int64)
        asked[[i for tree, i in nodes if tree == t]] = 2
        # Children come behind their parents.
        for i in np.flatnonzero(inputs >= 0)[::-1].tolist():
            asked[i] |= asked[left[i]] > 0 or asked[right[i]] > 0
        on_way[t] = asked
    for keys, labels, codes in blocks:
        rows = layout.rows(np.frombuffer(labels, np.uint8), np.frombuffer(codes, np.uint8))
        with np.errstate(over="ignore"):
            spread = np.frombuffer(keys, "<u8") * _U(0x9FB21C651E98DF25)
        for t, asked in on_way.items():
            inputs, last, left, right, _ = shapes[t]
            held = [(0, layout.drawn(rows, _times(spread, t)))]
            while held:
                i, mine = held.pop()
                if asked[i] >= 2:
                    yield (t, i), mine
                elif asked[i] and len(mine):
                    children = (int(left[i]), int(right[i]))
                    parts = layout.parts(mine, inputs[i], last[i], tuple(bool(asked[c]) for c in children))
                    held += [(c, part) for c, part in zip(children, parts, strict=True) if part is not None]


def _sums(shapes: dict[int, tuple], slots: list[tuple[int, int]], allowed: np.ndarray, layout: Layout):
    slot_of = {node: s for s, node in enumerate(slots)}

    def sums(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
        total = np.zeros((*allowed.shape, BINS, 2), np.int64)
        for node, rows in _drawn_rows(blocks, shapes, slots, layout):
            s = slot_of[node]
            total[s] += layout.histogram(rows, allowed[s])
        yield total

    return sums


def _rows_of(shapes: dict[int, tuple], small: list[tuple[int, int]], layout: Layout):
    def send(blocks: Iterator[tuple]) -> Iterator[tuple]:
        for node, rows in _drawn_rows(blocks, shapes, small, layout):
            if len(rows):
                yield node, rows.tobytes()

    return send


def _finish(paths: dict[tuple[int, int], int], layout: Layout, depth: int, per_split: int, weights: np.ndarray):
    def finish(sent: Iterator[tuple]) -> Iterator[tuple]:
        held: dict[tuple[int, int], list[bytes]] = {}
        for node, rows in sent:
            held.setdefault(node, []).append(rows)
        for node in list(held):
            rows = np.frombuffer(b"".join(held.pop(node)), np.uint64).reshape(-1, layout.words)
            tree = grown_locally(node[0], paths[node], rows, layout, depth, per_split, weights)
            columns = {**{c: getattr(tree, c) for c in ("input", "bin", "left", "right", "gain")}, "counts": np.array(tree.counts)}
            yield node, [np.ascontiguousarray(columns[c], k).tobytes() for c, k in _PARTS.items()]

    return finish


def _graft(tree: Tree, node: int, inputs: np.ndarray, bins: np.ndarray, left: np.ndarray, right: np.ndarray, gain: np.ndarray, counts: np.ndarray) -> None:
    """Puts a tree that was grown elsewhere in the place of one of its leaves."""
    shift = len(tree.input) - 1
    at = np.arange(len(inputs))
    place = np.where(at == 0, node, at + shift)
    leaf = inputs < 0
    ends = [np.where(leaf, place, place[c]) for c in (left, right)]
    for column, values in ((tree.input, inputs), (tree.bin, bins), (tree.left, ends[0]), (tree.right, ends[1]), (tree.gain, gain)):
        values = values.tolist()
        column[node] = values[0]
        column += values[1:]
    more = len(inputs) - 1
    tree.value += [0.0] * more
    tree.cover += [0.0] * more
    tree.path += [0] * more
    tree.counts[node], *others = counts.reshape(-1, 2)
    tree.counts += others
