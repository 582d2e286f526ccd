"""Compression of vectors to short codes: Lloyd's algorithm on two trees, in integers.

Vectors are cut into equal parts and each part gets the number of its nearest codebook entry. A block of
vectors keeps, for each part position, a tree: the order of its rows (halved at the median of the widest
component, level by level) and each node's box, count and componentwise sum. The few entries get a tree
of the same kind in every round. Both are walked down together:

1. Pairs of a part node and an entry node whose boxes lie farther apart than the part node's worst distance
   to another entry node are dropped.
2. Once entry nodes are single entries, an entry also goes if another one is nearer to every point of the
   part node's box (a linear function, largest at a corner).
3. A part node with one entry left is assigned whole, by its cached sum. Leaves with more entries are settled
   row by row with integer distances to the entries that are left.

All bounds are integers too, so pruning changes no result. A round moves one row per task, part and entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderrisk.session import cut_lineage

from .spread import with_group

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Rows whose trees are built together, at most, and components of them; rows of a leaf.
BLOCK_ROWS = 8192
BLOCK_VALUES = 1 << 22
LEAF_ROWS = 16
#: Integers beyond this would let squared distances leave 64 bits.
LARGEST = 1 << 24


def _starts(rows: int, level: int) -> np.ndarray:
    """Where the nodes of a level begin, and the end."""
    return (np.arange((1 << level) + 1) * rows) >> level


@dataclass
class Tree:
    """Rows in tree order and, level after level from the root, each node's box and sum."""

    rows: np.ndarray
    low: list[np.ndarray]
    high: list[np.ndarray]
    sums: list[np.ndarray]

    @property
    def depth(self) -> int:
        return len(self.low) - 1


def tree_order(rows: np.ndarray, leaf: int) -> tuple[np.ndarray, int]:
    """The order that halves every node at the median of its widest component, and the number of levels below the root."""
    n = len(rows)
    depth = max(0, int(np.ceil(np.log2(max(1, n) / leaf)))) if n else 0
    order = np.arange(n)
    for level in range(depth if rows.shape[1] else 0):
        starts = _starts(n, level)
        held = rows[order]
        wide = np.maximum.reduceat(held, starts[:-1]) - np.minimum.reduceat(held, starts[:-1])
        size = np.diff(starts)
        node = np.repeat(np.arange(len(size)), size)
        value = held[np.arange(n), np.repeat(wide.argmax(axis=1), size)]
        order = order[np.lexsort((value, node))]
    return order, depth


def tree_of(rows: np.ndarray, depth: int) -> Tree:
    """The tree of rows that are in tree order already. Every node has at least one row."""
    starts = _starts(len(rows), depth)[:-1]
    low, high, sums = [np.minimum.reduceat(rows, starts)], [np.maximum.reduceat(rows, starts)], [np.add.reduceat(rows, starts)]
    for _ in range(depth):
        low.append(np.minimum(low[-1][::2], low[-1][1::2]))
        high.append(np.maximum(high[-1][::2], high[-1][1::2]))
        sums.append(sums[-1][::2] + sums[-1][1::2])
    return Tree(rows, low[::-1], high[::-1], sums[::-1])


@dataclass
class Assigned:
    """What one walk found: per entry counts and sums, and each row's entry (in tree order) if asked for."""

    counts: np.ndarray
    sums: np.ndarray
    entry: np.ndarray | None
    whole_rows: int


def _near_far(tree: Tree, at: int, node: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest squared distance between the node's box and the boxes beside it."""
    a, b = tree.low[at][node], tree.high[at][node]
    near = np.maximum(np.maximum(low - b, a - high), 0)
    far = np.maximum(b - low, high - a)
    return (near * near).sum(axis=1), (far * far).sum(axis=1)


def assign(tree: Tree, codebook: np.ndarray, labels: bool = False) -> Assigned:
    """Every row's nearest entry, ties to the lower number."""
    n, k = len(tree.rows), len(codebook)
    order, levels = tree_order(codebook, 1)
    entries = tree_of(codebook[order], levels) if k & (k - 1) == 0 else None
    counts, sums = np.zeros(k, np.int64), np.zeros(codebook.shape, np.int64)
    entry = np.zeros(n, np.int64) if labels else None
    whole_rows = 0
    # Pairs in order of the part node. Where the number of entries is no power of two they begin as single entries.
    node, other = (np.zeros(1, np.int64), np.zeros(1, np.int64)) if entries else (np.zeros(k, np.int64), np.arange(k))
    below = 0 if entries else levels
    squares = (codebook * codebook).sum(axis=1)
    for at in range(tree.depth + 1):
        if at:
            # Both children of a part node inherit its pairs.
            firsts = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1]))) if len(node) else np.zeros(0, np.int64)
            size = np.diff(np.append(firsts, len(node)))
            pick = np.concatenate((firsts, firsts))
            by = np.argsort(np.concatenate((2 * node[firsts], 2 * node[firsts] + 1)), kind="stable")
            pick, size2 = pick[by], np.concatenate((size, size))[by]
            child = np.concatenate((2 * node[firsts], 2 * node[firsts] + 1))[by]
            take = np.repeat(pick - np.cumsum(size2) + size2, size2) + np.arange(size2.sum())
            node, other = np.repeat(child, size2), other[take]
        if not len(node):
            break
        while True:
            if entries and below < levels:
                below += 1
                node, other = np.repeat(node, 2), (2 * other[:, None] + np.arange(2)).ravel()
            single = below == levels
            if single and entries:
                which = order[other]
            else:
                which = other
            low = codebook[which] if single else entries.low[below][other]
            high = codebook[which] if single else entries.high[below][other]
            near, far = _near_far(tree, at, node, low, high)
            firsts = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
            group = np.cumsum(np.concatenate(([True], node[1:] != node[:-1]))) - 1
            kept = near <= np.minimum.reduceat(far, firsts)[group]
            if single:
                # The entry with the smallest worst distance stands for the node; it beats those that are farther everywhere.
                best = np.lexsort((which, far, group))[firsts]
                lead = which[best][group]
                step = codebook[which] - codebook[lead]
                corner = np.where(step > 0, tree.high[at][node], tree.low[at][node])
                behind = squares[lead] - squares[which] + 2 * (step * corner).sum(axis=1)
                kept &= ~((behind < 0) | ((behind == 0) & (lead < which)))
            node, other = node[kept], other[kept]
            if single or at < tree.depth:
                break
        if not single:
            continue
        which = order[other] if entries else other
        alone = np.ones(len(node), bool)
        alone[1:] &= node[1:] != node[:-1]
        alone[:-1] &= node[1:] != node[:-1]
        starts = _starts(n, at)
        done, to = node[alone], which[alone]
        np.add.at(counts, to, starts[done + 1] - starts[done])
        np.add.at(sums, to, tree.sums[at][done])
        size = starts[done + 1] - starts[done]
        whole_rows += int(size.sum())
        if labels:
            entry[np.repeat(starts[done] - np.cumsum(size) + size, size) + np.arange(size.sum())] = np.repeat(to, size)
        node, other, which = node[~alone], other[~alone], which[~alone]
        if at == tree.depth and len(node):
            size = starts[node + 1] - starts[node]
            row = np.repeat(starts[node] - np.cumsum(size) + size, size) + np.arange(size.sum())
            to = np.repeat(which, size)
            gaps = tree.rows[row] - codebook[to]
            places = np.unique(row)
            table = np.full((len(places), k), np.iinfo(np.int64).max)
            table[np.searchsorted(places, row), to] = (gaps * gaps).sum(axis=1)
            chosen = table.argmin(axis=1)
            counts += np.bincount(chosen, minlength=k)
            np.add.at(sums, chosen, tree.rows[places])
            if labels:
                entry[places] = chosen
    return Assigned(counts, sums, entry, whole_rows)


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of exactly ``rows`` rows, but for the last."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - count)
            held.append(part)
            count += part.num_rows
            batch = batch.slice(part.num_rows)
            if count == rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, count = [], 0
    if count:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, np.ndarray]:
    """(``key``, ``label``, code, error) per row with a finite vector, and the codebooks (part, entry, component).

    Rows whose vector is null or holds null or non-finite components are dropped. Each component x counts as
    floor(4096 x). The codebook begins with the ``entries`` rows of smallest key (then of smallest vector; a null key comes
    last), fewer if there are fewer rows; repeated rows count each. Ties of distance go to the lower entry,
    and unused entries stay. The length of the first row's vector that ``parts`` divides is the length of all;
    rows of another length keep a null code and error. An empty table gives no rows and no
    codebooks. Further columns are left out. Integers above ``LARGEST`` are refused by name.
    """
    spark = vectors.sparkSession
    kind, label_kind = (vectors.schema[c].dataType.simpleString() for c in (key, label))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    kept = vectors.where(F.col(vector).isNotNull() & finite).select(F.col(key).alias("id"), F.col(label).alias("label"), whole.alias("v"))
    fits = (F.size("v") > 0) & (F.size("v") % parts == 0)
    first = kept.where(fits).orderBy(F.col("id").asc_nulls_last(), "v").limit(1).select(F.size("v")).collect()
    width = first[0][0] if first else parts
    per = width // parts
    schema = f"`{key}` {kind}, `{label}` {label_kind}, code string, error long"
    start = kept.where(F.size("v") == width).orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not start:
        odd = kept.select(F.col("id").alias(key), F.col("label").alias(label), F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        return odd, np.zeros((parts, 0, per), np.int64)

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["ids", "labels", "orders", "values"]
        for block in _blocks(batches, max(LEAF_ROWS, min(block_rows, BLOCK_VALUES // width))):
            values = _matrix(block.column(2), width)
            if len(values) and np.abs(values).max() > LARGEST:
                at = int(np.abs(values).max(axis=1).argmax())
                raise ValueError(f"{key} {block.column(0)[at].as_py()}: a component beyond {LARGEST // SCALE} has no 64-bit distances")
            orders = [tree_order(values[:, p * per : (p + 1) * per], LEAF_ROWS)[0] for p in range(parts)]
            made = [values[o, p * per : (p + 1) * per].astype("<i4").tobytes() for p, o in enumerate(orders)]
            ends = np.array([0, block.num_rows], np.int32)
            columns = [pa.ListArray.from_arrays(ends, block.column(i)) for i in (0, 1)]
            blobs = [pa.array([[o.astype("<i4").tobytes() for o in orders]], pa.list_(pa.binary())), pa.array([made], pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays([*columns, *blobs], names)

    def trees(block: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray], list[Tree]]]:
        for i in range(block.num_rows):
            orders = [np.frombuffer(x.as_buffer(), "<i4") for x in block.column("orders")[i].values]
            depth = max(0, int(np.ceil(np.log2(len(orders[0]) / LEAF_ROWS))))
            planted = [tree_of(np.frombuffer(x.as_buffer(), "<i4").astype(np.int64).reshape(-1, per), depth) for x in block.column("values")[i].values]
            yield i, orders, planted

    blocks = kept.where(F.size("v") == width).mapInArrow(plant, f"ids array<{kind}>, labels array<{label_kind}>, orders array<binary>, values array<binary>")
    blocks = cut_lineage(blocks)
    # parts x entries small vectors, whatever the number of rows.
    books = np.array([r["v"] for r in start], np.int64).reshape(len(start), parts, per).transpose(1, 0, 2)

    def round_of(books: np.ndarray):
        def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts, sums = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
            for block in batches:
                for _, _, planted in trees(block):
                    for p, tree in enumerate(planted):
                        found = assign(tree, books[p])
                        counts[p] += found.counts
                        sums[p] += found.sums
            part, entry = np.nonzero(counts)
            columns = [part.astype(np.int32), entry.astype(np.int32), counts[part, entry]]
            some = pa.array(list(sums[part, entry]), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), some], ["part", "entry", "n", "sums"])

        return tally

    for _ in range(rounds):
        found = blocks.select("orders", "values").mapInArrow(round_of(books), "part int, entry int, n long, sums array<long>")
        total = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(per)))
        books = books.copy()
        for r in total.collect():
            books[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(per)]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches:
            for i, orders, planted in trees(block):
                codes, error = np.zeros((len(orders[0]), parts), np.uint8), np.zeros(len(orders[0]), np.int64)
                for p, tree in enumerate(planted):
                    entry = assign(tree, books[p], labels=True).entry
                    gaps = tree.rows - books[p][entry]
                    codes[orders[p], p] = entry
                    error[orders[p]] += (gaps * gaps).sum(axis=1)
                text = codes.tobytes().hex()
                code = pa.array([text[2 * parts * j : 2 * parts * (j + 1)] for j in range(len(codes))], pa.string())
                yield pa.RecordBatch.from_arrays([block.column("ids")[i].values, block.column("labels")[i].values, code, pa.array(error)], [key, label, "code", "error"])

    coded = blocks.mapInArrow(encode, schema)
    none = [F.lit(None).cast(t).alias(c) for c, t in (("code", "string"), ("error", "long"))]
    odd = kept.where(F.size("v") != width).select(F.col("id").alias(key), F.col("label").alias(label), *none)
    return coded.unionByName(odd), books


def digest(books: np.ndarray) -> str:
    """Hash of all components in order, as decimal text."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def coded(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", **how) -> DataFrame:
    """``compress`` with label_error (the error summed over rows of equal label, nulls together) and the codebooks' hash."""
    rows, books = compress(vectors, key=key, vector=vector, label=label, **how)
    rows = cut_lineage(rows)
    found = with_group(rows, [label], {"label_error": (F.sum, F.col("error"))}, [key, "code"], nulls=True)
    return found.select(key, label, "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
