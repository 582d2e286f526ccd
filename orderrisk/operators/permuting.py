"""Loss of accuracy when one input is permuted, over the whole table.

Rows have dense ranks (from the counts of the pieces they lie in), and a keyed Feistel network permutes the ranks: a bijection
that any row can work out for itself. So every row donates exactly once, without a window, a sort or blocks. One
join hands each row its donors; all changed copies of a row are scored inside its batch, and only counts of right
answers leave the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderrisk.session import cut_lineage

from .trees import matrix, vector

FEISTEL_ROUNDS = 6
# Rows whose copies are scored together.
_BATCH = 2048


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def permutation(ranks: np.ndarray, n: int, key: int) -> np.ndarray:
    """The place of each of ``ranks`` (0 to n - 1) in the permutation that ``key`` names.

    The network permutes all numbers of an even number of bits; those from ``n`` on are sent through it again until they
    fall below, at most three times as often as not.
    """
    half = np.uint64(max(1, ((n - 1).bit_length() + 1) // 2))
    low = (np.uint64(1) << half) - np.uint64(1)
    out = ranks.astype(np.uint64)
    left_over = np.arange(len(out))
    with np.errstate(over="ignore"):
        keys = _mixed(np.uint64(key) * np.uint64(FEISTEL_ROUNDS) + np.arange(FEISTEL_ROUNDS, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D))
        while len(left_over):
            a, b = out[left_over] >> half, out[left_over] & low
            for k in keys:
                a, b = b, a ^ (_mixed(b + k) & low)
            out[left_over] = (a << half) | b
            left_over = left_over[out[left_over] >= np.uint64(n)]
    return out.astype(np.int64)


def ranked(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` as a written table with ``rank``, 0 to n - 1, and n. The ranks are in the table, so they stay when it is read again."""
    held = cut_lineage(rows.withColumn("_at", F.monotonically_increasing_id()))
    # The upper bits number the piece, the lower ones the row in it. One row a piece comes to the driver.
    piece = F.shiftrightunsigned("_at", 33)
    counts = held.groupBy(piece.alias("piece")).agg(F.count("*").alias("n")).orderBy("piece").collect()
    before = np.cumsum([0, *[r["n"] for r in counts]])
    offsets = held.sparkSession.createDataFrame([(r["piece"], int(b)) for r, b in zip(counts, before, strict=False)], "_piece long, _before long")
    out = held.withColumn("_piece", piece).join(offsets, "_piece").withColumn("rank", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    return out.drop("_at", "_piece", "_before"), int(before[-1])


def permuted(rows: DataFrame, repeats: int) -> DataFrame:
    """(rank, ..., donors): each row beside the ``x`` of ``repeats`` others, each of which donates once per repeat.

    ``rows`` has x. The ranks of the donors are worked out in batches; the join by rank is spread evenly by nature.
    """
    numbered, n = ranked(rows)
    numbered = cut_lineage(numbered)

    def choose(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rank = part.column(0).to_numpy()
            donors = np.concatenate([permutation(rank, n, r) for r in range(repeats)])
            repeat = np.repeat(np.arange(repeats, dtype=np.int32), len(rank))
            yield pa.RecordBatch.from_arrays([pa.array(donors), pa.array(np.tile(rank, repeats)), pa.array(repeat)], ["rank", "taker", "repeat"])

    asked = numbered.select("rank").mapInArrow(choose, "rank long, taker long, repeat int")
    given = asked.join(numbered.select("rank", "x"), "rank").groupBy("taker").agg(F.sort_array(F.collect_list(F.struct("repeat", "x"))).alias("_given"))
    return numbered.join(given.withColumnRenamed("taker", "rank"), "rank").withColumn("donors", F.col("_given.x")).drop("_given")


def accuracy_drops(
    rows: DataFrame,
    names: list[str],
    probability: Callable[[np.ndarray], np.ndarray],
    repeats: int,
    threshold: float,
    label: str = "is_fraud",
    replaced: Callable[[np.ndarray], Iterable[Callable[[np.ndarray], np.ndarray]]] | None = None,
) -> DataFrame:
    """(feature, mean_drop, std_drop) over ``repeats`` permutations of each input.

    ``probability`` scores a matrix of inputs; a row counts as right if its label is 1 exactly where it reaches ``threshold``.
    ``replaced`` gives for a matrix and each input the probabilities with other values of that input; without it
    changed copies of the rows are scored whole. No rows give no drops.
    """
    pairs = permuted(rows.select(F.col(label).cast("int").alias("label"), vector(names).alias("x")), repeats)
    width = len(names)

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, base, n = np.zeros((repeats, width), np.int64), 0, 0
        for batch in parts:
            for start in range(0, batch.num_rows, max(1, _BATCH // width)):
                part = batch.slice(start, max(1, _BATCH // width))
                y, x = part.column(0).to_numpy() == 1, matrix(part.column(1))
                donors = matrix(part.column(2).flatten()).reshape(len(x), repeats, width)
                n += len(x)
                base += int(((probability(x) >= threshold) == y).sum())
                if replaced is not None:
                    for f, changed in enumerate(replaced(x)):
                        for r in range(repeats):
                            right[r, f] += int(((changed(donors[:, r, f]) >= threshold) == y).sum())
                    continue
                for r in range(repeats):
                    # One copy of the rows for each input, changed there.
                    copies = np.repeat(x[None], width, axis=0)
                    copies[np.arange(width), :, np.arange(width)] = donors[:, r].T
                    hit = (probability(copies.reshape(-1, width)) >= threshold).reshape(width, len(x)) == y
                    right[r] += hit.sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([base]), pa.array([right.ravel().tolist()], pa.list_(pa.int64()))], ["n", "base", "right"])

    counts = pairs.select("label", "x", "donors").mapInArrow(count, "n long, base long, right array<long>")
    flat = counts.select("n", "base", F.posexplode("right").alias("place", "right")).groupBy("place").agg(*(F.sum(c).alias(c) for c in ("n", "base", "right")))
    drop = (F.col("base") - F.col("right")) / F.col("n")
    feature = F.array(*[F.lit(name) for name in names])[(F.col("place") % width).cast("int")]
    return flat.where("n > 0").groupBy(feature.alias("feature")).agg(F.avg(drop).alias("mean_drop"), F.stddev_pop(drop).alias("std_drop"))
