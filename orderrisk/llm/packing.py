"""Packing of token sequences: combinations that fill a gap exactly are found by hashing length sums.

Pieces are interchangeable when they have the same length, so the plan is made from the number of
pieces of each length alone: at most ``capacity`` numbers, however many documents there are. Every step
of the plan uses up at least one length, which bounds its size too. The pieces then find their places
by their rank among the pieces of their length, side by side.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderrisk.session import cut_lineage

from .encode import encoder
from .words import slices

CAPACITY = 2048
#: Pieces of one length are ranked in so many deals at least, and in more where there are many pieces.
LEAST_DEALS, DEAL_ROWS = 64, 1 << 20
END_ID = 0


def pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The ids of each text and ``end_id``, cut into pieces of at most ``capacity`` ids.

    Columns: ``key``, piece (from 0), start (ids of the document before it), length, ids_crc32 and, if
    asked for, ids (little-endian unsigned 32-bit integers). A null or empty text is one piece of one id.
    """
    names = [key, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * with_ids]
    end = end_id.to_bytes(4, "little")

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Slices, not Spark's batches of so many rows: those hold texts and ids of any size at once.
        for part in slices(parts, 1):
            owner: list[int] = []
            rows: list[tuple] = []
            for at, ids in enumerate(encoder(tokenizer).ids(part.column(1).to_pylist())):
                ids += end
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    held = ids[start : start + 4 * capacity]
                    owner.append(at)
                    rows.append((piece, start // 4, len(held) // 4, zlib.crc32(held), *[held] * with_ids))
            if not rows:
                continue
            columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)), *columns], names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(key, text).mapInArrow(cut, schema)


def plan(available: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, number of such sequences) that use up ``available`` (length: pieces).

    From the longest length down: one, two or three other lengths whose sum is exactly the gap are
    consumed as often as their counts allow; what is left is packed best fit, longest first.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, count in available.items():
        left[length] += count
    made: list[tuple[tuple[int, ...], int]] = []

    def use(lengths: tuple[int, ...]) -> bool:
        need = Counter(lengths)
        times = min(int(left[x]) // n for x, n in need.items())
        if times:
            for x, n in need.items():
                left[x] -= n * times
            made.append((lengths, times))
        return times > 0

    def singles(gap: int) -> Iterator[tuple[int, ...]]:
        if left[gap]:
            yield (gap,)

    def pairs(gap: int) -> Iterator[tuple[int, ...]]:
        longer = np.arange(gap - 1, (gap - 1) // 2, -1)
        for a in longer[(left[longer] > 0) & (left[gap - longer] > 0)]:
            yield int(a), int(gap - a)

    def triples(gap: int) -> Iterator[tuple[int, ...]]:
        for a in np.flatnonzero(left[: max(gap - 1, 0)])[::-1]:
            for b, c in pairs(gap - int(a)):
                if b <= a:
                    yield int(a), b, c
                    if not left[a]:
                        break

    for longest in range(capacity, 0, -1):
        if not left[longest]:
            continue
        if longest == capacity:
            use((capacity,))
            continue
        for fills in (singles, pairs, triples):
            for filling in fills(capacity - longest):
                use((longest, *filling))
                if not left[longest]:
                    break
            if not left[longest]:
                break
    while left.any():
        rest, lengths = left.copy(), []
        gap = capacity
        while (fitting := np.flatnonzero(rest[1 : gap + 1])).size:
            best = int(fitting[-1]) + 1
            lengths.append(best)
            rest[best] -= 1
            gap -= best
        use(tuple(lengths))
    return made


def _slots(made: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, pieces a sequence, first sequence, offset) in ascending rank."""
    taken: Counter = Counter()
    sequence = 0
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    for lengths, times in made:
        offset = 0
        for length, n in sorted(Counter(lengths).items(), reverse=True):
            slots.setdefault(length, []).append((taken[length], n, sequence, offset))
            taken[length] += n * times
            offset += n * length
        sequence += times
    return {length: np.array(rows, np.int64) for length, rows in slots.items()}


def pack(found: DataFrame, capacity: int = CAPACITY, key: str = "doc_id") -> DataFrame:
    """``found`` (see :func:`pieces`) with sequence_id and offset: each piece's place in a sequence.

    Sequences have no gaps, hold at most ``capacity`` ids and keep every piece whole. Repeated rows have
    places of their own; an empty table stays empty.
    """
    found = cut_lineage(found)
    deals = max(LEAST_DEALS, found.count() // DEAL_ROWS)
    dealt = found.withColumn("_deal", F.expr(f"pmod(xxhash64(`{key}`, piece, ids_crc32), {deals})"))
    counts = dealt.groupBy("length", "_deal").agg(F.count("*").alias("_n"))
    by_deal = Window.partitionBy("length").orderBy("_deal")
    before = counts.select("length", "_deal", (F.sum("_n").over(by_deal) - F.col("_n")).alias("_before"))
    # At most ``capacity`` rows, one a length.
    available = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = _slots(plan(available, capacity))
    names = found.columns

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            length = part.column(names.index("length")).to_numpy()
            rank = part.column(len(names)).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for one in np.unique(length):
                at = np.flatnonzero(length == one)
                rows = slots[int(one)]
                first, n, base, start = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1].T
                sequence[at] = base + (rank[at] - first) // n
                offset[at] = start + (rank[at] - first) % n * one
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
            )

    among = Window.partitionBy("length", "_deal").orderBy(key, "piece", "ids_crc32")
    ranked = dealt.withColumn("_at", F.row_number().over(among) - 1).join(before, ["length", "_deal"])
    ranked = ranked.select(*names, (F.col("_before") + F.col("_at")).alias("_rank"))
    schema = found.schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place, schema)
