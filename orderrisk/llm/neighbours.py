"""Approximate nearest neighbours by cosine: p-stable hashing with several probes a table.

A table hashes a vector (scaled to length 1) by ``m`` random projections, each cut into steps. A
neighbour at cosine c has projections that scatter around the query's own by a known normal law, so the
probability that it lies in any given bucket is known too. Buckets are visited in descending order of
that probability until their sum reaches what the recall goal asks of a table. The first round aims at
near neighbours; queries whose fifth neighbour turned out farther away visit more buckets in a second.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderrisk.session import cut_lineage

TABLES = 4
STEP = 1.2
#: Wanted probability that a neighbour shares a visited bucket in one table at least.
GOAL = 0.985
FIRST_COSINE = 0.9
BUCKET_ROWS = 512
_REACH = 4


class Hashes:
    """The projections of all tables; their number grows with the logarithm of the rows."""

    def __init__(self, rows: int, dimension: int, tables: int = TABLES, seed: int = 11) -> None:
        self.tables = tables
        self.m = max(0, round(math.log(max(rows, 1) / BUCKET_ROWS) / math.log(3.5))) if rows > 4 * BUCKET_ROWS else 0
        draw = np.random.default_rng(seed)
        self._lines = draw.standard_normal((tables * self.m, dimension))
        self._shifts = draw.uniform(0, STEP, tables * self.m)

    def places(self, units: np.ndarray) -> np.ndarray:
        """(vectors, tables, m) projections in steps; the bucket is the whole part."""
        return ((units @ self._lines.T + self._shifts) / STEP).reshape(len(units), self.tables, self.m)

    def probes(self, place: np.ndarray, cosine: float) -> list[tuple[int, ...]]:
        """Buckets of one table in descending probability, until they hold what the goal asks for."""
        wanted = 1 - (1 - GOAL) ** (1 / self.tables)
        spread = math.sqrt(max(2 * (1 - cosine), 1e-6)) / STEP
        options: list[list[tuple[float, int]]] = []
        for x in place:
            own = math.floor(x)
            ends = [0.5 * math.erf((own + d - x) / spread / math.sqrt(2)) for d in range(-_REACH, _REACH + 2)]
            masses = [(max(b - a, 1e-300), own + d) for d, (a, b) in enumerate(zip(ends, ends[1:], strict=False), -_REACH)]
            options.append(sorted(masses, reverse=True))
        start = (0,) * len(options)
        heap = [(-math.prod(o[0][0] for o in options), start, 0)]
        found, mass = [], 0.0
        while heap and mass < wanted:
            chance, at, last = heapq.heappop(heap)
            mass -= chance
            found.append(tuple(o[i][1] for o, i in zip(options, at, strict=True)))
            for j in range(last, len(options)):
                if at[j] + 1 < len(options[j]):
                    more = -chance * options[j][at[j] + 1][0] / options[j][at[j]][0]
                    heapq.heappush(heap, (-more, (*at[:j], at[j] + 1, *at[j + 1 :]), j))
        return found


def _key(table: int, bucket: tuple[int, ...] | list[int]) -> str:
    return f"{table}:" + ",".join(map(str, bucket))


def _vectors(data: pa.Array | pa.ChunkedArray) -> np.ndarray:
    rows = data.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key and vector (bytes of doubles) of the vectors that take part.

    Null and zero vectors, those with null or non-finite components and those of a length other than the
    most frequent one (of equally frequent ones the larger) do not.
    """

    def clean(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            kept = []
            for x in part.column(1).to_pylist():
                x = None if x is None or None in x else np.array(x, np.float64)
                kept.append(x.tobytes() if x is not None and x.size and np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(kept, pa.binary())], ["vec_id", "vector"])

    rows = vectors.select(F.col(key).cast("long"), vector).mapInArrow(clean, "vec_id long, vector binary")
    rows = cut_lineage(rows.where("vec_id is not null and vector is not null").distinct())
    lengths = rows.groupBy(F.length("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).head(1)
    return rows.where(F.length("vector") == (lengths[0]["size"] if lengths else 0))


def _index(rows: DataFrame, hashes: Hashes) -> tuple[DataFrame, DataFrame]:
    """Rows by (bucket, block) and the number of blocks of each bucket; frequent buckets have many."""

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not part.num_rows:
                continue
            buckets = np.floor(hashes.places(_units(_vectors(part.column(1))))).astype(int)
            for table in range(hashes.tables if hashes.m else 1):
                names = [_key(table, b) for b in buckets[:, table].tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *part.columns], ["bucket", "vec_id", "vector"])

    placed = cut_lineage(rows.mapInArrow(place, "bucket string, vec_id long, vector binary"))
    blocks = placed.groupBy("bucket").agg(F.expr(f"cast(ceil(count(*) / {BUCKET_ROWS}) as int)").alias("blocks"))
    blocks = cut_lineage(blocks)
    dealt = placed.join(blocks, "bucket").withColumn("block", F.expr("cast(pmod(xxhash64(vec_id), blocks) as int)"))
    return cut_lineage(dealt.drop("blocks")), blocks


def _round(asked: DataFrame, index: DataFrame, blocks: DataFrame, hashes: Hashes, k: int) -> DataFrame:
    """Each query's nearest rows in every block that it visits. ``asked``: vec_id, vector, cosine, least.

    Only rows of score ``least`` or more come out: a query that knows ``k`` rows needs no farther ones.
    """

    def probe(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not part.num_rows:
                continue
            places = hashes.places(_units(_vectors(part.column(1))))
            who, names = [], []
            for i, cosine in enumerate(part.column(2).to_pylist()):
                for table in range(hashes.tables if hashes.m else 1):
                    for bucket in hashes.probes(places[i, table], cosine):
                        who.append(i)
                        names.append(_key(table, bucket))
            who = pa.array(who, pa.int64())
            columns = [part.column(i).take(who) for i in (0, 1, 3)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *columns], ["bucket", "query_id", "query", "least"])

    def nearest(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if rows.num_rows and asked.num_rows:
            ids, x = rows["vec_id"].to_numpy(), _units(_vectors(rows["vector"]))
            for at in range(0, asked.num_rows, 1024):
                some = asked.slice(at, 1024)
                queries, y = some["query_id"].to_numpy(), _units(_vectors(some["query"]))
                close = y @ x.T
                close[queries[:, None] == ids[None, :]] = -2
                floor = np.partition(close, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(y), -1.5)
                floor = np.maximum(floor, some["least"].to_numpy())
                for i, (one, least) in enumerate(zip(close, floor, strict=True)):
                    near = np.flatnonzero(one >= max(least - 1e-9, -1.5))
                    # Summed the same way wherever the row lies, so that equal vectors have equal scores.
                    exact = (x[near] * y[i]).sum(axis=1)
                    best = np.lexsort((ids[near], -exact))[:k]
                    for held, more in zip(out, (np.full(len(best), queries[i]), ids[near][best], exact[best]), strict=True):
                        held.append(more)
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table(dict(zip(("query_id", "vec_id", "score"), (np.concatenate([e, *o]) for e, o in zip(empty, out, strict=True)), strict=True)))

    probes = asked.mapInArrow(probe, "bucket string, query_id long, query binary, least double").join(blocks, "bucket")
    probes = probes.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    by = ["bucket", "block"]
    found = index.groupBy(*by).cogroup(probes.groupBy(*by)).applyInArrow(nearest, "query_id long, vec_id long, score double")
    return found


def _best(found: DataFrame, k: int) -> DataFrame:
    """A query's rows are at most ``k`` for each block that it visits."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    vectors: DataFrame, every: int = 50, k: int = 5, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for each row whose key is divisible by ``every``.

    Nearness is the cosine in double precision, ties go to the smaller key, a query never finds its own
    key, rows without a key take no part, rows repeated whole count once and of rows that share a key the
    nearest one counts. See :func:`usable` for vectors that take no part. An empty table gives no rows.
    """
    spark: SparkSession = vectors.sparkSession
    rows = usable(vectors, key, vector)
    first = rows.head(1)
    hashes = Hashes(rows.count(), len(first[0]["vector"]) // 8 if first else 1)
    index, blocks = _index(rows, hashes)
    queries = rows.where(F.col("vec_id") % every == 0)
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    queries = queries.repartition(n, "vec_id")
    first_round = queries.withColumns({"cosine": F.lit(FIRST_COSINE), "least": F.lit(-2.0)})
    near = cut_lineage(_round(first_round, index, blocks, hashes, k))
    reached = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"))
    reached = reached.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k)
    far = queries.join(reached.select(F.col("query_id").alias("vec_id"), "score"), "vec_id", "left")
    far = far.select(
        "vec_id", "vector", F.coalesce("score", F.lit(-1.0)).alias("cosine"), F.coalesce("score", F.lit(-2.0)).alias("least")
    ).where(F.col("cosine") < FIRST_COSINE)
    found = near.unionByName(_round(far, index, blocks, hashes, k)) if hashes.m else near
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
