"""Ranked lexical search with the Best Position Algorithm over impact lists.

Documents are indexed in shards of bounded size that hold, for each term that a query may ask for, its postings
(document and frequency). Which terms those are tells a bit filter of bounded size. Collection statistics are sums
over the shards. Queries are searched in blocks of bounded size, each block in one pass over all shards.

A shard turns the postings of a query's terms into lists by falling impact. Each list is read from its best
position, the first that has not been seen. Every new document is looked up in all lists (direct access), which
marks its positions there as seen too, so that best positions run ahead of the places read. A document
that has not been met lies at or behind every best position, hence scores at most the sum of the impacts there. The
search of a shard stops when that sum is strictly below the k-th best score that its task knows, from this shard and
those before.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderrisk.session import cut_lineage

from .decontaminate import _filter
from .words import PLAIN, slices, words

TOP = 10
SHARD_BYTES = 1 << 23
#: (query, term) pairs that are searched in one pass and come to the driver together.
BLOCK_TERMS = 200_000
#: Places of each list that the first step reads; every further step reads twice as many.
FIRST_STEP = 8
#: Pieces in which the best documents of one query are ranked before they meet.
RANK_SALTS = 16


def query_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """(query, id, term): the distinct terms of each row, numbered in a written table."""
    kind = queries.schema[key].dataType.simpleString()
    rows = cut_lineage(queries.select(F.monotonically_increasing_id().alias("query"), F.col(key).alias("id"), F.col(text).alias("text")))

    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts, 2):
            hashes, ends = words(part.column(2), PLAIN)
            owner = np.repeat(np.arange(part.num_rows), np.diff(ends))
            order = np.lexsort((hashes, owner))
            hashes, owner = hashes[order], owner[order]
            new = _changes(owner, hashes)
            who = pa.array(owner[new])
            yield pa.RecordBatch.from_arrays([part.column(0).take(who), part.column(1).take(who), pa.array(hashes[new].view(np.int64))], ["query", "id", "term"])

    return cut_lineage(rows.mapInArrow(find, f"query long, id {kind}, term long"))


def _changes(*columns: np.ndarray) -> np.ndarray:
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def shards(docs: DataFrame, bits: int, table: np.ndarray, key: str, text: str) -> DataFrame:
    """Postings of the terms in the filter, by term and document, with each document's number of terms."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def build(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        for part in slices(parts, 1, SHARD_BYTES):
            hashes, ends = words(part.column(1), PLAIN)
            size = np.diff(ends)
            owner = np.repeat(np.arange(part.num_rows, dtype=np.int64), size)
            place = hashes >> np.uint64(64 - bits)
            asked = (marks[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
            hashes, owner = hashes[asked], owner[asked]
            order = np.lexsort((owner, hashes))
            hashes, owner = hashes[order], owner[order]
            first = np.flatnonzero(_changes(hashes, owner)) if len(hashes) else np.zeros(0, np.int64)
            times = np.diff(np.append(first, len(hashes)))
            hashes, owner = hashes[first], owner[first]
            starts = np.flatnonzero(_changes(hashes)) if len(hashes) else np.zeros(0, np.int64)
            numbers = [pa.array([x], pa.int64()) for x in (int((size > 0).sum()), int(size.sum()))]
            ids = pa.ListArray.from_arrays(np.array([0, part.num_rows], np.int32), part.column(0))
            blobs = (size.astype("<i8"), hashes[starts], np.append(starts, len(hashes)).astype("<i8"), owner.astype("<u4"), times.astype("<u4"))
            columns = [*numbers, ids, *(pa.array([x.tobytes()], pa.binary()) for x in blobs)]
            yield pa.RecordBatch.from_arrays(columns, ["n_docs", "n_terms", "ids", "sizes", "terms", "starts", "owners", "times"])

    schema = f"n_docs long, n_terms long, ids array<{kind}>, sizes binary, terms binary, starts binary, owners binary, times binary"
    return cut_lineage(docs.select(key, text).mapInArrow(build, schema))


def document_counts(index: DataFrame) -> DataFrame:
    """(term, df), summed over the shards of a task before anything moves."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, df = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                more = np.frombuffer(batch.column(0)[i].as_buffer(), "<u8")
                held = np.diff(np.frombuffer(batch.column(1)[i].as_buffer(), "<i8"))
                terms, at = np.unique(np.concatenate((terms, more)), return_inverse=True)
                df = np.bincount(at, np.concatenate((df, held)), len(terms)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(df)], ["term", "df"])

    return index.select("terms", "starts").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


@dataclass
class Lists:
    """Impact lists of one shard: list t holds places ``starts[t]:starts[t + 1]``, best first.

    ``keys`` (list * documents + document) is in order and tells for each posting its place in its list and its impact.
    """

    n_docs: int
    starts: np.ndarray
    docs: np.ndarray
    impacts: np.ndarray
    keys: np.ndarray
    places: np.ndarray
    key_impacts: np.ndarray

    @classmethod
    def of(cls, n_docs: int, ends: np.ndarray, docs: np.ndarray, impacts: np.ndarray) -> Lists:
        lists = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        order = np.lexsort((docs, -impacts, lists))
        places = np.empty(len(docs), np.int64)
        places[order] = np.arange(len(docs)) - ends[lists]
        return cls(n_docs, ends, docs[order], impacts[order], lists * n_docs + docs, places, impacts)


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def best_positions(lists: Lists, asked: np.ndarray, k: int, known: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents and scores that hold the shard's k best for the lists ``asked``, and the places read in order.

    Documents that score below ``known``, the k-th best score of other shards, may be left out; so may those without a score.
    """
    begin, size = lists.starts[asked], np.diff(lists.starts)[asked]
    offset = np.concatenate(([0], np.cumsum(size)))
    seen, met = np.zeros(offset[-1], bool), np.zeros(lists.n_docs, bool)
    position = np.zeros(len(asked), np.int64)
    found, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    top = np.full(k, known, np.int64)
    step, read = FIRST_STEP, 0
    while True:
        open_lists = position < size
        bound = lists.impacts[(begin + position)[open_lists]].sum()
        if bound == 0 or bound < top[0]:
            return np.concatenate(found), np.concatenate(scores), read
        places = _runs(begin + position, np.minimum(size - position, step))
        read += len(places)
        docs = np.unique(lists.docs[places])
        docs = docs[~met[docs]]
        met[docs] = True
        # Direct access to the new documents in every list.
        wanted = (asked * lists.n_docs)[None, :] + docs[:, None]
        at = np.minimum(np.searchsorted(lists.keys, wanted.ravel()), len(lists.keys) - 1).reshape(wanted.shape)
        hit = lists.keys[at] == wanted
        total = np.where(hit, lists.key_impacts[at], 0).sum(axis=1)
        seen[(offset[:-1][None, :] + lists.places[at])[hit]] = True
        found.append(docs)
        scores.append(total)
        # k documents of other shards score ``known`` or more.
        top = np.sort(np.concatenate((top, total)))[-k:]
        unseen = np.append(np.flatnonzero(~seen), offset[-1])
        position = np.minimum(unseen[np.searchsorted(unseen, offset[:-1])], offset[1:]) - offset[:-1]
        step *= 2


def _searched(block: list, n_docs: int, n_terms: int, k: int):
    """The task function that ranks one block of queries, given as (query, term, df)."""
    queries = np.array([r["query"] for r in block], np.int64)
    terms = np.array([r["term"] for r in block], np.int64).view(np.uint64)
    known, which = np.unique(terms, return_inverse=True)
    df = np.zeros(len(known), np.int64)
    df[which] = [r["df"] for r in block]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    order = np.lexsort((which, queries))
    queries, which = queries[order], which[order]
    numbers = np.unique(queries)
    ends = np.searchsorted(queries, np.append(numbers, numbers[-1] + 1))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {}
        kind = None
        for batch in batches:
            kind = batch.column("ids").type.value_type
            for i in range(batch.num_rows):
                sizes, starts = (np.frombuffer(batch.column(c)[i].as_buffer(), "<i8") for c in ("sizes", "starts"))
                held = np.frombuffer(batch.column("terms")[i].as_buffer(), "<u8")
                at = np.minimum(np.searchsorted(known, held), len(known) - 1)
                mine = np.flatnonzero(known[at] == held)
                if not len(mine):
                    continue
                counts = np.diff(starts)[mine]
                picked = _runs(starts[mine], counts)
                owners, times = (np.frombuffer(batch.column(c)[i].as_buffer(), "<u4").astype(np.int64)[picked] for c in ("owners", "times"))
                length = 10 + 90 * sizes * n_docs // n_terms
                impacts = np.repeat(weight[at[mine]], counts) * (1_000_000_000 * times // (1000 * times + 8 * length[owners]))
                lists = Lists.of(len(sizes), np.concatenate(([0], np.cumsum(counts))), owners, impacts)
                list_of = np.full(len(known), -1)
                list_of[at[mine]] = np.arange(len(mine))
                ids = batch.column("ids")[i].values
                # Nulls last.
                rank = np.empty(len(ids), np.int64)
                rank[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
                for q, a, b in zip(numbers.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    asked = list_of[which[a:b]]
                    asked = asked[asked >= 0]
                    if not len(asked):
                        continue
                    now = best.get(q, [])
                    docs, scores, _ = best_positions(lists, asked, k, now[-1][0] if len(now) == k else 0)
                    good = np.flatnonzero(scores > 0)
                    good = good[np.lexsort((rank[docs[good]], -scores[good]))[:k]]
                    if len(good):
                        more = list(zip(scores[good].tolist(), ids.take(pa.array(docs[good])).to_pylist(), strict=True))
                        best[q] = sorted([*now, *more], key=lambda x: (-x[0], x[1] is None, 0 if x[1] is None else x[1]))[:k]
        if best:
            rows = [(q, d, s) for q, found in best.items() for s, d in found]
            columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), kind, pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["query", "doc", "score"])

    return search


def ranked(
    docs: DataFrame,
    queries: DataFrame,
    k: int = TOP,
    key: str = "doc_id",
    text: str = "text",
    query_key: str = "item_id",
    query_text: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(``query_key``, rank, ``key``, score): the k documents of highest score above 0 for each row of ``queries``.

    Terms are runs of ASCII letters and digits and of everything beyond ASCII in whole texts of any length, A-Z
    as a-z; null and empty texts have none, and a query without terms or with unknown ones only has no rows. Every row of
    ``queries`` is a query and every row of ``docs`` a document, so repeated rows are ranked each; a null key is a key and
    comes last among equal scores, which otherwise go by ascending key. Empty tables give no rows, and
    further columns are left out. Terms are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    kind, query_kind = docs.schema[key].dataType.simpleString(), queries.schema[query_key].dataType.simpleString()
    asked = query_terms(queries, query_key, query_text)
    bits, table = _filter(asked.select(F.col("term").alias("fingerprint")).distinct())
    index = shards(docs, bits, table, key, text)
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).head()
    weighed = cut_lineage(asked.join(document_counts(index), "term").select("query", "term", "df"))
    blocks = max(1, -(-weighed.count() // block_terms))
    found = spark.createDataFrame([], f"query long, doc {kind}, score long")
    for b in range(blocks):
        # About ``block_terms`` small rows; a query's own terms stay together.
        block = weighed.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b).collect()
        if block:
            found = found.unionByName(index.mapInArrow(_searched(block, n_docs, n_terms, k), f"query long, doc {kind}, score long"))
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(RANK_SALTS)))
    for by in (["query", "salt"], ["query"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
    names = asked.select("query", F.col("id").cast(query_kind).alias(query_key)).distinct()
    return names.join(salted, "query").select(query_key, "rank", F.col("doc").alias(key), "score")
