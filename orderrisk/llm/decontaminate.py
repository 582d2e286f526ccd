"""Benchmark decontamination by winnowing.

Of each window of ``WINDOW`` words the smallest hash of its runs of ``GRAM`` words is the fingerprint.
Equal windows have equal fingerprints, so every shared span of ``WINDOW`` words or more is found. The
fingerprints of the benchmark go into a bit filter of bounded size; windows of documents that pass it
are joined with the benchmark's by fingerprint and extended to the whole window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderrisk.session import cut_lineage

from .words import PLAIN, grams, lists, slices, words

WINDOW = 13
GRAM = 7
#: The filter has at most so many bits (16 MB), whatever the size of the benchmark.
FILTER_BITS = 27


def _fingerprints(hashes: np.ndarray, ends: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The smallest hash of the runs in the window that starts at each place."""
    low, _ = grams(hashes, ends, gram)
    width, wanted = 1, window - gram + 1
    while width < wanted:
        step = min(width, wanted - width)
        low = np.concatenate((np.minimum(low[:-step], low[step:]), low[-step:])) if len(low) > step else low
        width += step
    return low


def benchmark_windows(
    benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, item: str = "item_id", text: str = "text"
) -> DataFrame:
    """item, span (words), fingerprint and window (64-bit hashes) of each distinct window of each item.

    An item with fewer words is one window, and its own fingerprint.
    """

    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts, 1):
            hashes, ends = words(part.column(1), PLAIN)
            owner = np.repeat(np.arange(part.num_rows), np.diff(ends))
            length = np.diff(ends)[owner]
            whole, fits = grams(hashes, ends, window)
            low = _fingerprints(hashes, ends, window, gram)
            short = np.flatnonzero((np.diff(ends) < window) & (np.diff(ends) > 0))
            found = [(owner[fits], length[fits] * 0 + window, low[fits], whole[fits])]
            for n in np.unique(np.diff(ends)[short]):
                one = short[np.diff(ends)[short] == n]
                run = grams(hashes, ends, int(n))[0][ends[one]]
                found.append((one, one * 0 + n, run, run))
            who, span, mark, run = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(who)), pa.array(span, pa.int32()), pa.array(mark.view(np.int64)), pa.array(run.view(np.int64))],
                ["item", "span", "fingerprint", "window"],
            )

    rows = benchmark.select(F.col(item).cast("string"), text)
    return rows.mapInArrow(find, "item string, span int, fingerprint long, window long").distinct()


def _filter(known: DataFrame) -> tuple[int, np.ndarray]:
    """(bits, table): marks the leading bits of every fingerprint."""
    n = known.count()
    bits = min(FILTER_BITS, max(12, (16 * n).bit_length()))
    place = F.expr(f"shiftrightunsigned(fingerprint, {64 - bits})")
    marked = known.select((place / 64).cast("int").alias("at"), F.expr(f"shiftleft(1L, cast({_sql_mod(bits)} as int))").alias("bit"))
    # At most 2 ** (FILTER_BITS - 6) rows.
    rows = marked.groupBy("at").agg(F.bit_or("bit").alias("bits")).toPandas()
    table = np.zeros(1 << max(0, bits - 6), np.int64)
    table[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return bits, table.view(np.uint64)


def _sql_mod(bits: int) -> str:
    return f"shiftrightunsigned(fingerprint, {64 - bits}) & 63"


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per document: ``key``, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    A word inside any occurrence of a benchmark window is hit; spans lists the maximal runs of hit words
    (start, end). Contaminated means at least a twentieth of the words. Null or empty texts have no words
    and are clean; so is every document if the benchmark is empty. Repeated rows are judged each, items
    that repeat count once, and items without an id take part but are not listed.
    """
    spark = docs.sparkSession
    items = cut_lineage(benchmark_windows(benchmark, window, gram))
    bits, table = _filter(items.select("fingerprint").distinct())
    # At most ``window`` numbers.
    spans = sorted(r["span"] for r in items.select("span").distinct().collect())
    shared = spark.sparkContext.broadcast(table)

    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        for part in slices(parts, 2):
            hashes, ends = words(part.column(2), PLAIN)
            found = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]]
            for span in spans:
                whole, fits = grams(hashes, ends, span)
                low = _fingerprints(hashes, ends, window, gram) if span == window else whole
                place = low >> np.uint64(64 - bits)
                fits &= (marks[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
                at = np.flatnonzero(fits)
                for one, more in zip(found, (at, at * 0 + span, low[at], whole[at]), strict=True):
                    one.append(more)
            at, span, low, whole = map(np.concatenate, found)
            order = np.argsort(at, kind="stable")
            who = np.searchsorted(ends, at[order], "right") - 1
            counts = np.bincount(who, minlength=part.num_rows)
            columns = [
                lists(at[order] - ends[who], counts, pa.int64()),
                lists(span[order], counts, pa.int64()),
                lists(low[order].view(np.int64), counts, pa.int64()),
                lists(whole[order].view(np.int64), counts, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(np.diff(ends)), *columns], [key, "_row", "n_words", "at", "span", "fingerprint", "window"]
            )

    kind = docs.schema[key].dataType.simpleString()
    many = "array<long>"
    schema = f"`{key}` {kind}, _row long, n_words long, at {many}, span {many}, fingerprint {many}, window {many}"
    numbered = docs.select(key, F.monotonically_increasing_id().alias("_row"), text)
    seen = cut_lineage(numbered.mapInArrow(find, schema))
    zipped = F.explode(F.arrays_zip("at", "span", "fingerprint", "window")).alias("x")
    tried = seen.where(F.size("at") > 0).select("_row", zipped).select("_row", "x.*")
    on = ["fingerprint", "window", "span"]
    hit = cut_lineage(tried.join(items.select(*on).distinct(), on, "left_semi").select("_row", "at", *on))
    # A document's places are at most as many as its words, which came in one row.
    runs = hit.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("at", (F.col("at") + F.col("span")).alias("end")))).alias("runs"))
    merged = F.expr(
        "aggregate(runs, cast(array() as array<struct<start: bigint, end: bigint>>), (acc, x) -> "
        "if(size(acc) > 0 and x.at <= element_at(acc, -1).end, "
        "concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start, 'end', "
        "greatest(element_at(acc, -1).end, x.end)))), concat(acc, array(named_struct('start', x.at, 'end', x.end)))))"
    )
    runs = runs.select("_row", merged.alias("spans"))
    listed = hit.select("_row", *on).distinct().join(items, on).select("_row", "item").distinct()
    listed = listed.groupBy("_row").agg(
        F.count("item").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("_items")
    )
    out = seen.select(key, "_row", "n_words").join(runs, "_row", "left").join(listed, "_row", "left")
    n_hit = F.coalesce(F.expr("aggregate(spans, 0L, (n, x) -> n + x.end - x.start)"), F.lit(0).cast("long"))
    out = out.withColumn("n_hit", n_hit).withColumn("n_items", F.coalesce("n_items", F.lit(0).cast("long")))
    digest = F.sha2(F.coalesce("_items", F.lit("")), 256)
    dirty = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return out.select(key, "n_words", "n_hit", "n_items", digest.alias("items_sha256"), dirty.alias("contaminated"), "spans")
