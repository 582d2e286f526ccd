"""Removal of byte strings that occur earlier in the corpus, by prefix doubling over suffix positions.

Sorting (position, rank) pairs of every byte at every offset would move many times the corpus. So the
positions are ranked in an order in which most become unique, and drop out, before anything large moves:

1. Rank of the smallest ``GRAM``-byte string in each window of ``LENGTH`` bytes (its anchor). Equal windows
   have equal anchors, at equal offsets. Consecutive windows with one anchor form a run.
2. Rank of (anchor, whole run), past the threshold already: runs that equal an earlier run go. What is
   left of a run goes on only if another run has the same anchor.
3. The positions of those runs, side by side for each anchor: ranks of strings of a quarter of the
   threshold, then twice of pairs (rank of p, rank of p + offset), the offset doubling each time. A position
   whose rank is unique stops; the others have reached the threshold, and all but the earliest go.

Every step is one shuffle of packed arrays. Equal runs of one batch are settled before the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderrisk.session import cut_lineage

from .words import _BYTES, CHUNK_BYTES, MOST_PARTITIONS, content, mixed, powers, slices

LENGTH = 100
GRAM = 32
BUCKET_BYTES = 8 << 20
_LOW = np.uint64((1 << 24) - 1)
_NO_KEY = -(1 << 63)
_RUN = np.dtype([("anchor", "<u8"), ("same", "<u8"), ("key", "<i8"), ("tie", "<i8"), ("at", "<i8"), ("n", "<i4"), ("gone", "?")])
_PLACE = np.dtype([("anchor", "<u8"), ("at", "<i8"), ("n", "<i4")])


def anchored_runs(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: anchor's hash, run's hash, first window, windows.

    ``data`` holds texts that end at ``ends[1:]``; no window crosses an end.
    """
    none = np.zeros(0, np.int64)
    out = [(none.view(np.uint64), none.view(np.uint64), none, none)]
    for done in range(0, len(data), CHUNK_BYTES):
        part = data[done : done + CHUNK_BYTES + length - 1]
        n = min(CHUNK_BYTES, len(part) - length + 1)
        if n <= 0:
            break
        up, back = powers(len(part) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[part] * up[:-1])))
        marks = mixed((sums[gram:] - sums[:-gram]) * back[: len(part) - gram + 1])
        # The place in the low bits: of equal grams the first is the anchor.
        low = marks & ~_LOW | np.arange(len(marks), dtype=np.uint64)
        width, wanted = 1, length - gram + 1
        while width < wanted:
            step = min(width, wanted - width)
            low = np.minimum(low[:-step], low[step:])
            width += step
        low = low[:n]
        # Windows that end beyond the text in which they begin are none.
        whole = np.ones(n, bool)
        for end in ends[np.searchsorted(ends, done, "right") : np.searchsorted(ends, done + n + length, "right")].tolist():
            whole[max(end - length + 1 - done, 0) : max(end - done, 0)] = False
        begins, stops = whole.copy(), whole.copy()
        change = low[1:] != low[:-1]
        begins[1:] &= change | ~whole[:-1]
        stops[:-1] &= change | ~whole[1:]
        first, last = np.flatnonzero(begins), np.flatnonzero(stops) + length
        same = mixed((sums[last] - sums[first]) * back[first] + (last - first).astype(np.uint64))
        out.append((marks[(low[first] & _LOW).astype(np.int64)], same, first + done, last - first - length + 1))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _groups(*columns: np.ndarray) -> np.ndarray:
    """Where a new group begins in sorted columns."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _firsts(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``runs`` in order, marked where they repeat one with a smaller (key, tie, at); and the first of each kind."""
    runs = runs[np.lexsort((runs["at"], runs["tie"], runs["key"], runs["same"], runs["anchor"]))]
    new = _groups(runs["anchor"], runs["same"])
    first = runs[new][np.cumsum(new) - 1] if len(runs) else runs
    later = np.logical_or.reduce([runs[c] != first[c] for c in ("key", "tie", "at")]) if len(runs) else np.zeros(0, bool)
    runs["gone"] |= later
    return runs, new


def _by_document(runs: np.ndarray, gone: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """One row a document: its (anchor, at, n), of windows that go and of runs that go on."""
    order = np.lexsort((runs["at"], gone, runs["tie"], runs["key"]))
    runs, gone = runs[order], gone[order]
    starts = np.flatnonzero(_groups(runs["key"], runs["tie"], gone)) if len(runs) else np.zeros(0, int)
    places = np.zeros(len(runs), _PLACE)
    for c in _PLACE.names:
        places[c] = runs[c]
    held = [places[a:b].tobytes() for a, b in zip(starts, np.append(starts, len(runs))[1:], strict=True)]
    columns = [pa.array(runs["key"][starts]), pa.array(runs["tie"][starts]), pa.array(gone[starts]), pa.array(held, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names)


_FOUND = ["key", "tie", "gone", "places"]
_FOUND_SCHEMA = "key long, tie long, gone boolean, places binary"


def _buckets(anchors: np.ndarray, n: int) -> np.ndarray:
    # Anchors are smallest hashes and lie close together; mixed again they spread.
    return ((mixed(anchors) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _split(values: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    values, bucket = values[order], bucket[order]
    starts = np.flatnonzero(_groups(bucket)) if len(bucket) else np.zeros(0, int)
    for a, b in zip(starts, np.append(starts, len(bucket))[1:], strict=True):
        yield int(bucket[a]), values[a:b]


def _pack(runs: np.ndarray) -> bytes:
    """Column after column, so that equal leading bytes compress."""
    return np.int64(len(runs)).tobytes() + b"".join(np.ascontiguousarray(runs[c]).tobytes() for c in _RUN.names)


def _unpack(data: bytes) -> np.ndarray:
    n, at = int(np.frombuffer(data, "<i8", 1)[0]), 8
    runs = np.zeros(n, _RUN)
    for c in _RUN.names:
        runs[c] = np.frombuffer(data, _RUN[c], n, at)
        at += n * _RUN[c].itemsize
    return runs


def _ranks(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each row of the columns among all rows, and whether another row has the same."""
    order = np.lexsort(columns)
    new = _groups(*(c[order] for c in columns))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank, np.bincount(rank)[rank] > 1


def _doubled(texts: list[bytes], size: np.ndarray, length: int) -> np.ndarray:
    """For each window of the texts (``size[i]`` windows of ``length`` bytes each) the rank of its bytes; -1: unique."""
    step = length // 4
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.concatenate(([0], np.cumsum(size + length - 1)))
    up, back = powers(len(data) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[:-1])))
    at = np.arange(len(data) - step + 1)
    rank, many = _ranks(mixed((sums[step:] - sums[:-step]) * back[at]))
    # Positions that the next ranks need: every window's start and the offsets that follow it.
    offset = step
    reach = length - step
    while True:
        reach -= offset
        counts = size + reach
        at = np.repeat(ends[:-1] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        going = at[many[at] & many[at + offset]]
        wider, more = _ranks(rank[going + offset], rank[going])
        rank, many = np.full(len(data), -1), np.zeros(len(data), bool)
        rank[going], many[going] = wider, more
        if reach == 0:
            return np.where(many[at], rank[at], -1)
        offset *= 2


def _collected(column: pa.ChunkedArray) -> Iterator[bytes]:
    for x in column:
        yield x.as_buffer().to_pybytes()


def repeats(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    with_text: bool = False,
    carried: tuple[str, ...] = (),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per document: ``key``, n_bytes, n_removed, n_spans, kept_sha256, removed (start, end) and, if asked for, text.

    ``carried`` columns come along in a struct named carried.

    A byte of the UTF-8 text is removed if a string of ``length`` bytes covers it that also starts earlier:
    in a document with a smaller ``key``, or before in the same one. Null counts as empty. Among documents
    that share a key the hash of the text decides which is earlier; rows that repeat key and text are one
    document, judged once, and each row gets the result. A null key is the smallest. text is what is left,
    without the bytes of characters that were cut apart. ``length`` is a multiple of 4 above ``gram``.
    """
    kind = docs.schema[key].dataType.simpleString()
    held = docs.select(
        F.col(key).alias("id"),
        F.struct(F.lit(None).cast("int").alias("_"), *carried).alias("carried"),
        F.coalesce(F.col(key).cast("long"), F.lit(_NO_KEY)).alias("key"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("tie"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    total = held.select(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = max(8, int(total // BUCKET_BYTES) + 1)

    def anchors(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts, 2):
            data, ends = content(part.column(2))
            anchor, same, first, n = anchored_runs(data, ends, length, gram)
            owner = np.searchsorted(ends, first, "right") - 1
            runs = np.zeros(len(anchor), _RUN)
            runs["anchor"], runs["same"], runs["n"] = anchor, same, n
            runs["key"], runs["tie"] = part.column(0).to_numpy()[owner], part.column(1).to_numpy()[owner]
            runs["at"] = first - ends[owner]
            runs, _ = _firsts(runs)
            found = list(_split(runs, _buckets(runs["anchor"], buckets)))
            packed = pa.array([_pack(x) for _, x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int32()), packed], ["bucket", "runs"])

    def settle(table: pa.Table) -> pa.Table:
        runs, new = _firsts(np.concatenate([_unpack(x) for x in _collected(table["runs"])]))
        first = np.flatnonzero(new)
        begins = _groups(runs["anchor"][first])
        kinds = np.bincount(np.cumsum(begins) - 1)[np.cumsum(begins) - 1]
        on = np.zeros(len(runs), bool)
        on[first[kinds > 1]] = True
        # What went within its batch is marked and never first, as its original precedes it.
        picked = runs["gone"] | on
        return pa.Table.from_batches([_by_document(runs[picked], runs["gone"][picked], _FOUND)])

    blobs = held.select("key", "tie", "text").mapInArrow(anchors, "bucket int, runs binary")
    parts = min(buckets, MOST_PARTITIONS)
    found = cut_lineage(blobs.repartition(parts, "bucket").groupBy("bucket").applyInArrow(settle, _FOUND_SCHEMA))
    going = found.where(~F.col("gone")).groupBy("key", "tie").agg(F.collect_list("places").alias("places"))

    def bring(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts, 2):
            rows: list[list] = [[], [], [], [], [], [], []]
            for k, tie, body, held_places in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                body = body.encode()
                places = np.frombuffer(b"".join(held_places), _PLACE)
                for bucket, some in _split(places, _buckets(places["anchor"], buckets)):
                    cut = b"".join(body[a : a + n + length - 1] for a, n in zip(some["at"].tolist(), some["n"].tolist(), strict=True))
                    for column, value in zip(rows, (bucket, k, tie, some.tobytes(), cut), strict=False):
                        column.append(value)
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            columns = [pa.array(x, t) for x, t in zip(rows, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "key", "tie", "places", "bytes"])

    def double(table: pa.Table) -> pa.Table:
        places = [np.frombuffer(x, _PLACE) for x in _collected(table["places"])]
        counts = [len(x) for x in places]
        places = np.concatenate(places)
        size = places["n"].astype(np.int64)
        rank = _doubled(list(_collected(table["bytes"])), size, length)
        owner = np.repeat(np.arange(len(places)), size)
        row = np.repeat(np.arange(len(counts)), counts)[owner]
        runs = np.zeros(len(owner), _RUN)
        runs["same"], runs["n"] = rank.view(np.uint64), 1
        runs["key"], runs["tie"] = table["key"].to_numpy()[row], table["tie"].to_numpy()[row]
        runs["at"] = places["at"][owner] + np.arange(len(owner)) - (np.cumsum(size) - size)[owner]
        runs, _ = _firsts(runs[rank >= 0])
        runs = runs[runs["gone"]]
        # Neighbouring windows that go form one place.
        runs = runs[np.lexsort((runs["at"], runs["tie"], runs["key"]))]
        if len(runs):
            new = _groups(runs["key"], runs["tie"], runs["at"] - np.arange(len(runs)))
            counts = np.diff(np.append(np.flatnonzero(new), len(runs)))
            runs = runs[new]
            runs["n"] = counts
        return pa.Table.from_batches([_by_document(runs, runs["gone"], _FOUND)])

    # Both joins read the texts from one shuffle.
    texts = held.select("id", "carried", "key", "tie", "text")
    asked = texts.join(going, ["key", "tie"]).select("key", "tie", "text", "places")
    brought = asked.mapInArrow(bring, "bucket int, key long, tie long, places binary, bytes binary")
    later = brought.repartition(parts, "bucket").groupBy("bucket").applyInArrow(double, _FOUND_SCHEMA)
    gone = found.where("gone").unionByName(later).groupBy("key", "tie").agg(F.collect_list("places").alias("places"))
    names = [key, "carried", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", *["text"] * with_text]

    def remove(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts, 2):
            rows: list[tuple] = []
            for body, held_places in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                body = body.encode()
                spans, left = [], body
                if held_places:
                    places = np.frombuffer(b"".join(held_places), _PLACE)
                    turns = np.zeros(len(body) + 1, np.int64)
                    np.add.at(turns, places["at"], 1)
                    np.add.at(turns, places["at"] + places["n"] + (length - 1), -1)
                    covered = np.cumsum(turns)[:-1] > 0
                    edges = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])))).tolist()
                    spans = [{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2], strict=True)]
                    left = np.frombuffer(body, np.uint8)[~covered].tobytes()
                row = (len(body), len(body) - len(left), len(spans), hashlib.sha256(left).hexdigest(), spans)
                rows.append((*row, left.decode("utf-8", "ignore")) if with_text else row)
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.string()]
            columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names)

    schema = f"`{key}` {kind}, carried {held.schema['carried'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", removed array<struct<start: long, end: long>>" + ", text string" * with_text
    joined = texts.join(gone, ["key", "tie"], "left").select("id", "carried", "text", "places")
    found = joined.mapInArrow(remove, schema)
    return found if carried else found.drop("carried")
