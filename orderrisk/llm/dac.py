"""Token ids in files of directly addressable codes.

A file holds whole documents in ascending order. Each id is split into bytes, low byte first. Level 0
has the low byte of every id, level 1 the second byte of those ids that go on, and so forth. Beside the
bytes of a level lies a bitmap of the ids that go on, and a directory with the number of set bits before
every 512th. The place of an id on the next level is the number of set bits before it, so any id is
read from a few addresses, without decoding its neighbours.

Layout, little-endian: magic, number of documents, of ids and of levels; keys (int64) and null marks of
the documents; first id of each document and the end (uint64); and for each level its length (uint64),
bytes, bitmap and directory (uint64), each padded to eight bytes.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderrisk.session import cut_lineage

from .encode import encoder

MAGIC = b"DACIDS01"
SHARD_IDS = 1 << 22
_BLOCK = 512


def _padded(data: bytes) -> bytes:
    return data + b"\0" * (-len(data) % 8)


def dump(keys: list[int | None], ids: list[np.ndarray]) -> bytes:
    """One file's content: documents' keys and their ids."""
    flat = np.concatenate([np.zeros(0, "<u4"), *ids]).astype("<u4")
    ends = np.cumsum([0, *map(len, ids)]).astype("<u8")
    levels = []
    while len(flat):
        on = flat > 255
        bits = np.packbits(on, bitorder="little")
        blocks = np.add.reduceat(on.astype("<u8"), np.arange(0, len(on), _BLOCK))
        ranks = np.concatenate(([0], np.cumsum(blocks)[:-1])).astype("<u8")
        levels.append(b"".join([np.uint64(len(flat)).tobytes(), _padded(flat.astype(np.uint8).tobytes()), _padded(bits.tobytes()), ranks.tobytes()]))
        flat = flat[on] >> 8
    head = np.array([len(keys), ends[-1], len(levels)], "<u8").tobytes()
    named = np.array([0 if k is None else k for k in keys], "<i8").tobytes()
    nulls = _padded(np.array([k is None for k in keys], np.uint8).tobytes())
    return b"".join([MAGIC, head, named, nulls, ends.tobytes(), *levels])


class Reader:
    """A file's content, addressed in place."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        n, self.n_ids, n_levels = (int(x) for x in np.frombuffer(data, "<u8", 3, 8))
        at = 32
        keys = np.frombuffer(data, "<i8", n, at)
        at += 8 * n
        nulls = np.frombuffer(data, np.uint8, n, at)
        at += n + -n % 8
        self.keys = [None if gone else int(k) for k, gone in zip(keys, nulls, strict=True)]
        self.ends = np.frombuffer(data, "<u8", n + 1, at).astype(np.int64)
        at += 8 * (n + 1)
        self._levels = []
        for _ in range(n_levels):
            size = int(np.frombuffer(data, "<u8", 1, at)[0])
            at += 8
            low = np.frombuffer(data, np.uint8, size, at)
            at += size + -size % 8
            n_bytes = (size + 7) // 8
            bits = np.frombuffer(data, np.uint8, n_bytes, at)
            at += n_bytes + -n_bytes % 8
            ranks = np.frombuffer(data, "<u8", (size + _BLOCK - 1) // _BLOCK, at)
            at += 8 * len(ranks)
            self._levels.append((low, bits, ranks))

    def __getitem__(self, at: int) -> int:
        """The id at a place, from one address a level and the bits of one block."""
        if not 0 <= at < self.n_ids:
            raise IndexError(at)
        value = 0
        for depth, (low, bits, ranks) in enumerate(self._levels):
            value |= int(low[at]) << 8 * depth
            if not bits[at >> 3] >> (at & 7) & 1:
                break
            block = at // _BLOCK
            inside = np.unpackbits(bits[block * _BLOCK >> 3 : (at >> 3) + 1], bitorder="little")
            at = int(ranks[block]) + int(inside[: at - block * _BLOCK].sum())
        return value

    def ids(self) -> np.ndarray:
        """All ids."""
        later = np.zeros(0, "<u4")
        for low, bits, _ in reversed(self._levels):
            here = low.astype("<u4")
            here[np.unpackbits(bits, count=len(low), bitorder="little").astype(bool)] |= later << 8
            later = here
        return later


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 1,
    shard_ids: int = SHARD_IDS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Writes each text's ids and ``end_id`` in ascending order of ``key`` (a whole number) to files.

    Returns one row per file: part and shard (their order is the order of the ids), n_docs, n_ids and
    file. ``folder`` is shared by all machines and of a kind that ``pyarrow.fs`` opens. A file appears
    under its name only when it is whole, so a repeated task replaces what a lost one wrote. A null text
    counts as empty, null keys come first, repeated keys keep all their rows; an empty table has no files.
    """
    end = np.array([end_id], "<u4")

    def shards(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, place = fs.FileSystem.from_uri(folder)
        part_no, shard, held = TaskContext.get().partitionId(), 0, 0
        keys: list[int | None] = []
        ids: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal shard, held, keys, ids
            name = f"{place}/ids-{part_no:06d}-{shard:06d}.dac"
            store.create_dir(place)
            unfinished = f"{place}/.{uuid.uuid4().hex}"
            with store.open_output_stream(unfinished) as out:
                out.write(dump(keys, ids))
            store.move(unfinished, name)
            row = [[part_no], [shard], [len(keys)], [held], [name.rsplit("/", 1)[-1]]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            shard, held, keys, ids = shard + 1, 0, [], []
            return pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(row, kinds, strict=True)], ["part", "shard", "n_docs", "n_ids", "file"]
            )

        for part in parts:
            for k, found in zip(part.column(0).to_pylist(), encoder(tokenizer).ids(part.column(1).to_pylist()), strict=True):
                keys.append(k)
                ids.append(np.concatenate((np.frombuffer(found, "<u4"), end)))
                held += len(ids[-1])
                if held >= shard_ids:
                    yield flush()
        if keys:
            yield flush()

    ordered = docs.select(F.col(key).cast("long").alias(key), text).repartitionByRange(key).sortWithinPartitions(key)
    written = ordered.mapInArrow(shards, "part int, shard int, n_docs long, n_ids long, file string")
    return cut_lineage(written)


def read(files: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """Per document of the files: ``key``, start (ids of all before it), n_tokens, ids_crc32, ids.

    ``files`` is what :func:`write` returned.
    """
    spark = files.sparkSession

    def documents(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for path, content in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                held = Reader(content.as_buffer().to_pybytes())
                flat, ends = held.ids().tobytes(), held.ends * 4
                ids = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
                columns = [
                    pa.array([path.rsplit("/", 1)[-1]] * len(ids)),
                    pa.array(held.keys, pa.int64()),
                    pa.array(held.ends[:-1]),
                    pa.array(np.diff(held.ends)),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["file", key, "_at", "n_tokens", "ids_crc32", "ids"])

    if not files.head(1):
        return spark.createDataFrame([], f"`{key}` long, start long, n_tokens long, ids_crc32 long, ids binary")
    raw = spark.read.format("binaryFile").load(f"{folder}/ids-*.dac").select("path", "content")
    found = raw.mapInArrow(documents, f"file string, `{key}` long, _at long, n_tokens long, ids_crc32 long, ids binary")
    # One row a file: the files' order is their ids' order.
    order = Window.orderBy("part", "shard")
    before = files.select("file", (F.sum("n_ids").over(order) - F.col("n_ids")).alias("_before"))
    return found.join(before, "file").select(key, (F.col("_before") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32", "ids")
