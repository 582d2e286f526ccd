import random
import zlib
from array import array
from collections import defaultdict
from typing import ClassVar

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from orderrisk.llm import counts, dac, encode, packing
from orderrisk.session import scratch_dir

from .common import awkward, frame

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def plain(path, texts):
    tokenizer = Tokenizer.from_file(path)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_encoder_equals_the_library(path, monkeypatch):
    rng = random.Random(1)
    marks = [*"aAéÉ0 .,!'\n\t́ 　\x1c\x85sß|*-", "'s", "  ", "\n\n", "<|endoftext|>", "İ", "word", "Word."]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(25))) for _ in range(3000)]
    texts += [None, "", *(t for _, t in awkward())]
    wanted = plain(path, texts)
    found = encode.Encoder(path)
    assert found.ids(texts) == [array("I", x).tobytes() for x in wanted]
    assert found.lengths(texts) == [len(x) for x in wanted]
    monkeypatch.setattr(encode, "REMEMBERED", 50)
    monkeypatch.setattr(encode.segments, "__defaults__", (200,))
    monkeypatch.setattr(encode.batches, "__defaults__", (200,))
    assert encode.Encoder(path).lengths(texts) == [len(x) for x in wanted]


def test_counts(spark):
    docs = [*awkward(), (None, "no key"), (4, "One")]
    found = counts.token_counts(frame(spark, docs), BYTES).collect()
    wanted = [len(x) for x in plain(BYTES, [t for _, t in docs])]
    rows = sorted(((k or 0), len((t or "").encode()), n, n > 1024) for (k, t), n in zip(docs, wanted, strict=True))
    assert sorted(((r.doc_id or 0), r.n_bytes, r.n_tokens, r.over_limit) for r in found) == rows
    assert counts.token_counts(frame(spark, []).where("false"), BYTES).count() == 0


def test_dac_round_trip_and_random_access():
    rng = np.random.default_rng(3)
    ids = [rng.integers(0, 2 ** int(rng.integers(1, 33)), n, dtype=np.uint64).astype("<u4") for n in (0, 1, 7, 511, 512, 513, 4000)]
    held = dac.Reader(dac.dump([3, None, 5, 6, 7, 8, 9], ids))
    flat = np.concatenate(ids)
    assert held.keys == [3, None, 5, 6, 7, 8, 9]
    assert (held.ids() == flat).all()
    assert [held[i] for i in range(0, len(flat), 13)] == flat[::13].tolist()
    with pytest.raises(IndexError):
        held[len(flat)]


def test_dac_files(spark):
    docs = [*awkward(), (4, "One"), (None, "no key")]
    folder = f"{scratch_dir(spark)}/ids-test-{random.random()}"
    folder = folder if folder.startswith("file:") else f"file://{folder}"
    files = dac.write(frame(spark, docs), folder, WORDS, shard_ids=500)
    assert files.count() > 3
    found = sorted(dac.read(files, folder).collect(), key=lambda r: r.start)
    ids = dict(zip([k for k, _ in docs], plain(WORDS, [t for _, t in docs]), strict=True))
    assert [r.doc_id for r in found] == sorted((k for k, _ in docs), key=lambda k: -1 if k is None else k)
    start = 0
    for r in found:
        own = array("I", [*ids[r.doc_id], 1]).tobytes()
        assert (r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (start, len(own) // 4, zlib.crc32(own), own)
        start += r.n_tokens
    none = dac.write(frame(spark, []).where("false"), f"{folder}-none", WORDS)
    assert dac.read(none, f"{folder}-none").count() == 0


def test_packing(spark):
    docs = [*awkward(), (4, "One"), (None, "no key")]
    rows = packing.pack(packing.pieces(frame(spark, docs), WORDS, with_ids=True)).collect()
    ids = dict(zip([k for k, _ in docs], plain(WORDS, [t for _, t in docs]), strict=True))
    assert sum(r.length for r in rows) == sum(len(ids[k]) + 1 for k, _ in docs)
    by = defaultdict(list)
    for r in rows:
        own = [*ids[r.doc_id], 0][r.start : r.start + r.length]
        assert r.start == r.piece * 2048
        assert bytes(r.ids) == array("I", own).tobytes()
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids))
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 2048
    assert packing.pack(packing.pieces(frame(spark, []).where("false"), WORDS)).count() == 0


def test_plan_fills_gaps_exactly():
    have = {60: 5, 40: 3, 25: 2, 15: 2, 30: 9, 10: 1}
    made = packing.plan(have, 100)
    # 780 ids need eight sequences of 100, and exact combinations reach that.
    assert sum(length * n for length, n in have.items()) == 780
    assert sum(n for _, n in made) == 8
    rng = random.Random(5)
    for _ in range(30):
        have = {rng.randint(1, 64): rng.randint(1, 50) for _ in range(20)}
        made = packing.plan(have, 64)
        used = defaultdict(int)
        for lengths, n in made:
            assert sum(lengths) <= 64
            for x in lengths:
                used[x] += n
        assert used == have
        assert len(made) <= 2 * len(have) + 2
    rich = packing.plan({x: 1000 for x in range(1, 65)}, 64)
    assert sum(n for _, n in rich) <= 1000 * 65 / 2 * 1.01


def test_plan_tries_all_triples():
    made = packing.plan({59: 2, 21: 2, 15: 1, 5: 1, 11: 1, 9: 1, 13: 1}, 100)
    assert sorted(made) == [((13,), 1), ((59, 21, 11, 9), 1), ((59, 21, 15, 5), 1)]


def test_pieces_are_cut_in_slices_of_bounded_bytes(monkeypatch):
    class Table:
        schema = StructType().add("doc_id", "long").add("text", "string")

        def select(self, *columns):
            return self

        def mapInArrow(self, cut, schema):
            return cut

    class Spy:
        seen: ClassVar[list[int]] = []

        def ids(self, texts):
            self.seen.append(sum(map(len, texts)))
            return [b"\x01\0\0\0" * (len(t) >> 16) for t in texts]

    monkeypatch.setattr(packing, "encoder", lambda path: Spy())
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(100)), "text": ["x" * (1 << 18)] * 100})
    made = [r for part in packing.pieces(Table(), "a tokenizer")(iter([batch])) for r in part.to_pylist()]
    assert [(r["doc_id"], r["length"]) for r in made] == [(i, 5) for i in range(100)]
    assert max(Spy.seen) <= 1 << 22 and sum(Spy.seen) == 100 << 18
