import hashlib

from orderrisk.llm import repeats

from .common import awkward, frame


def brute(docs, length):
    seen, out = set(), {}
    for key, text in sorted(docs):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if data[p : p + length] in seen:
                covered[p : p + length] = b"\1" * length
            seen.add(data[p : p + length])
        left = bytes(x for x, c in zip(data, covered, strict=True) if not c)
        spans = sum(1 for i, c in enumerate(covered) if c and (not i or not covered[i - 1]))
        out[key] = (len(data), sum(covered), spans, hashlib.sha256(left).hexdigest())
    return out


def test_equals_brute_force(spark):
    docs = awkward()
    found = repeats.repeats(frame(spark, docs), with_text=True, carried=("source",)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == brute(docs, 100)
    for r in found:
        assert sum(s.end - s.start for s in r.removed) == r.n_removed
        assert r.carried.source == "s"
    assert next(r.text for r in found if r.doc_id == 200) == ""


def test_other_length(spark):
    docs = [(i, t) for i, t in awkward() if i < 350]
    found = repeats.repeats(frame(spark, docs), length=60, gram=20).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == brute(docs, 60)


def test_repeated_rows_null_keys_and_no_rows(spark):
    long = "unique text " + "".join(chr(97 + i * i % 23) + chr(97 + i % 26) for i in range(100))
    docs = [(5, long), (5, long), (None, long), (9, long), (9, "short")]
    found = repeats.repeats(frame(spark, docs)).collect()
    assert sorted(((r.doc_id or -1), r.n_bytes, r.n_removed) for r in found) == [
        (-1, 212, 0), (5, 212, 212), (5, 212, 212), (9, 5, 0), (9, 212, 212)
    ]
    assert repeats.repeats(frame(spark, []).where("false")).count() == 0
