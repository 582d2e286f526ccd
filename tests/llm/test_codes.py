import hashlib
import math
import random

import numpy as np
import pytest

from orderrisk.llm import codes, queries

from ..parity import compare, connect

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, _salt int"


def frame(spark, rows, parts: int = 3):
    """With further columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, "c", 1, 2) for r in rows], SCHEMA).repartition(parts)


def brute(rows, parts=8, entries=16, rounds=6):
    whole = [(k, [math.floor(4096 * float(np.float32(x))) for x in v], lab) for k, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = next((len(v) for _, v, _ in whole if v and len(v) % parts == 0), parts)
    fit = [r for r in whole if len(r[1]) == width]
    per = width // parts
    cut = [[v[p * per : (p + 1) * per] for _, v, _ in fit] for p in range(parts)]
    books = [[list(x) for x in cut[p][:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            got = [nearest(x, books[p])[1] for x in cut[p]]
            for e in range(len(books[p])):
                mine = [x for x, g in zip(cut[p], got) if g == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    out = []
    for i, (k, _, lab) in enumerate(fit):
        found = [nearest(cut[p][i], books[p]) for p in range(parts)]
        out.append([k, lab, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)])
    out += [[k, lab, None, None] for k, v, lab in whole if len(v) != width]
    sums = {}
    for _, lab, _, err in out:
        if err is not None:
            sums[lab] = sums.get(lab, 0) + err
    text = ",".join(str(c) for book in books for e in book for c in e)
    return sorted(((*r, sums.get(r[1]), hashlib.sha256(text.encode()).hexdigest()) for r in out), key=repr)


def rows_of(seed, n, dims=16, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims)) / 4
    return [(i, [float(x) for x in centres[rng.integers(12)] + rng.normal(size=dims) / 20], int(rng.integers(labels))) for i in range(n)]


def found(spark, rows, **how):
    return sorted((tuple(r) for r in codes.coded(frame(spark, rows), **how).collect()), key=repr)


def test_equals_plain_lloyd(spark):
    rows = rows_of(1, 700)
    assert found(spark, rows) == brute(rows)
    # The blocks that the rows come in change nothing.
    assert found(spark, rows, block_rows=64) == brute(rows)


def test_nulls_odd_lengths_ties_and_repeats(spark):
    rows = rows_of(2, 40)
    rows += [(50, None, 1), (51, [math.nan] * 16, 1), (52, [math.inf] + [0.0] * 15, 2), (53, [None] + [0.0] * 15, None)]
    rows += [(54, [0.5] * 7, 1), (55, [0.5] * 24, None), (-1, [], 2), (None, [0.25] * 16, None), (None, [0.25] * 16, None)]
    rows += [rows[3]] * 5 + [(60 + i, [0.0] * 16, None) for i in range(40)]
    random.Random(0).shuffle(rows)
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("n", [1, 3, 16, 17])
def test_few_rows(spark, n):
    assert found(spark, rows_of(3, n)) == brute(rows_of(3, n))


def test_no_rows(spark):
    assert codes.coded(frame(spark, [(1, None, 1)])).collect() == []
    assert codes.coded(frame(spark, [(1, None, 1)]).where("false")).columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]


def test_components_without_64_bit_distances_are_refused(spark):
    with pytest.raises(Exception, match="vec_id 7"):
        codes.coded(frame(spark, [(7, [1e30] * 8, 1)])).collect()


def test_walk_assigns_whole_nodes_and_equals_every_distance():
    rng = np.random.default_rng(5)
    rows = np.concatenate([rng.integers(-4000, 4000, (16, 4))[rng.integers(16, size=1)] + rng.integers(-150, 150, (256, 4)) for _ in range(16)])
    for k in (1, 5, 16):
        book = rng.integers(-4000, 4000, (k, 4))
        order, depth = codes.tree_order(rows, codes.LEAF_ROWS)
        tree = codes.tree_of(rows[order], depth)
        got = codes.assign(tree, book, labels=True)
        want = ((tree.rows[:, None] - book) ** 2).sum(axis=2).argmin(axis=1)
        assert (got.entry == want).all() and (got.counts == np.bincount(want, minlength=k)).all()
        assert all((got.sums[e] == tree.rows[want == e].sum(axis=0)).all() for e in range(k))
        assert got.whole_rows > len(rows) // 2


def test_query_equals_its_sql(spark, sf_dir):
    assert compare(queries.op11_vector_codes(spark, sf_dir), connect(sf_dir), queries.ORACLES["op11_vector_codes"]) == []
