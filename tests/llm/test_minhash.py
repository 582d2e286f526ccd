import numpy as np
import pytest

from orderrisk.llm import jaccard, minhash, queries

from ..parity import compare, connect
from .common import awkward, frame
from .test_jaccard import brute


def found(spark, docs, **how):
    return minhash.duplicates(frame(spark, docs), **how).collect()


def test_equals_brute_force(spark):
    docs = awkward()
    rows = found(spark, docs)
    assert len(rows) == len(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(docs, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def chain(steps, base=0):
    """Neighbours are similar, those two steps apart are not."""
    words = [f"v{base}x{i}" for i in range(400)]
    return [" ".join(words[7 * i : 7 * i + 120]) for i in range(steps)]


def test_chains_that_no_star_connects(spark, monkeypatch):
    # A star at one document reaches its neighbours only; the rest is left to the blocks, here of two rows.
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 2)
    docs = [(10 * i + j, t) for j in range(3) for i, t in enumerate(chain(20, j))]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found(spark, docs)} == brute(docs, 85)
    monkeypatch.setattr(minhash, "STAR_YIELD", 0)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found(spark, docs)} == brute(docs, 85)


def test_null_and_repeated_keys(spark):
    first, second = "a b c d e f g h", "k l m n o p q r"
    docs = [(3, first), (3, first), (3, second), (4, first), (None, first), (None, second), (None, "s t u v w x"), (7, None), (8, ""), (None, None)]
    rows = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in found(spark, docs))
    assert rows == [
        ("3", 4, "3", True), ("3", 4, "3", True), ("3", 4, "3", True), ("4", 4, "3", False), ("7", 0, "7", True), ("8", 0, "8", True),
        ("None", 0, "None", True), ("None", 2, "None", True), ("None", 4, "3", False), ("None", 4, "3", False),
    ]


def test_no_rows_and_no_words(spark):
    assert minhash.duplicates(frame(spark, awkward()).where("false")).collect() == []
    assert [tuple(r) for r in found(spark, [(1, None)])] == [(1, 0, 1, True)]


def sets_of(rng, n, similarity):
    """Two sets of about n hashes with that similarity."""
    both = int(n * 2 * similarity / (1 + similarity))
    pool = rng.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64) * np.uint64(2)
    return np.sort(pool[:n]), np.sort(np.concatenate((pool[:both], pool[n:])))


@pytest.mark.parametrize("n", [7, 40, 300, 5000])
def test_sketches_agree_as_often_as_sets_are_similar(n):
    rng = np.random.default_rng(n)
    agree = []
    for _ in range(40):
        a, b = sets_of(rng, n, 0.85)
        real = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        made = minhash.sketches(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]), minhash.BINS)
        agree.append((made[0] == made[1]).mean() - real)
        bands = minhash.bands_of(made, minhash.BANDS, minhash.ROWS)
        assert (bands[0] == bands[1]).any()
        assert (made[0] == made[1]).sum() >= minhash.least_agreement(85, minhash.BINS) or real < 0.85
    assert abs(np.mean(agree)) < 0.02


def test_one_filled_bin_fills_all_and_empty_sets_have_none():
    made = minhash.sketches(np.array([5 << 55], np.uint64), np.array([0, 0, 1]), 512)
    assert (made[0] == 0).all() and (made[1] == 5 << 55).all()


def test_sets_are_those_of_the_other_join():
    assert minhash.shingle_sets is jaccard.shingle_sets and minhash.SHINGLE == jaccard.SHINGLE


@pytest.mark.parametrize("name", ["op13_minhash_dedup", "op2_ngram_jaccard"])
def test_queries_equal_their_sql(spark, sf_dir, name):
    assert compare(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) == []


def test_copies_below_the_limit_leave_blocks_as_members_not_as_pairs(spark):
    # Copies of one text with changes of their own: signatures of any two agree well enough, full sets do not.
    base = [f"w{i}" for i in range(120)]
    docs = [(i, " ".join(f"x{i}y{j}" if j in (7 + i % 5, 60 + i % 7) else w for j, w in enumerate(base))) for i in range(100)]
    table = frame(spark, docs)
    state = minhash.sketched(table, minhash.SHINGLE, "doc_id", "text")
    one = state.selectExpr("7L as bucket", "0 as band", "row as key", "n", "row as component", "-1L as hub_component")
    blocks = minhash._left_over(one, state.selectExpr("row as key", "n", "signature"), minhash.PERCENT).collect()
    assert sum(len(r.others or b"") // 8 for r in blocks) > 10 * len(docs)
    assert len(blocks) <= len(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found(spark, docs)} == brute(docs, 85)
