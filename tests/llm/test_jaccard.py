import random
from collections import Counter

import numpy as np

from orderrisk.llm import jaccard, queries

from .common import TOKENIZER_WORDS, awkward, frame, lowered


def brute(docs, percent=75):
    sets = {}
    for key, text in docs:
        w = TOKENIZER_WORDS.findall(lowered(text))
        sets[key] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    holders = {}
    for key, found in sets.items():
        for x in found:
            holders.setdefault(x, []).append(key)
    parent = {key: key for key in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for key, found in sets.items():
        for other, both in Counter(o for x in found for o in holders[x] if o < key).items():
            if 100 * both >= percent * (len(found) + len(sets[other]) - both):
                a, b = sorted((root(key), root(other)))
                parent[b] = a
    return {key: (len(found), root(key)) for key, found in sets.items()}


def test_equals_brute_force(spark):
    docs = awkward()
    found = jaccard.join(frame(spark, docs)).collect()
    assert len(found) == len(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(docs)


def test_chain_of_links_between_hubs(spark):
    # Neighbours in the chain are similar, ends are not.
    words = [f"v{i}" for i in range(400)]
    docs = [(i, " ".join(words[10 * i : 10 * i + 120])) for i in range(25)]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(frame(spark, docs)).collect()}
    assert found == brute(docs)
    assert {c for _, c in found.values()} == {0}


def test_repeated_rows_null_keys_and_no_rows(spark):
    docs = [(3, "a b c d e f"), (3, "a b c d e f"), (4, "A b  c d e f"), (None, "a b c d e f"), (6, None)]
    found = jaccard.join(frame(spark, docs)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found if r.doc_id) == [
        ("3", 2, "None"), ("3", 2, "None"), ("4", 2, "None"), ("6", 0, "6")
    ]
    assert jaccard.join(frame(spark, []).where("false")).count() == 0


def test_null_keys_connect_nothing_and_are_no_ones_component(spark, tmp_path):
    first, second = "a b c d e f g h", "k l m n o p q r"
    docs = [(3, first), (4, first), (None, first), (7, second), (8, second), (None, second), (None, "s t u v w x"), (None, "s t u v w x"), (None, None), (9, second + " z"), (9, "quite another text of nine")]
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op2_ngram_jaccard(spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == [
        ("3", 4, "3"), ("4", 4, "3"), ("7", 4, "7"), ("8", 4, "7"), ("9", 1, "9"), ("9", 5, "7"),
        ("None", 0, "None"), ("None", 2, "None"), ("None", 2, "None"), ("None", 4, "3"), ("None", 4, "7"),
    ]


def test_bitmaps_differ_in_no_more_bits_than_sets_in_tokens(spark):
    rng = random.Random(5)
    sets = [rng.sample(range(3000), rng.choice([1, 20, 300, 1500])) for _ in range(40)]
    rows = [(i, np.array(s, "<u8").tobytes()) for i, s in enumerate(sets)]
    made = {r[0]: np.array(r[1:]) for r in jaccard._bitmaps(spark.createDataFrame(rows, "key long, tokens binary")).collect()}
    apart = [(len(set(sets[i]) ^ set(sets[j])), sum(int(x).bit_count() for x in (made[i] ^ made[j]).view(np.uint64))) for i in made for j in made]
    assert all(bits <= tokens for tokens, bits in apart)
    assert max(bits for _, bits in apart) > 200


def test_sets_that_differ_too_much_are_no_rows_of_the_join(spark):
    # All share the prefix token 1 and little else.
    sets = {k: [1, *range(1000 * k, 1000 * k + 40)] for k in range(2, 30)} | {k: [1, *range(2000, 2040), 5000 + k] for k in range(30, 33)}
    rows = spark.createDataFrame([(1, k, len(s), 0, 0, k) for k, s in sets.items()], "token long, key long, n long, lone long, at long, component long")
    held = spark.createDataFrame([(k, np.array(s, "<u8").tobytes()) for k, s in sets.items()], "key long, tokens binary")
    pairs = jaccard._pairs(rows, jaccard._bitmaps(held), 75)
    join = next(line for line in pairs._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line)
    assert "bit_count" in join
    assert {tuple(sorted(r)) for r in pairs.collect()} >= {(30, 31), (30, 32), (31, 32)}
    assert pairs.count() < 20


def test_first_turn_asks_for_no_labels(spark, monkeypatch):
    # Equal sets of a batch are linked already, but only one of them has tokens.
    seen, real = [], jaccard._labelled
    monkeypatch.setattr(jaccard, "_labelled", lambda rows, labels: seen.append(labels) or real(rows, labels))
    docs = [(i, f"a b c d e f g h {i // 2}") for i in range(8)]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(frame(spark, docs, 1)).collect()}
    assert found == brute(docs)
    assert seen[0] is None and len(seen) > 1


def test_labels_meet_one_row_a_set_and_settled_blocks_do_not_move(spark):
    # Sets 0 to 3 are one component and share tokens 0 to 9; 3 and 4 share 50 to 59, 5 is alone.
    sets = [list(range(10)) + list(range(20 + 5 * i, 24 + 5 * i)) for i in range(3)]
    sets += [list(range(10)) + list(range(50, 60)), list(range(50, 60)) + list(range(70, 75)), list(range(80, 90))]
    rows = [(i, len(t), 0, np.array(t, "<u8").tobytes()) for i, t in enumerate(sets)]
    labels = spark.createDataFrame([(i, 0) for i in range(4)], "key long, component long")
    found = jaccard._unsettled(spark.createDataFrame(rows, "key long, n long, lone long, tokens binary"), labels, 0).collect()
    names = {int(m): t for t, m in zip(range(90), jaccard.mixed(np.arange(90, dtype=np.uint64)).view(np.int64), strict=True)}
    wanted = {(t, key, component, at) for key, component, start in ((3, 0, 10), (4, 4, 0)) for at, t in enumerate(range(50, 60), start)}
    held = {(names[r.token], r.key, r.component, r.at) for r in found}
    assert wanted <= held
    # The filter may let a few others through.
    assert len(held - wanted) < 5


def test_prefix_rows_do_not_move_by_key_to_meet_labels(spark, monkeypatch):
    joined = []
    labelled = jaccard._labelled
    monkeypatch.setattr(jaccard, "_labelled", lambda rows, labels: joined.append((labels is not None, "token" in rows.columns)) or labelled(rows, labels))
    docs = awkward()
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(frame(spark, docs)).collect()}
    assert found == brute(docs)
    assert joined[:2] == [(False, True), (True, False)]
