import math
import re
from collections import Counter

import numpy as np
import pytest

from orderrisk.llm import lexical, queries

from ..parity import compare, connect
from .common import awkward, frame, lowered

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def brute(docs, items, k=10):
    held = [(key, Counter(TERM.findall(lowered(text)))) for key, text in docs]
    n_docs = sum(1 for _, c in held if c)
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for key, c in held:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // max(1, total)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(TERM.findall(lowered(text))) if t in c)
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        out += [(item, i + 1, key, -s) for i, (s, _, _, key) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def asked(spark, items):
    return spark.createDataFrame([(i, t, 1, 2, "d") for i, t in items], "item_id long, text string, query long, score long, doc string")


def found(spark, docs, items, **how):
    return sorted((tuple(r) for r in lexical.ranked(frame(spark, docs), asked(spark, items), **how).collect()), key=repr)


ITEMS = [(1, "w1é w2é W3É fox"), (2, None), (3, ""), (4, "one"), (5, "nowhere to be seen"), (6, "The the THE quick-brown"), (None, "w7é"), (1, "a b c"), (8, " ".join(f"w{i}é" for i in range(400)))]


@pytest.mark.parametrize("how", [{}, {"block_terms": 50}, {"k": 1}, {"k": 200}])
def test_equals_brute_force(spark, how, monkeypatch):
    docs = [*awkward(), (None, "w7é w7é"), (None, "w7é"), (4, "one"), (4, "One two")]
    assert found(spark, docs, ITEMS, **how) == brute(docs, ITEMS, how.get("k", 10))


def test_ties_go_by_key_across_shards(spark, monkeypatch):
    docs = [(i, "same text here" if i % 2 else "other") for i in range(200, 0, -1)]
    assert found(spark, docs, [(1, "same"), (2, "text other")]) == brute(docs, [(1, "same"), (2, "text other")])


def test_empty_tables(spark):
    docs, items = frame(spark, awkward()), asked(spark, ITEMS)
    assert lexical.ranked(docs.where("false"), items).collect() == []
    assert lexical.ranked(docs, items.where("false")).collect() == []
    assert lexical.ranked(docs, asked(spark, [(1, "unseen")])).columns == ["item_id", "rank", "doc_id", "score"]


def lists_of(rng, n_docs, n_lists, skew):
    docs, impacts, ends = [], [], [0]
    for _ in range(n_lists):
        some = np.sort(rng.choice(n_docs, rng.integers(1, n_docs), replace=False))
        docs.append(some)
        impacts.append((1000 * rng.pareto(skew, len(some))).astype(np.int64) + 1)
        ends.append(ends[-1] + len(some))
    return lexical.Lists.of(n_docs, np.array(ends), np.concatenate(docs), np.concatenate(impacts))


def scores_of(lists, asked_lists):
    total = np.zeros(lists.n_docs, np.int64)
    for t in asked_lists:
        a, b = lists.starts[t : t + 2]
        total[lists.docs[a:b]] += lists.impacts[a:b]
    return total


def test_search_of_a_shard_is_exact_and_stops_early():
    rng = np.random.default_rng(3)
    read = whole = 0
    for _ in range(60):
        lists = lists_of(rng, 3000, 6, 0.7)
        some = np.sort(rng.choice(6, rng.integers(1, 7), replace=False))
        docs, scores, places = lexical.best_positions(lists, some, 10)
        want = scores_of(lists, some)
        assert (want[docs] == scores).all() and len(np.unique(docs)) == len(docs)
        assert sorted(scores, reverse=True)[:10] == sorted(want, reverse=True)[:10]
        # Every document that ties with the k-th is there.
        kth = np.sort(want)[-10]
        assert set(np.flatnonzero(want >= max(kth, 1))) <= set(docs)
        read += places
        whole += np.diff(lists.starts)[some].sum()
    assert read < whole / 3


def test_a_known_score_of_other_shards_ends_the_search_before_it_begins():
    lists = lists_of(np.random.default_rng(4), 500, 3, 2.0)
    highest = int(lists.impacts[lists.starts[:-1]].sum())
    assert lexical.best_positions(lists, np.arange(3), 10, highest + 1)[2] == 0
    assert lexical.best_positions(lists, np.arange(3), 10, highest)[2] > 0


def test_query_equals_its_sql(spark, sf_dir):
    assert compare(queries.op12_lexical_search(spark, sf_dir), connect(sf_dir), queries.ORACLES["op12_lexical_search"]) == []
