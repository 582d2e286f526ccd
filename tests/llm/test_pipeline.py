import corpus_pipeline
import pytest
from orderrisk.llm import decontaminate, jaccard, repeats

from .common import TOKENIZER_WORDS, lowered


@pytest.fixture(scope="module")
def stages(spark, small_dir):
    docs = [spark.read.parquet(f"{small_dir}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(corpus_pipeline.cut_lineage(stage(spark, docs[-1], small_dir)))
    return docs


def test_every_stage_takes_effect_and_keeps_the_columns(spark, small_dir, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small_dir}/labels.parquet").collect()}
    for frame in stages[1:5]:
        assert sorted(frame.columns) == sorted(stages[0].columns)
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in stages]
    gone = ids[0] - ids[1]
    assert gone
    assert all(labels.get(x) != 1 for x in gone)
    assert not any(labels.get(x) == 0 for x in ids[1])
    # One of each group stays, judged on what the stage before kept.
    found = jaccard.join(stages[1]).collect()
    assert ids[2] == {r.doc_id for r in found if r.component_id == r.doc_id}
    assert ids[3] == ids[2]
    assert ids[4] == ids[3] - {r.doc_id for r in decontaminate.decontaminate(stages[3], spark.read.parquet(f"{small_dir}/benchmark.parquet")).collect() if r.contaminated}
    assert ids[5] == ids[4]


def test_no_long_string_is_left_twice(stages):
    seen = set()
    for r in sorted(stages[2].collect(), key=lambda r: r.doc_id):
        data = r.text.encode()
        seen.update(data[p : p + 100] for p in range(len(data) - 99))
    kept = {r.doc_id: r for r in stages[3].collect()}
    judged = {r.doc_id: r for r in repeats.repeats(stages[2]).collect()}
    for key, row in kept.items():
        assert len(row.text.encode()) <= judged[key].n_bytes - judged[key].n_removed
        assert row.n_chars == len(row.text)
    assert sum(r.n_removed for r in judged.values()) > 0


def test_groups_have_one_survivor(stages):
    sets = {}
    for r in stages[2].collect():
        w = TOKENIZER_WORDS.findall(lowered(r.text))
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            assert not both or 100 * both < 75 * len(sets[a] | sets[b])


def test_awkward_rows(spark, small_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, "en", "s", 0), (None, "The same words here again today.", "en", "s", 5), (7, "", "en", "s", 0), (7, "", "en", "s", 0), (8, "A text of a few words.", "en", "s", 1), (8, "A text of a few words.", "en", "s", 1)]
    docs = spark.createDataFrame(rows, schema)
    for frame in (docs, docs.where("false")):
        kept = corpus_pipeline.near_duplicate_stage(spark, frame, small_dir)
        assert kept.count() == (5 if frame is docs else 0)
        for _, stage in corpus_pipeline.STAGES:
            frame = corpus_pipeline.cut_lineage(stage(spark, frame, small_dir))


def test_rows_are_judged_not_doc_ids(spark, small_dir):
    first, second = "a b c d e f g h", "k l m n o p q r"
    rows = [(1, first), (1, second), (1, None), (1, " "), (2, second), (3, "s t u v w x"), (4, "s t u v w x"), (None, "s t u v w x"), (5, first), (5, first), (6, second + " z")]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, small_dir).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in kept) == [("1", " "), ("1", "None"), ("1", first), ("1", second), ("3", "s t u v w x"), ("None", "s t u v w x")]


def test_columns_with_the_helpers_names_come_through(spark, small_dir):
    rows = [(1, "a b c d e f g", 11, 12, 13), (2, "a b c d e f g", 21, 22, 23), (3, "k l m n o p q", 31, 32, 33)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int, _again int, _key int")
    for stage, kept in ((corpus_pipeline.near_duplicate_stage, [1, 3]), (corpus_pipeline.decontamination_stage, [1, 2, 3])):
        found = sorted(map(tuple, stage(spark, docs, small_dir).collect()))
        assert found == [r for r in rows if r[0] in kept]
