"""The registered queries that SQL can express, and the pipeline against its stages without Spark."""

import pytest

import corpus_pipeline
from parity import compare, connect
from tillstone.llm import near_dedup, packing, quality
from tillstone.llm.queries import ORACLES, QUERIES, WORD_BPE
from test_operators import brute_components, brute_spans, rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    ok, text = compare(spark, connect(FOLDER), FOLDER, name, QUERIES[name], ORACLES[name])
    assert ok, text


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = dict(rows_of(docs))
    good = {r.doc_id for r in quality.quality(docs, ["doc_id"]).where("keep").collect()}
    first = {}
    for i in sorted(good, key=lambda i: (-len(texts[i]), i)):
        first.setdefault("".join(texts[i].split(" ")).translate({c: None for c in range(9, 14)}), i)
    label, _ = brute_components([(i, texts[i]) for i in first.values()], 5, 80)
    left = sorted(i for i in label if label[i] == i)
    clean = {}
    for i in left:
        t = list(texts[i])
        for s, e, _ in brute_spans(texts[i]):
            t[s:e] = "*" * (e - s)
        clean[i] = "".join(t)
    made = packing.LibraryIds(WORD_BPE)
    want = {i: len(b) // 4 + 1 for i, b in zip(left, made([clean[i] for i in left]))}
    got = {}
    for r in corpus_pipeline.run(spark, FOLDER).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want


def test_stages_keep_the_columns(spark):
    docs = spark.createDataFrame([(1, None, "q"), (2, "five words are in here. token=abcdefgh1", None), (3, "", "q")], "doc_id BIGINT, text STRING, kept STRING")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    assert corpus_pipeline.mask_secrets(spark, docs, FOLDER).where("doc_id = 2").first().text == "five words are in here. " + "*" * 15


CLASHING = ["keep", "kept", "_kept", "_text", "spans", "blob", "score", "posterior", "votes", "component_id", "keep_id",
            "group_size", "_part", "_before", "ids", "size", "shard", "key", "start", "length", "offset"]


def test_extra_columns_may_have_any_name(spark):
    text = "five words are in here. token=abcdefgh1"
    rows = [(i, t, *[f"{n}{i}" for n in CLASHING]) for i, t in ((1, text), (2, text), (3, None), (None, "a text without an id is kept"))]
    docs = spark.createDataFrame(rows, ", ".join(["doc_id BIGINT", "text STRING", *[f"`{n}` STRING" for n in CLASHING]]))
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, FOLDER)
        assert left.columns == docs.columns, name
    kept = {r.doc_id: r for r in left.collect()}
    assert set(kept) == {1, None} and all(kept[1][n] == f"{n}1" for n in CLASHING)
    assert kept[1].text == "five words are in here. " + "*" * 15
    assert corpus_pipeline.pack_sequences(spark, left, FOLDER).count() == 2


def test_dedup_decides_by_row(spark):
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    rows = [(7, "twice"), (7, "twice"), (None, "hot"), (None, "hot"), (None, "hot"), (3, "x"), (9, "x"), (9, "y"), (None, "x"), (None, "z")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    left = corpus_pipeline.drop_exact_copies(spark, docs, FOLDER)
    want = [("hot", None), ("twice", 7), ("x", 3), ("y", 9), ("z", None)]
    assert sorted((r.text, r.doc_id) for r in left.collect()) == want
    near = [(None, long), (None, f"{long} more"), (4, f"{long} less"), (5, "other"), (5, f"{long} end"), (5, "other")]
    docs = spark.createDataFrame(near, "doc_id BIGINT, text STRING").repartition(3)
    left = corpus_pipeline.drop_near_copies(spark, docs, FOLDER)
    assert sorted((r.text, r.doc_id) for r in left.collect()) == [(f"{long} less", 4), ("other", 5)]


def test_packing_words_are_kept_by_the_task_not_the_worker():
    # A reused Python worker carried the words of all earlier tasks and runs into the next stage and run.
    first = packing.LibraryIds(WORD_BPE)
    made = first(["one two three", "two three four"])
    assert first.known
    assert not packing.LibraryIds(WORD_BPE).known
    assert not hasattr(packing._library(WORD_BPE), "known")
    assert packing.LibraryIds(WORD_BPE)(["one two three", "two three four"]) == made
