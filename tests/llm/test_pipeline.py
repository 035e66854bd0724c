import gc
import re
import sys
import weakref

import corpus_pipeline
import public_tokenizers
import pyarrow as pa
from llm.conftest import prose
from llm.test_decontamination import brute as leaks
from llm.test_jaccard import brute as groups
from llm.test_jaccard import changed

from shopgrain.llm import language, packing, tokens
from shopgrain.llm.common import HANDED, steps, written


def test_every_stage_against_brute_force(spark, folder):
    base = prose("en", 90, 1)
    rows = [(i, prose(lang, 70, i), lang) for i, lang in enumerate(["en", "de"] * 25)]
    rows += [(100, base, "en"), (101, changed(base, 1, 1), "en"), (102, base, "en"), (103, None, "en"), (104, "", None), (105, "12 34", "de")]
    rows += [(106, f'{prose("de", 40, 9)} token = "abcdefghijklmnop"', "de")]
    items = [(1, prose("de", 20, 77)), (2, prose("en", 30, 78))]
    rows += [(107, f"{prose('de', 30, 5)} {items[0][1]}", "de"), (108, f"{items[1][1]} {prose('en', 30, 6)}", "en")]
    docs = spark.createDataFrame([(i, t, l, "s", len(t or "")) for i, t, l in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")

    model = language.Model(language.fit(language.training_rows(docs)))
    left = [(i, t) for i, t, _ in rows if (p := model.predict(t))[0] != "und" and p[2] >= language.LEAST_MARGIN]
    assert {i for i, _, _ in rows} - {i for i, _ in left} == {103, 104, 105}
    stages = [left]
    _, group = groups([t for _, t in left])
    left = [row for n, row in enumerate(left) if group[n] == n]
    stages.append(left)
    found = {i for i, _ in leaks(left, items)}
    assert found == {107, 108}
    left = [row for row in left if row[0] not in found]
    stages.append(left)
    left = [(i, re.sub(r'token = "[a-z]+', "[SECRET]", t)) for i, t in left]
    stages.append(left)

    now = spark.read.parquet(f"{folder}/documents.parquet")
    for (name, stage), want in zip(corpus_pipeline.STAGES, stages):
        now = written(stage(spark, now, folder), "test-stage")
        assert now.columns == docs.columns, name
        assert sorted((r["doc_id"], r["text"]) for r in now.collect()) == sorted(want), name
    last = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in last} == {i for i, _ in left}
    direct = packing.pack(now).collect()
    assert sorted((r["doc_id"], r["ids_crc32"]) for r in last) == sorted((r["doc_id"], r["ids_crc32"]) for r in direct)


def test_a_written_table_hands_small_batches_to_python_tasks(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows]}, schema=pa.schema([("rows", pa.int64())]))

    before = {name: spark.conf.get(name) for name in HANDED}
    found = written(spark.range(0, 5000, 1, 1).mapInArrow(sizes, "rows long"), "batches")
    assert found.groupBy().sum("rows").first()[0] == 5000
    assert found.groupBy().max("rows").first()[0] <= 1024
    assert {name: spark.conf.get(name) for name in HANDED} == before


def test_tasks_of_other_stages_drop_the_encoders_that_packing_left():
    path = public_tokenizers.path(packing.TOKENIZER)
    batch = pa.RecordBatch.from_pydict({"text": ["one"]})
    kept = tokens.encoder(path)
    assert len(list(steps([batch], encoders=True))) == 1
    assert tokens.encoder(path) is kept
    assert len(list(steps([batch]))) == 1
    assert tokens.KEPT not in sys.__dict__


def test_a_task_frees_what_earlier_tasks_left(monkeypatch):
    class Held:
        pass

    held = Held()
    held.itself = held  # as functions sent to a task refer to each other
    left = weakref.ref(held)
    gc.disable()
    try:
        del held
        monkeypatch.setitem(sys.__dict__, tokens.TIDIED, 0.0)
        assert len(list(steps([pa.RecordBatch.from_pydict({"text": ["one"]})], encoders=True))) == 1
        assert left() is None
    finally:
        gc.enable()


def test_steps_hold_no_more_bytes_than_asked():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 1000] * 300})
    sizes = [step.num_rows for step in steps([batch], 64, most=20_000)]
    assert sum(sizes) == 300 and max(sizes) <= 20


def test_empty_documents(spark, folder):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []
