import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import prose
from pyspark.sql import functions as F

from shopgrain.llm import quality

KINDS = quality._class_table()
LABELS = "doc_id long, quality int, toxic int"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    marked = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = text.split("\n")
    again = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(marked)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB é|#😀\n\t\x0b\x0c\r\x85 .", max_size=60))
def test_base_statistics_equal_brute_force(text):
    assert quality.text_statistics(text, KINDS)[:5] == brute(text)


def test_words_by_kind_and_windows_of_many_words():
    found = dict(zip(quality.STATISTICS, quality.text_statistics("NO!! no a|b It's OK É", KINDS)))
    assert (found["n_symbol_words"], found["n_capital_words"], found["n_marked_words"], found["n_top_word"]) == (1, 2, 1, 1)
    codes = np.array([0, 1, 2, 3, 0, 1, 2], dtype=np.int64)
    assert quality._repeated_words(codes, 4) == quality._repeated_words(codes, 3_000_000) == 6


def test_forest_sets_outliers_apart():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 4))
    x[:20] += 9
    scores = quality.grow(x, 100).scores(x)
    assert scores[:20].min() > np.quantile(scores[20:], 0.99)
    assert (quality.grow(x, 100).scores(x) == scores).all()
    # The path of a row is that of a walk by hand.
    forest = quality.grow(x, 3)
    node, tree = 0, 1
    while forest.left[tree, node] != node:
        below = x[5, forest.feature[tree, node]] < forest.split[tree, node]
        node = (forest.left if below else forest.right)[tree, node]
    walked = forest.length[1, node]
    alone = quality.Forest(*(a[1:2] for a in (forest.feature, forest.split, forest.left, forest.right, forest.length)), forest.height, forest.rows)
    assert alone.scores(x[5:6])[0] == pytest.approx(2 ** (-walked / float(quality.mean_path(256))))


def junk(seed):
    rng = random.Random(seed)
    return " ".join(w + rng.choice(["###", "***", "&&&"]) for w in prose("en", 150, seed).split())


@pytest.fixture(scope="module")
def corpus():
    good = [(i, prose("en" if i % 2 else "de", 60 + i, i)) for i in range(400)]
    return good, [(1000 + i, junk(i)) for i in range(24)]


def test_junk_goes_and_clean_documents_stay(spark, documents, corpus):
    good, bad = corpus
    docs = documents(*good, *bad, *[(5000 + i, bad[0][1]) for i in range(100)])  # copies of one junk text
    labels = spark.createDataFrame(
        [(i, 1, 0) for i, _ in good[::2]] + [(i, 0, 1) for i, _ in bad[::2]] + [(None, 0, 0), (3, None, 1), (2, 1, 0)], LABELS
    )
    found = {r["doc_id"]: r for r in quality.judge(docs, labels).collect()}
    assert len(found) == 524
    assert sum(found[i]["kept"] for i, _ in good) >= 0.85 * len(good)
    assert sum(found[i]["kept"] for i, _ in bad) <= 0.25 * len(bad)
    assert len({found[i]["kept"] for i in [1000, *range(5000, 5100)]}) == 1
    for i, text in good[:40] + bad[:10]:
        assert tuple(found[i][n] for n in quality.STATISTICS[:5]) == brute(text)


def test_awkward_rows_and_missing_labels(spark, awkward):
    none = spark.createDataFrame([], LABELS)
    found = quality.judge(awkward, none)
    rows = {(r["doc_id"], r["n_words"]): r for r in found.collect()}
    assert found.count() == 11
    assert rows[1, 0]["base_failed"] and not rows[1, 0]["kept"] and rows[2, 0]["base_failed"]
    assert rows[7, 20_000]["kept"] and rows[6, 400]["kept"]
    assert quality.judge(awkward.limit(0), none).count() == 0


def test_the_plain_rules_at_their_bounds(spark, documents):
    words = [f"w{i}" for i in range(200)]
    half = words[:50] + ["x", "y", "z"] * 17  # 51 of 101 words repeated
    docs = documents((1, " ".join(words[:49])), (2, " ".join(words[:50])), (3, " ".join(half)), (4, " ".join(half[:50] + half)))
    found = {r["doc_id"]: r for r in quality.statistics(docs).withColumn("failed", quality.base_failed()).collect()}
    assert [found[i]["failed"] for i in (1, 2, 3, 4)] == [True, False, 100 * 51 > 50 * 101, True]


def test_thresholds_follow_the_labels():
    good, bad = np.zeros(quality.BINS), np.zeros(quality.BINS)
    good[100:200], bad[600:700] = 5, 1
    assert 199 / quality.BINS < quality._best_cut(good, bad) < 600 / quality.BINS + 1e-9
    good[640] = 1  # one good row among the bad: cheaper to drop than to keep 40 bad ones
    assert quality._best_cut(good, bad) < 601 / quality.BINS


def test_stats_read_no_other_columns(awkward):
    assert set(quality.statistics(awkward.withColumn("n_words", F.lit("x"))).columns) == {"doc_id", "digest", *quality.STATISTICS}


def test_junk_and_clean_documents_of_the_test_tables(spark):
    folder = "/root/testdata/sf0.1"
    found = quality.op11_quality_rules(spark, folder).where("not base_failed")
    marks = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    kept = {r["quality"]: r["kept"] for r in found.join(marks, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert kept[1] > 0.98 and kept[0] < 0.3
