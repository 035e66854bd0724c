import random
import time
import tracemalloc
from collections import Counter

import numpy as np
from llm.conftest import AWKWARD, prose

from shopgrain.llm import decontamination as d
from shopgrain.llm.shingles import shingle_hashes, word_hashes, words


def grams(text):
    found = text.encode().lower().split()
    width = min(5, len(found))
    return [tuple(found[i : i + width]) for i in range(len(found) - width + 1)], len(found)


def brute(texts, items):
    out = set()
    for doc_id, text in texts:
        own = (text or "").encode().lower().split()
        for item_id, item in items:
            want, m = grams(item)
            width = min(5, m)
            mine = [tuple(own[i : i + width]) for i in range(len(own) - width + 1)]
            size = min(len(want), len(mine))
            for at in range(len(mine) - size + 1 if size else 0):
                shared = sum((Counter(mine[at : at + size]) & Counter(want)).values())
                if shared / (size + len(want) - shared) >= 0.8:
                    out.add((doc_id, item_id))
    return out


def test_against_every_window(spark, documents):
    rng = random.Random(4)
    items = [(i, prose("de", n, 700 + i)) for i, n in enumerate((3, 5, 6, 15, 15, 30, 45, 59))] + [(8, "la la la la la la la la la")]
    texts = []
    for i in range(80):
        body = prose("en", rng.randint(0, 120), i).split()
        passage = rng.choice(items)[1].split()
        for _ in range(rng.choice((0, 0, 1, 2, 4))):
            passage[rng.randrange(len(passage))] = "changed"
        passage = passage[rng.choice((0, 0, 2)) :] if rng.random() < 0.5 else passage[: len(passage) // rng.choice((1, 1, 2))]
        at = rng.randint(0, len(body))
        texts.append((i, " ".join(body[:at] + passage + body[at:])))
    benchmark = spark.createDataFrame([*items, (9, None), (None, "x y"), (10, " ")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in d.find_leaks(documents(*texts), benchmark).collect()}
    assert found == brute(texts, items) and len(found) > 20
    kept = d.drop_leaks(documents(*texts), benchmark)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in texts} - {i for i, _ in found}


def test_more_than_one_slice(spark, documents, monkeypatch):
    items = [(i, prose("de", 20, i)) for i in range(30)]
    texts = [(i, f"{prose('en', 10, i)} {items[i % 30][1]} {prose('en', 10, i + 50)}") for i in range(40)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    make = d.slices
    monkeypatch.setattr(d, "slices", lambda table: make(table, slice_chars=600))
    assert len(list(d.slices(benchmark))) > 3
    found = {(r["doc_id"], r["item_id"]) for r in d.find_leaks(documents(*texts), benchmark).collect()}
    assert found == {(i, i % 30) for i in range(40)}
    assert d.drop_leaks(documents(*texts), benchmark).count() == 0


def test_the_tables_find_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(6)
    own = d._Class(9)
    own.ids, own._prints = list(range(50)), list(rng.integers(0, 256, (50, 16), dtype=np.uint8))
    own.close()
    near = own.prints[rng.integers(0, 50, 400)].copy()
    for row in near:
        bits = np.unpackbits(row)
        bits[rng.choice(128, rng.integers(0, 60), replace=False)] ^= 1
        row[:] = np.packbits(bits)
    distance = np.unpackbits(near[:, None] ^ own.prints[None], axis=2).sum(axis=2)
    window, item, found = own.within(near)
    assert set(zip(window, item)) == set(zip(*np.nonzero(distance <= d.RADIUS)))
    assert (found == distance[window, item]).all()


def test_fingerprints_of_windows_are_those_of_their_shingles():
    shingles = shingle_hashes(word_hashes(words(prose("en", 60, 1))))
    for start in (0, 7, 30):
        bits = np.unpackbits(d.fingerprints(shingles, 12, np.arange(start, start + 3))[1])
        one = np.unpackbits(d.fingerprints(shingles[start + 1 : start + 13], 12, np.zeros(1, dtype=np.int64))[0])
        assert (bits == one).all()


def test_many_items_of_one_length_in_bounded_memory():
    """20,000 items of 40 words: what a text costs follows its hits, and no table of all windows with all items is made."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=40))) for i in range(20_000)]
    bench = d.Benchmark(items)
    clean = " ".join(rng.choices(vocabulary, k=100_000))
    leaky = " ".join(f"{clean[i * 400 : i * 400 + 400]} {items[i * 90][1]} {items[i * 90 + 1][1]}" for i in range(100))
    tracemalloc.start()
    started = time.monotonic()
    assert bench.find(clean) == []
    found = bench.find(leaky)
    seconds, peak = time.monotonic() - started, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {x[0] for x in found} == {i * 90 + k for i in range(100) for k in (0, 1)}
    assert peak < 200 << 20 and seconds < 60


def test_awkward_documents(spark, awkward):
    items = [(1, "one"), (2, prose("en", 400, 6))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = d.find_leaks(awkward, benchmark).collect()
    assert Counter((r["doc_id"], r["item_id"]) for r in found) == {(4, 1): 2, (None, 1): 1, (6, 2): 2}
    kept = d.drop_leaks(awkward, benchmark)
    assert kept.columns == awkward.columns and kept.count() == len(AWKWARD) - 5
    assert d.find_leaks(awkward, benchmark.limit(0)).collect() == []
    assert d.find_leaks(awkward.limit(0), benchmark).collect() == []
