import math
from collections import Counter, defaultdict

from llm.conftest import AWKWARD, prose

from shopgrain.llm import scoring
from shopgrain.llm.common import crc_mod_of

END = object()


def tokens(text):
    return (text or "").encode().lower().split() + [END]


def check(docs, texts):
    rows = scoring.score_documents(docs).collect()
    learned = [t for i, t in texts if crc_mod_of(i, 7) != 2]
    words, pairs = Counter(), Counter()
    for text in learned:
        found = tokens(text)
        words.update(found)
        pairs.update(zip([END, *found], found))
    n, v = sum(words.values()), len(words)
    by_id = defaultdict(set)
    for i, text in texts:
        by_id[i].add(text)
    for r in rows:
        (text,) = by_id[r["doc_id"]]
        found = tokens(text)
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in found)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(found), sum(words[w] > 0 for w in found), n)
        assert r["held_out"] == (crc_mod_of(r["doc_id"], 7) == 2)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9, abs_tol=1e-9)
        assert r["score"] < 0 and math.isfinite(r["score"])
    assert len(rows) == len(texts)
    return rows, words, pairs, n, v


def test_counts_base_and_better_scores(documents, monkeypatch):
    monkeypatch.setattr(scoring, "BLOCK_BYTES", 6_000)  # many blocks and buckets
    monkeypatch.setattr(scoring, "BUCKET_GRAMS", 700)
    texts = [(i, prose("en", 40 + i % 60, i % 150)) for i in range(240)]
    rows, *_ = check(documents(*texts), texts)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_the_mixture_is_the_one_with_the_learned_weights(documents, monkeypatch):
    learned = {}
    own = scoring.learn_weights

    def keep(*args):
        learned["w"] = own(*args)
        return learned["w"]

    monkeypatch.setattr(scoring, "learn_weights", keep)
    texts = [(i, prose("de", 30, i % 40)) for i in range(90)]
    rows, words, pairs, n, v = check(documents(*texts), texts)
    w = learned["w"]
    assert abs(w.sum(axis=1) - 1).max() < 1e-9 and w.min() >= 0 and w[0, 0] == 0
    for r in rows:
        found = tokens(dict(texts)[r["doc_id"]])
        score = 0.0
        for h, x in zip([END, *found], found):
            a, b, c = w[int(math.log2(words[h])) + 1 if words[h] else 0]
            score += math.log10(a * pairs[h, x] / max(words[h], 1) + b * words[x] / n + c / (v + 1))
        assert math.isclose(r["score"], score, rel_tol=1e-9)


def test_awkward_documents(documents, awkward):
    rows = [r for r in AWKWARD if r[0] is not None]
    check(documents(*rows), rows)
    assert scoring.score_documents(awkward).count() == len(AWKWARD)
    assert scoring.score_documents(awkward.limit(0)).collect() == []


def test_sorted_numbers_and_counts_come_back():
    import numpy as np

    values = np.sort(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64)) * np.uint64(2)
    assert (scoring._unpack_sorted(scoring._pack_sorted(values)) == values).all()
    for most in (0, 255, 256, 70_000, 2**40):
        assert scoring._expand(scoring._squeeze(np.array([0, most]))).tolist() == [0, most]
