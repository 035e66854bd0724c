import random

import pytest
from llm.conftest import AWKWARD, prose

from shopgrain.llm import toxicity


def texts(n):
    rng = random.Random(8)
    out = []
    for i in range(n):
        words = prose(rng.choice(("en", "de")), rng.randint(5, 60), i).split()
        toxic = i % 3 == 0
        for _ in range(rng.randint(1, 4) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(("you grobian", "lumpi" + rng.choice(("en", "chen", "heit")), "GROBIAN!!", "gr0bian")))
        out.append((i, " ".join(words), int(toxic)))
    return out


@pytest.fixture(scope="module")
def fitted(spark):
    rows = texts(900)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    return rows, docs, toxicity.fit(docs, labels.where("doc_id < 600"))


def test_held_out_documents(fitted):
    rows, docs, model = fitted
    assert "grobian" in model.lexicon and any(term.startswith("^lump") for term in model.lexicon)
    found = {r["doc_id"]: r for r in toxicity.score(docs.where("doc_id >= 600"), model).collect()}
    truth = {i: toxic for i, _, toxic in rows if i >= 600}
    assert sum(found[i]["predicted"] == t for i, t in truth.items()) / len(truth) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())


def test_scores_rise_with_the_trees_probability(fitted):
    _, docs, model = fitted
    raw = toxicity._raw(toxicity._with_features(docs, model.lexicon), model.trees).select("doc_id", "p")
    both = raw.join(toxicity.score(docs, model), "doc_id").orderBy("p").collect()
    assert all(a["score"] <= b["score"] + 1e-12 for a, b in zip(both, both[1:]))


def test_awkward_documents(spark, fitted, awkward):
    _, docs, model = fitted
    found = toxicity.score(awkward, model).collect()
    assert len(found) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found if r["doc_id"] in (1, 2)}) == 1
    assert toxicity.score(awkward.limit(0), model).collect() == []
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (4, 0)], "doc_id long, toxic int")
    prior = toxicity.fit(awkward, labels)  # too few rows for trees
    assert prior.trees is None and {r["score"] for r in toxicity.score(awkward, prior).collect()} == {prior.prior}
    assert toxicity.fit(awkward, labels.limit(0)).prior == 0.0


def test_features_by_hand():
    found = toxicity.features("You are a GROBIAN!! soooo grobian", {"grobian": 2.0})
    named = dict(zip(("density", "log", "weight", "max", "kinds", "near_share"), found))
    assert named["density"] == pytest.approx(100 * 2 / 6) and named["max"] == 2.0 and named["kinds"] == 1.0
    assert named["near_share"] == 1.0 and found[10] == pytest.approx(100 * 2 / 33)
    assert toxicity.features("", {}) == [0.0] * toxicity.FEATURES
    assert toxicity.features("a gr0b1an", {"grobian": 2.0})[14] == 1.0
