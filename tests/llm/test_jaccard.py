import random

from llm.conftest import AWKWARD, prose

from shopgrain.llm import jaccard
from shopgrain.llm.components import components


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(texts):
    """Position -> (set size, positions reachable by links) by comparing all pairs."""
    sets = [shingles(t) for t in texts]
    group = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= 80 * len(x | y) and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return [len(x) for x in sets], group


def changed(text, edits, seed):
    rng = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def check(documents, texts, monkeypatch=None):
    sizes, group = brute(texts)
    found = {r["doc_id"]: r for r in jaccard.jaccard_components(documents(*enumerate(texts))).collect()}
    assert [found[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert [found[i]["component_id"] for i in range(len(texts))] == group


def test_against_all_pairs(documents):
    rng = random.Random(5)
    texts = [prose("en", n, n) for n in (1, 2, 3, 4, 5, 8, 9, 12, 14, 20, 30, 60, 200)]
    texts += [t + " tail" for t in texts] + ["head " + t for t in texts]
    texts += [changed(prose("en", n, n), n // k, n + k) for n in (30, 60, 200) for k in (12, 20, 30, 45, 60)]
    common = prose("de", 55, 1)  # a passage that many documents share
    texts += [f"{prose('en', rng.randint(10, 90), 900 + i)} {common} {prose('en', 8, 1900 + i)}" for i in range(40)]
    base = prose("de", 150, 2)  # near copies of one text, some out of reach of each other
    texts += [changed(base, rng.randint(0, 5), 3000 + i) for i in range(60)]
    texts += [texts[-1]] * 30 + ["", None, "  "]
    rng.shuffle(texts)
    check(documents, texts)


def test_split_lists_and_every_boundary(documents, monkeypatch):
    """Frequent shingles from a count of 2 on, lists split over salts, few star rounds, and other boundaries."""
    texts = [changed(prose("en", 40, 1), i % 4, i) for i in range(30)] + [changed(prose("en", 12, 2), i % 2, i) for i in range(12)]
    texts += [prose("en", 12, 2) + " x" * i for i in range(4)]
    monkeypatch.setattr(jaccard, "FREQUENT_LEAST", 2)
    monkeypatch.setattr(jaccard, "SALT_ROWS", 3)
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", 0)
    for boundary in (3, 20):
        monkeypatch.setattr(jaccard, "light_boundary", lambda sizes, mean, b=boundary: b)
        check(documents, texts)


def test_pairs_of_a_list_that_cannot_link_are_not_joined(documents, monkeypatch):
    """Texts that share a fifth of their shingles, all of them rare, meet in lists and differ too much to link."""
    common = prose("de", 40, 1)
    texts = [f"{prose('en', 150, 100 + i)} {common}" for i in range(5)] + [changed(prose("en", 150, 7), i, i) for i in range(3)]
    seen, lists = [], []
    meetings = jaccard._meetings

    def spied(live, sketches, boundary):
        found = meetings(live, sketches, boundary)
        lists.append(live.count())
        seen.append(found.count())
        return found

    monkeypatch.setattr(jaccard, "_meetings", spied)
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", 0)
    monkeypatch.setattr(jaccard, "FREQUENT_LEAST", 100)
    check(documents, texts)
    only = len(seen)
    check(documents, texts[:5])
    assert lists[only] > 0 and seen[only] == 0


def test_few_sets_go_to_the_pairs_and_many_are_shuffled(spark, documents, monkeypatch):
    texts = [changed(prose("en", 60, i), n, 7 * i + n) for i in range(4) for n in range(5)]
    seen = []

    def spied(df, work, schema, f=jaccard.map_steps):
        if schema == "a long, b long":
            seen.append(df._jdf.queryExecution().executedPlan().toString())
        return f(df, work, schema)

    monkeypatch.setattr(jaccard, "map_steps", spied)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        check(documents, texts)
        assert seen and all("BroadcastHashJoin [a#" in plan and "SortMergeJoin" not in plan for plan in seen)
        seen.clear()
        monkeypatch.setattr(jaccard, "SETS_SENT", -1)
        check(documents, texts)
        assert seen and all("SortMergeJoin [a#" in plan for plan in seen)
    finally:
        spark.conf.set(limit, before)


def test_sketches_of_linked_sets_differ_in_no_more_than_a_link_allows():
    for edits in range(8):
        for n in (6, 30, 150, 1000):
            base = prose("en", n, n)
            one, two = (jaccard.shingle_set(t) for t in (base, changed(base, edits, edits)))
            differ = sum(bin(int(x) & (2**64 - 1)).count("1") for x in jaccard._sketch_of(one) ^ jaccard._sketch_of(two))
            assert differ <= len(set(one.tolist()) ^ set(two.tolist()))


def test_the_boundary_has_the_least_cost():
    assert jaccard.light_boundary({5: 1000}, 1.0) >= 5  # three pairs against two lists of two
    assert jaccard.light_boundary({60: 1000}, 1.0) < 60  # 91 pairs against 13 lists
    assert jaccard.light_boundary({30: 1000}, 1000.0) >= 37  # long lists: pairs pay once no heavy set is in reach


def test_awkward_documents(awkward):
    found = jaccard.jaccard_components(awkward).collect()
    assert len(found) == len(AWKWARD)
    assert all((r["n_shingles"], r["component_id"]) == (0, r["doc_id"]) for r in found if r["doc_id"] in (1, 2, 3))
    one = [r["component_id"] for r in found if r["doc_id"] == 4 or (r["doc_id"] is None and r["n_shingles"])]
    assert one == [4, 4, 4]  # a null id never is the smallest of others
    assert jaccard.jaccard_components(awkward.limit(0)).collect() == []


def test_one_of_each_group_stays(documents):
    base = prose("en", 100, 1)
    docs = documents((7, base), (3, changed(base, 1, 1)), (3, changed(base, 1, 1)), (9, prose("en", 50, 2)), (None, base), (5, ""), (6, ""), (None, None), (None, "solo"))
    kept = jaccard.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, (r["text"] or "")[:4]) for r in kept.collect()) == [
        (0, ""), (0, "solo"), (3, changed(base, 1, 1)[:4]), (5, ""), (6, ""), (9, prose("en", 50, 2)[:4]),
    ]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(200, 260)]
    found = components(spark.createDataFrame(chain + star + [(9, 9), (1, 2), (2, 1)], "a long, b long"))
    want = {i: 100 for i in range(100, 161)} | {i: 5 for i in [5, *range(200, 260)]} | {1: 1, 2: 1}
    assert {r["node"]: r["component"] for r in found.collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
