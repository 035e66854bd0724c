import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shopgrain.llm import trie

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, (role or "", text or "")))
    own = {c: [x[2] for x in sorted(t, key=lambda x: x[:2])] for c, t in own.items()}
    rebuilt = {}  # the remainder has the sign of the id, as in SQL
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - (abs(c) % 5) * (1 if c > 0 else -1), [])[:h] + turns[h:]
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, held in members.items():
        own_saved = (len(held) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += own_saved
    out = []
    for node, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(held), len(node), parent, len(held), len(children[node]), leaves[node], saved[node], digest))
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame(rows, TURNS) if rows else spark.createDataFrame([], TURNS)
    df = df.repartition(5).withColumn("depth", F.lit("x")).withColumn("b", F.lit("x")).withColumn("CONV", F.lit(1))
    return sorted(tuple(r) for r in trie.prefix_trie(df).collect())


def talk(rng, convs, most, choices):
    return [
        (c, t, rng.choice(["user", "assistant", None]), rng.choice(choices))
        for c in convs
        for t in range(rng.randint(1, most))
    ]


@pytest.mark.parametrize("seed", range(4))
def test_nodes_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    convs = rng.sample(range(-40, 400), 120)
    rows = talk(rng, convs, (3, 12, 30, 6)[seed], ["a", "bé", "ccc", "", None, "😀 long one"][: 2 + seed])
    assert run(spark, rows) == brute(rows)


def test_a_conversation_of_many_blocks(spark):
    rows = [(c, t, "user", f"{t}" * (t % 5)) for c in (5, 6, 7) for t in range(300 + c)]
    assert run(spark, rows) == brute(rows)


def test_hot_first_turn_and_hot_conversation(spark, monkeypatch):
    monkeypatch.setattr(trie, "WIDE_LEAST", 20)
    monkeypatch.setattr(trie, "PIECE", 64)
    rows = [(c, 0, "user", "hello") for c in range(400)]
    rows += [(c, 1, "user", f"own {c}") for c in range(0, 200)]  # 200 children of a few parents
    rows += [(c, t, "user", "same") for c in range(1000, 1600) for t in range(9)]  # 600 equal conversations
    assert run(spark, rows) == brute(rows)


def test_awkward_rows(spark):
    rows = [(None, 0, "user", "lost"), (10, None, "user", "first"), (10, 0, None, None), (10, 1, "user", "x"), (10, 1, "user", "x")]
    rows += [(11, 3, "user", "only"), (3, 0, "user", "y"), (2**62, 0, "", ""), (-7, 0, "a", "b" * 200_000)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == [] and run(spark, [(None, 0, "user", "lost")]) == []


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(c, 0, "user", "gone") for c in range(1, 60) if c % 5]  # no group has its first conversation
    found = run(spark, rows)
    assert found == brute(rows)
    assert found[0][3] == len(rows) and any(zlib.crc32(str(c).encode()) % 9 > 0 for c, *_ in rows)


def test_role_and_text_are_not_confused(spark):
    rows = [(5, 0, "a", "bc"), (10, 0, "ab", "c"), (15, 0, "1:a", "b"), (20, 0, "", "abc")]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_the_sample_tables(spark, folder):
    path = f"/root/testdata/{folder}"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(tuple(r) for r in trie.op12_prefix_trie(spark, path).collect()) == brute(rows)
