import zlib
from collections import Counter

from conftest import rows
from llm.conftest import AWKWARD
from pyspark.sql import functions as F

from shopgrain.llm import sharding


def test_slots_and_growth(spark, documents):
    docs = documents(*[(i, f"text {i}") for i in range(3000)])
    found = sharding.shard_documents(docs).collect()
    assert len(found) == 3000 and {r["law"] for r in found} == {"key"}
    for shard, n in Counter(r["shard"] for r in found).items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(n))
    assert all(r["grown_shard"] in (r["shard"], 40) for r in found)
    assert 40 < sum(r["grown_shard"] == 40 for r in found) < 120
    assert all(45 < n < 110 for n in Counter(r["shard"] for r in found).values())


def test_a_joined_shard_takes_rows_only_into_itself_at_any_size(spark):
    ids = spark.range(4000)
    for shards, joined in ((1, 1), (7, 2), (40, 3)):
        before, after = (sharding.shard_of(F.col("id"), sharding.default_tree(shards, j)) for j in (joined - 1, joined))
        moved = ids.select(before.alias("a"), after.alias("b")).where("a != b")
        assert rows(moved.select("b").distinct()) == [(shards + joined - 1,)]


def test_weights_move_only_the_subtree(spark):
    tree = sharding.default_tree(20)
    grown = [sharding.Shard(s.number, s.region, s.rack, 3.0 if s.number == 0 else 1.0) for s in tree]
    ids = spark.range(4000).select(
        sharding.shard_of(F.col("id"), tree).alias("a"), sharding.shard_of(F.col("id"), grown).alias("b")
    )
    # Rows leave unchanged regions only for the region that grew.
    assert ids.where("a >= 10 and b >= 10 and a != b").count() == 0
    assert ids.where("a < 10 and b >= 10").count() == 0
    assert 0.10 < ids.where("b = 0").count() / 4000 < 0.18


def test_awkward_documents(awkward):
    found = sharding.shard_documents(awkward).collect()
    assert len(found) == len(AWKWARD)
    assert all((r["size"], r["text_crc32"]) == (16, 0) for r in found if r["doc_id"] in (1, 2))
    smile = next(r for r in found if r["doc_id"] == 5)
    data = "12 34 !! 😀 ñ".encode()
    assert (smile["size"], smile["text_crc32"]) == (len(data) + 16, zlib.crc32(data))
    assert len({r["shard"] for r in found if r["doc_id"] is None}) == 1
    assert sharding.shard_documents(awkward.limit(0)).collect() == []


def test_written_shards(spark, documents, folder):
    docs = documents(*[(i, f"text {i}") for i in range(200)])
    sharding.write_shards(docs, folder, shards=4, files_per_shard=2)
    back = spark.read.parquet(folder)
    assert back.count() == 200 and set(docs.columns) < set(back.columns)
    assert back.where(F.col("shard") != sharding.shard_of(F.col("doc_id"), sharding.default_tree(4))).count() == 0
