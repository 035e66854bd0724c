"""Sharding: a hierarchical weighted hash tree (regions, racks, shards).

A row descends the tree. At each level every child draws ``-ln(u) / weight``, with
``u`` a uniform hash of the row's key and the child's name; the smallest draw wins,
so a child gets rows in proportion to its weight. A shard that joins later is a layer
of its own in every subtree above it: the subtree's draw is the smaller one of its
settled draw and of the draws of its joined shards, and a row that a joined shard's
draw has won follows it down. So a change of weights moves rows only into the
subtrees whose weight grew, and there only into the shard that joined.

Everything is a native expression over the row; the tree has a fixed, small size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopgrain.llm.common import numbered, pick, written
from shopgrain.llm.registry import register, table

SHARDS = 40
#: Shards of a rack and racks of a region in the default tree.
RACK_SHARDS = 5
REGION_RACKS = 2


@dataclass(frozen=True)
class Shard:
    """A leaf: its number, its place and its weight. ``joined`` marks a shard added
    after the tree was laid out; its draw is kept apart, so nothing else moves."""

    number: int
    region: int
    rack: int
    weight: float = 1.0
    joined: bool = False


def default_tree(shards: int = SHARDS, joined: int = 0) -> list[Shard]:
    """``shards`` settled leaves of equal weight and ``joined`` later ones, which go
    to the racks in turn."""
    if shards < 1 or joined < 0:
        raise ValueError("a tree needs a settled shard, and no negative number of joined ones")
    racks = -(-shards // RACK_SHARDS)
    settled = [Shard(n, n // (RACK_SHARDS * REGION_RACKS), n // RACK_SHARDS) for n in range(shards)]
    later = [Shard(shards + j, (j % racks) // REGION_RACKS, j % racks, 1.0, True) for j in range(joined)]
    return settled + later


def _draw(key: Column, name: str, weight: float) -> Column:
    """An exponential draw with rate ``weight``: 53 hash bits make the uniform number."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(name), key), 11)
    uniform = (bits.cast("double") + F.lit(0.5)) * F.lit(2.0**-53)
    return -F.log(uniform) / F.lit(weight)


def _smallest(draws: list[tuple[Column, Column]]) -> Column:
    """The value of the smallest draw; equal draws go to the smaller value."""
    return F.array_min(F.array(*[F.struct(draw.alias("draw"), value.alias("value")) for draw, value in draws]))["value"]


def shard_of(key: Column, tree: list[Shard]) -> Column:
    """The shard of a key. A null key is a key like any other."""
    if len({s.number for s in tree}) != len(tree) or any(s.weight <= 0 for s in tree):
        raise ValueError("shards need distinct numbers and positive weights")
    settled, joined = [s for s in tree if not s.joined], [s for s in tree if s.joined]
    if not settled:
        raise ValueError("a tree needs a settled shard")
    key = F.coalesce(key.cast("string"), F.lit("null"))

    def weights(level: str, leaves: list[Shard]) -> dict[int, float]:
        found: dict[int, float] = {}
        for leaf in leaves:
            found[getattr(leaf, level)] = found.get(getattr(leaf, level), 0.0) + leaf.weight
        return found

    def descend(leaves: list[Shard], levels: tuple[str, ...]) -> Column:
        """The winner among settled leaves, one level after another."""
        level, below = levels[0], levels[1:]
        children = weights(level, leaves)
        draws = [(_draw(key, f"{level}:{child}", weight), F.lit(child)) for child, weight in children.items()]
        if not below:
            return _smallest(draws)
        if len(children) == 1:
            return descend(leaves, below)
        winner = _smallest(draws)
        inside = None
        for child in children:
            shard = descend([x for x in leaves if getattr(x, level) == child], below)
            inside = F.when(winner == child, shard) if inside is None else inside.when(winner == child, shard)
        return inside

    base = descend(settled, ("region", "rack", "number"))
    if not joined:
        return base.cast("int")
    # The draws of joined shards meet the settled draws of the regions at the top; a row
    # that a joined shard wins goes down through that shard's region and rack to it.
    regions = [(_draw(key, f"region:{r}", w), F.lit(-1)) for r, w in weights("region", settled).items()]
    late = _smallest(regions + [(_draw(key, f"joined:{s.number}", s.weight), F.lit(s.number)) for s in joined])
    return F.when(late >= 0, late).otherwise(base).cast("int")


def with_slots(df: DataFrame, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps.

    ``df`` holds narrow rows. They are written once; the write task of a row and its
    place there fix its order. Only counts per (task, shard) are summed over tasks, so
    no shard's rows meet in one task."""
    place = F.monotonically_increasing_id()
    rows = written(df.withColumn("_place", place), "shard-rows")
    slice_of = F.shiftrightunsigned(F.col("_place"), 33).cast("int")
    rows = rows.withColumn("_slice", slice_of)
    before = Window.partitionBy(shard).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(shard, "_slice")
        .agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(shard, "_slice").orderBy("_place")
    return (
        rows.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(starts, [shard, "_slice"])
        .withColumn(slot, (F.col("_start") + F.col("_rank")).cast("long"))
        .drop("_place", "_slice", "_rank", "_start")
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shard, slot and the shard after one more shard has joined, for every document.

    The law is ``key``: doc_id and the number of shards decide. Null doc_ids are one key
    and share a shard; a null text has size 16 and the crc32 of the empty text; repeated
    rows share a shard and get slots of their own; an empty table gives no rows; extra
    columns are not read."""
    docs = pick(docs, "doc_id", "text")
    octets = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(octets) + 16).cast("long").alias("size"),
        F.crc32(octets).cast("long").alias("text_crc32"),
        shard_of(F.col("doc_id"), default_tree(shards)).alias("shard"),
        shard_of(F.col("doc_id"), default_tree(shards, joined=1)).alias("grown_shard"),
    )
    return with_slots(rows).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, files_per_shard: int = 1) -> None:
    """Write whole documents into one folder per shard (``shard=N``). Each shard's rows
    are dealt over ``files_per_shard`` tasks, so a large shard is many files."""
    if "shard" in docs.columns:
        raise ValueError("the documents already have a column named shard")
    key = F.col(f"_{docs.columns.index('doc_id')}")
    dealt = numbered(docs).withColumn("shard", shard_of(key, default_tree(shards)))
    spread = F.pmod(F.xxhash64(*dealt.columns), F.lit(files_per_shard))
    dealt = dealt.repartition(shards * files_per_shard, "shard", spread)
    dealt.toDF(*docs.columns, "shard").write.partitionBy("shard").parquet(folder)


@register("op9_sharding")
def op9_sharding(spark, folder):
    return shard_documents(table(spark, folder, "documents"))
