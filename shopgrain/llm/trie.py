"""Conversation prefix trie: one row for each distinct prefix of rebuilt conversations.

Turns become short ids; texts are never shuffled. The ids of a conversation stand in blocks
of positional columns, and one Spark SQL ``ROLLUP`` over these columns aggregates the
prefixes of all conversations together; ``grouping_id`` tells how many turns a group has.
A long conversation goes on in further rows of the same columns, keyed by the node that its
block before ended at. As such a key follows from the ids before the block alone, all blocks
are rolled up at once, however long a conversation is.

The root and popular prefixes have very many members, children and ends. Members are
combined before the shuffle. The conv_ids of parents with many children, of which there can
only be few, are broadcast. The members that end at a node are sorted over all tasks, and
only hashed text in long pieces comes together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopgrain.llm.common import arrow_schema, as_batch, pick, written
from shopgrain.llm.registry import register, table

#: Positional columns of a block.
COLUMNS = 8
#: Conversations are rebuilt from the start of the one that begins their group of ``GROUP``.
GROUP, HEADS = 5, 9
#: Parents whose conv_id is broadcast: those with more than a ``WIDE_PART``-th of all nodes as children.
WIDE_PART, WIDE_LEAST = 50_000, 1000
#: Characters of conv_ids that are hashed at a time.
PIECE = 1 << 18

TURN_COLUMNS = tuple(f"t{i}" for i in range(COLUMNS))
KEY = ("k1", "k2", "depth")


def _turn_id(role: Column, text: Column) -> Column:
    """20 bytes: 128 bits of a digest of role and text, and the text's length in bytes."""
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return F.unhex(F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.octet_length(text)), 8, "0")))


def _text_bytes(turn: Column) -> Column:
    return F.coalesce(F.conv(F.hex(F.substring(turn, 17, 4)), 16, 10).cast("long"), F.lit(0))


def _turn_keys(place: Column, turn: Column) -> tuple[Column, Column]:
    """What a turn at a place adds (by exclusive or) to the two numbers that name a prefix."""
    one, two = F.xxhash64(place, turn), F.xxhash64(F.lit(GROUP), place, turn)
    return tuple(F.when(turn.isNotNull(), x).otherwise(F.lit(0).cast("long")) for x in (one, two))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1) and turn id of every turn, in order of turn, null first; turns with
    the same number come in an order of their content. Rows without a conv_id are left out."""
    plain = pick(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null")
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    rows = plain.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _turn_id(role, text).alias("id"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "id")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "id")


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """conv_id, part, pos, id: the first h turns of the group's first conversation (part 0), the
    own turns after the first h (1), and one row without an id at the end (2)."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    conv = F.col("conv_id")
    first = turns.where(F.col("pos") == 1).select("conv_id")
    heads = turns.where((conv % GROUP == 0) & (F.col("pos") < HEADS)).groupBy(conv.alias("base"))
    heads = heads.agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("head"))  # of eight turns at most
    taken = first.withColumn("base", conv - conv % GROUP).join(heads, "base")
    taken = taken.select("conv_id", F.lit(0).alias("part"), F.inline(F.slice("head", F.lit(1), h.cast("int"))))
    own = turns.where(F.col("pos") > h).select("conv_id", F.lit(1).alias("part"), "pos", "id")
    end = first.select("conv_id", F.lit(2).alias("part"), F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("id"))
    return taken.unionByName(own).unionByName(end)


def blocks_of(rebuilt: DataFrame) -> DataFrame:
    """One row for each block of a conversation: its number ``b``, the name (x1, x2) of the node
    that the block before ended at, the bytes ``base`` of the texts before, and the turns' columns.
    The block with the end of the conversation has n_turns, e1, e2 and bytes: the last node."""
    order = Window.partitionBy("conv_id").orderBy("part", "pos")
    sofar = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rebuilt.withColumn("q", F.row_number().over(order).cast("long"))
    one, two = _turn_keys(F.col("q"), F.col("id"))
    rows = rows.withColumns({"a1": one, "a2": two, "own": _text_bytes(F.col("id"))})
    rows = rows.withColumns(
        {"k1": F.bit_xor("a1").over(sofar), "k2": F.bit_xor("a2").over(sofar), "bytes": F.sum("own").over(sofar)}
    )
    slot = (F.col("q") - 1) % COLUMNS
    last = F.col("id").isNull()

    def at_start(value: Column) -> Column:
        return F.max(F.when(slot == 0, value))

    found = rows.groupBy("conv_id", F.expr(f"(q - 1) div {COLUMNS}").alias("b")).agg(
        at_start(F.col("k1").bitwiseXOR(F.col("a1"))).alias("x1"),
        at_start(F.col("k2").bitwiseXOR(F.col("a2"))).alias("x2"),
        at_start(F.col("bytes") - F.col("own")).alias("base"),
        *[F.max(F.when(slot == i, F.col("id"))).alias(name) for i, name in enumerate(TURN_COLUMNS)],
        F.max(F.when(last, F.col("q") - 1)).alias("n_turns"),
        *[F.max(F.when(last, F.col(k))).alias(e) for k, e in (("k1", "e1"), ("k2", "e2"), ("bytes", "bytes"))],
    )
    return found


def _rolled_up(blocks: DataFrame, aggregates: str) -> DataFrame:
    """One row a node, by ROLLUP over the positional columns within a block and its key: name
    (k1, k2, depth), the parent's name (p1, p2), ``before`` (bytes of the texts above the node's
    own turn), and the aggregates over its members."""
    names = ", ".join(TURN_COLUMNS)
    rolled = blocks.sparkSession.sql(
        f"SELECT b, x1, x2, {names}, {COLUMNS} - bit_count(grouping_id()) AS level, min(base) AS base, {aggregates}"
        f" FROM {{blocks}} WHERE b = 0 OR {TURN_COLUMNS[0]} IS NOT NULL GROUP BY b, x1, x2, ROLLUP ({names})",
        blocks=blocks,
    )
    level, zero = F.col("level"), F.lit(0).cast("long")
    # A group of a level whose column is null holds conversations that ended before.
    own_turn = F.element_at(F.array(*TURN_COLUMNS), F.greatest(level, F.lit(1)))
    rolled = rolled.where(((level == 0) & (F.col("b") == 0)) | ((level > 0) & own_turn.isNotNull()))
    adds = [_turn_keys(F.col("b") * COLUMNS + i + 1, F.col(name)) for i, name in enumerate(TURN_COLUMNS)]

    def name_at(which: int, depth: Column) -> Column:
        parts = [F.when(depth > i, add[which]).otherwise(zero) for i, add in enumerate(adds)]
        return reduce(Column.bitwiseXOR, parts, F.col(f"x{which + 1}"))

    before = [F.when(level - 1 > i, _text_bytes(F.col(name))).otherwise(zero) for i, name in enumerate(TURN_COLUMNS)]
    return rolled.withColumns(
        {
            "depth": F.col("b") * COLUMNS + level,
            "k1": name_at(0, level), "k2": name_at(1, level),
            "p1": name_at(0, level - 1), "p2": name_at(1, level - 1),
            "before": reduce(Column.__add__, before, F.col("base")),
        }
    ).drop("b", "x1", "x2", "level", "base", *TURN_COLUMNS)


def _with_parents(nodes: DataFrame) -> DataFrame:
    """The nodes with their parent's conv_id."""
    wide = max(WIDE_LEAST, nodes.count() // WIDE_PART)
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    on = ["p1", "p2", "depth"]
    # More than ``wide`` children each, of which there are no more than nodes: at most WIDE_PART rows.
    few = written(parents.where(F.col("n_children") > wide).drop("n_children"), "wide-parents")
    known = nodes.join(F.broadcast(few), on, "left")
    # Each of the others has at most ``wide`` children.
    rest = known.where("parent_conv_id is null").drop("parent_conv_id")
    rest = rest.join(parents.where(F.col("n_children").between(1, wide)).drop("n_children"), on, "left")
    return known.where("parent_conv_id is not null").unionByName(rest)


def _hashed_ends(blocks: DataFrame) -> DataFrame:
    """For each node at which conversations end, the SHA-256 of their ids in order.

    The ends are sorted over all tasks. A task hashes the nodes that lie whole within it; of the
    one or two at its edges, and of those of many ends, it passes on pieces of text, which one task
    a node hashes in order, a piece at a time."""
    ends = blocks.where("n_turns is not null").select(F.col("e1").alias("k1"), F.col("e2").alias("k2"), F.col("n_turns").alias("depth"), "conv_id")
    schema = "k1 long, k2 long, depth long, first long, text string, hash string"
    arrow = arrow_schema(blocks.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, parts, size, whole = None, 0, [], 0, False
        rows: list[tuple] = []

        def close(complete: bool) -> None:
            if parts:
                text = ",".join(parts)
                done = hashlib.sha256(text.encode()).hexdigest() if complete else None
                rows.append((*node, first, None if complete else text, done))

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            return as_batch(dict(zip(arrow.names, zip(*found))), arrow)

        for batch in batches:
            keys = np.column_stack([batch.column(x).to_numpy() for x in KEY])
            ids = batch.column("conv_id").to_pylist()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)]):
                own = tuple(keys[start].tolist()) if start < stop else node
                if own != node:
                    close(whole)
                    whole = node is not None  # a task's first node may have begun in the task before
                    node, first, parts, size = own, ids[start], [], 0
                for at in range(start, stop, PIECE // 16):
                    some = ids[at : min(at + PIECE // 16, stop)]
                    if size >= PIECE:
                        close(False)
                        whole, first, parts, size = False, some[0], [], 0
                    parts.append(",".join(map(str, some)))
                    size += len(parts[-1])
            if len(rows) >= 1000 or size >= PIECE:
                if rows:
                    yield batch_of(rows)
                rows = []
        close(False)  # the last node may go on in the next task
        if rows:
            yield batch_of(rows)

    order = [*KEY, "conv_id"]
    pieces = written(ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema), "ends")
    joined_schema = "k1 long, k2 long, depth long, hash string"
    joined = arrow_schema(blocks.sparkSession, joined_schema)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, done = None, None, []
        for batch in batches:
            for own, text in zip(zip(*(batch.column(x).to_pylist() for x in KEY)), batch.column("text")):
                if own != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = own, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.as_py().encode())
            if done:
                yield as_batch(dict(zip(joined.names, zip(*done))), joined)
                done = []
        if node is not None:
            yield as_batch(dict(zip(joined.names, zip((*node, state.hexdigest())))), joined)

    parts = pieces.where("hash is null").drop("hash").repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return pieces.where("hash is not null").select(*KEY, "hash").unionByName(parts.mapInArrow(join, joined_schema))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256
    of every node.

    Rows without a conv_id are left out; a null role or text is empty; a null turn comes first,
    and turns of one number in an order of their content; repeated rows are turns of their own.
    An empty table gives no rows, not even a root; other columns are not read.

    What a subtree saves is each member's bytes that an earlier member has as well. A member is
    the smallest of every node below the first one of which it is the smallest, so it repeats just
    the texts above that node: ``repeated``. Under a node, all members but the smallest repeat
    what they repeat in all, less the texts above the node's own turn."""
    turns = written(ordered_turns(conversations), "turns")
    blocks = written(blocks_of(rebuilt_turns(turns)), "blocks")
    nodes = written(_rolled_up(blocks, "min(conv_id) AS conv_id, count(*) AS n_convs"), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"), (F.col("depth") - 1).alias("depth"))
    nodes = nodes.join(children.agg(F.count("*").alias("n_children")), list(KEY), "left").fillna(0, ["n_children"])
    nodes = written(nodes, "parents")

    smallest = nodes.groupBy("conv_id").agg(
        F.min_by("before", "depth").alias("repeated"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf")
    )
    ends = blocks.where("n_turns is not null").select("conv_id", "bytes")
    members = ends.join(smallest, "conv_id", "left").select(
        "conv_id", F.coalesce("repeated", "bytes").alias("repeated"), F.coalesce("leaf", F.lit(0).cast("long")).alias("leaf")
    )
    measured = blocks.drop("bytes").join(members, "conv_id")
    below = _rolled_up(measured, "sum(leaf) AS n_leaves, sum(repeated) AS repeated, min_by(repeated, conv_id) AS of_smallest")
    found = _with_parents(nodes).join(below.select(*KEY, "n_leaves", "repeated", "of_smallest"), list(KEY))
    found = found.join(_hashed_ends(blocks), list(KEY), "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("repeated") - F.col("of_smallest") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"),
        F.coalesce("hash", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


@register("op12_prefix_trie")
def op12_prefix_trie(spark, folder):
    return prefix_trie(table(spark, folder, "conversations"))
