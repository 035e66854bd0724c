"""Approximate nearest neighbours by a permutation index.

A bounded sample of the vectors serves as pivots. Every vector is represented by the
order of its ``length`` nearest pivots and posted in the inverted files of its
``posted`` nearest ones. A query looks into the files of its ``probed`` nearest pivots,
ranks what it finds there by the footrule distance of the two orders (a pivot outside the
first ``length`` counts as rank ``length``), takes the share ``rerank`` of each file, and
ranks that by the inner product of the original vectors.

Largest inner product becomes nearest direction by one more component,
``sqrt(most - |x|^2)`` for rows and 0 for queries, with ``most`` the largest squared
norm of the table.

Files are cut into blocks of rows and of queries, so a hot pivot is many tasks. Equal
vectors are searched once, and only the ``k + 1`` smallest ids of equal vectors can be
among a query's first ``k``, so a vector with many copies costs no more than ``k + 1``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopgrain.llm.common import arrow_schema, as_batch, by_group, map_steps, pick, written
from shopgrain.llm.registry import register, table

K = 20
PIVOTS = 128
LENGTH = 64
POSTED = 3
PROBED = 48
RERANK = 0.2
#: Least number of rows of a block that are reranked, and the sizes of blocks.
RERANK_LEAST = 64
BLOCK_ROWS, BLOCK_QUERIES = 8192, 1024


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and v (doubles) of the vectors that take part: an id, a vector that is not
    null, no null or non-finite component, not all zero, and the table's most frequent
    length (the shorter one on a tie)."""
    rows = pick(vectors, "vec_id", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
    )
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
    rows = rows.where(~bad & F.exists("v", lambda x: x != 0))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (usual["n"] if usual else 0))


def _orders(rows: DataFrame, pivots: np.ndarray, most: float, length: int, query: bool) -> DataFrame:
    """Add ``near``: the numbers of the nearest pivots, nearest first."""

    def work(step) -> dict:
        x = np.array(step.column("v").to_pylist(), dtype=np.float64).reshape(step.num_rows, -1)
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, most - (x * x).sum(axis=1)))
        close = x @ pivots[:, :-1].T + extra[:, None] * pivots[:, -1]
        near = np.argsort(-close, axis=1, kind="stable")[:, :length].astype(np.int16)
        return {"vec_id": step.column("vec_id"), "v": step.column("v"), "near": list(near)}

    return map_steps(rows, work, "vec_id long, v array<double>, near array<short>")


def _blocks(counts: dict[int, int], size: int) -> Column:
    """The number of blocks of the pivot in column ``pivot``; the pivots are a bounded few."""
    pairs = [F.lit(x) for pivot, n in counts.items() for x in (pivot, -(-n // size))]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col("pivot")), F.lit(0)) if pairs else F.lit(0)


def _search(n_pivots: int, length: int, k: int, rerank: float, schema):
    """The search inside one block of rows and one of queries of a pivot's file."""

    def run(batches):
        ids, vectors, orders, asking = [], [], [], []
        for batch in batches:
            ids += batch.column("vec_id").to_pylist()
            vectors += batch.column("v").to_pylist()
            orders += batch.column("near").to_pylist()
            asking += batch.column("asking").to_pylist()
        is_query = np.array(asking, dtype=bool)
        if not is_query.any() or is_query.all():
            return
        ids_, x = np.array(ids, dtype=np.int64), np.array(vectors, dtype=np.float64)
        near = np.array(orders, dtype=np.int64)
        rows, queries = np.flatnonzero(~is_query), np.flatnonzero(is_query)
        own_ids, own = ids_[rows], x[rows]
        # Twice the rank of every pivot for every row; |q - r| + r = max(2r - q, q), whose
        # sum over the query's pivots is the footrule distance less a constant.
        twice = np.full((n_pivots, len(rows)), 2 * length, dtype=np.int16)
        twice[near[rows], np.arange(len(rows))[:, None]] = 2 * np.arange(near.shape[1], dtype=np.int16)
        rank = np.arange(near.shape[1], dtype=np.int16)[:, None]
        share = min(len(rows), max(RERANK_LEAST, int(np.ceil(rerank * len(rows)))))
        out = {"query_id": [], "vec_id": [], "score": []}
        for q in queries:
            foot = np.maximum(twice[near[q]] - rank, rank).sum(axis=0, dtype=np.int32)
            taken = np.argpartition(foot, share - 1)[:share] if share < len(rows) else np.arange(len(rows))
            product = (own[taken] * x[q]).sum(axis=1)
            best = np.lexsort((own_ids[taken], -product))[:k]
            out["query_id"].append(np.full(len(best), ids_[q]))
            out["vec_id"].append(own_ids[taken][best])
            out["score"].append(product[best])
        yield as_batch({name: np.concatenate(parts) for name, parts in out.items()}, schema)

    return run


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    n_pivots: int = PIVOTS,
    length: int = LENGTH,
    posted: int = POSTED,
    probed: int = PROBED,
    rerank: float = RERANK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the nearest rows of every query.

    ``is_query`` is a condition on ``vec_id``. Every usable row but the query's own is a
    candidate. Ties go to the smaller id. A repeated id counts once, with its smallest
    vector. An empty table, or one without usable queries, gives no rows; extra columns
    are not read."""
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors).groupBy("vec_id").agg(F.min("v").alias("v"))
    rows = written(rows, "vectors")
    equal = Window.partitionBy("v").orderBy("vec_id")
    members = rows.withColumn("_n", F.row_number().over(equal)).where(F.col("_n") <= k + 1).drop("_n")
    asked = rows.where(is_query)
    firsts = asked.groupBy("v").agg(F.min("vec_id").alias("vec_id")).select("vec_id", "v")
    most = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0]
    sample = rows.orderBy(F.xxhash64(F.lit("pivot"), "v"), "vec_id").limit(n_pivots).collect()
    if not sample:
        return spark.createDataFrame([], result)
    pivots = np.unique(np.array([r["v"] for r in sample], dtype=np.float64), axis=0)
    pivots = np.hstack([pivots, np.sqrt(np.maximum(0.0, most - (pivots**2).sum(axis=1)))[:, None]])
    length, posted, probed = (min(x, len(pivots)) for x in (length, posted, probed))

    index = written(_orders(members, pivots, most, length, query=False), "index")
    asks = written(_orders(firsts, pivots, most, length, query=True), "queries")
    files = index.select("*", F.explode(F.slice("near", 1, posted)).alias("pivot"))
    probes = asks.select("*", F.explode(F.slice("near", 1, probed)).alias("pivot"))
    in_file, in_probe = (
        {r["pivot"]: r["count"] for r in df.groupBy("pivot").count().collect()} for df in (files, probes)
    )
    row_blocks, query_blocks = _blocks(in_file, BLOCK_ROWS), _blocks(in_probe, BLOCK_QUERIES)

    def dealt(df: DataFrame, asking: bool, own: Column, other: Column) -> DataFrame:
        """A row is in one block of its own kind and meets all blocks of the other."""
        mine = F.pmod(F.xxhash64("vec_id"), own).cast("int")
        return (
            df.where(other > 0)
            .withColumn("theirs", F.explode(F.sequence(F.lit(0), other - 1)))
            .select(
                "vec_id",
                "v",
                "near",
                F.lit(asking).alias("asking"),
                "pivot",
                (F.col("theirs") if asking else mine).alias("row_block"),
                (mine if asking else F.col("theirs")).alias("query_block"),
            )
        )

    both = dealt(files, False, row_blocks, query_blocks).unionByName(dealt(probes, True, query_blocks, row_blocks))
    found_schema = "query_id long, vec_id long, score double"
    search = _search(len(pivots), length, k + 1, rerank, arrow_schema(spark, found_schema))

    found = by_group(both, ["pivot", "row_block", "query_block"], search, found_schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    tops = (
        found.dropDuplicates(["query_id", "vec_id"])
        .withColumn("_n", F.row_number().over(best))
        .where(F.col("_n") <= k + 1)
        .groupBy("query_id")
        .agg(F.sort_array(F.collect_list(F.struct("_n", "vec_id", "score"))).alias("tops"))
    )
    # Every query of equal vectors takes the list of the first one, without its own row.
    lists = firsts.withColumnRenamed("vec_id", "query_id").join(tops, "query_id").drop("query_id")
    others = F.slice(F.filter("tops", lambda t: t["vec_id"] != F.col("own")), 1, k)
    return (
        asked.select(F.col("vec_id").alias("own"), "v")
        .join(lists, "v")
        .select(F.col("own").alias("query_id"), F.posexplode(others).alias("at", "t"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "t.vec_id", "t.score")
    )


@register("op6_nearest_neighbours")
def op6_nearest_neighbours(spark, folder):
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)
