"""N-gram Jaccard join: a size-aware join of light and heavy sets.

Two texts link when their sets of five-word shingles have a Jaccard similarity of 0.8 or
more. Equal sets are one class, so copies cost one set. Shingles have a global order, rare
ones first; two sets that link and are cut to their first ``n - ceil(0.8 n) + k`` shingles
share ``k`` of them. Light sets post every pair (``k = 2``) of their cut as one key; heavy
sets post its single shingles (``k = 1``) in inverted lists, where light sets of a size
that can link to a heavy one stand too. The boundary is the size with the least cost: keys
made against list entries visited, from the sizes of all sets and the mean list length.

Candidates are found in two steps, so that a group of near copies never becomes all its
pairs. First, in a few rounds, every member of a list is compared with the list's pivots of
that round only, and the links give components. Pivots are by turns the members with most
shared keys, which most near copies link to, and random ones. Then every pair of a list whose
members are still in different components is a candidate, unless the numbers of shared keys or
the sketches show that it can't link. What has been left out are pairs that are connected
already. All candidates are checked exactly.

A sketch tells for each of ``SKETCH`` bits whether an odd number of a set's shingles falls on it.
Shingles that two sets share cancel out, so sketches differ in at most as many bits as the sets
differ in shingles, and a pair whose sketches differ in more than a link allows is none.

Frequent shingles are known from a count over all documents. The threshold of the count
follows the corpus, so that at most ``FREQUENT`` shingles reach it; these go to the tasks,
come last in the order, and have their lists split over salts.
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

from shopgrain.llm.common import (
    arrow_schema,
    as_batch,
    bounded_broadcast,
    by_group_key,
    map_steps,
    numbered,
    pick,
    steps,
    written,
)
from shopgrain.llm.components import components
from shopgrain.llm.registry import register, table
from shopgrain.llm.shingles import shingle_set

#: Links need 100 * shared >= PERCENT * union.
PERCENT = 80
#: Most shingles that count as frequent, and the least count of one.
FREQUENT, FREQUENT_LEAST = 300_000, 6
#: Rounds in which members are compared with a pivot only.
STAR_ROUNDS = 6
#: Members for each pivot up to which a list counts as one of few members, after the first round.
FEW = 4
#: Members of a frequent shingle's list that are dealt to one salt, about.
SALT_ROWS = 1000
#: Bits of a set's sketch, kept as so many longs.
SKETCH = 512
SKETCH_LONGS = [f"s{i}" for i in range(SKETCH // 64)]
#: Shingles in all sets read so far up to which these go to the tasks whole, and pairs of one such task.
SETS_SENT, PAIRS_TASK = 2_000_000, 20_000
#: Largest size for which pairs are weighed against lists.
LIGHT_MOST = 64
#: Most shingles in a bucket of the count, about, and shingles that a task gathers before it sends.
BUCKET, SENT = 500_000, 1_000_000
_HALF = np.uint64(1 << 59)
_HASH = np.uint64((1 << 60) - 1)


def overlap_least(n: int) -> int:
    """Shingles that a set of size ``n`` must share with any set it links to."""
    return -(-PERCENT * n // 100)


def _class_of(found: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sketch_of(found: np.ndarray) -> np.ndarray:
    """The parities of the numbers of shingles that fall on each bit, as longs."""
    odd = np.bincount(((found >> np.uint64(4)) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


class _Order:
    """The global order of shingles: 60 bits of the hash below a level. Level 0: counted and
    not frequent; 1: not counted (the upper half of the hashes); from 2: frequent, by count."""

    def __init__(self, bits: int, codes: np.ndarray, counts: np.ndarray, least: int):
        self.bits, self.codes, self.counts, self.least = bits, codes, counts, least

    def code(self, hashes: np.ndarray) -> np.ndarray:
        """What is counted of a 60-bit hash: its first bits below the half."""
        return hashes >> np.uint64(59 - 32 - self.bits)

    def sorted(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The set in the global order, and for each shingle its count if it is frequent, else 0."""
        hashes = found >> np.uint64(4)
        low = hashes < _HALF
        level = np.where(low, 0, 1).astype(np.uint64)
        count = np.zeros(len(hashes), dtype=np.int64)
        if len(self.codes):
            code = self.code(hashes)
            place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            frequent = low & (self.codes[place] == code)
            count[frequent] = self.counts[place[frequent]]
            ratio = np.maximum(count[frequent] // self.least, 1)
            level[frequent] = 2 + np.minimum(5, np.log2(ratio) // 2).astype(np.uint64)
        order = (level << np.uint64(60)) | hashes
        by = np.argsort(order)
        return order[by].astype(np.int64), count[by]


def _read_sets(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """One pass over the texts gives the members (doc_id, digest of the text, size of the set,
    class, a 64-bit digest of the set, null when empty, and the longs of its sketch), and the counts of shingles in the lower
    half of the hashes by bucket: each task sends a shingle once for ``SENT`` that it read. The
    third result is the number of bits that tell a bucket."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = max(0, (chars // (8 * BUCKET)).bit_length())
    probe = _Order(bits, np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), 1)
    longs = ", ".join(f"{name} long" for name in SKETCH_LONGS)
    read = f"doc_id long, digest long, n long, class long, {longs}, bucket int, codes binary, counts binary"
    arrow = arrow_schema(docs.sparkSession, read)

    def rows(columns: dict) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        return as_batch({f.name: columns.get(f.name, [None] * size) for f in arrow}, arrow)

    def send(parts: list[np.ndarray]) -> pa.RecordBatch:
        codes, counts = np.unique(np.concatenate(parts), return_counts=True)
        bucket = (codes >> np.uint64(32)).astype(np.int64)
        firsts = np.flatnonzero(np.diff(bucket, prepend=-1))
        cuts = list(zip(firsts.tolist(), [*firsts[1:].tolist(), len(codes)]))
        return rows(
            {
                "bucket": bucket[firsts].astype(np.int32),
                "codes": [codes[a:b].astype("<u4").tobytes() for a, b in cuts],
                "counts": [_narrow(counts[a:b]) for a, b in cuts],
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for step in steps(batches):
            found, sketches = {"n": [], "class": []}, np.zeros((step.num_rows, len(SKETCH_LONGS)), dtype=np.int64)
            for at, text in enumerate(step.column("text").to_pylist()):
                own = shingle_set(text)
                sketches[at] = _sketch_of(own)
                found["n"].append(len(own))
                found["class"].append(_class_of(own) if len(own) else None)
                hashes = own >> np.uint64(4)
                parts.append(probe.code(hashes[hashes < _HALF]))
                size += len(parts[-1])
                if size >= SENT:
                    yield send(parts)
                    parts, size = [], 0
            found |= {name: sketches[:, i] for i, name in enumerate(SKETCH_LONGS)}
            yield rows({"doc_id": step.column("doc_id"), "digest": step.column("digest"), **found})
        if size:
            yield send(parts)

    found = docs.withColumn("digest", _digest(F.col("text"))).mapInArrow(run, read)
    found = written(found, "members")
    members = found.where("bucket is null").select("doc_id", "digest", "n", "class", *SKETCH_LONGS)
    return members, found.where("bucket is not null").select("bucket", "codes", "counts"), bits


def _frequent(counted_codes: DataFrame, bits: int, total: int) -> tuple[_Order, float]:
    """The frequent shingles and the mean count, from the counts that the tasks sent."""
    counted = "code long, n long"
    answer = arrow_schema(counted_codes.sparkSession, counted)

    def add(key, batches) -> Iterator[pa.RecordBatch]:
        codes, counts = [], []
        for batch in batches:
            codes += [np.frombuffer(x, dtype="<u4") for x in batch.column("codes").to_pylist()]
            counts += [np.frombuffer(x[1:], dtype=f"<u{x[0]}").astype(np.int64) for x in batch.column("counts").to_pylist()]
        codes, counts = np.concatenate(codes), np.concatenate(counts)
        by = np.argsort(codes)
        codes = codes[by]
        firsts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        distinct, n = codes[firsts], np.add.reduceat(counts[by], firsts)
        often = n >= FREQUENT_LEAST
        yield as_batch(
            {
                "code": [-1, *(distinct[often].astype(np.int64) | (key[0] << 32)).tolist()],
                "n": [len(distinct), *n[often].tolist()],
            },
            answer,
        )

    rows = written(by_group_key(counted_codes, ["bucket"], add, counted), "frequent")
    distinct = rows.where("code < 0").agg(F.sum("n")).first()[0] or 0
    # The least power of two that at most FREQUENT shingles reach, from a histogram of powers.
    power = F.floor(F.log2("n")).cast("int").alias("power")
    by_power = {r["power"]: r["count"] for r in rows.where("code >= 0").groupBy(power).count().collect()}
    least = next(
        (max(FREQUENT_LEAST, 1 << p) for p in range(65) if sum(c for q, c in by_power.items() if q >= p) <= FREQUENT)
    )
    found = rows.where((F.col("code") >= 0) & (F.col("n") >= least)).toPandas().sort_values("code")
    order = _Order(bits, found["code"].to_numpy(dtype=np.uint64), found["n"].to_numpy(dtype=np.int64), least)
    return order, (total / 2) / distinct if distinct else 1.0


def _narrow(counts: np.ndarray) -> bytes:
    width = next(w for w in (1, 2, 4, 8) if int(counts.max(initial=0)) < 1 << (8 * w))
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def light_boundary(sizes: dict[int, int], mean_list: float) -> int:
    """The largest size of light sets with the least cost. A pair costs one key; a single
    shingle costs its entry and a visit of each entry of its list. Light sets that can link to
    a heavy one stand in the lists as well."""

    def cost(boundary: int) -> float:
        total = 0.0
        for n, number in sizes.items():
            cut = n - overlap_least(n) + 1
            if n <= boundary:
                total += number * (cut + 1) * cut / 2
            if n > boundary or n >= overlap_least(boundary + 1):
                total += number * cut * (1.0 + mean_list)
        return total

    return min(range(3, LIGHT_MOST + 1), key=lambda b: (cost(b), b))


def _postings(docs: DataFrame, order: _Order, boundary: int) -> DataFrame:
    """One row a class: class, its size, the last order number of its cut, and its keys with
    their salts. Even keys are single shingles, odd ones pairs."""
    schema = "class long, n int, last long, keys array<struct<key:long,salt:int>>"
    arrow = arrow_schema(docs.sparkSession, schema)
    entry = arrow.field("keys").type.value_type

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches):
            rows = {"class": [], "n": [], "last": [], "keys": []}
            for text in step.column("text").to_pylist():
                found = shingle_set(text)
                n = len(found)
                if n < 4:  # such a set links to an equal one only
                    continue
                own = _class_of(found)
                ordered, counts = order.sorted(found)
                cut = n - overlap_least(n) + 1
                keys, salts = [], []
                if n > boundary or n >= overlap_least(boundary + 1):
                    parts = counts[:cut] // SALT_ROWS + 1
                    keys.append(ordered[:cut] << 1)
                    salts.append(np.where(parts > 1, 1 + own % parts, 0))  # 0: a list in one piece
                if n <= boundary:
                    first, second = np.triu_indices(cut + 1, 1)
                    pair = ordered[first] * np.int64(0x2545F4914F6CDD1D) + ordered[second]
                    keys.append(pair | 1)
                    salts.append(np.zeros(len(pair), dtype=np.int64))
                rows["class"].append(own)
                rows["n"].append(n)
                rows["last"].append(int(ordered[cut - 1]))
                keys, salts = np.concatenate(keys), np.concatenate(salts).astype(np.int32)
                rows["keys"].append(pa.StructArray.from_arrays([pa.array(keys), pa.array(salts)], fields=list(entry)))
            lengths = np.cumsum([0, *[len(x) for x in rows["keys"]]]).astype(np.int32)
            flat = pa.concat_arrays(rows["keys"]) if rows["keys"] else pa.array([], type=entry)
            lists = pa.ListArray.from_arrays(pa.array(lengths), flat, type=arrow.field("keys").type)
            plain = [pa.array(rows[f.name], type=f.type) for f in arrow if f.name != "keys"]
            yield pa.RecordBatch.from_arrays([*plain, lists], schema=arrow)

    every = docs.select("text").mapInArrow(work, schema)
    return every.groupBy("class").agg(F.first("n").alias("n"), F.first("last").alias("last"), F.first("keys").alias("keys"))


def _sizes_fit(a: Column, b: Column) -> Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _sets(docs: DataFrame, firsts: DataFrame, classes: DataFrame) -> DataFrame:
    """The sets of the given classes, from one document of each, read again."""
    wanted = written(firsts.join(classes, "class", "left_semi"), "wanted")
    narrow = bounded_broadcast(wanted.select(F.col("doc_id").alias("wanted_id")).distinct())
    rows = docs.join(narrow, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")

    def work(step) -> dict:
        sets = [x for x in (shingle_set(text) for text in step.column("text").to_pylist()) if len(x)]
        return {"class": [_class_of(x) for x in sets], "n": list(map(len, sets)), "set": [x.tobytes() for x in sets]}

    # A repeated or null id brings other texts too; they are dropped here, and copies once more.
    found = map_steps(rows, work, "class long, n int, set binary").join(wanted.select("class"), "class", "left_semi")
    return found.dropDuplicates(["class"])


def _links(docs: DataFrame, firsts: DataFrame, pairs: DataFrame, held: list[DataFrame]) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets. ``held`` has the sets read so far, and
    gets those that are missing. While these are few, they go to the tasks and no pair is dealt
    by its sets; else pairs and sets are shuffled."""
    classes = pairs.select(F.col("a").alias("class")).unionAll(pairs.select(F.col("b").alias("class"))).distinct()
    missing = classes = written(classes, "pair-classes")
    for sets in held:
        missing = missing.join(sets.select("class"), "class", "left_anti")
    missing = written(missing, "missing-sets")
    if not missing.isEmpty():
        held.append(written(_sets(docs, firsts, missing), "sets"))
    sets = reduce(DataFrame.unionAll, held)
    if (sets.agg(F.sum("n")).first()[0] or 0) <= SETS_SENT:
        sets, pairs = F.broadcast(sets), pairs.repartition(max(1, -(-pairs.count() // PAIRS_TASK)))
    else:  # sets are the widest rows here; those that no pair asks for stay where they are
        sets = sets.join(bounded_broadcast(classes), "class", "left_semi")

    def work(step) -> dict:
        a, b = [], []
        rows = zip(*(step.column(x).to_pylist() for x in ("a", "b", "set_a", "set_b")))
        for x, y, set_x, set_y in rows:
            one, two = np.frombuffer(set_x, dtype=np.uint64), np.frombuffer(set_y, dtype=np.uint64)
            shared = len(np.intersect1d(one, two, assume_unique=True))
            if 100 * shared >= PERCENT * (len(one) + len(two) - shared):
                a.append(x)
                b.append(y)
        return {"a": a, "b": b}

    both = pairs
    for side in ("a", "b"):
        both = both.join(sets.select(F.col("class").alias(side), F.col("set").alias(f"set_{side}")), side)
    return written(map_steps(both.select("a", "b", "set_a", "set_b"), work, "a long, b long"), "links")


def _named(lists: DataFrame, nodes: DataFrame | None) -> DataFrame:
    """The lists whose members are in more than one component, with the component of each."""
    if nodes is None:
        return lists.withColumn("component", F.col("class"))
    plain = lists.drop("component")
    named = plain.join(nodes, plain["class"] == nodes["node"], "left")
    named = named.select(*plain.columns, F.coalesce("component", "class").alias("component"))
    split = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return written(named.join(split.select("key"), "key"), "live-lists")


def _with_share(lists: DataFrame, boundary: int) -> DataFrame:
    """The lists with the share of its keys that a member has in common with any other. A text
    with few changes of its own has the highest; in a group of near copies most link to it."""
    n = F.col("n")
    cut = n - F.ceil(n * PERCENT / 100) + 1
    single = F.when((n > boundary) | (n >= overlap_least(boundary + 1)), cut).otherwise(0)
    pairs = F.when(n <= boundary, cut * (cut + 1) / 2).otherwise(0)
    own = F.count("*").over(Window.partitionBy("class"))
    return lists.withColumn("share", (own / (single + pairs)).cast("float"))


def _star_pairs(lists: DataFrame, number: int) -> DataFrame:
    """Every member of a list with the list's pivots of this round, twice as many as in the round
    before: by turns those with the highest share and those of the smallest random numbers. A
    list of few members for so many pivots is left out: all its pairs are looked at later. The
    first pivots of a split list are compared with the first of them all. Members of one
    component need no look."""
    most = 1 << number
    chance = F.xxhash64(F.lit(f"pivot {number}"), "class")
    rank = F.struct((-F.col("share") if number % 2 == 0 else F.lit(0.0)).alias("by"), chance.alias("chance"), F.col("class").alias("id"))
    member = ("class", "n", "component")
    part = Window.partitionBy("key", "salt")
    ranked = lists.withColumn("rank", rank).withColumn("place", F.row_number().over(part.orderBy("rank")))
    if number:
        ranked = ranked.where(F.col("size") > FEW * most)
    pivots = F.collect_list(F.when(F.col("place") <= most, F.struct(*member, "place"))).over(part)

    def differs(y: Column) -> Column:
        return (y["place"] < F.col("place")) & (y["component"] != F.col("component")) & _sizes_fit(y["n"], F.col("n"))

    useful = F.explode(F.filter("pivots", differs)).alias("y")
    seen = ranked.withColumn("pivots", pivots).select(F.struct(*member).alias("x"), useful)
    firsts = lists.where("salt > 0").withColumn("rank", rank).groupBy("key", "salt").agg(F.min(F.struct("rank", *member)).alias("x"))
    tops = firsts.groupBy("key").agg(F.min("x").alias("y"), F.count("*").alias("parts")).where("parts > 1")
    far = firsts.join(tops, "key").select(*[F.struct(*[f"{side}.{m}" for m in member]).alias(side) for side in ("x", "y")])
    far = far.where("x.component != y.component").where(_sizes_fit(F.col("x.n"), F.col("y.n")))
    sides = [F.col(f"{side}.{m}").alias(f"{m}_{side}") for side in ("x", "y") for m in ("class", "n")]
    pairs = seen.select(*sides).unionAll(far.select(*sides))
    shared = pairs.groupBy(F.least("class_x", "class_y").alias("a"), F.greatest("class_x", "class_y").alias("b"))
    shared = shared.agg(F.count("*").alias("c"), F.min(F.least("n_x", "n_y")).alias("n"))
    # Stars only have to connect what is clearly near; all other pairs are looked at later.
    return shared.where("c >= 1 + 0.04 * n").select("a", "b")


def _meetings(live: DataFrame, sketches: DataFrame, boundary: int) -> DataFrame:
    """Every pair of a list in different components that can link, once a list, with the number of
    common lists that it needs.

    The set whose cut ends first has all shared shingles up to there in both cuts, so it shares
    as many as the pair has common lists, and at most those after its cut. A pair that needs
    more common lists than one of the two is in at all is none. Two sets that link differ in at
    most ``(100 - PERCENT) / (100 + PERCENT)`` of the sum of their sizes, and so do their sketches."""
    counted = live.where("key % 2 = 0").groupBy("class").agg(F.count("*").alias("m"))
    live = live.join(counted, "class", "left").fillna(0, ["m"]).join(sketches, "class")
    live = written(live, "counted-lists")
    member = ("class", "n", "last", "m", "component")
    x, y = (
        live.select("key", *[F.col(name).alias(f"{name}_{side}") for name in (*member, *SKETCH_LONGS)])
        for side in ("a", "b")
    )
    n_a, n_b = F.col("n_a"), F.col("n_b")
    ends_first = F.when(F.col("last_a") <= F.col("last_b"), n_a).otherwise(n_b)
    needed = F.ceil((n_a + n_b) * PERCENT / (100 + PERCENT)) - F.ceil(ends_first * PERCENT / 100) + 1
    pair = F.col("key") % 2 != 0
    heavy = (F.greatest(n_a, n_b) > boundary) & (F.least("m_a", "m_b") >= needed)
    differ = reduce(Column.__add__, [F.bit_count(F.col(f"{s}_a").bitwiseXOR(F.col(f"{s}_b"))) for s in SKETCH_LONGS])
    near = (100 + PERCENT) * differ <= (100 - PERCENT) * (n_a + n_b)
    met = x.join(
        y.withColumnRenamed("key", "key_b"),
        (F.col("key") == F.col("key_b"))
        & (F.col("class_a") < F.col("class_b"))
        & (F.col("component_a") != F.col("component_b"))
        & _sizes_fit(n_a, n_b)
        & (pair | heavy)
        & near,
    )
    return met.select(F.col("class_a").alias("a"), F.col("class_b").alias("b"), pair.alias("pair"), needed.alias("needed"))


def _other_pairs(live: DataFrame, sketches: DataFrame, boundary: int) -> DataFrame:
    """The pairs of the lists that have as many common lists as they need."""
    pairs = _meetings(live, sketches, boundary).groupBy("a", "b", "pair", "needed").agg(F.count("*").alias("c"))
    return pairs.where("pair or c >= needed").select("a", "b").distinct()


def jaccard_components(docs: DataFrame, keep_digest: bool = False) -> DataFrame:
    """doc_id, n_shingles and component_id of every document.

    A null or empty text, or one without words, has an empty set and is linked with nothing;
    texts of fewer than five words have one shingle. Repeated rows are copies. A null id never
    is the smallest of a component with other ids; alone it stays null. An empty table gives no
    rows; extra columns are not read. ``keep_digest`` adds the digest of the text and ``group``,
    a number of the component that is never null but for an empty set."""
    docs = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    members, counted, bits = _read_sets(docs)
    total = members.agg(F.sum("n")).first()[0] or 0
    members, sized = members.drop(*SKETCH_LONGS), members.where("n > 0")
    firsts = sized.groupBy("class").agg(F.min("doc_id").alias("doc_id"), *[F.first(x).alias(x) for x in ("n", *SKETCH_LONGS)])
    firsts = written(firsts, "classes")
    order, mean_list = _frequent(counted, bits, total)
    sizes = {r["n"]: r["count"] for r in firsts.where(f"n between 4 and {2 * LIGHT_MOST}").groupBy("n").count().collect()}
    boundary = light_boundary(sizes, mean_list)

    posted = _postings(docs, order, boundary)
    entries = posted.select("class", "n", "last", F.explode("keys").alias("k")).select("class", "n", "last", "k.key", "k.salt")
    found = _join_components(docs, members, firsts, entries, boundary)
    return found if keep_digest else found.drop("digest", "group")


def _nearer(nodes: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels after one more round: two steps of taking the smallest label among linked ones, so
    a star becomes one. Nodes of one label are connected; the reverse holds only at the end."""
    if nodes is not None:
        for side in ("a", "b"):
            old = nodes.select(F.col("node").alias(side), F.col("component").alias(f"old_{side}"))
            links = links.join(old, side, "left").withColumn(side, F.coalesce(f"old_{side}", side)).drop(f"old_{side}")
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b")
    once = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("at"), F.least("a", "m").alias("m"))
    twice = both.join(once, F.col("b") == F.col("at")).groupBy("a").agg(F.min("m").alias("m"))
    twice = written(twice.select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    if nodes is None:
        return twice
    moved = twice.select(F.col("node").alias("component"), F.col("component").alias("new"))
    known = nodes.join(moved, "component", "left").select("node", F.coalesce("new", "component").alias("component"))
    return written(known.unionAll(twice.join(nodes, "node", "left_anti")), "labels")


def _join_components(docs: DataFrame, members: DataFrame, firsts: DataFrame, entries: DataFrame, boundary: int) -> DataFrame:
    alone = Window.partitionBy("key", "salt")
    lists = entries.withColumn("size", F.count("*").over(alone)).where("size > 1 or salt > 0")
    lists = written(_with_share(written(lists, "lists"), boundary), "shared-lists")
    ids = firsts.select("class", "doc_id")
    nodes, held, found, live = None, [], [], _named(lists, None)
    for number in range(STAR_ROUNDS):
        pairs = written(_star_pairs(live, number), "star-pairs")
        if pairs.isEmpty():
            break
        links = _links(docs, ids, pairs, held)
        if links.isEmpty():
            break
        found.append(links)
        nodes = _nearer(nodes, links)
        # Lists of few members wait for the look at all pairs, and aren't dealt once more a round.
        live = _named(live.where((F.col("size") > FEW << (number + 1)) | (F.col("salt") > 0)), nodes)
    others = _other_pairs(_named(lists, nodes), firsts.select("class", *SKETCH_LONGS), boundary)
    others = written(others, "other-pairs")
    if not others.isEmpty():
        found.append(_links(docs, ids, others, held))
    if found:
        nodes = written(components(reduce(DataFrame.unionAll, found)), "components")
    else:
        nodes = docs.sparkSession.createDataFrame([], "node long, component long")

    named = firsts.join(nodes, firsts["class"] == nodes["node"], "left")
    named = named.select("class", "doc_id", F.coalesce("component", "class").alias("component"))
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_class = named.join(smallest, "component").select("class", "component_id", F.col("component").alias("group"))
    return members.join(by_class, "class", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "digest",
        "group",
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents, all columns as they are, with one left of each component: the smallest id,
    nulls last, then the smallest digest of the text. Of rows with that id and text one stays.
    Documents without words all stay."""
    found = written(_with_text_digest(docs), "document-components")
    keys = ["doc_id", "digest"]
    in_component = found.where("n_shingles > 0")
    best = in_component.groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")).alias("k")
    )
    kept = best.select(F.col("k.doc_id").alias("doc_id"), F.col("k.digest").alias("digest")).distinct()
    rows = in_component.groupBy(*keys).agg(F.count("*").alias("copies"))
    kept = kept.withColumn("stays", F.lit(True))
    same = rows["doc_id"].eqNullSafe(kept["doc_id"]) & (rows["digest"] == kept["digest"])
    state = rows.join(kept, same, "left").select(rows["doc_id"], rows["digest"], "copies", "stays")
    state = written(state, "document-states")
    gone = bounded_broadcast(state.where("stays is null").select("doc_id", "digest"))
    repeated = bounded_broadcast(state.where("stays and copies > 1").select("doc_id", "digest"))

    names = docs.columns
    plain = numbered(docs)
    doc_id, text = (f"_{names.index(x)}" for x in ("doc_id", "text"))
    own = plain.withColumn("own_digest", _digest(F.col(text)))

    def matches(other: DataFrame) -> Column:
        return own[doc_id].cast("long").eqNullSafe(other["doc_id"]) & (own["own_digest"] == other["digest"])

    once = own.join(gone, matches(gone), "left_anti").join(repeated, matches(repeated), "left_anti")
    first = own.join(repeated, matches(repeated), "left_semi").dropDuplicates([doc_id, "own_digest"])
    return once.unionAll(first).select(*plain.columns).toDF(*names)


def _digest(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _with_text_digest(docs: DataFrame) -> DataFrame:
    """Every document's id, text digest, set size and a number of its component."""
    plain = pick(docs, "doc_id", "text")
    rows = plain.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return jaccard_components(rows, keep_digest=True)


@register("op1_ngram_jaccard")
def op1_ngram_jaccard(spark, folder):
    return jaccard_components(table(spark, folder, "documents"))
