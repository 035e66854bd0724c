"""Packing of token pieces into sequences by a configuration linear program.

Documents become token ids; a document longer than a sequence is cut into pieces. The
program sees only the histogram of piece lengths, which has at most ``capacity`` rows
whatever the input. Its variables are patterns (how many pieces of each length class fill
a sequence). Multiplicative weights solve it: a class that has been covered less weighs
more, and pricing, a knapsack solved by dynamic programming, finds the pattern of most
weight. The fractional solution is rounded down, the rest is solved again a few times,
and what remains is placed by best fit, largest first, into the slack of the patterns and
then into new sequences. All of that works on counts: equal sequences are one entry.

Ranks give each piece its place. Pieces of a length are numbered by the task that made
them and their order there; only counts per (length, task) are summed, so no length's
pieces meet in one task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopgrain.llm.common import arrow_schema, as_batch, pick, steps, written
from shopgrain.llm.registry import register, table
from shopgrain.llm.tokens import encoder

CAPACITY = 4096
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Rows and bytes of text that are encoded at once: cut into pieces they take many times their bytes.
ENCODED_ROWS, ENCODED_BYTES = 64, 512 << 10
#: Length classes: a sequence is so many units long.
UNITS = 512
#: Solutions of the program and pricing steps of each; the rate of the weights.
SOLUTIONS, PRICINGS, RATE = 4, 500, 0.5

Pattern = tuple[int, ...]


def _best_pattern(sizes: np.ndarray, values: np.ndarray, units: int) -> np.ndarray:
    """Copies of each class in the pattern of most value (sizes ascending, any number of copies)."""
    best = np.zeros(units + 1)
    choice = np.full(units + 1, -1, dtype=np.int64)
    fitting = np.searchsorted(sizes, np.arange(units + 1), side="right")
    for room in range(1, units + 1):
        best[room] = best[room - 1]
        n = fitting[room]
        if n:
            worth = best[room - sizes[:n]] + values[:n]
            top = int(worth.argmax())
            if worth[top] > best[room] + 1e-15:
                best[room], choice[room] = worth[top], top
    copies = np.zeros(len(sizes), dtype=np.int64)
    room = units
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            copies[choice[room]] += 1
            room -= sizes[choice[room]]
    return copies


def _solve(sizes: np.ndarray, demand: np.ndarray, units: int) -> list[tuple[float, np.ndarray]]:
    """Patterns with their fractional numbers of uses, by multiplicative weights."""
    weights = np.ones(len(sizes))
    covered = np.zeros(len(sizes))
    uses: dict[bytes, float] = defaultdict(float)
    for _ in range(PRICINGS):
        copies = _best_pattern(sizes, weights / demand, units)
        cover = copies / demand
        step = 1.0 / cover.max()
        uses[copies.tobytes()] += step
        covered += step * cover
        weights *= np.exp(-RATE * step * cover)
        weights /= weights.max()
    scale = 1.0 / max(covered.mean(), 1e-9)
    return [(n * scale, np.frombuffer(key, dtype=np.int64)) for key, n in uses.items()]


class _Sequences:
    """Groups of equal sequences: a number of them and the piece lengths in each. Groups with
    slack are found by it, the fullest first."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.closed: list[tuple[int, Pattern]] = []
        self._open: dict[int, list[tuple[int, Pattern]]] = {}
        self._slacks: list[int] = []

    def add(self, number: int, lengths: Pattern, slack: int) -> None:
        if number <= 0:
            return
        if slack == 0:
            self.closed.append((number, lengths))
            return
        if slack not in self._open:
            self._open[slack] = []
            insort(self._slacks, slack)
        self._open[slack].append((number, lengths))

    def best_fit(self, length: int, number: int) -> None:
        while number > 0:
            at = bisect_left(self._slacks, length)
            if at == len(self._slacks):
                most = self.capacity // length
                full, rest = divmod(number, most)
                self.add(full, (length,) * most, self.capacity - length * most)
                self.add(int(rest > 0), (length,) * rest, self.capacity - length * rest)
                return
            slack = self._slacks[at]
            count, lengths = self._open[slack].pop()
            if not self._open[slack]:
                del self._open[slack]
                self._slacks.pop(at)
            taken = min(count, number)
            self.add(count - taken, lengths, slack)
            self.add(taken, (*lengths, length), slack - length)
            number -= taken

    def all(self) -> list[tuple[int, Pattern]]:
        return self.closed + [x for slack in self._slacks for x in self._open[slack]]


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, Pattern]]:
    """Groups (number of sequences, piece lengths of each) that hold every piece once."""
    if any(not 0 < length <= capacity for length in histogram):
        raise ValueError("a piece is longer than a sequence or empty")
    unit = max(1, capacity // UNITS)
    units = capacity // unit
    left = {length: n for length, n in histogram.items() if n > 0}
    done = _Sequences(capacity)
    for _ in range(SOLUTIONS):
        classes: dict[int, list[int]] = defaultdict(list)
        for length in sorted(left, reverse=True):
            classes[-(-length // unit)].append(length)
        usable = sorted(size for size in classes if size <= units)
        demand = np.array([sum(left[x] for x in classes[size]) for size in usable], dtype=np.float64)
        if len(usable) < 2 or demand.sum() < 64:
            break
        rest = demand.astype(np.int64)
        placed = 0
        for uses, copies in sorted(_solve(np.array(usable), demand, units), key=lambda x: -x[0]):
            some = np.flatnonzero(copies)
            number = int(min(uses, (rest[some] // copies[some]).min()))
            if number < 1:
                continue
            rest[some] -= number * copies[some]
            placed += number
            for count, lengths in _fill(number, copies, usable, classes, left):
                done.add(count, lengths, capacity - sum(lengths))
        left = {length: n for length, n in left.items() if n > 0}
        if not placed:
            break
    for length in sorted(left, reverse=True):
        done.best_fit(length, left[length])
    return done.all()


def _fill(number: int, copies: np.ndarray, usable: list[int], classes: dict, left: dict) -> Iterator[tuple[int, Pattern]]:
    """``number`` sequences of a pattern with real lengths, taken from each class longest first.
    Every slot is a list of runs of equal lengths; cuts of all slots part the sequences."""
    slots = []
    for i in np.flatnonzero(copies):
        lengths = classes[usable[i]]
        for _ in range(int(copies[i])):
            runs, need = [], number
            for length in lengths:
                take = min(need, left[length])
                if take:
                    runs.append((take, length))
                    left[length] -= take
                    need -= take
                if not need:
                    break
            slots.append(runs)
    cuts = sorted({int(x) for runs in slots for x in np.cumsum([n for n, _ in runs])})
    at = [0] * len(slots)
    used = [0] * len(slots)
    before = 0
    for cut in cuts:
        yield cut - before, tuple(runs[at[s]][1] for s, runs in enumerate(slots))
        for s, runs in enumerate(slots):
            used[s] += cut - before
            if used[s] == runs[at[s]][0]:
                at[s], used[s] = at[s] + 1, 0
        before = cut


def places(groups: list[tuple[int, Pattern]]) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, rank after the last, sequence of the first, offset): the piece
    of a length with rank ``r`` goes to sequence ``first + r - first rank``."""
    cursor: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for number, lengths in groups:
        offset = 0
        for length in lengths:
            rank = cursor[length]
            out.append((length, rank, rank + number, sequence, offset))
            cursor[length] = rank + number
            offset += length
        sequence += number
    return out


def tokenized(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """The pieces of every document, written once: doc_id, piece, start, length, ids_crc32, the
    task and the rank among its pieces of that length (and the ids, if asked for)."""
    docs = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"
    schema += ", ids binary" if keep_ids else ""
    arrow = arrow_schema(docs.sparkSession, schema)
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        own = encoder(tokenizer_path or public_tokenizers.path(TOKENIZER))
        task = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for step in steps(batches, ENCODED_ROWS, encoders=True, most=ENCODED_BYTES):
            rows = []
            for doc_id, data in zip(step.column("doc_id").to_pylist(), own.encode(step.column("text").to_pylist())):
                data += end
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    length = len(part) // 4
                    rows.append((doc_id, piece, at // 4, length, zlib.crc32(part), task, seen[length], part))
                    seen[length] += 1
            yield as_batch({field.name: [row[i] for row in rows] for i, field in enumerate(arrow)}, arrow)

    return written(docs.mapInArrow(run, schema), "pieces")


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Every piece with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset
    (and the ids, if asked for).

    Null and empty texts are the end id alone; repeated rows are packed each for itself; an
    empty table gives no rows; extra columns are not read."""
    spark = docs.sparkSession
    pieces = tokenized(docs, capacity, tokenizer_path, keep_ids)
    counts = written(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {int(r["length"]): r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = places(plan_sequences(histogram, capacity))
    # One row for each slot of each group: bounded by the number of lengths, not by the pieces.
    # It goes as an Arrow table: a list of rows would need Python workers of another kind, which
    # stay beside those of the tasks for a minute.
    columns = arrow_schema(spark, "length long, first long, after long, sequence long, offset long")
    arrays = [pa.array([row[i] for row in rows], type=field.type) for i, field in enumerate(columns)]
    layout = spark.createDataFrame(pa.Table.from_arrays(arrays, schema=columns))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = pieces.join(starts, ["length", "task"]).withColumn("rank", F.col("rank") + F.col("before"))
    inside = (ranked["length"] == layout["length"]) & (ranked["rank"] >= layout["first"]) & (ranked["rank"] < layout["after"])
    placed = ranked.join(F.broadcast(layout), inside).select(
        "doc_id",
        "piece",
        "start",
        ranked["length"],
        "ids_crc32",
        (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"),
        "offset",
        *(["ids"] if keep_ids else []),
    )
    return placed


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence (little-endian unsigned 32-bit), from ``pack`` with ids.
    A group is one sequence, so it is never longer than the capacity."""
    joined = F.aggregate(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))), F.lit(b""), lambda s, x: F.concat(s, x["ids"])
    )
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))


@register("op4_pack_sequences")
def op4_pack_sequences(spark, folder):
    return pack(table(spark, folder, "documents"))
