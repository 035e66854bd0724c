"""Benchmark decontamination: SimHash over item-sized windows, a multi-index Hamming
search, and an exact check of weighted shingles.

A benchmark item of ``m`` words is looked for in every window of ``m`` words of a text.
Windows and items have a 128-bit SimHash over their five-word shingles, each as heavy as
it is frequent. Fingerprints are cut into 16 blocks of 8 bits; if two differ in at most
``RADIUS`` bits, some block differs in at most ``RADIUS // 16`` of its bits, so a table
of each block's neighbours finds every fingerprint within the radius. What is within it
is checked exactly: the sum of the smaller over the sum of the larger shingle counts must
reach ``SIMILARITY``. Windows none of whose shingles occurs in any item have similarity 0
and are not fingerprinted.

The benchmark goes to the tasks in slices of bounded size, one pass over the documents a
slice; documents are scanned whole, row by row, without shuffles.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import arrow_schema, as_batch, map_steps, pick, steps
from shopgrain.llm.registry import register, table
from shopgrain.llm.shingles import SHINGLE, mix, shingle_hashes, word_hashes, words

BITS, BLOCKS = 128, 16
RADIUS = 40
SIMILARITY = 0.8
#: Characters of benchmark text that go to the tasks at a time.
SLICE_CHARS = 20_000_000
#: Windows of one size that are fingerprinted at a time, and pairs of a window and an item that are looked at at a time.
WINDOWS, PAIRS = 4096, 2_000_000


def fingerprints(shingles: np.ndarray, size: int, starts: np.ndarray) -> np.ndarray:
    """SimHashes (16 bytes each) of the windows of ``size`` shingles that begin at ``starts``."""
    first, last = int(starts[0]), int(starts[-1]) + size
    own = shingles[first:last]
    halves = np.stack([own, mix(own ^ np.uint64(0xA5A5A5A55A5A5A5A))], axis=1)
    signs = np.unpackbits(halves.view(np.uint8).reshape(len(own), 16), axis=1).astype(np.int32)
    sums = np.zeros((len(own) + 1, BITS), dtype=np.int32)
    np.cumsum(signs * 2 - 1, axis=0, out=sums[1:])
    at = starts - first
    return np.packbits(sums[at + size] - sums[at] > 0, axis=1)


class _Class:
    """The items of one number of words."""

    def __init__(self, size: int):
        self.size = size
        self.width = min(SHINGLE, size)
        self.ids: list[int] = []
        self.counts: list[Counter] = []
        self._prints: list[np.ndarray] = []

    def add(self, item_id: int, shingles: np.ndarray) -> None:
        self.ids.append(item_id)
        self.counts.append(Counter(shingles.tolist()))
        self._prints.append(fingerprints(shingles, len(shingles), np.zeros(1, dtype=np.int64))[0])

    def close(self) -> None:
        """Lay out the tables: for each block and each of its 256 values, the items near it."""
        self.prints = np.array(self._prints)
        ones = np.array([bin(x).count("1") for x in range(256)], dtype=np.uint8)
        values = np.arange(256, dtype=np.uint8)
        self.ones = ones
        self.near = [ones[values[:, None] ^ self.prints[None, :, b]] <= RADIUS // BLOCKS for b in range(BLOCKS)]

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (window, item) within the radius, and their distances."""
        kept = []
        for start in range(0, len(prints), max(1, PAIRS // len(self.ids))):
            some = prints[start : start + max(1, PAIRS // len(self.ids))]
            found = np.zeros((len(some), len(self.ids)), dtype=bool)
            for b in range(BLOCKS):
                found |= self.near[b][some[:, b]]
            window, item = np.nonzero(found)
            distance = np.zeros(len(window), dtype=np.int32)
            for b in range(BITS // 8):
                distance += self.ones[some[window, b] ^ self.prints[item, b]]
            close = distance <= RADIUS
            kept.append((start + window[close], item[close], distance[close]))
        return tuple(np.concatenate(x) for x in zip(*kept))


class Benchmark:
    """The items of a slice, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str]]):
        classes: dict[int, _Class] = {}
        known: dict[int, list[np.ndarray]] = {}
        for item_id, text in items:
            hashes = word_hashes(words(text))
            if len(hashes) == 0:
                continue
            own = classes.setdefault(len(hashes), _Class(len(hashes)))
            shingles = shingle_hashes(hashes, own.width)
            own.add(item_id, shingles)
            known.setdefault(own.width, []).append(shingles)
        self.classes = sorted(classes.values(), key=lambda c: c.size)
        for own in self.classes:
            own.close()
        self.known = {width: np.unique(np.concatenate(parts)) for width, parts in known.items()}
        self._maybe = {}
        for width, values in self.known.items():
            bits = np.zeros(1 << 20, dtype=bool)
            bits[values & np.uint64((1 << 20) - 1)] = True
            self._maybe[width] = bits

    def _marks(self, shingles: np.ndarray, width: int) -> np.ndarray:
        """Positions of shingles that occur in some item."""
        at = np.flatnonzero(self._maybe[width][shingles & np.uint64((1 << 20) - 1)])
        values = self.known[width]
        place = np.minimum(np.searchsorted(values, shingles[at]), len(values) - 1)
        return at[values[place] == shingles[at]]

    def find(self, text: str | None) -> list[tuple[int, int, int, float, int]]:
        """For every item found: item_id, first word and number of words of the most similar
        window (the first of equal ones), similarity and distance."""
        hashes = word_hashes(words(text))
        n = len(hashes)
        if n == 0:
            return []
        shingles = {width: shingle_hashes(hashes, width) for width in self.known if n >= width}
        marks = {width: self._marks(x, width) for width, x in shingles.items()}
        best: dict[tuple[int, int], tuple[float, int, int, int]] = {}
        for own in self.classes:
            if not len(marks.get(own.width, ())):
                continue
            size = min(own.size, n) - own.width + 1  # shingles of a window; a shorter text is one window
            needed = SIMILARITY * (size + own.size - own.width + 1) / (1 + SIMILARITY)
            starts = _starts(marks[own.width], size, len(shingles[own.width]), needed)
            for part in _runs(starts):
                prints = fingerprints(shingles[own.width], size, part)
                for w, i, distance in zip(*own.within(prints)):
                    start = int(part[w])
                    value = _similarity(shingles[own.width][start : start + size], own.counts[i])
                    if value >= SIMILARITY:
                        key, rank = (own.size, int(i)), (-value, start, int(distance), size)
                        if key not in best or rank < best[key]:
                            best[key] = rank
        by_size = {own.size: own for own in self.classes}
        return [
            (by_size[m].ids[i], start, size + by_size[m].width - 1, -value, distance)
            for (m, i), (value, start, distance, size) in sorted(best.items())
        ]


def _starts(marks: np.ndarray, size: int, total: int, needed: float) -> np.ndarray:
    """First shingles of the windows that hold at least ``needed`` marks. A similar window shares
    that many shingles with its item, and each of them is marked."""
    held = np.zeros(total + 1, dtype=np.int64)
    held[marks + 1] = 1
    np.cumsum(held, out=held)
    return np.flatnonzero(held[size:] - held[:-size] >= needed - 1e-9)


def _runs(starts: np.ndarray):
    """Consecutive starts, at most ``WINDOWS`` at a time."""
    for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
        for at in range(0, len(run), WINDOWS):
            yield run[at : at + WINDOWS]


def _similarity(window: np.ndarray, item: Counter) -> float:
    """Sum of the smaller over the sum of the larger shingle counts."""
    own = Counter(window.tolist())
    shared = sum(min(n, item[x]) for x, n in own.items() if x in item)
    return shared / (len(window) + item.total() - shared)


def slices(benchmark: DataFrame, slice_chars: int = SLICE_CHARS) -> list[list[tuple[int, str]]]:
    """The items in slices of about ``slice_chars`` characters, made one at a time by the
    caller's loop; null texts, null ids and texts without words are no items."""
    items = pick(benchmark, "item_id", "text").where("item_id is not null and text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-chars // slice_chars)
    dealt = items.withColumn("_part", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, parts))))
    for part in range(parts):
        rows = dealt.where(F.col("_part") == part).orderBy("item_id", "text").collect()
        yield [(int(r["item_id"]), r["text"]) for r in rows]


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item found in it: doc_id, item_id, start (of
    the most similar window, in words), n_words, similarity, distance.

    Null and empty texts hold nothing; repeated rows give repeated rows; an empty table of
    documents or items gives no rows; extra columns are not read."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, start long, n_words long, similarity double, distance int"
    rows = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    found = None
    for items in slices(benchmark):
        part = map_steps(rows, _finder(items), schema)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], schema) if found is None else found


def _finder(items: list[tuple[int, str]]):
    made: dict[str, Benchmark] = {}

    def work(step) -> dict:
        bench = made.get("bench") or made.setdefault("bench", Benchmark(items))
        out = [
            (doc_id, *leak)
            for doc_id, text in zip(step.column("doc_id").to_pylist(), step.column("text").to_pylist())
            for leak in bench.find(text)
        ]
        names = ("doc_id", "item_id", "start", "n_words", "similarity", "distance")
        return {name: [row[i] for row in out] for i, name in enumerate(names)}

    return work


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns as they are, that hold no benchmark item."""
    place, arrow = docs.columns.index("text"), arrow_schema(docs.sparkSession, docs.schema)
    flag = pa.schema([("keep", pa.bool_())])

    def without(df: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
        made: dict[str, Benchmark] = {}

        def run(batches):
            bench = made.get("bench") or made.setdefault("bench", Benchmark(items))
            for step in steps(batches):
                keep = [not bench.find(text) for text in step.column(place).to_pylist()]
                kept = step.filter(as_batch({"keep": keep}, flag).column(0))
                yield kept.cast(arrow) if kept.schema != arrow else kept

        return df.mapInArrow(run, df.schema)

    for items in slices(benchmark):
        docs = without(docs, items)
    return docs


@register("op8_decontamination")
def op8_decontamination(spark, folder):
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
