"""Quality rules: an isolation forest over rule statistics, with calibrated thresholds.

Every text is reduced to the statistics that quality rules use (word counts, symbols,
repeated lines and words, capitals, punctuation). A forest of random splits, grown
on a bounded sample of distinct texts, gives each document a mean path length: documents
that few random splits set apart are anomalous. How anomalous is too much is learned from
labelled rows, in bands of document length, as statistics of short texts spread more.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import map_steps, pick, written
from shopgrain.llm.registry import register, table

#: Distinct texts that the forest is grown on, at most; trees; texts a tree sees.
SAMPLE, TREES, TREE_ROWS = 20_000, 300, 256
#: A document has at least so many words, and at most this share of them in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Lengths in words at which bands of thresholds begin.
BANDS = (0, 100, 200, 400, 800)
#: Labelled rows of each class that a band needs for a threshold of its own.
BAND_LABELS = 20
#: Cost of a good document dropped, against one of a bad document kept.
GOOD_COST = 2.0
#: Steps in which thresholds are looked for.
BINS = 2000
SEED = 11

SYMBOLS = "#*$%&|<>"
STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_top_word",
    "n_lines", "n_letters", "n_upper", "n_marks", "n_symbol_words", "n_capital_words", "n_marked_words",
)
_OTHER, _LETTER, _UPPER, _MARK, _SYMBOL, _SPACE = range(6)


def _class_table() -> np.ndarray:
    """The class of each code point of the basic plane."""
    kinds = np.zeros(1 << 16, dtype=np.uint8)
    for code in range(1 << 16):
        sign = chr(code)
        if sign in " \t\n\r\x0b\x0c":
            kinds[code] = _SPACE
        elif sign in SYMBOLS:
            kinds[code] = _SYMBOL
        elif sign.isalpha():
            kinds[code] = _UPPER if sign.isupper() else _LETTER
        elif code > 32 and not sign.isspace() and not sign.isdigit():
            kinds[code] = _MARK
    return kinds


def _repeated_words(codes: np.ndarray, distinct: int) -> int:
    """Words that stand in a window of three words found twice or more."""
    if len(codes) < 3:
        return 0
    pairs = codes[:-1] * distinct + codes[1:]
    if distinct >= 2_000_000:  # three codes would not fit 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    windows = pairs[:-1] * distinct + codes[2:]
    _, place, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[place] > 1
    marked = np.zeros(len(codes), dtype=bool)
    for shift in range(3):
        marked[shift : shift + len(again)] |= again
    return int(marked.sum())


def text_statistics(text: str | None, kinds: np.ndarray) -> tuple[int, ...]:
    """The statistics of one text, in the order of ``STATISTICS``; all zero without a word."""
    text = text or ""
    words = text.encode().split()
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
    signs = kinds[np.minimum(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32), 0xFFFF)]
    count = np.bincount(signs, minlength=6).tolist()
    seen: set[str] = set()
    lines = again = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\r\x0b\x0c"):
            lines += 1
            again += line in seen
            seen.add(line)
    # Of each word: its signs by class, from sums over the places where words begin.
    by_word = [0, 0, 0]
    if words:
        solid = signs != _SPACE
        starts = np.flatnonzero(solid & np.concatenate(([True], ~solid[:-1])))
        sums = [np.add.reduceat((signs == kind).astype(np.int32), starts) for kind in (_SYMBOL, _UPPER, _LETTER, _MARK)]
        by_word = [
            int((sums[0] > 0).sum()),
            int(((sums[1] > 1) & (sums[2] == 0)).sum()),
            int((sums[3] > 1).sum()),
        ]
    top = int(np.bincount(codes).max()) if words else 0
    return (
        len(words), len(signs) - count[_SPACE], count[_SYMBOL], again, _repeated_words(codes, len(numbers)),
        len(numbers), top, lines, count[_LETTER] + count[_UPPER], count[_UPPER], count[_MARK], *by_word,
    )


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text and its statistics, one row a document.

    A null text counts as empty; a null id stays null; repeated rows stay; other columns are
    not read. A text is held whole by the task that counts it."""
    plain = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"), "text"
    )

    tables = []  # filled once a task

    def work(step) -> dict:
        if not tables:
            tables.append(_class_table())
        found = [text_statistics(text, tables[0]) for text in step.column("text").to_pylist()]
        columns = list(zip(*found)) if found else [()] * len(STATISTICS)
        return {"doc_id": step.column("doc_id"), "digest": step.column("digest"), **dict(zip(STATISTICS, columns))}

    return map_steps(plain, work, "doc_id long, digest long, " + ", ".join(f"{name} long" for name in STATISTICS))


def features(values: dict[str, np.ndarray]) -> np.ndarray:
    """Rates of rules, one row a document. Rates near zero are spread, as random splits fall
    evenly over a feature's range."""
    of = {name: np.asarray(values[name], dtype=np.float64) for name in STATISTICS}
    words, signs = np.maximum(of["n_words"], 1), np.maximum(of["word_chars"], 1)

    def spread(rate: np.ndarray) -> np.ndarray:
        return np.sqrt(np.minimum(rate, 1.0))

    return np.column_stack(
        [
            np.log(signs / words),
            spread(of["n_symbols"] / signs),
            spread(of["n_symbol_words"] / words),
            spread(of["n_dup_lines"] / np.maximum(of["n_lines"], 1)),
            spread(of["n_repeat_words"] / words),
            spread(of["n_top_word"] / words),
            spread(of["n_upper"] / np.maximum(of["n_letters"], 1)),
            spread(of["n_capital_words"] / words),
            spread(of["n_marks"] / signs),
            spread(of["n_marked_words"] / words),
        ]
    )


def mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype=np.float64)
    safe = np.maximum(n, 2)
    return np.where(n <= 1, 0.0, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe)


@dataclass
class Forest:
    """Trees as arrays of nodes, one row a tree; a leaf points to itself."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray  # path length of a row that ends at this node
    height: int
    rows: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 to the power of minus the mean path over its expectation: 0 to 1, high is anomalous."""
        if not len(x):
            return np.zeros(0)
        trees = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), dtype=np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.height):
            below = x[rows, self.feature[trees, node]] < self.split[trees, node]
            node = np.where(below, self.left[trees, node], self.right[trees, node])
        return np.exp2(-self.length[trees, node].mean(axis=1) / max(float(mean_path(self.rows)), 1e-9))


def grow(x: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = SEED) -> Forest:
    """A forest over the rows of ``x``; without rows, trees of one leaf."""
    rng = np.random.default_rng(seed)
    rows = min(tree_rows, len(x))
    height = max(1, int(np.ceil(np.log2(max(rows, 2)))))
    size = 2 ** (height + 1)
    feature, split = np.zeros((trees, size), dtype=np.int64), np.zeros((trees, size))
    left, right = (np.tile(np.arange(size), (trees, 1)) for _ in range(2))
    length = np.zeros((trees, size))
    for tree in range(trees):
        part = x[rng.choice(len(x), rows, replace=False)] if rows else x
        free = 1
        todo = [(0, part, 0)]
        while todo:
            node, held, depth = todo.pop()
            low, high = (held.min(axis=0), held.max(axis=0)) if len(held) else (np.zeros(1), np.zeros(1))
            open_features = np.flatnonzero(high > low)
            if depth >= height or not len(open_features):
                length[tree, node] = depth + float(mean_path(len(held)))
                continue
            chosen = int(rng.choice(open_features))
            at = rng.uniform(low[chosen], high[chosen])
            at = at if at > low[chosen] else high[chosen]
            feature[tree, node], split[tree, node] = chosen, at
            left[tree, node], right[tree, node] = free, free + 1
            below = held[:, chosen] < at
            todo += [(free, held[below], depth + 1), (free + 1, held[~below], depth + 1)]
            free += 2
    small = [a.astype(np.int16) for a in (feature, left, right)]
    return Forest(small[0], split, small[1], small[2], length, height, rows)


def base_failed() -> Column:
    """The plain rules: too few words, or too many of them repeated."""
    repeated = 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    return (F.col("n_words") < LEAST_WORDS) | repeated


def fit(stats: DataFrame) -> Forest:
    """The forest, grown on at most ``SAMPLE`` distinct texts that the plain rules pass, chosen by
    hash, so that a text that fills a third of the table counts once. A task passes on its share
    of the sample only, so what reaches the driver doesn't grow with the number of tasks."""
    passing = stats.where(~base_failed()).select("digest", *STATISTICS)
    distinct = passing.agg(F.approx_count_distinct("digest", 0.02)).first()[0]
    place = F.xxhash64(F.lit(SEED), "digest")
    near = F.pmod(place, F.lit(1 << 40)) < int((1 << 40) * min(1.0, 1.2 * SAMPLE / max(distinct, 1)))
    once = passing.where(near).groupBy("digest").agg(F.max(F.struct(*STATISTICS)).alias("s"))
    sample = once.orderBy(F.pmod(place, F.lit(1 << 40)), "digest").limit(SAMPLE).select("s.*").toPandas()
    return grow(features({name: sample[name].to_numpy() for name in STATISTICS}))


def scored(stats: DataFrame, forest: Forest) -> DataFrame:
    """``stats`` with the anomaly score of each row (0 to 1)."""

    def work(step) -> dict:
        values = {name: step.column(name).to_numpy(zero_copy_only=False) for name in STATISTICS}
        return {name: step.column(name) for name in step.schema.names} | {"score": forest.scores(features(values))}

    fields = ", ".join(f"{f.name} long" for f in stats.schema.fields)
    return map_steps(stats, work, f"{fields}, score double")


def band_of(n_words: Column) -> Column:
    """The place of a length among ``BANDS``."""
    found = F.lit(0)
    for place, least in enumerate(BANDS):
        found = F.when(n_words >= least, place).otherwise(found)
    return found


def _best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The cut of least cost, from counts of good and bad rows by score step; of equally good
    neighbouring cuts the middle one. Rows of a step above the cut are dropped."""
    dropped = np.concatenate((np.cumsum(good[::-1])[::-1], [0]))
    kept = np.concatenate(([0], np.cumsum(bad)))
    cost = GOOD_COST * dropped + kept
    first = last = int(np.argmin(cost))
    while last + 1 < len(cost) and cost[last + 1] == cost[first]:
        last += 1
    return (first + last) / 2 / BINS


def calibrate(scores: DataFrame, labels: DataFrame) -> list[float]:
    """A threshold for each band, from counts of all labelled rows that the plain rules pass.

    A band with few labelled rows of a class takes the threshold of all; without labelled rows
    of both classes nothing is anomalous (2.0). Null labels and ids don't count; of an id that
    is labelled more than once the mean decides."""
    marks = pick(labels, "doc_id", "quality").select(F.col("doc_id").cast("long").alias("labelled"), "quality")
    marks = marks.dropna().groupBy("labelled").agg((F.avg("quality") >= 0.5).alias("good"))
    rows = scores.where(~base_failed()).join(marks, F.col("doc_id") == F.col("labelled"))
    step = F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).cast("int")
    counted = rows.groupBy(band_of(F.col("n_words")).alias("band"), step.alias("step"), "good").count()
    counts = np.zeros((2, len(BANDS), BINS))  # at most this many rows come back
    for row in counted.collect():
        counts[int(row["good"]), row["band"], row["step"]] = row["count"]
    bad, good = counts
    if not bad.sum() or not good.sum():
        return [2.0] * len(BANDS)
    whole = _best_cut(good.sum(axis=0), bad.sum(axis=0))
    enough = [min(good[b].sum(), bad[b].sum()) >= BAND_LABELS for b in range(len(BANDS))]
    return [_best_cut(good[b], bad[b]) if enough[b] else whole for b in range(len(BANDS))]


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The statistics of every document with ``base_failed``, ``score``, ``threshold`` and ``kept``.

    Kept is what passes the plain rules and doesn't score above its band's threshold. A null,
    empty or blank text has no words and fails; repeated rows are judged alike, each on its own;
    an empty table gives no rows; without usable labels only the plain rules decide."""
    stats = written(statistics(docs), "rule-statistics")
    scores = written(scored(stats, fit(stats)), "rule-scores")
    thresholds = F.array(*[F.lit(x) for x in calibrate(scores, labels)])
    found = scores.withColumns({"base_failed": base_failed(), "threshold": thresholds[band_of(F.col("n_words"))]})
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("score") <= F.col("threshold")))


@register("op11_quality_rules")
def op11_quality_rules(spark, folder):
    found = judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score", "threshold",
    )
