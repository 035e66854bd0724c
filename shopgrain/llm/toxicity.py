"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a whole text: density of a learned lexicon (words, and beginnings of words for
compounds), how close lexicon words stand to second-person words, capitals, punctuation
and obfuscation (letters replaced by signs or digits, stretched letters). The labelled rows
are drawn by a hash of the id, at most ``SAMPLE`` of them, and dealt by another hash into
three parts: the first gives the lexicon, the second the trees, the third the calibration,
so that no part is judged on what it has been fitted to. Scoring reads whole texts, row by
row, without shuffles.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import crc_mod, map_steps, pick, written
from shopgrain.llm.registry import register, table

#: Labelled rows that are learned from, at most.
SAMPLE = 15_000
#: Lexicon entries, at most, and what an entry needs: documents and log-odds.
LEXICON_MOST = 5_000
LEXICON_DOCS = 4
LEXICON_ODDS = 2.5
#: Lengths of word beginnings that may become entries.
STEMS = (4, 5, 6, 7)
NEAR = 5
ROUNDS, DEPTH, STEP = 25, 3, 0.25
HELD_OUT_OF = 5

# Second-person words of the languages at hand.
SECOND_PERSON = frozenset(
    """you your yours yourself yourselves u ur ya tu te toi ton ta tes vous votre vos du dich dir dein deine deiner
    deinen deinem euch euer eure ihr tú ti tus usted ustedes vosotros vuestro vuestra""".split()
)
#: Signs and digits that stand for letters.
LEET = str.maketrans("013457@$!|", "oieastasil")

WORDS = re.compile(r"[^\W_]+(?:['’*@$!][^\W_]+)*")
OBFUSCATED = re.compile(r"(?<![\w@$*!])(?=[\w@$*!]*[^\W\d_][0-9@$*!]+[^\W\d_])[\w@$*!]+")
SHOUTED = re.compile(r"\b[A-Z]{3,}\b")
FEATURES = 16


def terms(text: str) -> set[str]:
    """The lexicon candidates of a text: its words, and beginnings of words marked by ``^``."""
    words = set(WORDS.findall(text.lower()))
    found = set(words)
    for n in STEMS:
        found.update("^" + w[:n] for w in words if len(w) > n)
    return found


def weight_of(word: str, lexicon: dict[str, float]) -> float:
    """The largest weight of the word and of its beginnings; 0 if none is in the lexicon."""
    best = lexicon.get(word, 0.0)
    for n in STEMS:
        if len(word) > n:
            best = max(best, lexicon.get("^" + word[:n], 0.0))
    return best


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    if not text:
        return [0.0] * FEATURES
    lower = text.lower()
    words = WORDS.findall(lower)
    n_words = max(1, len(words))
    weights = {w: x for w in set(words) if (x := weight_of(w, lexicon)) > 0.0}
    total = near = hits = 0
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    if weights:
        at = [i for i, w in enumerate(words) if w in weights]
        hits = len(at)
        total = sum(weights[words[i]] for i in at)
        if second:
            places = np.array(second)
            right = np.searchsorted(places, at)
            gaps = np.minimum(
                np.abs(places[np.minimum(right, len(places) - 1)] - at), np.abs(places[np.maximum(right - 1, 0)] - at)
            )
            near = int((gaps <= NEAR).sum())
    masked = OBFUSCATED.findall(lower)
    unmasked = sum(weight_of(w.translate(LEET).strip("*"), lexicon) > 0.0 for w in masked)
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    counts = np.bincount(data, minlength=256)
    size = float(len(data))
    upper, small = counts[65:91].sum(), counts[97:123].sum()
    letters = max(1, int(upper + small))
    signs = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()
    stretched = 0
    if len(data) > 2:
        folded = data | 32
        same = (folded[2:] == folded[1:-1]) & (folded[1:-1] == folded[:-2]) & (folded[2:] >= 97) & (folded[2:] <= 122)
        stretched = int(same.sum())
    return [
        100.0 * hits / n_words,
        math.log1p(hits),
        100.0 * total / n_words,
        max(weights.values(), default=0.0),
        float(len(weights)),
        near / hits if hits else 0.0,
        100.0 * near / n_words,
        100.0 * len(second) / n_words,
        float(upper) / letters,
        len(SHOUTED.findall(text)) / n_words,
        100.0 * counts[33] / size,
        100.0 * counts[63] / size,
        100.0 * float(signs) / size,
        len(masked) / n_words,
        float(unmasked),
        100.0 * stretched / size,
    ]


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Terms of toxic documents by smoothed log-odds, from rows (text, toxic)."""

    def work(step) -> dict:
        toxic, clean = Counter(), Counter()
        for text, label in zip(step.column("text").to_pylist(), step.column("toxic").to_pylist()):
            (toxic if label else clean).update(terms(text or ""))
        # A term that no toxic document of this step has adds only to the clean count.
        found = list(toxic.keys() | clean.keys())
        return {"term": found, "toxic": [toxic[x] for x in found], "clean": [clean[x] for x in found]}

    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return {}
    counted = map_steps(sample, work, "term string, toxic long, clean long").groupBy("term")
    counted = counted.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.2) / (sizes[1] + 1)) - F.log((F.col("clean") + 0.2) / (sizes[0] + 1))
    entries = (
        counted.withColumn("odds", odds)
        .where((F.col("toxic") >= LEXICON_DOCS) & (F.col("odds") >= LEXICON_ODDS))
        .orderBy(F.desc(F.col("odds") * F.log(F.col("toxic") + 1.0)), "term")
        .limit(LEXICON_MOST)
    )
    return {r["term"]: r["odds"] for r in entries.collect()}


@dataclass
class ToxicityModel:
    """What has been learned. Without both labels among the rows, ``prior`` is every score."""

    prior: float
    lexicon: dict[str, float] = field(default_factory=dict)
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None


def _with_features(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """doc_id (and toxic, if there) with the array of features."""
    kept = [name for name in ("doc_id", "toxic") if name in docs.columns]
    schema = ", ".join({"doc_id": "doc_id long", "toxic": "toxic int"}[x] for x in kept) + ", f array<double>"

    def work(step) -> dict:
        return {x: step.column(x) for x in kept} | {
            "f": [features(text, lexicon) for text in step.column("text").to_pylist()]
        }

    return map_steps(docs, work, schema)


def _raw(frame: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    """Add ``p``: the trees' own probability."""
    scored = trees.transform(frame.withColumn("features", array_to_vector("f")))
    return scored.withColumn("p", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """At most ``most`` labelled documents (doc_id, text, toxic, part), drawn by a hash of
    the id. Null labels and ids are left out; an id labelled twice counts once, as toxic
    if most of its labels say so."""
    labels = pick(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null")
    chosen = (
        labels.groupBy("doc_id")
        .agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
        .orderBy(F.xxhash64(F.lit("toxicity sample"), "doc_id"), "doc_id")
        .limit(most)
    )
    part = F.pmod(F.xxhash64(F.lit("toxicity part"), "doc_id"), F.lit(3)).cast("int")
    rows = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    joined = rows.join(F.broadcast(chosen.withColumn("doc_id", F.col("doc_id").cast("long"))), "doc_id")  # at most `most` rows
    return written(joined.withColumn("part", part), "toxicity-sample")


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> ToxicityModel:
    """Learn from the documents and labels given; what is held out must not be among them."""
    sample = labelled_rows(docs, labels, most)
    sizes = {(r["part"], r["toxic"]): r["n"] for r in sample.groupBy("part", "toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    prior = sum(n for (_, toxic), n in sizes.items() if toxic) / total if total else 0.0
    if any(not sizes.get((part, toxic)) for part in range(3) for toxic in (0, 1)):
        return ToxicityModel(prior)
    lexicon = learn_lexicon(sample.where("part = 0").select("text", "toxic"))
    frame = written(_with_features(sample.where("part > 0").select("doc_id", "text", "toxic"), lexicon), "toxicity-features")
    part = F.pmod(F.xxhash64(F.lit("toxicity part"), "doc_id"), F.lit(3)).cast("int")
    for_trees = frame.where(part == 1).withColumn("features", array_to_vector("f")).coalesce(4)
    trees = GBTClassifier(
        labelCol="toxic", featuresCol="features", maxIter=ROUNDS, maxDepth=DEPTH, stepSize=STEP, maxBins=64, seed=1
    ).fit(for_trees.withColumn("toxic", F.col("toxic").cast("double")))
    held = _raw(frame.where(part == 2), trees).withColumn("toxic", F.col("toxic").cast("double"))
    calibration = IsotonicRegression(labelCol="toxic", featuresCol="p").fit(held.select("p", "toxic"))
    return ToxicityModel(prior, lexicon, trees, calibration)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score and predicted for every document.

    Null and empty texts have features of zero and get a score like any other; repeated
    rows give repeated rows; an empty table gives none; extra columns are not read."""
    docs = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    if model.trees is None:
        return docs.select("doc_id", F.lit(model.prior).alias("score"), F.lit(int(model.prior >= 0.5)).alias("predicted"))
    raw = _raw(_with_features(docs, model.lexicon), model.trees)
    calibrated = model.calibration.transform(raw)
    # Isotonic steps make ties; a hair of the trees' own probability orders them.
    value: Column = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.98 * F.col("prediction") + 0.02 * F.col("p")))
    return calibrated.select("doc_id", value.alias("score"), (value >= 0.5).cast("int").alias("predicted"))


@register("op5_toxicity")
def op5_toxicity(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = fit(docs, labels.where(crc_mod(F.col("doc_id"), HELD_OUT_OF) != 0))
    return score(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), HELD_OUT_OF) == 0).alias("held_out"), "score", "predicted"
    )
