import random

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = {"en": "the ing tion and er on st re".split(), "de": "sch ung ein keit ich der zu au".split()}


def prose(lang: str, words: int, seed: int) -> str:
    """Invented words of one language."""
    rng = random.Random(f"{lang}{seed}")
    parts = SYLLABLES[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(words))


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text[, lang]) with columns whose names clash with outputs."""

    def build(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in ("score", "piece", "digest", "_digest", "_spans", "shard_", "component_id", "length", "class"):
            df = df.withColumn(name, F.lit("x"))
        return df

    return build


#: Nulls, empty and blank texts, one word, repeated rows, signs beyond the basic plane.
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (4, "one"),
    (None, "one"),
    (None, None),
    (5, "12 34 !! 😀 ñ"),
    (6, prose("en", 400, 6)),
    (6, prose("en", 400, 6)),
    (7, prose("en", 20_000, 7)),
]


@pytest.fixture
def awkward(documents):
    return documents(*AWKWARD)
