"""Language identification by compression with one raw-content dictionary a language.

A dictionary is plain text of its language. A text, in lower case and with ASCII digits
and punctuation as spaces, is compressed whole with every dictionary, in consecutive parts
of ``PART_BYTES`` whose sizes are added up; the dictionary with the smallest sum names the
language. The relative gap between the smallest and the second smallest sum is the margin;
as each part begins from the dictionary alone, it doesn't shrink with the length of the
text. Where it is below ``CLOSE``, the text is compressed again with a more thorough
search, which decides; a margin that stays narrow is rejected.

The dictionaries are fitted on a bounded sample: for each language ``sample_docs``
documents drawn by a hash of their id, ``slice_bytes`` from the middle of each, up to
``dictionary_bytes`` in all. Prediction reads whole texts, row by row, without shuffles.
"""

from __future__ import annotations

import math

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from shopgrain.llm.common import arrow_schema, as_batch, crc_mod, map_steps, pick, steps
from shopgrain.llm.registry import register, table

UNKNOWN = "und"
DICTIONARY_BYTES = 48 * 1024
SAMPLE_DOCS = 400
SLICE_BYTES = 1024
#: A text is compressed in parts of so many bytes, each from the dictionary alone.
PART_BYTES = 16 * 1024
#: Compression levels of the first look and of the thorough one.
LEVEL, THOROUGH = 5, 12
#: A first margin below this calls for the thorough look.
CLOSE = 0.12
#: Margins below this are narrow: the language is rejected.
LEAST_MARGIN = 0.005
#: ASCII digits, punctuation and controls become spaces.
PLAIN = bytes(c if c >= 128 or 97 <= c <= 122 or 65 <= c <= 90 else 32 for c in range(256))
#: Languages a model may have; a table with more values of lang is refused.
MOST_LANGUAGES = 200
HELD_OUT_OF = 5
KEEP = pa.schema([("keep", pa.bool_())])


def fit(
    docs: DataFrame,
    dictionary_bytes: int = DICTIONARY_BYTES,
    sample_docs: int = SAMPLE_DOCS,
    slice_bytes: int = SLICE_BYTES,
) -> dict[str, bytes]:
    """One dictionary for each non-null language of ``docs`` (doc_id, text, lang).

    Ids are drawn by their hash: a threshold on it thins each language to a few times
    the sample before any row moves, so a large language isn't sorted whole."""
    rows = pick(docs, "doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & (F.length(F.coalesce(F.col("text"), F.lit(""))) > 0)
    )
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return {}
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("language sample"), "doc_id", "text"), 11) * F.lit(2.0**-53)
    share = F.create_map(
        *[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, (2.0 * sample_docs + 50) / n))]
    )
    octets = F.col("text").cast("binary")
    middle = F.greatest(F.lit(1), ((F.octet_length(octets) - slice_bytes) / 2).cast("int") + 1)
    drawn = rows.withColumn("draw", draw).where(F.col("draw") <= F.element_at(share, F.col("lang")))
    drawn = drawn.select("lang", "draw", F.substring(octets, middle, F.lit(slice_bytes)).alias("part"))
    order = Window.partitionBy("lang").orderBy("draw", "part")
    sample = drawn.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= sample_docs)
    parts: dict[str, list[bytes]] = {lang: [] for lang in sizes}
    for row in sample.orderBy("lang", "_n").collect():
        parts[row["lang"]].append(bytes(row["part"]))
    return {
        lang: b" ".join(plain(x.decode("utf-8", "ignore")) for x in found)[:dictionary_bytes]
        for lang, found in sorted(parts.items())
        if found
    }


def plain(text: str) -> bytes:
    """What is compressed: words in lower case, one space around each."""
    return b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(PLAIN).split()) + b" "


class Model:
    """The fitted dictionaries, ready to compress."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.languages = sorted(dictionaries)
        self._looks = [[self._compressor(dictionaries[x], level) for x in self.languages] for level in (LEVEL, THOROUGH)]

    @staticmethod
    def _compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=level)
        return zstandard.ZstdCompressor(dict_data=data, write_checksum=False, write_content_size=False, write_dict_id=False)

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score (0 to 1) and margin. ``und`` with 0 for null and for text
        without a letter; equal sizes go to the language that comes first by name."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        if len(self.languages) == 1:
            return self.languages[0], 1.0, 1.0
        data = memoryview(plain(text))
        parts = [data[at : at + PART_BYTES] for at in range(0, len(data), PART_BYTES)]
        for look in self._looks:
            sizes = [sum(len(compressor.compress(part)) for part in parts) for compressor in look]
            best, second = sorted(sizes)[:2]
            margin = (second - best) / second
            if margin >= CLOSE:
                break
        score = 1.0 / sum(math.exp(-50.0 * (size - best) / second) for size in sizes)
        return self.languages[sizes.index(best)], score, margin


def identify(docs: DataFrame, dictionaries: dict[str, bytes], least_margin: float = LEAST_MARGIN) -> DataFrame:
    """doc_id, lang_pred, score, margin and accepted for every document.

    Null and empty texts and texts without letters are ``und`` and not accepted; repeated
    rows give repeated rows; an empty table gives none; extra columns are not read."""
    found: dict[str, Model] = {}

    def work(step) -> dict:
        model = found.get("model") or found.setdefault("model", Model(dictionaries))
        out = [model.predict(text) for text in step.column("text").to_pylist()]
        return {
            "doc_id": step.column("doc_id"),
            "lang_pred": [x[0] for x in out],
            "score": [x[1] for x in out],
            "margin": [x[2] for x in out],
            "accepted": [x[0] != UNKNOWN and x[2] >= least_margin for x in out],
        }

    return map_steps(
        pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")),
        work,
        "doc_id long, lang_pred string, score double, margin double, accepted boolean",
    )


def keep_accepted(docs: DataFrame, dictionaries: dict[str, bytes], least_margin: float = LEAST_MARGIN) -> DataFrame:
    """The documents, all columns as they are, whose language is accepted."""
    place = docs.columns.index("text")
    found: dict[str, Model] = {}
    schema: StructType = docs.schema
    arrow = arrow_schema(docs.sparkSession, schema)

    def run(batches):
        model = found.get("model") or found.setdefault("model", Model(dictionaries))
        for step in steps(batches):
            keep = []
            for text in step.column(place).to_pylist():
                lang, _, margin = model.predict(text)
                keep.append(lang != UNKNOWN and margin >= least_margin)
            kept = step.filter(as_batch({"keep": keep}, KEEP).column(0))
            yield kept.cast(arrow) if kept.schema != arrow else kept

    return docs.mapInArrow(run, schema)


def training_rows(docs: DataFrame) -> DataFrame:
    """The documents that may be learned from: crc32 of the id modulo 5 is not 0."""
    return pick(docs, "doc_id", "text", "lang").where(crc_mod(F.col("doc_id"), HELD_OUT_OF) != 0)


@register("op3_language_id")
def op3_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    found = identify(docs, fit(training_rows(docs)))
    return found.select(
        "doc_id", (crc_mod(F.col("doc_id"), HELD_OUT_OF) == 0).alias("held_out"), "lang_pred", "score", "margin", "accepted"
    )
