"""Secret scans: keyword, access-key and hex spans, and the entropy of sliding windows.

Native expressions only. Spans are found with regular expressions: the text between
matches and the matches themselves give their places in code points. Beyond those
base spans, every candidate string (a long run of token characters) with a letter and a
digit belongs to a character class, and so does every long run of letters and digits
between the signs of a candidate, as in ``key=value``, paths and prefixed tokens. A window
slides over both, and the Shannon entropy of each window comes
from symbol counts that are changed by the one character that leaves and the one that
enters. Windows at or above the threshold of the class make an ``entropy`` span, unless
the candidate is on the allow list. Base spans are never suppressed.

A null text counts as empty. Nothing is grouped or shuffled: every row is scanned
alone, over its whole text.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import numbered, pick
from shopgrain.llm.registry import register, table

# Kinds in the order of ties, patterns and least lengths of the base spans.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"  # runs of 18 or more; a shorter run holds no longer one
HEX = r"[0-9a-f]{16,}"

MASK = "[SECRET]"
_PLACE = "struct<start:int,rank:int,end:int>"
_MATCH = "struct<start:int,end:int,value:string>"
_SPAN = f"array<{_PLACE}>"
#: Items that are extended one by one before they are joined as a block.
BLOCK = 128
#: Bits of a symbol's count, and counts in a number.
BITS, DIGITS = 5, 12


@dataclass(frozen=True)
class Entropy:
    """Parameters of the entropy scan. ``run``: what is scanned by itself inside a
    candidate with signs. ``classes``: name, pattern of a whole candidate or run and least
    entropy in bits; the first pattern that fits gives the class, and what fits none (only
    letters or only digits, with or without signs) is not scanned. ``allowed``: patterns
    of whole candidates that are no secrets, with the runs in them."""

    window: int = 20
    candidate: str = r"[A-Za-z0-9+/_=-]{20,}"
    run: str = r"[A-Za-z0-9]{20,}"
    classes: tuple[tuple[str, str, float], ...] = (
        ("hex", r"^(?=.*[0-9])(?=.*[a-fA-F])[0-9a-fA-F]+$", 3.0),
        ("alnum", r"^(?=.*[0-9])(?=.*[a-zA-Z])(?:[0-9a-z]+|[0-9A-Z]+)$", 3.6),
        ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_=-]+$", 3.8),
        ("signed", r"^(?=.*[0-9])(?=.*[a-zA-Z])[A-Za-z0-9+/_=-]+$", 4.0),  # paths in one case reach 3.9
    )
    allowed: tuple[str, ...] = field(
        default=(
            r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUID
            # Words, paths and names with a number; possessive, so that no path is too long to match.
            r"^[A-Za-z]++(?:[-_/][A-Za-z]++)*+[-_/]?[0-9]{0,4}$",
            r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[-_T0-9]*$",  # dates
        )
    )


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(items: Column, zero: Column, step: Callable, emit: Callable, kind: str) -> Column:
    """``emit(state before, x)`` for each item in order, with the state that ``step`` carries on.

    Arrays are extended within blocks, and blocks are joined at the end, so that many items don't
    copy the whole result for each of them."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(items) - 1, F.lit(0)), F.lit(BLOCK)), lambda at: F.slice(items, at + 1, BLOCK)
    )
    nothing = F.array().cast(f"array<{kind}>")

    def inner(state: Column, x: Column) -> Column:
        before = state["state"]
        return F.struct(step(before, x).alias("state"), F.array_append(state["out"], emit(before, x)).alias("out"))

    def outer(state: Column, block: Column) -> Column:
        done = F.aggregate(block, F.struct(state["state"].alias("state"), nothing.alias("out")), inner)
        return _bound(done, lambda d: F.struct(d["state"].alias("state"), F.array_append(state["out"], d["out"]).alias("out")))

    start = F.struct(zero.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out"))
    return F.flatten(F.aggregate(blocks, start, outer, lambda state: state["out"]))


def _located(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches as structs (start, end, value): places of the whole match, text of the group."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    lengths = F.arrays_zip(
        # The last piece is what follows the last match; it has no match beside it.
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(whole, F.length).alias("own"),
        value.alias("value"),
    )

    def emit(at: Column, x: Column) -> Column:
        begin = at + x["gap"]
        return F.struct(begin.alias("start"), (begin + x["own"]).alias("end"), x["value"].alias("value"))

    def located(pieces: Column) -> Column:
        matched = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))
        return _bound(matched, lambda m: _running(m, F.lit(0), lambda at, x: at + x["gap"] + x["own"], emit, _MATCH))

    return F.when(text.rlike(pattern), _bound(lengths, located)).otherwise(F.array().cast(f"array<{_MATCH}>"))


def _spans(located: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.transform(
        located, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"))
    ).cast(_SPAN)


def _hot_windows(value: Column, least: Column, window: int) -> Column:
    """Struct (first, last): where the first window with enough entropy begins and the
    last one ends, from 0; first is -1 without such a window.

    A symbol's count in the window is a digit of ``BITS`` bits in one of a few numbers. A step
    takes one from the digit of the symbol that leaves and adds one to that of the one that enters."""
    if window >= 1 << BITS:
        raise ValueError(f"a window has at most {(1 << BITS) - 1} characters")
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 1)])  # c * log2(c)
    ones = F.array(*[F.lit(1 << (BITS * i)).cast("long") for i in range(DIGITS)])

    def digit(code: Column) -> Column:
        place = (code % DIGITS).cast("int")
        return F.struct(
            F.floor(code / DIGITS).cast("int").alias("word"), (place * BITS).alias("shift"), F.get(ones, place).alias("one")
        )

    def count(counts: Column, of: Column) -> Column:
        shifted = F.call_function("shiftrightunsigned", F.get(counts, of["word"]), of["shift"])
        return shifted.bitwiseAND(F.lit((1 << BITS) - 1).cast("long")).cast("int")

    def added(counts: Column, of: Column, sign: int) -> Column:
        return F.transform(counts, lambda c, j: F.when(j == of["word"], c + sign * of["one"]).otherwise(c))

    state = F.struct(
        F.array_repeat(F.lit(0).cast("long"), -(-128 // DIGITS)).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(0).alias("at"),
        F.lit(-1).alias("first"),
        F.lit(-1).alias("last"),
    )

    def step(s: Column, x: Column) -> Column:
        out, into = x["leave"], x["enter"]

        def entered(left: Column) -> Column:
            there = count(left["counts"], into)
            total = left["sum"] + F.get(weight, there + 1) - F.get(weight, there)
            return _bound(total, lambda t: moved(left, t))

        def moved(left: Column, total: Column) -> Column:
            i = s["at"]
            hot = (i >= window - 1) & (F.lit(math.log2(window)) - total / window >= least)
            return F.struct(
                added(left["counts"], into, 1).alias("counts"),
                total.alias("sum"),
                (i + 1).alias("at"),
                F.when(hot & (s["first"] < 0), i - (window - 1)).otherwise(s["first"]).alias("first"),
                F.when(hot, i + 1).otherwise(s["last"]).alias("last"),
            )

        gone = count(s["counts"], out)
        without = F.struct(
            added(s["counts"], out, -1).alias("counts"), (s["sum"] + F.get(weight, gone - 1) - F.get(weight, gone)).alias("sum")
        )
        same = F.struct(s["counts"].alias("counts"), s["sum"].alias("sum"))
        return _bound(F.when(out.isNull(), same).otherwise(without), entered)

    def scan(codes: Column) -> Column:
        leaving = F.concat(F.array_repeat(F.get(codes, F.lit(-1)), window), codes)
        pairs = F.arrays_zip(codes.alias("enter"), F.slice(leaving, F.lit(1), F.size(codes)).alias("leave"))
        return F.aggregate(pairs, state, step, lambda s: F.struct(s["first"], s["last"]))

    return _bound(F.transform(F.split(value, ""), lambda c: digit(F.ascii(c))), scan)


def _any(value: Column, patterns: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for pattern in patterns:
        found = found | value.rlike(pattern)
    return found


def _entropy_spans(text: Column, rules: Entropy) -> Column:
    """Spans of the candidates and of the runs between signs inside them."""

    def least(value: Column) -> Column:
        found = F.lit(None).cast("double")
        for _, pattern, bits in reversed(rules.classes):
            found = F.when(value.rlike(pattern), F.lit(bits)).otherwise(found)
        return found

    def with_least(x: Column) -> Column:
        return F.struct(x["start"].alias("start"), x["value"].alias("value"), least(x["value"]).alias("least"))

    def inside(candidates: Column) -> Column:
        """The runs that are part of a candidate; one that is a whole candidate is scanned as such."""
        both = F.concat(
            F.transform(candidates, lambda x: F.struct(x["start"], F.lit(0).alias("rank"), x["end"], x["value"])),
            F.transform(_located(text, rules.run), lambda x: F.struct(x["start"], F.lit(1).alias("rank"), x["end"], x["value"])),
        ).cast("array<struct<start:int,rank:int,end:int,value:string>>")
        last = F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("end"))

        def step(state: Column, x: Column) -> Column:
            return F.when(x["rank"] == 0, F.struct(x["start"].alias("start"), x["end"].alias("end"))).otherwise(state)

        def emit(state: Column, x: Column) -> Column:
            part = (x["rank"] == 1) & (x["end"] <= state["end"]) & (x["end"] - x["start"] < state["end"] - state["start"])
            return F.struct(x["start"].alias("start"), x["end"].alias("end"), F.when(part, x["value"]).alias("value"))

        found = _bound(F.array_sort(both), lambda items: _running(items, last, step, emit, _MATCH))
        return F.concat(candidates, F.filter(found, lambda x: x["value"].isNotNull()))

    candidates = F.filter(_located(text, rules.candidate), lambda x: ~_any(x["value"], rules.allowed))
    suspects = F.filter(F.transform(_bound(candidates, inside), with_least), lambda x: x["least"].isNotNull())
    scanned = F.transform(
        suspects,
        lambda x: F.struct(x["start"].alias("start"), _hot_windows(x["value"], x["least"], rules.window).alias("hot")),
    )
    hot = F.filter(scanned, lambda x: x["hot"]["first"] >= 0)
    spans = F.transform(
        hot,
        lambda x: F.struct(
            (x["start"] + x["hot"]["first"]).alias("start"),
            F.lit(KINDS.index("entropy")).alias("rank"),
            (x["start"] + x["hot"]["last"]).alias("end"),
        ),
    )
    return F.when(text.rlike(rules.candidate), F.array_distinct(spans.cast(_SPAN))).otherwise(F.array().cast(_SPAN))


def _uncovered(base: Column, entropy: Column) -> Column:
    """The entropy spans that no base span and no other entropy span covers: with spans in order
    of their starts, and longer ones first, those that end after all before them."""

    def ordered(spans: Column) -> Column:
        return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("end"), x["rank"].alias("rank")))

    both = F.array_sort(F.concat(ordered(base), ordered(entropy)))
    rank = KINDS.index("entropy")

    def emit(most: Column, x: Column) -> Column:
        kept = (x["rank"] == rank) & (-x["end"] > most)
        return F.struct(x["start"].alias("start"), F.when(kept, x["rank"]).otherwise(-1).alias("rank"), (-x["end"]).alias("end"))

    found = _bound(both, lambda items: _running(items, F.lit(-1), lambda most, x: F.greatest(most, -x["end"]), emit, _PLACE))
    return F.filter(found, lambda x: x["rank"] == rank)


def with_spans(df: DataFrame, text: Column, rules: Entropy | None = None) -> DataFrame:
    """Add ``_base`` and ``_spans``: sorted arrays of structs (start, rank of the kind, end).

    Base spans come from the three patterns; entropy spans are added where no base span
    or larger entropy span covers them."""
    rules = rules or Entropy()
    whole = F.coalesce(text, F.lit(""))
    assign = F.filter(_located(whole, ASSIGN, 1), lambda x: F.length(x["value"]) >= ASSIGN_LEAST)
    base = F.array_sort(
        F.concat(
            _spans(assign, "assign"),
            _spans(_located(whole, ACCESS), "access"),
            _spans(_located(whole, HEX), "hex"),
        )
    )
    df = df.withColumn("_base", base).withColumn("_entropy", _entropy_spans(whole, rules))
    added = F.when(F.size("_entropy") > 0, _uncovered(F.col("_base"), F.col("_entropy"))).otherwise(F.array().cast(_SPAN))
    return df.withColumn("_spans", F.array_sort(F.concat(F.col("_base"), added))).drop("_entropy")


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(
        ",", F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["rank"]), x["start"], x["end"]))
    )


def scan_secrets(docs: DataFrame, rules: Entropy | None = None) -> DataFrame:
    """Counts and spans of secrets of every document.

    A null or empty text has no spans; repeated rows give repeated rows; an empty table
    gives none; extra columns are not read."""
    docs = with_spans(pick(docs, "doc_id", "text"), F.col("text"), rules)

    def count(kind: str) -> Column:
        return F.size(F.filter("_base", lambda x: x["rank"] == KINDS.index(kind))).cast("long")

    return docs.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"),
        _joined(F.col("_spans")).alias("spans"),
    )


def masked(text: Column, spans: Column, mask: str = MASK) -> Column:
    """The text with every span replaced; overlapping spans become one mask."""

    def emit(at: Column, x: Column) -> Column:
        gap = F.substring(text, at + 1, x["start"] - at)
        return F.when(x["start"] >= at, F.concat(gap, F.lit(mask))).otherwise(F.lit(""))

    pieces = _running(spans, F.lit(0), lambda at, x: F.greatest(at, x["end"]), emit, "string")
    rest = F.substring(text, F.array_max(F.transform(spans, lambda x: x["end"])) + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(text)


def mask_secrets(docs: DataFrame, rules: Entropy | None = None) -> DataFrame:
    """The documents with secrets masked in ``text`` and ``n_chars`` counted again.
    No row goes; a null text stays null."""
    names = docs.columns
    text = f"_{names.index('text')}"
    plain = numbered(docs)
    spanned = with_spans(plain, F.col(text), rules).withColumn(text, masked(F.col(text), F.col("_spans")))
    if "n_chars" in names:
        count = f"_{names.index('n_chars')}"
        spanned = spanned.withColumn(count, F.when(F.size("_spans") > 0, F.length(text)).otherwise(F.col(count)).cast("long"))
    return spanned.select(*plain.columns).toDF(*names)


@register("op10_secret_scan")
def op10_secret_scan(spark, folder):
    return scan_secrets(table(spark, folder, "documents"))
