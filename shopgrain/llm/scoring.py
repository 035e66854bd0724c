"""Language-model scores by deleted interpolation.

A bigram model: the probability of a word after a word is a mixture of the bigram's and the
word's maximum-likelihood estimates and of a uniform distribution over the vocabulary and
one unknown word. The weights depend on how often the context has been seen (a bucket for
each power of two) and are learned by expectation-maximisation: a seventh of the training
documents is left out of the counts, and its tokens show which estimate predicts best. The
counts that score are those of all training documents.

Counts of the whole corpus are looked up without a vocabulary in anyone's memory. The scan
packs documents into blocks of bounded size, written once. A block asks for the n-grams in
it, each once, as sorted hashes cut by range into buckets; a bucket adds up what the blocks
counted and answers each of them in its own order; block and answers meet again to score.
An n-gram in every document is one entry a block, so none is hot.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import arrow_schema, as_batch, by_group_key, crc_mod_of, pick, steps, written
from shopgrain.llm.registry import register, table
from shopgrain.llm.shingles import mix, word_hashes

#: Documents whose crc32 modulo 7 is 2 are not learned from; 3 is left out of the counts that
#: the weights are learned with.
FOLDS, HELD_OUT, FOR_WEIGHTS = 7, 2, 3
#: Bytes of text in a block, and n-grams in a bucket (about).
BLOCK_BYTES = 8 << 20
BUCKET_GRAMS = 1_500_000
#: Context buckets: never seen, then a bucket for each power of two.
CONTEXTS = 40
#: Steps of a histogram of probabilities: a quarter of a bit, down to 2**-48.
GRID, LOWEST = 4, 48
EM_ROUNDS = 60
BLOCKS = "block long, for_weights boolean, doc_ids array<long>, roles binary, sizes binary, texts binary"
REQUESTS = "block long, bucket int, grams binary, kept binary, left_out binary"
ANSWERS = "block long, bucket int, kept binary, every binary, tokens long, words long, kept_tokens long, kept_words long"
EVALUATED, KEPT, LEFT_OUT = 0, 1, 2
_END = np.uint64(0x5851F42D4C957F2D)  # the token after the last word
_TOP = np.uint64(1 << 63)


def _squeeze(values: np.ndarray) -> bytes:
    """Unsigned numbers in the smallest width that holds them all; the first byte is the width."""
    most = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w))
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _expand(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{data[0]}", offset=1).astype(np.int64)


def _pack_sorted(values: np.ndarray) -> bytes:
    """Ascending numbers as gaps, byte by byte of all gaps, so that the zero bytes lie together."""
    gaps = np.diff(values, prepend=np.zeros(1, dtype=np.uint64))
    return np.ascontiguousarray(gaps.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpack_sorted(data: bytes) -> np.ndarray:
    gaps = np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(gaps, dtype=np.uint64)


@dataclass(frozen=True)
class Sizes:
    """Numbers that every task must agree on."""

    buckets: int
    shift: int

    @staticmethod
    def of(text_bytes: int) -> Sizes:
        tokens = max(1, text_bytes // 5)
        # Bigram hashes keep 22 bits more than it takes to number the tokens, in whole bytes.
        shift = max(0, (64 - 23 - tokens.bit_length()) // 8 * 8)
        return Sizes(max(1, -(-tokens // BUCKET_GRAMS)), shift)

    def bucket(self, grams: np.ndarray) -> np.ndarray:
        return ((grams >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)


def text_blocks(docs: DataFrame) -> DataFrame:
    """The documents packed into blocks by the tasks that scan them, written once."""
    docs = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    arrow = arrow_schema(docs.sparkSession, BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        task = TaskContext.get().partitionId()
        made = 0
        open_: dict[bool, list[tuple[int, int, bytes]]] = {False: [], True: []}
        filled = {False: 0, True: 0}

        def close(which: bool) -> pa.RecordBatch:
            nonlocal made
            rows, open_[which], filled[which] = open_[which], [], 0
            made += 1
            return as_batch(
                {
                    "block": [(task << 24) + made],
                    "for_weights": [which],
                    "doc_ids": [[row[0] for row in rows]],
                    "roles": [bytes(row[1] for row in rows)],
                    "sizes": [np.array([len(row[2]) for row in rows], dtype="<u8").tobytes()],
                    "texts": [squeeze.compress(b"".join(row[2] for row in rows))],
                },
                arrow,
            )

        for step in steps(batches):
            for doc_id, text in zip(step.column("doc_id").to_pylist(), step.column("text").to_pylist()):
                fold = crc_mod_of(doc_id, FOLDS)
                role = EVALUATED if fold == HELD_OUT else LEFT_OUT if fold == FOR_WEIGHTS else KEPT
                data = (text or "").encode("utf-8", "replace")
                which = role == LEFT_OUT
                open_[which].append((doc_id, role, data))
                filled[which] += len(data) + 16
                if filled[which] >= BLOCK_BYTES:
                    yield close(which)
        for which in (False, True):
            if open_[which]:
                yield close(which)

    return written(docs.mapInArrow(run, BLOCKS), "lm-blocks")


class _Block:
    """The tokens of a block's documents one after another, as n-grams with their numbers."""

    def __init__(self, roles: bytes, sizes: bytes, texts: bytes, at: Sizes):
        data = zstandard.ZstdDecompressor().decompress(texts)
        self.roles = np.frombuffer(roles, dtype=np.uint8)
        ends = np.cumsum(np.frombuffer(sizes, dtype="<u8").astype(np.int64)).tolist()
        parts, lengths, begin = [], [], 0
        for end in ends:
            found = word_hashes(data[begin:end].lower().split())
            parts += [found, np.array([_END], dtype=np.uint64)]
            lengths.append(len(found) + 1)
            begin = end
        words = np.concatenate(parts)
        self.lengths = np.array(lengths, dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        before = np.empty_like(words)
        before[1:] = words[:-1]
        before[self.starts] = _END  # the start has been seen as often as the end
        pairs = mix(before * np.uint64(0x9FB21C651E98DF25) + words)
        low = np.uint64((1 << at.shift) - 1)
        own = words >> np.uint64(1)
        both = np.concatenate([own, (pairs >> np.uint64(1) | _TOP) & ~low])
        self.grams, place = np.unique(both, return_inverse=True)
        self.word, self.pair = place[: len(words)], place[len(words) :]
        self.context = np.empty_like(self.word)
        self.context[1:] = self.word[:-1]
        self.context[self.starts] = self.word[self.starts + self.lengths - 1]

    def counted(self, role: int) -> np.ndarray:
        """How often each n-gram occurs in the documents of a role."""
        chosen = np.repeat(self.roles == role, self.lengths)
        both = np.concatenate([self.word[chosen], self.pair[chosen]])
        return np.bincount(both, minlength=len(self.grams))


def _requests(blocks: DataFrame, at: Sizes) -> DataFrame:
    arrow = arrow_schema(blocks.sparkSession, REQUESTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, 1):
            row = step.to_pylist()[0]
            block = _Block(row["roles"], row["sizes"], row["texts"], at)
            kept, left_out = block.counted(KEPT), block.counted(LEFT_OUT)
            buckets = at.bucket(block.grams)
            firsts = np.flatnonzero(np.diff(buckets.astype(np.int64), prepend=-1))
            cuts = list(zip(firsts.tolist(), [*firsts[1:].tolist(), len(buckets)]))
            yield as_batch(
                {
                    "block": [row["block"]] * len(cuts),
                    "bucket": buckets[firsts].astype(np.int32),
                    "grams": [_pack_sorted(block.grams[a:b]) for a, b in cuts],
                    "kept": [_squeeze(kept[a:b]) for a, b in cuts],
                    "left_out": [_squeeze(left_out[a:b]) for a, b in cuts],
                },
                arrow,
            )

    return blocks.mapInArrow(run, REQUESTS)


def _answers(requests: DataFrame) -> DataFrame:
    """Add up the counts of a bucket and answer every block. One more row for each bucket
    (block -1) holds its numbers of tokens and of distinct words."""
    arrow = arrow_schema(requests.sparkSession, ANSWERS)

    def work(key, batches) -> Iterator[pa.RecordBatch]:
        blocks, grams, kept, left_out = [], [], [], []
        for batch in batches:
            blocks += batch.column("block").to_pylist()
            grams += [_unpack_sorted(x) for x in batch.column("grams").to_pylist()]
            kept += [_expand(x) for x in batch.column("kept").to_pylist()]
            left_out += [_expand(x) for x in batch.column("left_out").to_pylist()]
        cuts = np.cumsum([0, *[len(x) for x in grams]]).tolist()
        distinct, place = np.unique(np.concatenate(grams), return_inverse=True)
        in_kept = np.bincount(place, weights=np.concatenate(kept), minlength=len(distinct)).astype(np.int64)
        in_all = in_kept + np.bincount(place, weights=np.concatenate(left_out), minlength=len(distinct)).astype(np.int64)
        is_word = distinct < _TOP
        total = {
            "block": [-1],
            "bucket": [key[0]],
            "kept": [None],
            "every": [None],
            "tokens": [int(in_all[is_word].sum())],
            "words": [int((in_all[is_word] > 0).sum())],
            "kept_tokens": [int(in_kept[is_word].sum())],
            "kept_words": [int((in_kept[is_word] > 0).sum())],
        }
        yield as_batch(total, arrow)
        for at in range(0, len(blocks), 64):
            part = range(at, min(at + 64, len(blocks)))
            out = {name: [None] * len(part) for name in ("tokens", "words", "kept_tokens", "kept_words")}
            out |= {
                "block": [blocks[i] for i in part],
                "bucket": [key[0]] * len(part),
                "kept": [_squeeze(in_kept[place[cuts[i] : cuts[i + 1]]]) for i in part],
                "every": [_squeeze(in_all[place[cuts[i] : cuts[i + 1]]]) for i in part],
            }
            yield as_batch(out, arrow)

    return by_group_key(requests, ["bucket"], work, ANSWERS)


def _meeting(blocks: DataFrame, answers: DataFrame, column: str, at: Sizes, use, schema: str) -> DataFrame:
    """Bring blocks and their answers together: ``use(doc_ids, block, counts)`` gives columns."""
    arrow = arrow_schema(blocks.sparkSession, schema)
    theirs = answers.where("block >= 0").select(F.col("block").alias("to"), "bucket", F.col(column).alias("counts"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        batches = []
        for row in left.to_pylist():
            block = _Block(row["roles"], row["sizes"], row["texts"], at)
            found = sorted(zip(right.column("bucket").to_pylist(), right.column("counts").to_pylist()))
            counts = np.concatenate([_expand(x) for _, x in found])
            batches.append(as_batch(use(row["doc_ids"], block, counts), arrow))
        return pa.Table.from_batches(batches, arrow)

    return blocks.groupBy("block").cogroup(theirs.groupBy("to")).applyInArrow(run, schema)


def _context(counts: np.ndarray) -> np.ndarray:
    """The bucket of a context that has been seen so often."""
    return np.where(counts > 0, np.minimum(CONTEXTS - 1, np.log2(np.maximum(counts, 1)).astype(np.int64) + 1), 0)


def _bin(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.minimum(LOWEST * GRID, np.rint(-GRID * np.log2(np.maximum(p, 1e-300)))), -1).astype(np.int64)


def _estimates(block: _Block, counts: np.ndarray, tokens: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every token: how often its context was seen, and the two estimates."""
    context = counts[block.context]
    return context, counts[block.pair] / np.maximum(context, 1), counts[block.word] / max(1, tokens)


def learn_weights(blocks: DataFrame, answers: DataFrame, at: Sizes, tokens: int, words: int) -> np.ndarray:
    """Weights (bigram, word, uniform) for each context bucket, from the left-out documents.

    Their tokens become a histogram over (context bucket, both estimates in quarters of a bit):
    a table of bounded size, on which expectation-maximisation runs."""

    def use(doc_ids, block, counts) -> dict:
        context, pair, word = _estimates(block, counts, tokens)
        key = (_context(context) * 256 + _bin(pair) + 1) * 256 + _bin(word) + 1
        cells, n = np.unique(key, return_counts=True)
        return {"cell": cells, "n": n}

    seen = _meeting(blocks.where("for_weights"), answers, "kept", at, use, "cell long, n long")
    rows = seen.groupBy("cell").agg(F.sum("n").alias("n")).collect()
    weights = np.tile(np.array([0.4, 0.4, 0.2]), (CONTEXTS, 1))
    weights[0] = 0.0, 0.7, 0.3
    if not rows:
        return weights
    cell, n = (np.array([row[i] for row in rows], dtype=np.int64) for i in (0, 1))
    where, bins = cell >> 16, np.stack([(cell >> 8) & 255, cell & 255], axis=1) - 1
    p = np.where(bins >= 0, 2.0 ** (-bins / GRID), 0.0)
    p = np.hstack([p, np.full((len(p), 1), 1.0 / (words + 1))])
    for _ in range(EM_ROUNDS):
        share = weights[where] * p
        share *= (n / share.sum(axis=1))[:, None]
        total = np.zeros((CONTEXTS, 3))
        np.add.at(total, where, share)
        total += weights.mean(axis=0) * 2.0  # a little of the mean where few tokens were seen
        total[0, 0] = 0.0
        weights = total / total.sum(axis=1, keepdims=True)
    return weights


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Null and empty texts are the end token alone; a null id counts as empty text in the folds;
    repeated rows count and are scored each for itself; an empty table gives no rows; extra
    columns are not read."""
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    size = pick(docs, "text").agg(F.sum(F.octet_length("text"))).first()[0] or 0
    at = Sizes.of(size)
    blocks = text_blocks(docs)
    answers = written(_answers(_requests(blocks, at)), "lm-answers")
    sums = answers.where("block = -1").agg(*[F.sum(x).alias(x) for x in ("tokens", "words", "kept_tokens", "kept_words")])
    total = {name: value or 0 for name, value in sums.first().asDict().items()}
    weights = learn_weights(blocks, answers, at, total["kept_tokens"], total["kept_words"])
    tokens, words = total["tokens"], total["words"]
    unknown = math.log10(tokens + words + 1)

    def use(doc_ids, block, counts) -> dict:
        context, pair, word = _estimates(block, counts, tokens)
        own = weights[_context(context)]
        p = own[:, 0] * pair + own[:, 1] * word + own[:, 2] / (words + 1)
        known = counts[block.word]
        rows = len(doc_ids)
        return {
            "doc_id": doc_ids,
            "held_out": block.roles == EVALUATED,
            "n_tokens": block.lengths,
            "n_known": np.add.reduceat((known > 0).astype(np.int64), block.starts),
            "train_tokens": [tokens] * rows,
            "base_score": np.add.reduceat(np.log10(known + 1.0) - unknown, block.starts),
            "score": np.add.reduceat(np.log10(p), block.starts),
        }

    return _meeting(blocks, answers, "every", at, use, schema)


@register("op7_lm_scores")
def op7_lm_scores(spark, folder):
    return score_documents(table(spark, folder, "documents"))
