import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import AWKWARD, prose
from tokenizers import Tokenizer

from shopgrain.llm import packing, tokens

PATH = public_tokenizers.path(packing.TOKENIZER)


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


ODD = ["a  b\t c\x1cd", "<|endoftext|> x y<|STARTOFTEXT|>z", "Don't THE'S it's 'll", "é café ́x", "İstanbul ß ẞ ΟΔΟΣ", "12 3.14,  a.b,c ,. ..", "a　b c\u0085", "", "😀😀 👍🏽", "THE,.", "x,", " ", "\r\nA\r"]


def test_new_pieces_of_a_step_are_learned_at_once_when_the_memory_is_full(plain, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 400)
    learned = []
    monkeypatch.setattr(tokens.Encoder, "_learn", lambda self, new, f=tokens.Encoder._learn: (learned.append(len(new)), f(self, new))[1])
    own = tokens.Encoder(PATH)
    for turn in range(4):
        texts = [f"word{turn}x{i} über{turn}, {turn * 40 + i} same." for i in range(40)]
        ids = [plain.encode(text, add_special_tokens=False).ids for text in texts]
        assert own.encode(texts) == [np.array(x, dtype="<u4").tobytes() for x in ids]
    assert len(learned) == 4


def test_remembered_pieces_give_the_tokenizers_ids(plain, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 120)
    own = tokens.Encoder(PATH)
    rng = random.Random(3)
    texts = ODD + [prose(lang, 90, i).title() + ", " + rng.choice(ODD) for i in range(40) for lang in ("en", "de")]
    for text, found in zip(texts, own.encode(texts)):
        assert np.frombuffer(found, dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


@settings(max_examples=40, deadline=None, database=None, derandomize=True)
@given(st.dictionaries(st.integers(1, 256), st.integers(1, 300), max_size=60))
def test_plans_hold_every_piece_once(histogram):
    groups = packing.plan_sequences(histogram, 256)
    held = Counter()
    for number, lengths in groups:
        assert sum(lengths) <= 256
        for length in lengths:
            held[length] += number
    assert held == Counter(histogram)
    assert sum(n for n, _ in groups) <= 1.1 * first_fit(histogram, 256) + 1


def first_fit(histogram, capacity):
    """The sequences that first fit, longest first, needs."""
    room = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            at = next((i for i, r in enumerate(room) if r >= length), None)
            if at is None:
                room.append(capacity - length)
            else:
                room[at] -= length
    return len(room)


def test_few_more_sequences_than_the_bound():
    rng = np.random.default_rng(1)
    lengths, counts = np.unique(np.clip(rng.lognormal(6, 1.2, 30_000).astype(int) + 1, 1, 4096), return_counts=True)
    groups = packing.plan_sequences(dict(zip(lengths.tolist(), counts.tolist())))
    assert sum(n for n, _ in groups) <= 1.01 * (lengths * counts).sum() / 4096 + 1


def check(docs, texts, plain, capacity):
    packed = packing.pack(docs, capacity, keep_ids=True)
    rows = packed.collect()
    want = Counter()
    for doc_id, text in texts:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            data = np.array(ids[at : at + capacity], dtype="<u4").tobytes()
            want[doc_id, piece, at, len(data) // 4, zlib.crc32(data)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by_sequence = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == by_sequence.get(r["sequence_id"], 0)  # gapless from 0
        by_sequence[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(by_sequence.values()) <= capacity
    stored = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    for r in rows:
        s = stored[r["sequence_id"]]
        assert bytes(s["ids"])[4 * r["offset"] : 4 * (r["offset"] + r["length"])] == bytes(r["ids"])
        assert len(s["ids"]) == 4 * by_sequence[r["sequence_id"]] == 4 * s["n_tokens"]
    return len(by_sequence)


def test_pieces_and_places(documents, awkward, plain):
    texts = [(i, prose("en", 5 + 13 * i % 160, i)) for i in range(120)] + [(900, prose("en", 3, 1))] * 50
    n = check(documents(*texts), texts, plain, 64)
    assert n <= 1.05 * sum(len(plain.encode(t, add_special_tokens=False).ids) + 1 for _, t in texts) / 64 + 2
    check(awkward, AWKWARD, plain, 4096)
    assert packing.pack(awkward.limit(0)).collect() == []


def test_the_layout_needs_no_python_workers_of_its_own(spark, documents, monkeypatch):
    docs = documents((1, prose("en", 20, 1)), (2, None))
    given_, make = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *rest: (given_.append(type(data)), make(self, data, *rest))[1])
    assert packing.pack(docs).count() == 2
    assert given_ == [pa.Table]
