"""Token ids of a public tokenizer, with a memory of white-space-separated pieces.

The tokenizer works inside pieces between spaces and line feeds: its normaliser, its
pre-tokenizer and its special tokens never reach across one. So the ids of a text are
the ids of its pieces one after another, and a piece that has been seen needs no second
run. The memory is bounded: when it is full it becomes the older one, from which pieces that
are met again are taken over, and the older one before it goes.
"""

from __future__ import annotations

import ctypes
import gc
import os
import struct
import sys
import time

import numpy as np
import pyarrow as pa

REMEMBERED = 150_000
#: Pieces that are encoded in one run.
BATCH = 20_000
SIGNS = ",."


#: Bytes that a byte-level vocabulary writes as other characters: those that aren't printable.
_OTHERS = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
BYTE_CHARS = {b: 256 + n for n, b in enumerate(_OTHERS)}


def _latin(text: str) -> bool:
    """Characters up to U+00FF only: lower case and composition change nothing but A-Z and À-Þ."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _byte_chars(word: str) -> str:
    """A word as a byte-level vocabulary writes it."""
    return word.encode().decode("latin-1").translate(BYTE_CHARS)


class Encoder:
    """Texts to ids (little-endian unsigned 32-bit bytes)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        most = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self._four = [struct.pack("<I", n) for n in range(most)]  # what each id is written as
        # Words go straight to the merges if this gives the same ids as the whole tokenizer.
        probes = ["the", "international", "zqxjkvb", "über", "ñandúção", "déjàvuß", "a", "ÿ"]
        self._direct = all(
            self._word_ids(x) == self._tokenizer.encode(x, add_special_tokens=False).ids
            and self._word_ids(x) + self._tokenizer.encode(".", add_special_tokens=False).ids
            == self._tokenizer.encode(x.capitalize() + ".", add_special_tokens=False).ids
            for x in probes
        )
        self._known: dict[str, bytes] = {"": b""}
        self._older: dict[str, bytes] = {}

    def _word_ids(self, word: str) -> list[int]:
        return [token.id for token in self._model.tokenize(word if word.isascii() else _byte_chars(word))]

    def _learn(self, pieces: list[str]) -> None:
        """Ids of new pieces. A word with a comma or full stop behind it has the ids of the word
        in lower case and of the sign, for the pre-tokenizer splits letters from signs."""
        known, older = self._known, self._older
        tokenize, four = self._model.tokenize, self._four
        others, joined = [], []
        for piece in pieces:
            if piece in older:
                known[piece] = older[piece]
                continue
            sign = piece[-1]
            word = piece[:-1] if sign in SIGNS else piece
            if not (self._direct and word.isalpha() and (word.isascii() or _latin(word))):
                others.append(piece)
                continue
            word = word.lower()
            if word not in known:
                if word in older:
                    known[word] = older[word]
                else:
                    plain = word if word.isascii() else _byte_chars(word)
                    known[word] = b"".join([four[token.id] for token in tokenize(plain)])
            if word != piece:
                joined.append((piece, word, sign if sign in SIGNS else ""))
        others += [sign for sign in SIGNS if sign not in known]
        for at in range(0, len(others), BATCH):
            part = others[at : at + BATCH]
            for piece, found in zip(part, self._tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                known[piece] = np.array(found.ids, dtype="<u4").tobytes()
        for piece, word, sign in joined:
            known[piece] = known[word] + (known[sign] if sign else b"")

    def _text(self, pieces: list[str]) -> bytes:
        known = self._known
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            if len(pieces) > REMEMBERED // 4:  # a text of very many pieces, part by part
                middle = len(pieces) // 2
                return self._text(pieces[:middle]) + self._text(pieces[middle:])
            wanted = dict.fromkeys(pieces)
            if len(known) + 2 * len(wanted) > REMEMBERED:
                self._known, self._older = {"": b""}, known
                known = self._known
            self._learn([piece for piece in wanted if piece not in known])
            return b"".join([known[piece] for piece in pieces])

    def _pieces(self, text: str | None) -> list[str]:
        if not text:
            return [""]
        if "<|" not in text and _latin(text):  # special tokens are looked for before lower case
            text = text.lower()
        return text.replace("\n", " ").split(" ")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of every text; null is empty. New pieces of all texts are learned at once, also
        when the memory is full; only texts of very many different pieces go one by one."""
        split = [self._pieces(text) for text in texts]
        wanted = set().union(*split)
        new = wanted.difference(self._known)
        if new and len(self._known) + 2 * len(new) > REMEMBERED >= 2 * len(wanted):
            self._known, self._older = {"": b""}, self._known
            new = wanted.difference(self._known)
        if new and len(self._known) + 2 * len(new) <= REMEMBERED:
            self._learn(list(new))
        return [self._text(pieces) for pieces in split]


KEPT = "_shopgrain_encoders"


def encoder(path: str) -> Encoder:
    """The encoder of this process; Python workers serve many tasks and keep it."""
    kept = sys.__dict__.setdefault(KEPT, {})
    if path not in kept:
        kept[path] = Encoder(path)
        give_back()  # what reading the vocabulary took
    return kept[path]


def drop_encoders() -> None:
    """For tasks that need none: Python workers serve later stages too, which need the memory."""
    if sys.__dict__.pop(KEPT, None):
        gc.collect()
        give_back()


TIDIED, TIDY_SECONDS = "_shopgrain_tidied", 2.0


def tidy() -> None:
    """What an earlier task of this process left is freed and given back. Its functions refer to
    each other and keep what they hold until a full collection, which Python seldom makes; one
    in a few seconds is enough, as short tasks leave little."""
    if time.monotonic() - sys.__dict__.get(TIDIED, 0.0) >= TIDY_SECONDS:
        gc.collect()
        give_back()
        sys.__dict__[TIDIED] = time.monotonic()


def give_back() -> None:
    """Give freed memory back to the system, for the allocators keep most of it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)
