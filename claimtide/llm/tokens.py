"""Ids of a public tokenizer, a few times faster than text by text.

Both vocabularies cut a text into pieces first and encode each piece by itself. So each
different piece goes through the library once per task and is looked up after that. Texts
with characters beyond the plain Latin ones below, or with a special token's string, go through
the library whole.
"""

from __future__ import annotations

import os
import re
from itertools import chain
from operator import itemgetter

import numpy as np

END_ID = 2
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_BEYOND = re.compile(rf"[^\t\n\r\x20-\x7e{_LETTERS}¡¿«»§°–—‘’“”…€]")
# How the two pre-tokenizers cut plain Latin text (fixed values, part of their formats).
_SPACED = re.compile(rf" ?[{_LETTERS}]++|'(?:[stmd]|re|ve|ll)| ?[0-9]++| ?[^\s{_LETTERS}0-9]++|\s+(?!\S)|\s+")
_LOWERED = re.compile(rf"[{_LETTERS}]++|'(?:[stmd]|re|ve|ll)|[0-9]|[^\s{_LETTERS}0-9]++")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable bytes stand for
    themselves, the others for the code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


_LETTER = _byte_letters()


class _Codes(dict):
    """Piece -> running number; `new` keeps the pieces not encoded yet."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        code = self[piece] = len(self)
        self.new.append(piece)
        return code


class Encoder:
    """Encodes batches of texts; keeps at most about `most_pieces` pieces."""

    def __init__(self, path: str, most_pieces: int = 250_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # Strings of special tokens in a text are these tokens, as in the library's plain call.
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.lower = "Lowercase" in str(self.library.normalizer)
        self.findall = (_LOWERED if self.lower else _SPACED).findall
        self.most_pieces = most_pieces
        self.dtype = np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32
        self.codes = _Codes()
        self.flat = np.zeros(0, self.dtype)
        self.first = np.zeros(1, np.int64)  # where each piece's ids begin; one more at the end
        self.used = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keeps the third of the pieces that was used most."""
        kept = np.sort(np.argsort(-self.used, kind="stable")[:self.most_pieces // 3])
        size = np.diff(self.first)[kept]
        ends = np.cumsum(size)
        self.flat = self.flat[np.repeat(self.first[kept] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        self.first = np.concatenate([[0], ends])
        self.used = self.used[kept] // 2
        pieces = list(self.codes)
        self.codes.clear()
        self.codes.update((pieces[k], code) for code, k in enumerate(kept.tolist()))

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self) -> None:
        """Encodes the new pieces by the library's model: they are cut and lower-cased already."""
        if not self.codes.new:
            return
        tokenize = self.library.model.tokenize
        ids = [[t.id for t in tokenize(p.encode().decode("latin-1").translate(_LETTER))] for p in self.codes.new]
        self.codes.new.clear()
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), self.dtype)])
        ends = self.first[-1] + np.cumsum([len(x) for x in ids], dtype=np.int64)
        self.first = np.concatenate([self.first, ends])
        self.used = np.append(self.used, np.zeros(len(ids), np.int64))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has. Copies are encoded once."""
        different = {t: k for k, t in enumerate(dict.fromkeys(texts))}
        flat, lengths = self._encode(list(different))
        if len(different) == len(texts):
            return flat, lengths
        ends = np.cumsum(lengths)
        parts = [flat[ends[k] - lengths[k]:ends[k]] for k in (different[t] for t in texts)]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.codes) > self.most_pieces:
            self._forget()
        whole = {k: None for k, t in enumerate(texts) if _BEYOND.search(t) or any(s in t for s in self.special)}
        cut = [[] if k in whole else self.findall(t.lower() if self.lower else t) for k, t in enumerate(texts)]
        # itemgetter looks up all pieces of a text in one call; for a single one it gives no tuple.
        found = [np.array(itemgetter(*pieces)(self.codes)).reshape(-1) for pieces in cut if pieces]
        codes = np.concatenate(found) if found else np.zeros(0, np.int64)
        self._learn()
        self.used += np.bincount(codes, minlength=len(self.used))
        begin, size = self.first[codes], self.first[codes + 1] - self.first[codes]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.flat[np.repeat(begin - (ends - size), size) + np.arange(total)]
        pieces = np.cumsum([0, *map(len, cut)])
        upto = np.concatenate([[0], ends])[pieces]
        lengths = np.diff(upto)
        if whole:
            parts = [flat[upto[k]:upto[k + 1]] for k in range(len(texts))]
            for k, ids in zip(whole, self._library([texts[k] for k in whole])):
                parts[k] = np.asarray(ids, self.dtype)
            flat, lengths = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return flat, lengths

    def encode_ended(self, texts: list[str], end: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """As encode, with the end id after each text."""
        flat, lengths = self.encode(texts)
        out = np.full(len(flat) + len(lengths), end, self.dtype)
        ids = np.ones(len(out), bool)
        ids[np.cumsum(lengths + 1) - 1] = False
        out[ids] = flat
        return out, lengths + 1


_KEPT: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, most_pieces: int = 250_000) -> Encoder:
    """The worker's encoder for a vocabulary file, shared by the tasks that it runs."""
    key = path, most_pieces
    if key not in _KEPT:
        _KEPT[key] = Encoder(path, most_pieces)
    return _KEPT[key]
