"""Token ids of whole texts: every distinct piece of text between white space is encoded once."""

from __future__ import annotations

import os
from itertools import chain

import numpy as np

from tarnlake.llm.words import span_hashes, word_spans

#: Encoded pieces kept by a Python worker; further ones are encoded for the run at hand only.
STORE_PIECES = 400_000
#: ASCII punctuation at which pieces end; without ``' < | >``, which contractions and control strings need.
PUNCTUATION = b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
_IS_PUNCTUATION = np.isin(np.arange(256), list(PUNCTUATION))
_PROBES = ["abc", "Zebra", "thingest", "\xe9t\xe9", "\xc0\xdf\xff", "\xf1a\xed", "q"]
_encoders: dict[str, Encoder] = {}


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in shown)}


class Encoder:
    """Ids of a tokenizer whose pre-tokens are runs of letters, or of punctuation, or single digits.

    Such a tokenizer gives a text the ids of its pieces, joined. Pieces end at ASCII white
    space and between a Latin-1 letter and ASCII punctuation; they are told apart by 64-bit
    hashes. Pieces of Latin-1 letters alone go straight to the tokenizer's model, in lower case and
    the byte-level alphabet, if the tokenizer proves on probes to do the same.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype(np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        self.letters = _byte_letters()
        self.direct = all(self._model(p) == self.tokenizer.encode(p, add_special_tokens=False).ids for p in _PROBES)
        self.known: dict[int, int] = {}
        self.flat = np.zeros(1 << 20, dtype=self.dtype)
        self.bounds = np.zeros(1 << 16, dtype=np.int64)

    def _model(self, piece: str) -> list[int]:
        piece = piece.lower()
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.tokenizer.model.tokenize(piece)]

    def _ids(self, pieces: list[str]) -> list[list[int]]:
        simple = [self.direct and p.isalpha() and max(p) <= "\xff" for p in pieces]
        other = iter(self.tokenizer.encode_batch_fast([p for p, s in zip(pieces, simple, strict=True) if not s], add_special_tokens=False))
        return [self._model(p) if s else next(other).ids for p, s in zip(pieces, simple, strict=True)]

    def _add(self, pieces: list[str], start: int) -> None:
        """Append pieces to the store from number ``start`` on."""
        ids = self._ids(pieces)
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.fromiter(chain.from_iterable(ids), dtype=self.dtype, count=int(size.sum()))
        while start + len(ids) + 1 > len(self.bounds):
            self.bounds = np.r_[self.bounds, np.zeros_like(self.bounds)]
        at = self.bounds[start]
        while at + len(flat) > len(self.flat):
            self.flat = np.r_[self.flat, np.zeros_like(self.flat)]
        self.flat[at : at + len(flat)] = flat
        self.bounds[start + 1 : start + 1 + len(ids)] = at + np.cumsum(size)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of each row in them) of the texts in ``data``."""
        row, starts, ends = word_spans(data, offsets, _letter_edges(data))
        if not len(starts):
            return np.zeros(0, self.dtype), np.zeros(len(offsets), np.int64)
        hashes, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        raw, stored = data.tobytes(), len(self.known)
        keys = hashes.tolist()
        slots = np.fromiter((self.known.get(h, -1) for h in keys), dtype=np.int64, count=len(keys))
        new = np.flatnonzero(slots < 0)
        slots[new] = stored + np.arange(len(new))
        for part in range(0, len(new), 10_000):
            take = new[part : part + 10_000]
            pieces = [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[first[take]].tolist(), ends[first[take]].tolist(), strict=True)]
            self._add(pieces, stored + part)
        for i in new[: max(0, STORE_PIECES - stored)]:
            self.known[keys[i]] = int(slots[i])
        slots = slots[inverse]
        begin, length = self.bounds[slots], self.bounds[slots + 1] - self.bounds[slots]
        upto = np.cumsum(length)
        ids = self.flat[np.repeat(begin - (upto - length), length) + np.arange(upto[-1])]
        return ids, np.r_[0, upto][np.searchsorted(row, np.arange(len(offsets)))]


def _letter_edges(data: np.ndarray) -> np.ndarray:
    """Where a Latin-1 letter and ASCII punctuation meet, in either order."""
    ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    accented = np.zeros(len(data), dtype=bool)  # second byte of a letter from U+00C0 to U+00FF
    accented[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7) & (data[1:] >= 0x80) & (data[1:] < 0xC0)
    begins = ascii_letter.copy()
    begins[:-1] |= accented[1:]
    stop = _IS_PUNCTUATION[data]
    return np.flatnonzero((stop[1:] & (ascii_letter | accented)[:-1]) | (stop[:-1] & begins[1:])) + 1


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
