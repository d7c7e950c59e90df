"""Token ids of whole texts, by the tokenizers library, in bulk.

The vocabulary used here drops white space and merges only within a run of letters, a digit or a run
of other signs, so a text's ids are its pieces' ids one after the other.  Pieces are found and hashed
(64 bits) by array operations; the library encodes each distinct piece once, and a worker remembers
the first 300,000.  A word that holds anything but printable ASCII and the letters of Latin-1, or an
apostrophe or "<|", is one piece.  Tokenizer files that :func:`splits_at_blanks` does not know are
encoded text by text.
"""

from __future__ import annotations

import json
from itertools import chain

import numpy as np

from shelfcast.llm.common import chunks, rolling, spans_hash

#: Pieces, and ids of pieces, that a worker remembers.
PIECES, PIECE_IDS = 300_000, 2_000_000
#: Fixed value: how the known tokenizer file splits text; white space is removed.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_ENCODERS: dict[str, Encoder] = {}


def splits_at_blanks(spec: dict) -> bool:
    """Whether a tokenizer's ids can be found piece by piece."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    marks = all(t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"] or t["single_word"]) and t["content"].split() == [t["content"]]
                for t in spec["added_tokens"])
    return (marks and steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and bool(steps[0].get("invert"))
            and steps[0]["pattern"].get("Regex") == PATTERN and [x["type"] for x in steps[1:]] == ["ByteLevel"] and not steps[1]["add_prefix_space"]
            and [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"])


def _classes() -> np.ndarray:
    """Of each byte: 0 blank, 1 letter, 2 digit, 3 other sign, 4 byte whose word is left whole."""
    out = np.full(256, 4, np.uint8)
    out[33:127] = 3
    out[[*range(9, 14), 32]] = 0
    out[[*range(65, 91), *range(97, 123)]] = 1
    out[48:58] = 2
    out[39] = 4
    return out


_CLASS = _classes()


def pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of ``data`` (bytes that end in a blank) start and end."""
    kind = _CLASS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)  # letters from U+00C0 to U+00FF are 0xC3 and one more byte
    lead = lead[(data[lead + 1] >= 0x80) & (data[lead + 1] <= 0xBF) & (data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = 1
    kind[np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))] = 4
    before = np.concatenate([np.zeros(1, np.uint8), kind[:-1]])
    edge = (kind != before) | (kind == 2)
    whole = np.flatnonzero(kind == 4)
    if len(whole):  # no edge within the words of such bytes
        blank = np.flatnonzero(kind == 0)
        at = np.unique(np.searchsorted(blank, whole))
        for end, start in zip(blank[at], np.where(at > 0, blank[at - 1] + 1, 0)):
            edge[start + 1:end] = False
    start = np.flatnonzero(edge)
    end = np.concatenate([start[1:], [len(data)]])
    real = kind[start] != 0
    return start[real], end[real]


class Encoder:
    """``ids(texts)`` gives all ids in a row and how many each text has."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            self.by_piece = splits_at_blanks(json.load(f))
        self.vocabulary = self.tokenizer.get_vocab_size()
        # Hashes in order, and of each the place and number of its ids in ``flat``.
        self.hash, self.start, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _piece(self, piece: bytes) -> list[int]:
        if piece.isalpha():  # of bytes: ASCII letters only
            return [t.id for t in self.model.tokenize(piece.decode().lower())]
        return self.tokenizer.encode(piece.decode(), add_special_tokens=False).ids

    def _some(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_piece:
            got = [e.ids for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(got), np.uint32), np.array([len(g) for g in got], np.int64)
        raw = b"\n".join([*texts, b""])
        # Before a combining mark case decides whether two characters become one, so lower case must wait for the library there.
        if b"<|" not in raw and b"\xcc" not in raw and b"\xcd" not in raw:
            raw = raw.lower()
        data = np.frombuffer(raw, np.uint8)
        begin, end = pieces(data)
        distinct, first, which = np.unique(spans_hash(rolling(data), begin, end), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hash, distinct), max(0, len(self.hash) - 1))
        known = self.hash[at] == distinct if len(self.hash) else np.zeros(len(distinct), bool)
        got = [self._piece(raw[begin[i]:end[i]]) for i in first[~known]]
        more = np.fromiter(map(len, got), np.int64, len(got))
        start, length = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
        start[known], length[known] = self.start[at[known]], self.length[at[known]]
        start[~known], length[~known] = len(self.flat) + np.cumsum(more) - more, more
        flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(got), np.uint32, int(more.sum()))])
        if got and len(self.hash) + len(got) <= PIECES and len(flat) <= PIECE_IDS:
            put = np.searchsorted(self.hash, distinct[~known])
            self.flat = flat
            self.hash, self.start, self.length = (np.insert(a, put, b[~known]) for a, b in
                                                  ((self.hash, distinct), (self.start, start), (self.length, length)))
        length = length[which]
        upto = np.concatenate([[0], np.cumsum(length)])
        ids = flat[np.repeat(start[which] - upto[:-1], length) + np.arange(upto[-1])]
        texts_end = np.cumsum([len(t) + 1 for t in texts])
        return ids, np.diff(upto[np.searchsorted(begin, texts_end)], prepend=0)

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        parts = [self._some(texts[a:b]) for a, b in chunks(texts)]
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def encoder(path: str) -> Encoder:
    """The worker's encoder of this file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
