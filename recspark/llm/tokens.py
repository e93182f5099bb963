"""Token ids of whole texts with a public tokenizer, word by word where that is exact.

The tokenizer drops white space and cuts between letters and other signs, so a text is cut
at ASCII white space and between an ASCII letter and ASCII punctuation (but the apostrophe,
which begins contractions), and each distinct piece is encoded once per encoder. Ids
are put together with array lookups. Texts holding a special token are encoded whole.
An encoder keeps at most `KEPT` pieces, so its memory is bounded. Workers outlive their stage, so
a task that is followed by other stages makes its own encoder and gives its memory back.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from .bytesarrays import LOWER, flat, prefix_hashes, slices, span_hashes, within

END = 1
KEPT = 800_000
_SLOT_BITS = 20
_JOINED = 128  # pieces per call of the tokenizer
_SPECIAL = (b"<|startoftext|>", b"<|endoftext|>")

# 0: white space, 1: ASCII letter, 2: ASCII punctuation without the apostrophe, 3: others
_KIND = np.full(256, 3, np.uint8)
_KIND[33:127] = 2
for _low, _high in (("0", "9"), ("'", "'")):
    _KIND[ord(_low) : ord(_high) + 1] = 3
for _low, _high in (("A", "Z"), ("a", "z")):
    _KIND[ord(_low) : ord(_high) + 1] = 1
_KIND[[9, 10, 13, 32]] = 0


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # sorted
        self.entry = np.zeros(0, np.int32)
        self.first = np.zeros(1, np.int32)  # of each entry in `ids`
        self.ids = np.zeros(0, np.uint16)
        self.slot_hash = np.zeros(1 << _SLOT_BITS, np.uint64)  # the latest piece of each slot
        self.slot_entry = np.zeros(1 << _SLOT_BITS, np.int32)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after the other, and how many each has."""
        found: list[list[int]] = [[]] * len(pieces)
        others = []
        plain = self.tokenizer.model
        for i, piece in enumerate(pieces):
            if piece.isalpha():  # ASCII letters: normal form and byte letters are the same
                found[i] = [t.id for t in plain.tokenize(piece.decode())]
            else:
                others.append(i)
        for at in range(0, len(others), _JOINED):
            some = others[at : at + _JOINED]
            texts = [pieces[i].decode() for i in some]
            # white space is dropped, so one call may encode many pieces
            encoded = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            ends = np.cumsum([len(t) + 1 for t in texts])
            begin = np.fromiter((o[0] for o in encoded.offsets), np.int64, len(encoded.ids))
            bounds = np.searchsorted(begin, np.concatenate(([0], ends))).tolist()
            ids = encoded.ids
            for i, low, high in zip(some, bounds, bounds[1:]):
                found[i] = ids[low:high]
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint16, int(size.sum())), size

    def _entries(self, hashes: np.ndarray, example: np.ndarray, last: np.ndarray, raw: bytes) -> np.ndarray:
        """Entries of distinct sorted hashes; pieces never seen are encoded."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        new = self.hashes[at] != hashes if len(self.hashes) else np.ones(len(hashes), bool)
        if new.any():
            pieces = [raw[a:b] for a, b in zip(example[new].tolist(), last[new].tolist())]
            ids, size = self._encode(pieces)
            entry = np.arange(len(pieces), dtype=np.int32) + np.int32(len(self.first) - 1)
            self.first = np.concatenate((self.first, (np.cumsum(size) + self.first[-1]).astype(np.int32)))
            self.ids = np.concatenate((self.ids, ids))
            at = np.searchsorted(self.hashes, hashes[new])
            self.hashes = np.insert(self.hashes, at, hashes[new])
            self.entry = np.insert(self.entry, at, entry)
            at = np.searchsorted(self.hashes, hashes)
        return self.entry[at]

    def _slice(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint16), np.zeros(len(starts), np.int64)
        if len(self.hashes) > KEPT:
            self._forget()
        data = LOWER[data]  # as the tokenizer does
        kind = _KIND[data]
        cut = np.ones(len(data), bool)
        before, here = kind[:-1], kind[1:]
        cut[1:] = (here == 0) | (before == 0) | ((here ^ before) == 3) & (here != 3) & (before != 3)
        cut[starts[:-1][starts[:-1] < len(data)]] = True
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(data))
        keep = kind[first] != 0
        first, last = first[keep], last[keep]
        if not len(first):
            return np.zeros(0, np.uint16), np.zeros(len(starts), np.int64)
        hashes = span_hashes(prefix_hashes(data), first, last)
        slot = (hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        entry = self.slot_entry[slot].astype(np.int64)
        missed = np.flatnonzero(self.slot_hash[slot] != hashes)
        if len(missed):
            distinct, example, which = np.unique(hashes[missed], return_index=True, return_inverse=True)
            spots = missed[example]
            got = self._entries(distinct, first[spots], last[spots], data.tobytes())
            entry[missed] = got[which]
            self.slot_hash[slot[spots]] = 0
            self.slot_entry[slot[spots]] = got
            self.slot_hash[slot[spots]] = distinct
        begin = self.first[entry].astype(np.int64)
        sizes = self.first[entry + 1] - begin
        ids = self.ids[within(begin, sizes)]
        return ids, np.concatenate(([0], np.cumsum(sizes)))[np.searchsorted(first, starts)]

    def texts(self, column: pa.Array):
        """Yields (first row, ids of some rows, where each row begins); rows in order."""
        data, starts = flat(column)
        for low, high in slices(starts):
            own = data[starts[low] : starts[high]]
            raw = own.tobytes()
            bounds = starts[low : high + 1] - starts[low]
            if any(s in raw for s in _SPECIAL):
                parts = [self.whole(raw[a:b].decode()) for a, b in zip(bounds[:-1], bounds[1:])]
                yield low, np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))
            else:
                ids, first = self._slice(own, bounds)
                yield low, ids.astype(np.uint32), first


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker and tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def with_end(ids: np.ndarray, first: np.ndarray, end: int = END) -> tuple[np.ndarray, np.ndarray]:
    """The same rows, each followed by the end id."""
    rows = len(first) - 1
    out = np.full(len(ids) + rows, end, np.uint32)
    mask = np.ones(len(out), bool)
    bounds = first + np.arange(rows + 1)
    mask[bounds[1:] - 1] = False
    out[mask] = ids
    return out, bounds
