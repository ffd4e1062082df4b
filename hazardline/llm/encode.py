"""Token ids of whole Arrow batches, by the tokenizers library.

Both tokenizers used here cut a text before any merge: at white space, and between letters and other marks.
So the ids of a text are those of its parts, and a part met before need not be encoded again.  The parts
are found with numpy over the batch's bytes, and only cuts that hold for both tokenizers are made:

* a space before a word belongs to the word; of a longer run of white space the last character stands apart
  from the rest (the word tokenizer drops white space, so there it makes no difference);
* between an ASCII letter and an ASCII mark, but not after an apostrophe (contractions).

Texts with white space beyond ASCII are encoded whole.  Known parts are looked up by a 64-bit hash with a seed that each
worker draws for itself, so no text can be made to meet another's part; the table is emptied when it is full, and what a
worker holds stays under about 60 MB.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from hazardline.llm.textnp import LOWER, blocks, span_hashes, utf8

_SLOTS = 1 << 21
_SHIFT = np.uint64(64 - 21)
MOST_PARTS = _SLOTS // 3       # parts kept
MOST_IDS = 4_000_000           # ids kept

_WS = np.zeros(256, bool)
_WS[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_AFTER = _MARK.copy()
_AFTER[ord("'")] = False
#: Unicode's White_Space characters beyond ASCII (fixed values), in UTF-8.
_WIDE = re.compile("[\x85\xa0  -     　]")
_WIDE_LEADS = np.zeros(256, bool)
_WIDE_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_ENCODERS: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """One encoder per Python worker and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def part_starts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Where the parts of the texts in ``data`` start."""
    n = len(data)
    ws, letter, space = _WS[data], _LETTER[data], data == 32
    begin = np.zeros(n + 1, bool)
    begin[offs] = True                       # a text's first byte
    prev_ws = np.empty(n, bool)
    prev_ws[0], prev_ws[1:] = False, ws[:-1]
    next_ws = np.empty(n, bool)
    next_ws[-1], next_ws[:-1] = True, ws[1:]
    next_ws[begin[1:n + 1]] = True           # nothing follows a text's last byte
    first = begin[:n]
    start = first | (ws & (~prev_ws | ~next_ws))
    prev_space = np.empty(n, bool)
    prev_space[0], prev_space[1:] = False, space[:-1]
    start |= ~ws & prev_ws & ~prev_space
    mark = _MARK[data]
    start[1:] |= (letter[:-1] & mark[1:]) | (_AFTER[data[:-1]] & letter[1:])
    return np.flatnonzero(start)


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        self.words = self.tok.normalizer is not None  # word BPE: folds case and drops white space itself
        self._empty()

    def _empty(self) -> None:
        self.keys, self.slot = np.zeros(_SLOTS, np.uint64), np.zeros(_SLOTS, np.int32)
        self.seed = int.from_bytes(os.urandom(8), "little")
        self.parts = self.used = 0
        self.at, self.len = np.empty(1 << 16, np.int32), np.empty(1 << 16, np.int32)
        self.ids = np.empty(1 << 18, np.uint32)

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        """``a`` with room for ``n`` entries (at least half as much again where it grows)."""
        if n <= len(a):
            return a
        a.resize(max(n, len(a) * 3 // 2), refcheck=False)
        return a

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the parts with these hashes, -1 for unknown ones (open addressing, all at once)."""
        out = np.full(len(h), -1, np.int64)
        todo, slot = np.arange(len(h)), (h >> _SHIFT).astype(np.int64)
        while len(todo):
            k = self.keys[slot]
            hit = k == h[todo]
            out[todo[hit]] = self.slot[slot[hit]]
            go = ~hit & (k != 0)
            todo, slot = todo[go], (slot[go] + 1) % _SLOTS
        return out

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        """Encode new parts, each as a word of its own, and enter them under their (distinct) hashes."""
        e = self.tok.encode(texts, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(e.ids, np.uint32)
        size = np.bincount(np.array(e.word_ids, np.int64), minlength=len(texts))
        at = self.used + np.cumsum(size) - size
        n = self.parts + len(texts)
        self.ids, self.at, self.len = self._room(self.ids, self.used + len(ids)), self._room(self.at, n), self._room(self.len, n)
        self.ids[self.used:self.used + len(ids)] = ids
        self.at[self.parts:n], self.len[self.parts:n] = at, size
        number, slot = self.parts + np.arange(len(texts)), (hashes >> _SHIFT).astype(np.int64)
        self.used, self.parts = self.used + len(ids), self.parts + len(texts)
        while len(number):
            free = np.flatnonzero(self.keys[slot] == 0)
            own, first = np.unique(slot[free], return_index=True)
            got = free[first]
            self.keys[own], self.slot[own] = hashes[got], number[got]
            left = np.ones(len(number), bool)
            left[got] = False
            hashes, number, slot = hashes[left], number[left], (slot[left] + 1) % _SLOTS

    def block(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts of one block without wide white space."""
        texts = len(offs) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(texts + 1, np.int64)
        s = s0 = part_starts(data, offs)
        e = np.append(s[1:], len(data))
        if self.words:  # fewer kinds of parts: no leading space, lower case
            data = LOWER[data]
            s = np.minimum(s + (data[s] == 32), e)
        h = span_hashes(data, s, e, self.seed) | np.uint64(1)
        n = self._find(h)
        new = np.flatnonzero(n < 0)
        if len(new):
            if self.parts + len(new) > MOST_PARTS or self.used > MOST_IDS:
                self._empty()
                h = span_hashes(data, s, e, self.seed) | np.uint64(1)
                new = np.arange(len(h))
            fresh, first = np.unique(h[new], return_index=True)
            raw = data.tobytes()
            for i in range(0, len(fresh), MOST_PARTS):
                self._learn(fresh[i:i + MOST_PARTS], [raw[s[k]:e[k]].decode("utf-8", "replace")
                                                      for k in new[first[i:i + MOST_PARTS]]])
            n[new] = self._find(h[new])
        size = self.len[n].astype(np.int64)
        ends = np.cumsum(size)
        ids = self.ids[np.repeat(self.at[n] - (ends - size), size) + np.arange(ends[-1])]
        upto = np.concatenate([[0], ends])
        return ids, upto[np.searchsorted(s0, offs)]

    def encode(self, texts: pa.Array):
        """Yields (first row, last row, ids, offsets) for blocks of the rows of a string array, in order."""
        data, offs = utf8(texts)
        for i, j in blocks(offs):
            part, o = data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
            if _WIDE_LEADS[part].any():
                own = [bytes(part[o[k]:o[k + 1]]).decode("utf-8", "replace") for k in range(j - i)]
                wide = np.array([bool(_WIDE.search(t)) for t in own])
                if wide.any():
                    got = []
                    for k in range(j - i):
                        got.append(np.array(self.tok.encode(own[k], add_special_tokens=False).ids, np.uint32) if wide[k]
                                   else self.block(part[o[k]:o[k + 1]], np.array([0, o[k + 1] - o[k]]))[0])
                    yield i, j, np.concatenate(got), np.concatenate([[0], np.cumsum([len(x) for x in got])])
                    continue
            yield i, j, *self.block(part, o)

    def documents(self, texts: pa.Array):
        """The ids of each text with the end id 0, as little-endian bytes."""
        for i, j, ids, offs in self.encode(texts):
            raw, o = ids.astype("<u4", copy=False).tobytes(), (offs * 4).tolist()
            for k in range(j - i):
                yield raw[o[k]:o[k + 1]] + b"\0\0\0\0"
