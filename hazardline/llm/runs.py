"""Periodic runs of words (op 13): a suffix automaton whose link tree is a link-cut forest.

Appending word i walks from the automaton's state of prefix i up the suffix links.  The link-cut forest keeps that tree
as vertical paths whose states all ended last at the same word; the walk ("access") meets the path segments from the
deepest to the root and recolours them to i.  A segment with last end e whose deepest state spells L words says that the
last L words also end at e and that e is their latest other end: with p = i - e <= L they hold a square of period p, and
L + p words up to i have period p, which reaches back to where the run begins.  The same run is met again at every
word that extends it, so the last end seen under (start, period) is its end.

L is exact: suffixes of prefix i whose last ends differ have different sets of ends, so the longest with one last end
is the longest string of its state, in the finished automaton as well.  p is the smallest period: a smaller one
of at least 2p words would divide p (Fine and Wilf) and give a later end than e.

The walk needs Python objects word by word, so texts are first cut down, without loss, to the stretches that can hold a run.
In a run of period q all but its first q words have occurred at most q words before, so it lies in a stretch of at
least length - q such words; :func:`stretches` finds all of them for q up to every power of two.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import docs_of

#: A run has at least so many words and at least so many times its period.
MIN_WORDS, MIN_PERIODS = 6, 4

SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          "collapsed_sha256 string")


def words_of(text: bytes) -> list[bytes]:
    """Runs of bytes that are not ASCII white space (what ``bytes.split`` cuts at)."""
    return text.split()


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    number: dict[bytes, int] = {}
    return np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))


def stretches(x: np.ndarray, least: int = MIN_WORDS, periods: int = MIN_PERIODS) -> list[tuple[int, int]]:
    """Disjoint [lo, hi) ranges of ``x`` that hold all runs, with a word to spare on either side."""
    n = len(x)
    order = np.argsort(x, kind="stable")
    back = np.full(n, n + 1, np.int64)          # distance to the word's previous occurrence
    same = x[order[1:]] == x[order[:-1]]
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    inside = np.zeros(n + 1, np.int64)
    top = 1
    while top // 2 * periods < n:               # periods in (top / 2, top]
        q = top // 2 + 1
        edge = np.diff(np.concatenate([[0], back <= top, [0]]))
        lo, hi = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
        long = hi - lo >= max((periods - 1) * q, least - top)
        lo, hi = np.maximum(lo[long] - top - 1, 0), np.minimum(hi[long] + 1, n)
        np.add.at(inside, lo, 1)
        np.add.at(inside, hi, -1)
        top *= 2
    edge = np.diff(np.concatenate([[0], np.cumsum(inside[:n]) > 0, [0]]))
    return list(zip(np.flatnonzero(edge > 0).tolist(), np.flatnonzero(edge < 0).tolist()))


def suffix_automaton(x: list[int]) -> tuple[array, array, array]:
    """(len, link, state of each prefix) of the automaton of ``x``.  Nearly all states have one way on, kept in two
    arrays; only the others have a table."""
    size, link, state = array("i", [0]), array("i", [-1]), array("i")
    word, to, more = array("i", [-1]), array("i", [-1]), {}
    last = 0
    for c in x:
        cur = len(size)
        size.append(size[last] + 1)
        link.append(0)
        word.append(-1)
        to.append(-1)
        p = last
        while p >= 0:
            w = word[p]
            if w < 0:
                word[p], to[p] = c, cur
            elif w == c:
                break
            else:
                t = more.get(p)
                if t is None:
                    more[p] = {c: cur}
                elif c in t:
                    break
                else:
                    t[c] = cur
            p = link[p]
        if p >= 0:
            q = to[p] if word[p] == c else more[p][c]
            if size[q] == size[p] + 1:
                link[cur] = q
            else:
                new = len(size)
                size.append(size[p] + 1)
                link.append(link[q])
                word.append(word[q])
                to.append(to[q])
                if q in more:
                    more[new] = dict(more[q])
                link[q] = link[cur] = new
                while p >= 0:
                    if word[p] == c:
                        if to[p] != q:
                            break
                        to[p] = new
                    else:
                        t = more.get(p)
                        if t is None or t.get(c) != q:
                            break
                        t[c] = new
                    p = link[p]
        last = cur
        state.append(cur)
    return size, link, state


class LinkCut:
    """Paths of a rooted tree as splay trees by depth; a path's colour is kept at the root of its splay tree."""

    def __init__(self, parent: array):
        n = len(parent)
        self.up = array("i", parent)            # parent in the splay tree, else (at its root) of the path's top
        self.left, self.right = array("i", [-1]) * n, array("i", [-1]) * n
        self.colour = array("i", [-1]) * n

    def _splay(self, v: int) -> None:
        up, left, right = self.up, self.left, self.right
        while True:
            p = up[v]
            if p < 0 or (left[p] != v and right[p] != v):
                return
            g = up[p]
            below = g >= 0 and (left[g] == p or right[g] == p)
            if below:
                if (left[g] == p) == (left[p] == v):
                    self._rotate(p)
                else:
                    self._rotate(v)
                self._rotate(v)
            else:
                self._rotate(v)
                return

    def _rotate(self, v: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[v]
        g = up[p]
        if left[p] == v:
            b = right[v]
            left[p], right[v] = b, p
        else:
            b = left[v]
            right[p], left[v] = b, p
        if b >= 0:
            up[b] = p
        up[p], up[v] = v, g
        if g >= 0 and left[g] == p:
            left[g] = v
        elif g >= 0 and right[g] == p:
            right[g] = v
        else:
            self.colour[v] = self.colour[p]     # v is the root now

    def access(self, v: int, colour: int):
        """Yields (state, colour) of the deepest state of each segment of the path from ``v`` to the root, whose
        colour was not ``colour``; afterwards the whole path is one segment of this colour."""
        up, right = self.up, self.right
        below, x = -1, v
        while x >= 0:
            self._splay(x)
            was = self.colour[x]
            r = right[x]
            if r >= 0:
                self.colour[r] = was            # the deeper part keeps its colour
            right[x] = below
            if was >= 0:
                yield x, was
            below, top = x, x
            x = up[x]
        self.colour[top] = colour
        self._splay(v)


def runs_within(x: list[int], least: int = MIN_WORDS, periods: int = MIN_PERIODS) -> dict[tuple[int, int], int]:
    """(start, period) -> length of the runs of ``x`` with at least ``least`` words and ``periods`` periods (>= 2)."""
    size, link, state = suffix_automaton(x)
    tree, found = LinkCut(link), {}
    for i, v in enumerate(state):
        for s, e in tree.access(v, i):
            p, k = i - e, size[s]
            if k + p >= periods * p and k + p >= least:
                found[i + 1 - p - k, p] = k + p
    return found


def runs(x: np.ndarray, least: int = MIN_WORDS, periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of ``x``, by start, then period."""
    out = []
    for lo, hi in stretches(x, least, periods):
        out += [(lo + s, k, p) for (s, p), k in runs_within(x[lo:hi].tolist(), least, periods).items()]
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id: int | None, n: int) -> np.ndarray:
    """Indices of the words of the text that is searched: in a tenth of the documents, told by their id, the words
    from some place on repeat those from there.  A null id plants nothing."""
    i = np.arange(n)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return i
    g = h // 10
    a = g % n
    return np.where(i >= a, a + (i - a) % (1 + (n - a) // (3 + g % 8)), i)


def describe(doc_id: int | None, text: bytes, plant: bool) -> tuple:
    """One row of the result."""
    words = words_of(text)
    x = word_numbers(words)
    if plant:
        at = planted(doc_id, len(words))
        words, x = [words[i] for i in at.tolist()], x[at]
    found = runs(x) if len(words) >= MIN_WORDS else []
    kept = words
    if found:
        drop = np.zeros(len(words) + 1, np.int64)
        for s, k, p in found:
            drop[s + p] += 1
            drop[s + k] -= 1
        kept = [w for w, d in zip(words, np.cumsum(drop).tolist()) if not d]
    best = (None, None, None, None)
    if found:
        s, k, p = found[0]
        for r in found[1:]:                     # exact comparison of length / period; ties keep start, then period
            if r[1] * p > k * r[2]:
                s, k, p = r
        best = (s, k, p, 1000 * k // p)
    listed = "".join(f"{s},{k},{p}\n" for s, k, p in found).encode()
    return (doc_id, len(found), *best, hashlib.sha256(listed).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """One row per row of ``docs``: its runs (count, the one of greatest exponent, a digest of all) and a digest of the
    text with each run cut to its first period.

    A null or empty text has no words and no runs; so has a text of under six words.  Repeated rows give repeated rows,
    a null id stays null, an empty table gives an empty result.  ``plant`` searches the texts of :func:`planted` instead.
    A document is one row of one task; its memory grows with the stretches that can hold runs.
    """
    def of(batches):
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        types = [pa.string() if f.endswith("string") else pa.int64() for f in SCHEMA.split(", ")]
        for b in batches:
            got = [describe(i, t.encode(), plant) for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist())]
            cols = list(zip(*got)) if got else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)
    return docs_of(docs, id_col, text_col).select("doc_id", F.col("text")).mapInArrow(of, SCHEMA)
