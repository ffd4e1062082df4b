"""Benchmark passages in documents: CGK embedding, bit-sampling LSH, exact edit distance.

An item and a passage match if their edit distance is at most ``max_edit`` of the item's length (bytes of the
text with ASCII case folded and white space runs as one space).

1. Seeds: an item is cut into 8-byte pieces, or shorter ones where 8 bytes give no more pieces than edits.  At most
   ``max_edit`` * length pieces can be hurt by that many edits, so a matching window holds the others unchanged near
   one diagonal.  This is exact; it says which item-sized windows of a document are worth embedding.  Windows of
   items with shorter pieces go to step 3 at once.
2. CGK: a random walk copies each byte zero or more times, so that few edits become few changed places.  Each
   window and item is embedded with ``WALKS`` seeds; from each embedding ``KEYS`` keys of sampled places are
   taken.  A window is a candidate of an item if any key agrees.
3. Candidates are verified by edit distance against the text around the window (free ends).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import docs_of, stage, lean
from hazardline.llm.textnp import LOWER, blocks, mix, utf8

PIECE = 8
MAX_EDIT = 0.1
#: Walks and keys per walk.
WALKS, KEYS = 8, 16
EMBED_CELLS = 1 << 24    # bytes of embeddings made together
ITEMS_AT_ONCE = 20_000   # items sent to the tasks together; more are taken in turns


def normalised(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with ASCII letters in lower case and every run of ASCII white space as one space."""
    low = LOWER[data]
    ws = (low == 32) | ((low >= 9) & (low <= 13))
    low[ws] = 32
    keep = np.ones(len(low), bool)
    keep[1:] = ~(ws[1:] & ws[:-1])
    first = offs[:-1][offs[:-1] < len(low)]
    keep[first] = True
    upto = np.concatenate([[0], np.cumsum(keep)])
    return low[keep], upto[offs]


def _grams(data: np.ndarray, piece: int = PIECE) -> np.ndarray:
    """The ``piece`` bytes at each position as one integer."""
    if len(data) < piece:
        return np.zeros(0, np.uint64)
    if piece < PIECE:
        n = len(data) - piece + 1
        out = np.zeros(n, np.uint64)
        for j in range(piece):
            out |= data[j:j + n].astype(np.uint64) << np.uint64(8 * j)
        return out
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, PIECE)).view(np.uint64).ravel()


class Items:
    """The pieces of the items, found in a text by one table lookup per position."""

    def __init__(self, ids: list[int], texts: list[str], max_edit: float = MAX_EDIT):
        self.ids, self.max_edit = ids, max_edit
        self.text = [bytes(normalised(*utf8(pa.array([t])))[0].tobytes().strip()) for t in texts]
        self.length = np.array([len(t) for t in self.text], np.int64)
        self.edits = (self.length * max_edit).astype(np.int64)
        # So many pieces that the edits cannot hurt all; a match must hold the others.
        self.piece = np.clip(self.length // (self.edits + 1), 1, PIECE)
        self.need = np.maximum(1, self.length // self.piece - self.edits)
        self.tables = [self._table(p) for p in sorted({PIECE, *self.piece[self.length > 0].tolist()})]
        self.keys = keys(self.text, self.length, self.edits)

    def _table(self, piece: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(piece, keys in order, their items, their places, slots that have a key) of the items with such pieces."""
        key, item, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in np.flatnonzero(self.piece == piece).tolist():
            g = _grams(np.frombuffer(self.text[i], np.uint8), piece)[::piece]
            key.append(g)
            item.append(np.full(len(g), i))
            at.append(np.arange(len(g)) * piece)
        key = np.concatenate(key)
        order = np.argsort(key, kind="stable")
        bits = np.zeros(1 << 22, bool)
        bits[self._slot(key)] = True
        return piece, key[order], np.concatenate(item)[order], np.concatenate(at)[order], bits

    @staticmethod
    def _slot(k: np.ndarray) -> np.ndarray:
        return ((k * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype(np.int64)

    def windows(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, start in ``data``) of the windows that hold enough pieces near one diagonal."""
        hits = [self._hits(data, offs, *t) for t in self.tables]
        text, item, diag, place = (np.concatenate(x) for x in zip(*hits))
        order = np.lexsort((place, diag, item, text))
        text, item, diag = text[order], item[order], diag[order]
        group = text * len(self.ids) + item
        # the hit `need - 1` further on must be of the same text and item and at most 2 * edits diagonals away
        last = np.arange(len(diag)) + self.need[item] - 1
        ok = last < len(diag)
        last = np.minimum(last, max(0, len(diag) - 1))
        ok &= (group[last] == group) & (diag[last] - diag <= 2 * self.edits[item]) if len(diag) else ok
        # all hits between the two are part of the passage
        within = np.zeros(len(diag) + 1, np.int64)
        np.add.at(within, np.flatnonzero(ok), 1)
        np.add.at(within, last[ok] + 1, -1)
        ok = np.cumsum(within)[:-1] > 0
        text, item, diag = text[ok], item[ok], diag[ok]
        # several windows per passage: insertions and deletions put its pieces on several diagonals, and only from about the
        # right one do the walks start together.  A whole item in one short piece is found once.
        short = self.piece[item] < PIECE
        stretch = diag // np.where(short, PIECE, np.maximum(1, self.edits[item] // 3))
        stretch[short & (self.edits[item] == 0)] = 0
        new = np.ones(len(diag), bool)
        new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (stretch[1:] != stretch[:-1])
        return text[new], item[new], diag[new]

    def _hits(self, data, offs, piece, key, item, at, bits):
        """(text, item, diagonal, place in the item) of the pieces of a table found in the texts."""
        g = _grams(data, piece)
        pos = np.flatnonzero(bits[self._slot(g)])
        lo = np.searchsorted(key, g[pos], "left")
        n = np.searchsorted(key, g[pos], "right") - lo
        pos, lo, n = pos[n > 0], lo[n > 0], n[n > 0]
        which = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        pos = np.repeat(pos, n)
        text = np.searchsorted(offs, pos, "right") - 1
        inside = pos + piece <= offs[text + 1]
        pos, which, text = pos[inside], which[inside], text[inside]
        return text, item[which], pos - at[which], at[which]


def places(edits: np.ndarray) -> np.ndarray:
    """Places per key for items with so many edits: the more edits, the sooner two walks part, so the fewer places must agree for
    one of the WALKS * KEYS keys to hit.  Tests hold every cell of lengths and edits to a recall of 0.95, insertions and deletions too."""
    return np.select([edits <= 4, edits <= 10, edits <= 20], [8, 6, 5], 4)


def embed(rows: np.ndarray, size: np.ndarray, walk: int) -> np.ndarray:
    """CGK embeddings of byte rows [n, width] (lengths ``size``): [n, 3 * width], 0 once a row is used up.

    The walk's random bits depend on the step and the byte only, so equal strings walk alike in rows of any width.
    """
    n, width = rows.shape
    bits = np.random.RandomState(1000 + walk)
    out, at, idx = np.zeros((3 * width, n), np.uint8), np.zeros(n, np.int64), np.arange(n)
    padded = np.concatenate([rows, np.zeros((n, 1), np.uint8)], 1)
    for j in range(3 * width):
        step = bits.randint(0, 2, 256).astype(np.int64)
        c = padded[idx, np.minimum(at, size)]
        out[j] = c
        at += step[c]
    return out.T


def keys(texts: list[bytes], like: np.ndarray, edits: np.ndarray) -> np.ndarray:
    """LSH keys [n, WALKS * KEYS] of byte strings; places are sampled among those that ``like`` bytes fill, as many as ``edits`` ask.

    Strings are embedded together with others of about their length, and at most ``EMBED_CELLS`` bytes of embeddings at a
    time, so that one long item makes neither the short ones nor the memory grow.
    """
    out = np.empty((len(texts), WALKS * KEYS), np.uint64)
    width = np.maximum(like, [len(t) for t in texts])
    order = np.argsort(width, kind="stable")
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and width[order[hi]] <= 4 * width[order[lo]] and (hi - lo) * 3 * width[order[hi]] < EMBED_CELLS:
            hi += 1
        part = order[lo:hi]
        out[part] = _keys([texts[i] for i in part.tolist()], like[part], places(edits[part]))
        lo = hi
    return out


def _keys(texts: list[bytes], like: np.ndarray, most: np.ndarray) -> np.ndarray:
    size = np.array([len(t) for t in texts], np.int64)
    rows = np.zeros((len(texts), max(int(like.max()), int(size.max()))), np.uint8)
    for r, t in enumerate(texts):
        rows[r, :len(t)] = np.frombuffer(t, np.uint8)
    out, idx = np.empty((len(texts), WALKS * KEYS), np.uint64), np.arange(len(texts))
    for w in range(WALKS):
        e = embed(rows, size, w)
        share = np.random.RandomState(5000 + w).random_sample((KEYS, 8))
        for k in range(KEYS):
            h = np.full(len(rows), w * KEYS + k + 1, np.uint64)
            for j, f in enumerate(share[k]):
                h = np.where(j < most, mix(h * np.uint64(0x100000001B3) + e[idx, (f * f * 2 * like).astype(np.int64)].astype(np.uint64)), h)
            out[:, w * KEYS + k] = h
    return out


def edit_distance_inside(item: bytes, text: bytes, most: int) -> int:
    """Least edit distance of ``item`` to any substring of ``text``; more than ``most`` if above it."""
    a, b = np.frombuffer(item, np.uint8), np.frombuffer(text, np.uint8)
    prev = np.zeros(len(b) + 1, np.int64)
    steps = np.arange(len(b) + 1)
    for i in range(len(a)):
        cur = np.empty(len(b) + 1, np.int64)
        cur[0] = i + 1
        cur[1:] = np.minimum(prev[1:] + 1, prev[:-1] + (b != a[i]))
        cur = np.minimum.accumulate(cur - steps) + steps     # insertions
        if cur.min() > most:
            return most + 1
        prev = cur
    return int(prev.min())


def _scan(items: Items):
    def run(batches):
        for b in batches:
            data, offs = utf8(b.column("text"))
            found, windows, spot, spots, candidates = [], [], [], [], set()
            for i, j in blocks(offs):
                d, o = normalised(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                for t, it, s in zip(*(x.tolist() for x in items.windows(d, o))):
                    m, e, lo, hi = int(items.length[it]), int(items.edits[it]), int(o[t]), int(o[t + 1])
                    x = max(s, lo)
                    windows.append(d[x:min(x + m, hi)].tobytes())
                    # windows next to each other share one place to verify: the text around all of them
                    if not spots or spots[-1][:2] != [i + t, it] or s - spots[-1][2] > max(1, e // 2):
                        spots.append([i + t, it, s, s, b""])
                    p = spots[-1]
                    p[3], p[4] = s, d[max(lo, p[2] - 2 * e - PIECE):min(hi, s + m + 2 * e + PIECE)].tobytes()
                    spot.append(len(spots) - 1)
            for at in range(0, len(windows), 4096):
                it = np.array([spots[p][1] for p in spot[at:at + 4096]])
                hit = items.piece[it] < PIECE
                far = np.flatnonzero(~hit)
                if len(far):
                    hit[far] = (keys([windows[at + w] for w in far.tolist()], items.length[it[far]], items.edits[it[far]]) == items.keys[it[far]]).any(1)
                candidates.update(spot[at + r] for r in np.flatnonzero(hit).tolist())
            for row, k, _, _, context in (spots[c] for c in sorted(candidates)):
                most = int(items.edits[k])
                dist = 0 if items.text[k] in context else edit_distance_inside(items.text[k], context, most)
                if dist <= most:
                    found.append((row, items.ids[k], dist))
            best: dict = {}
            for row, item_id, dist in found:
                best[row, item_id] = min(dist, best.get((row, item_id), dist))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array([r for r, _ in best], pa.int64())),
                 pa.array([r for _, r in best], pa.int64()), pa.array(list(best.values()), pa.int64()),
                 b.column("row").take(pa.array([r for r, _ in best], pa.int64()))],
                names=["doc_id", "item_id", "edits", "row"])
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 max_edit: float = MAX_EDIT) -> DataFrame:
    """(doc_id, item_id, edits, row): the items found in each document, with the fewest edits of any place.

    Items without text are found nowhere; a null text holds no item.  Items of less than 10 bytes are found unchanged.
    ``row`` is a hash of id and text.  Items are sent to the tasks in turns of ``ITEMS_AT_ONCE``, so what is sent
    is bounded however large the benchmark is.
    """
    rows = docs_of(docs, id_col, text_col).withColumn("row", F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "text"))
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where("item_id IS NOT NULL AND length(text) > 0").distinct()
    total, out, last = bench.count(), None, None
    for _ in range(max(1, -(-total // ITEMS_AT_ONCE))):
        part = bench if last is None else bench.where((F.col("item_id") > last[0]) | ((F.col("item_id") == last[0]) & (F.col("text") > last[1])))
        got = [tuple(r) for r in part.orderBy("item_id", "text").limit(ITEMS_AT_ONCE).collect()]
        last = got[-1] if got else None
        items = Items([g[0] for g in got], [g[1] for g in got], max_edit)
        found = rows.mapInArrow(lean(_scan(items)), "doc_id long, item_id long, edits long, row long")
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  max_edit: float = MAX_EDIT) -> DataFrame:
    """One row per document: doc_id, n_items, min_edits (null: none), contaminated."""
    d = docs_of(docs, id_col, text_col)
    hits = stage(contaminated(docs, benchmark, id_col, text_col, max_edit), "benchmark-hits")
    per = hits.groupBy("row").agg(F.countDistinct("item_id").alias("n_items"), F.min("edits").alias("min_edits"))
    rows = d.select("doc_id", F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "text").alias("row"))
    return rows.join(per, "row", "left").select(
        "doc_id", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), "min_edits",
        F.col("n_items").isNotNull().alias("contaminated"))
