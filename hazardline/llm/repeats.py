"""Remove byte strings that occur more than once, by hash grouping around content-chosen samples.

A difference cover samples positions so that any two equal suffix prefixes have samples at equal distance.  Here
the samples are chosen by content: every 200-byte string elects the 64-byte gram in it with the smallest hash.
Equal strings elect the same place, so the property holds exactly, and only one position in about 60 is sampled
(a cover of period 3 would sort two suffixes of every three bytes).  The cover's recursion on names, its sorting of
suffixes and its comparison of adjacent prefixes are replaced by grouping hashes of the bytes:

1. samples: each elected position with its *triple* - the strings it stands for (text before it), its gram, and the
   text after - is named by hash; grouping names finds which grams and which triples repeat;
2. settled grams: a gram seen once ends here; a triple seen twice settles all its strings at once;
3. remaining starts: for grams that repeat in different triples every remaining start is named by (gram, distance to its
   sample, 200 bytes from there), and starts of one name have equal prefixes;
4. starts whose prefix has an equal elsewhere are joined to maximal runs per text.

Names are 64-bit hashes of the bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import docs_of, join_counted, stage
from hazardline.llm.textnp import blocks, mix, prefix_sums, segments, utf8

LENGTH = 200       # bytes of a string
GRAM = 64          # bytes of a sampled position's own name
CHUNK = 4 << 20    # longer texts are sampled in overlapping chunks
HOT_GRAM = 5000    # a gram with more different triples is compared by a grouped count instead of inside a task


def cover(sums: np.ndarray, offs: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """The sampled positions of the texts behind ``sums`` (offsets ``offs``).

    Every string of ``length`` bytes elects the position in it whose ``gram``-byte name is smallest (the leftmost
    of equals).  Returns for each sampled position: first start of the strings that elect it, how many, the
    position, its name.
    """
    n = len(sums) - 1
    none = tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0, np.uint64),)
    if n < length:
        return none
    at = np.arange(n - gram + 1)
    h = segments(sums, at, at + gram)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    width, span = length - gram + 1, 1
    while 2 * span <= width:                    # minimum over `width` positions by doubling
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if span < width:
        key = np.minimum(key[:len(key) - (width - span)], key[width - span:])
    inside = np.zeros(n, bool)                  # starts of strings inside one text
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
        inside[a:max(a, b - length + 1)] = True
    start = np.flatnonzero(inside[:len(key)])
    if not len(start):
        return none
    best = (key[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (best[1:] != best[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    return start[first], np.diff(np.append(first, len(start))), best[first], h[best[first]]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _samples(length: int):
    """(row, text) -> (row, at, gram, triple); at packs start << 16 | (strings - 1) << 8 | distance to the sample."""
    def run(batches):
        for b in batches:
            row = b.column("row").to_numpy()
            data, offs = utf8(b.column("text"))
            for i, j in blocks(offs):
                # several texts, or one text in chunks
                for base in [0] if j - i > 1 else range(0, max(1, offs[j] - offs[i]), CHUNK):
                    o = offs[i:j + 1] if j - i > 1 else \
                        np.array([offs[i] + base, min(offs[j], offs[i] + base + CHUNK + length - 1)])
                    sums = prefix_sums(data[o[0]:o[-1]])
                    o = o - o[0]
                    s, n, a, h = cover(sums, o, length)
                    if not len(s):
                        continue
                    text = np.searchsorted(o, s, "right") - 1
                    triple = segments(sums, s, s + n + length - 1) ^ mix((a - s).astype(np.uint64))
                    at = ((s - o[text] + base) << 16) | ((n - 1) << 8) | (a - s)
                    yield pa.RecordBatch.from_arrays([pa.array(row[i + text]), pa.array(at), _signed(h), _signed(triple)],
                                                     names=["row", "at", "gram", "triple"])
    return run


def _bytes_of(length: int):
    """(row, text, wanted) -> the bytes of each wanted triple."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                raw, want = b.column("text")[i].as_py().encode(), b.column("wanted")[i].as_py()
                at = [w["at"] for w in want]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.column("row")[i].as_py()] * len(at), pa.int64()), pa.array(at, pa.int64()),
                     pa.array([w["gram"] for w in want], pa.int64()), pa.array([w["n"] for w in want], pa.int64()),
                     pa.array([w["kinds"] for w in want], pa.int64()),
                     pa.array([raw[x >> 16:(x >> 16) + (x >> 8 & 255) + length] for x in at], pa.binary())],
                    names=["row", "at", "gram", "n", "kinds", "bytes"])
    return run


def _names(b: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of all starts in the triples of a batch; the triple and the place in it of each."""
    data, offs = utf8(b.column("bytes"))
    at, gram = b.column("at").to_numpy(), b.column("gram").to_numpy().view(np.uint64)
    count = (at >> 8 & 255) + 1
    which = np.repeat(np.arange(b.num_rows), count)
    k = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    s = offs[which] + k
    distance = ((at & 255)[which] - k).astype(np.uint64)
    return segments(prefix_sums(data), s, s + length) ^ mix(gram[which] + distance * np.uint64(0x9E3779B97F4A7C15)), which, k


def _runs(b: pa.RecordBatch, which: np.ndarray, k: np.ndarray, again: np.ndarray, length: int) -> pa.RecordBatch:
    """Runs of repeated starts as (row, from, to)."""
    which, k = which[again], k[again]
    if not len(which):
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, names=["row", "lo", "hi"])
    new = np.ones(len(which), bool)
    new[1:] = (which[1:] != which[:-1]) | (k[1:] != k[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(which)) - 1
    s = b.column("at").to_numpy()[which[first]] >> 16
    return pa.RecordBatch.from_arrays(
        [pa.array(b.column("row").to_numpy()[which[first]]), pa.array(s + k[first]), pa.array(s + k[last] + length)],
        names=["row", "lo", "hi"])


def _merge(length: int):
    """Triples sorted by gram -> runs of starts whose name occurs again in the same gram."""
    def settle(t: pa.Table):
        b = t.combine_chunks().to_batches()[0]
        names, which, k = _names(b, length)
        order = np.argsort(names, kind="stable")
        same = names[order][1:] == names[order][:-1]
        again = np.zeros(len(names), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        again &= (b.column("n").to_numpy() == 1)[which]     # the others are settled already
        return _runs(b, which, k, again, length)

    def run(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            gram = t.column("gram").to_numpy()
            cut = int(np.searchsorted(gram, gram[-1])) if len(gram) else 0   # the last gram may go on
            held = t.slice(cut)
            if cut:
                yield settle(t.slice(0, cut))
        if held is not None and held.num_rows:
            yield settle(held)
    return run


def _named(length: int):
    def run(batches):
        for b in batches:
            names, which, k = _names(b, length)
            s, n = b.column("at").to_numpy() >> 16, b.column("n").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [_signed(names), pa.array(b.column("row").to_numpy()[which]), pa.array(s[which] + k), pa.array(n[which])],
                names=["name", "row", "start", "n"])
    return run


def _cut(batches):
    for b in batches:
        out = []
        for i in range(b.num_rows):
            raw, spans = b.column("text")[i].as_py().encode(), b.column("spans")[i].as_py() or []
            kept, at, removed, count, end = hashlib.sha256(), 0, 0, 0, -1
            lo = 0
            for x, y in sorted((s["lo"], s["hi"]) for s in spans):
                if x > end:           # runs that touch are one
                    if end >= 0:
                        removed += end - lo
                    kept.update(raw[at:x])
                    lo, count = x, count + 1
                end = max(end, y)
                at = max(at, end)
            if end >= 0:
                removed += end - lo
            kept.update(raw[at:])
            out.append((len(raw), removed, count, kept.hexdigest()))
        cols = list(zip(*out)) if out else [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(row, lo, hi): byte ranges, perhaps overlapping, whose union is what repeated strings cover.

    ``rows``: (row, text), ``row`` naming the text.
    """
    sampled = stage(rows.mapInArrow(_samples(length), "row long, at long, gram long, triple long"), "samples")
    grams = stage(sampled.groupBy("gram").agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1"), "grams")
    again = stage(join_counted(sampled, grams, "gram", [], "cnt", F.col("row")), "repeated-grams")
    triples = stage(again.groupBy("triple").agg(F.count(F.lit(1)).alias("n"), F.min("gram").alias("gram"),
                                                F.min(F.struct("row", "at")).alias("one")), "triples")
    settled = join_counted(again, stage(triples.where("n > 1").select("triple", "n"), "settled"), "triple", [], "n", F.col("row")) \
        .select("row", F.expr("at >> 16").alias("lo"), F.expr(f"(at >> 16) + ((at >> 8) & 255) + {length}").alias("hi"))

    kinds = stage(triples.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "kinds")
    open_ = join_counted(triples.select("gram", "n", "one.*"), kinds, "gram", ["kinds"], "kinds", F.col("row"))
    wanted = open_.groupBy("row").agg(F.collect_list(F.struct("at", "gram", "n", "kinds")).alias("wanted"))
    parts = stage(rows.join(wanted, "row").mapInArrow(
        _bytes_of(length), "row long, at long, gram long, n long, kinds long, bytes binary"), "triple-bytes")
    cold = parts.where(F.col("kinds") <= HOT_GRAM).repartition("gram").sortWithinPartitions("gram") \
        .mapInArrow(_merge(length), "row long, lo long, hi long")
    names = parts.where(F.col("kinds") > HOT_GRAM).mapInArrow(_named(length), "name long, row long, start long, n long")
    names = stage(names, "hot-names")
    common = stage(names.groupBy("name").agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1"), "common-names")
    hot = join_counted(names, common, "name", [], "cnt", F.col("row")).where("n = 1") \
        .select("row", F.col("start").alias("lo"), (F.col("start") + length).alias("hi"))
    return settled.unionByName(cold).unionByName(hot)


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Removed is each byte covered by a ``length``-byte string that also starts anywhere else in the input (in
    the same text too, overlaps included); no string crosses texts.  Texts shorter than ``length`` keep all.
    A row is named by a 64-bit hash of id and text, so null ids and ids repeated with other texts are texts of
    their own; rows repeated with id and text are copies of each other, as any copies.
    """
    d = docs_of(docs, id_col, text_col)
    rows = d.withColumn("row", F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "text"))
    spans = stage(repeated_spans(rows.select("row", "text"), length), "spans")
    per = spans.groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    return rows.join(per, "row", "left").select("doc_id", "text", "spans").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
