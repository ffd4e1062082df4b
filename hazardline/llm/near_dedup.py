"""Near-duplicate documents by HyperMinHash.

1. Each text's set of word shingles is hashed once.  One hash gives the bucket (8 bits); per bucket the smallest
   remaining value is stored compressed: its number of leading zeros and the ``MANTISSA`` bits after them.
2. Texts with the same set are one class; only its representative goes on.
3. Banding: 51 bands of 5 compressed registers (empty ones borrow a fixed other bucket's register).
4. Probing: in some bands, bucket members are compared with one pivot of their bucket, not with each other; a pair
   is dropped if its sizes allow no link, or on its collision-corrected Jaccard estimate only if that is ``SIGMAS``
   standard errors below the threshold, the others are verified on their full shingle sets.  This joins most of a group
   of near copies for a few comparisons per member.  Pivots are the smallest or the largest id of their bucket, so they
   come with its count, and those of a group are much the same in every band.
5. Settling: buckets of all bands that still hold several components are compared in full, so no link that banding
   finds is lost: buckets of up to ``SMALL`` members pair by pair as in 4, larger ones as pairs of blocks of about
   ``BLOCK`` members.  A component with many members in a bucket has blocks of its own, which meet only the blocks
   of others.  A block pair is one task's work of bounded size, whatever the size of the bucket, and gives
   exact intersections by a matrix product over the shared shingles.  Only pairs of different components count, and
   what is found links components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import docs_of, join_counted, stage, lean
from hazardline.llm.components import components
from hazardline.llm.textnp import blocks, mix, shingles, utf8, word_hashes

BUCKET_BITS, MANTISSA = 8, 10
BUCKETS = 1 << BUCKET_BITS
BANDS, ROWS = 51, 5
PROBES = ((0, 6), (6, 14))   # probed bands; the pivot is the smallest id of a bucket in the first range, the largest in the next
SIGMAS = 4.5
SMALL, BLOCK = 3, 256
_TAKE = np.random.RandomState(7).randint(0, BUCKETS, (24, BUCKETS))  # where an empty bucket borrows from


def shingle_sets(texts: pa.Array, k: int):
    """Per text, in order: its sorted distinct shingle hashes."""
    data, offs = utf8(texts)
    for i, j in blocks(offs):
        words, first = word_hashes(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        for t in range(j - i):
            yield np.unique(shingles(words[first[t]:first[t + 1]], k))


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash registers [texts, BUCKETS], 0 where a bucket is empty."""
    out = np.zeros((len(sets), BUCKETS), np.uint16)
    size = np.array([len(s) for s in sets], np.int64)
    if not size.sum():
        return out
    text, u = np.repeat(np.arange(len(sets)), size), np.concatenate(sets)
    bucket = (u >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.ones(len(u), bool)
    first[1:] = (bucket[1:] != bucket[:-1]) | (text[1:] != text[:-1])   # sets are sorted: the smallest of a bucket
    text, bucket = text[first], bucket[first]
    v = u[first] & np.uint64((1 << (64 - BUCKET_BITS)) - 1)
    bits = np.frexp(v.astype(np.float64))[1].astype(np.int64)           # bit length
    zeros = 64 - BUCKET_BITS - bits
    shift = bits - 1 - MANTISSA
    top = np.where(shift >= 0, v >> np.maximum(shift, 0).astype(np.uint64), v << np.maximum(-shift, 0).astype(np.uint64))
    out[text, bucket] = (((zeros + 1) << MANTISSA) | (top.astype(np.int64) & ((1 << MANTISSA) - 1))).astype(np.uint16)
    return out


def band_keys(reg: np.ndarray) -> np.ndarray:
    """Keys [texts, BANDS] of sketches without all-empty rows."""
    d = reg.copy()
    rows, cols = np.nonzero(d == 0)
    for take in _TAKE:
        if not len(rows):
            break
        d[rows, cols] = reg[rows, take[cols]]
        left = d[rows, cols] == 0
        rows, cols = rows[left], cols[left]
    step = 1
    while len(rows) and step < BUCKETS:      # the next bucket that has something
        d[rows, cols] = reg[rows, (cols + step) % BUCKETS]
        left = d[rows, cols] == 0
        rows, cols, step = rows[left], cols[left], step + 1
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(reg), 1))
    for r in range(ROWS):
        key = mix(key + d[:, r:BANDS * ROWS:ROWS].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return key.view(np.int64)


def jaccard_estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected estimate and its standard error from registers [pairs, BUCKETS] and set sizes."""
    used = ((a > 0) | (b > 0)).sum(1)
    same = ((a == b) & (a > 0)).sum(1)
    # Two registers of unrelated minima agree when both zeros and mantissa do: about 2**-MANTISSA / 3 if the
    # sets are equally large, less otherwise.
    chance = 2.0 ** -MANTISSA / 3 * np.minimum(n, m) / np.maximum(np.maximum(n, m), 1)
    j = np.clip((same - used * chance) / np.maximum(used * (1 - chance), 1), 0, 1)
    return j, np.sqrt(np.maximum(j * (1 - j), 0.04) / np.maximum(used, 1))


def _sketch(k: int):
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                x = b.slice(lo, 1000)
                sets = list(shingle_sets(x.column("text"), k))
                reg = sketches(sets)
                full = np.array([len(s) > 0 for s in sets], bool)
                keys = np.zeros((len(sets), BANDS), np.int64)
                if full.any():
                    keys[full] = band_keys(reg[full])
                with np.errstate(over="ignore"):
                    hi = [int(mix(np.array([np.sum(mix(s ^ np.uint64(11)), dtype=np.uint64)]))[0]) for s in sets]
                    lo_ = [int(np.sum(mix(s * np.uint64(5) + np.uint64(len(s))), dtype=np.uint64)) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [x.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([h.to_bytes(8, "big") + l.to_bytes(8, "big") for h, l in zip(hi, lo_)], pa.binary()),
                     pa.array([r.tobytes() for r in reg], pa.binary()),
                     pa.array([list(r) if f else [] for r, f in zip(keys.tolist(), full)], pa.list_(pa.int64()))],
                    names=["doc_id", "n", "set_hash", "sketch", "bands"])
    return run


def _estimate(num: int, den: int):
    """Pairs whose sizes allow a link and whose estimate is not clearly below the threshold."""
    def run(batches):
        for b in batches:
            reg = [np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in ("sketch", "pivot_sketch")]
            n, m = b.column("n").to_numpy(), b.column("pivot_n").to_numpy()
            j, err = jaccard_estimate(*reg, n, m)
            go = pa.array(np.flatnonzero((j + SIGMAS * err >= num / den) & (den * np.minimum(n, m) >= num * np.maximum(n, m))))
            yield pa.RecordBatch.from_arrays([b.column("pivot").take(go), b.column("id").take(go)], names=["pivot", "id"])
    return run


def _verify(k: int, num: int, den: int):
    """Links among pairs with both texts, on the full sets."""
    def run(batches):
        known: tuple = (None, None)
        for b in batches:
            link = np.zeros(b.num_rows, bool)
            ids, pivots = b.column("pivot").to_pylist(), b.column("pivot_text")
            for i, s in enumerate(shingle_sets(b.column("text"), k)):
                if known[0] != ids[i]:
                    known = (ids[i], next(shingle_sets(pivots.slice(i, 1), k)))
                p = known[1]
                both = len(np.intersect1d(s, p, assume_unique=True))
                link[i] = den * both >= num * (len(s) + len(p) - both)
            go = pa.array(np.flatnonzero(link))
            yield pa.RecordBatch.from_arrays([b.column("pivot").take(go), b.column("id").take(go)], names=["a", "b"])
    return run


def block_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, comp: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of different components between the rows ``left`` and ``right`` of some sets."""
    size = np.array([len(x) for x in sets], np.int64)
    u, at = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), size)
    keep = np.bincount(at)[at] > 1                        # a shingle of one set is in no intersection
    at, row = np.unique(at[keep], return_inverse=True)[1], row[keep]
    both = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    width = 8192
    for lo in range(0, int(at[-1]) + 1 if len(at) else 0, width):
        x, y = np.searchsorted(at, [lo, lo + width])
        m = np.zeros((len(sets), width), np.float32)
        m[row[x:y], at[x:y] - lo] = 1
        both += m[left] @ m[right].T
    i = both.astype(np.int64)
    total = size[left][:, None] + size[right][None, :] - i
    return np.nonzero((den * i >= num * total) & (comp[left][:, None] != comp[right][None, :]))


def _settle(k: int, num: int, den: int):
    """Rows (key, i, j, own, id, c, text) sorted by (key, i, j): linked components between blocks i and j of a bucket."""
    def settle(t: pa.Table):
        own, i, j = (t.column(c).to_numpy() for c in ("own", "i", "j"))
        left, right = np.flatnonzero(own == i[0]), np.flatnonzero(own == j[0])
        if not len(left) or not len(right):
            return None
        comp = t.column("c").to_numpy()
        if (comp == comp[0]).all():
            return None
        a, b = block_links(list(shingle_sets(t.column("text"), k)), left, right, comp, num, den)
        a, b = comp[left[a]], comp[right[b]]
        return np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)

    def run(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            g = np.stack([t.column(c).to_numpy() for c in ("key", "i", "j")], 1)
            cut = np.concatenate([[0], np.flatnonzero((g[1:] != g[:-1]).any(1)) + 1])
            for x, y in zip(cut[:-1].tolist(), cut[1:].tolist()):
                yield settle(t.slice(x, y - x))
            held = t.slice(int(cut[-1]))
        if held is not None and held.num_rows:
            yield settle(held)

    def out(batches):
        for r in run(batches):
            if r is not None and len(r):
                yield pa.RecordBatch.from_arrays([pa.array(r[:, 0]), pa.array(r[:, 1])], names=["a", "b"])
    return out


def near_dedup(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable over links), kept.

    Two documents are linked if ``den * |intersection| >= num * |union|`` of their sets of ``k``-word shingles
    (ASCII case folded; fewer than k words: the whole sequence is one shingle).  A document without words has an
    empty set and is linked with nothing.  A row with a null id cannot be named by a link: its component is null
    and it is kept.  Rows repeated with one id and text get the same answer.
    """
    d = docs_of(docs, id_col, text_col)
    sk = stage(d.mapInArrow(lean(_sketch(k)), "doc_id long, n long, set_hash binary, sketch binary, bands array<long>"), "sketches")
    named = sk.where("n > 0 AND doc_id IS NOT NULL")
    classes = stage(named.groupBy("set_hash").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    reps = sk.join(classes.select(F.col("rep").alias("doc_id"), "set_hash"), ["doc_id", "set_hash"]) \
        .dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("id"), "n", "sketch", "bands")
    banded = stage(reps, "class-sketches")

    rows = banded.select("id", "n", F.posexplode("bands").alias("band", "key"))
    buckets = stage(rows.groupBy("key").agg(F.count(F.lit(1)).alias("cnt"), F.min("id").alias("low"), F.max("id").alias("high"))
                    .where("cnt > 1"), "buckets")
    pivot = F.lit(None).cast("long")
    for i, (lo, hi) in enumerate(PROBES):
        pivot = F.when((F.col("band") >= lo) & (F.col("band") < hi), F.col("high" if i % 2 else "low")).otherwise(pivot)
    members = stage(join_counted(rows, buckets, "key", ["low", "high"], "cnt", F.col("id"))
                    .select("key", "id", "n", pivot.alias("pivot")), "members")
    ids = stage(members.select("id").distinct(), "member-ids")     # stored, so that its size is known to the join
    d = stage(d.join(ids.withColumnRenamed("id", "doc_id"), "doc_id").dropDuplicates(["doc_id"]), "member-texts")
    done = stage(members.where("pivot <> id").select(F.least("id", "pivot").alias("pivot"), F.greatest("id", "pivot").alias("id"))
                 .distinct(), "pairs")
    comp = stage(components(_verified(done, d, banded, k, num, den)), "components")

    here, sizes = _open_buckets(members, comp)
    pairs = _small_pairs(here.where(F.col("cnt") <= SMALL), done, num, den)
    links = _verified(pairs, d, banded, k, num, den)
    for end in ("a", "b"):
        links = links.join(comp.toDF(end, "c"), end, "left").withColumn(end, F.coalesce("c", end)).drop("c")
    links = links.select("a", "b")
    many = stage(_block_pairs(*(x.where(F.col("cnt") > SMALL) for x in (here, sizes))), "block-pairs")
    ids = many.select(F.col("id").alias("doc_id")).distinct()
    texts = stage(d.join(stage(ids, "block-ids"), "doc_id").withColumnRenamed("doc_id", "id"), "block-texts")
    many = many.join(texts, "id").select("key", "i", "j", "own", "id", "c", "text") \
        .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(lean(_settle(k, num, den)), "a long, b long")
    joined = stage(components(stage(links.union(many), "component-links")), "joined-components")

    of_class = classes.join(comp.toDF("rep", "c"), "rep", "left").withColumn("c", F.coalesce("c", "rep")) \
        .join(joined.withColumnRenamed("id", "c"), "c", "left") \
        .select("set_hash", "copies", F.coalesce("component", "c").alias("component"))
    of_class = stage(of_class, "class-components")
    linked = join_counted(named.select("doc_id", "n", "set_hash"), of_class, "set_hash", ["component"], "copies", F.col("doc_id"))
    alone = sk.where("n = 0 OR doc_id IS NULL").select("doc_id", "n", "set_hash", F.col("doc_id").alias("component"))
    return linked.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"))


def _open_buckets(members: DataFrame, comp: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the buckets that hold several components ``c``, with their counts ``cnt``: members (key, id, n, c, size, cnt) and
    components (of, key, c, size, cnt), ``size`` of them in the bucket."""
    here = stage(members.select("key", "id", "n").join(comp.withColumnRenamed("component", "c"), "id", "left")
                 .withColumn("c", F.coalesce("c", "id")), "with-components")
    sizes = stage(here.groupBy("key", "c").agg(F.count(F.lit(1)).alias("size")), "bucket-components")
    open_ = stage(sizes.groupBy("key").agg(F.sum("size").alias("cnt"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
                  .select("key", "cnt"), "open-buckets")
    of = F.struct("key", "c").alias("of")
    # a bucket may have very many components; both sides are plain shuffles, which Spark splits when skewed
    sizes = stage(sizes.join(open_, "key").select(of, "key", "c", "size", "cnt"), "open-components")
    here = join_counted(here.select(of, "key", "id", "n", "c"), sizes, "of", ["size", "cnt"], "size", F.col("id"))
    return stage(here.drop("of"), "open-members"), sizes


def _small_pairs(rows: DataFrame, done: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct pairs (pivot, id) of members (key, id, n, c) of one bucket of at most SMALL members, of different
    components and of sizes that allow a link, but for the pairs compared before (``done``)."""
    mates = rows.groupBy("key").agg(F.collect_list(F.struct("id", "n", "c")).alias("ps"))
    pairs = mates.select("ps", F.explode("ps").alias("p")).select("p", F.explode("ps").alias("q")) \
        .where((F.col("p.id") < F.col("q.id")) & (F.col("p.c") != F.col("q.c"))
               & (F.lit(den) * F.least("p.n", "q.n") >= F.lit(num) * F.greatest("p.n", "q.n"))) \
        .select(F.col("p.id").alias("pivot"), F.col("q.id").alias("id"), F.lit(False).alias("seen"))
    pairs = pairs.union(done.select("pivot", "id", F.lit(True)))
    return stage(pairs.groupBy("pivot", "id").agg(F.max("seen").alias("seen")).where("NOT seen").select("pivot", "id"), "pairs")


def _block_pairs(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """(key, i, j, own, id, c): the members (key, id, c, size) of a bucket in blocks ``own``, once per block pair (i, j) of theirs.

    A component with at least BLOCK / 2 members in a bucket is a unit of its own; the others of the bucket are one
    unit.  Units are dealt to blocks by hash.  Blocks of one component need no comparison, so no pair is made of them.
    """
    unit = F.struct("key", F.when(F.col("size") * 2 >= BLOCK, F.col("c")).alias("c")).alias("unit")
    rows = rows.select("key", "id", "c", unit)
    units = sizes.select(unit, "size").groupBy("unit").agg(F.sum("size").alias("cnt"))
    units = stage(units.select("unit", "cnt", F.ceil(F.col("cnt") / BLOCK).cast("int").alias("blocks")), "units")
    # members of a component share a block, unless the component is a unit
    spread = F.pmod(F.when(F.col("unit.c").isNull(), F.xxhash64("c")).otherwise(F.xxhash64("id")), F.col("blocks"))
    rows = join_counted(rows, units, "unit", ["blocks"], "cnt", F.col("id")) \
        .select("key", "id", "c", F.xxhash64("unit.c", spread.cast("int")).alias("own"))

    left = units.select(F.col("unit.key").alias("key"), F.col("unit.c").alias("x"), F.col("blocks").alias("nx"))
    right = left.select("key", F.col("x").alias("y"), F.col("nx").alias("ny"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    pairs = left.join(right, "key").where("x < y OR x IS NULL") \
        .withColumn("a", every("nx")).withColumn("b", every("ny")).where("x IS NOT NULL OR y IS NOT NULL OR a <= b") \
        .select("key", F.xxhash64("x", "a").alias("i"), F.xxhash64("y", "b").alias("j"))
    sides = pairs.select("key", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("own"))
    return rows.join(sides, ["key", "own"]).select("key", "i", "j", "own", "id", "c")


def _verified(pairs: DataFrame, d: DataFrame, banded: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Links (a, b) among pairs (pivot, id): first by their sketches, then by their texts in ``d`` (one row per id).

    A pivot may have very many partners; both sides of each join are plain shuffles, which Spark splits when skewed.
    """
    def both_sides(pairs, side):
        right = side.select([F.col(c).alias("pivot" if c == "id" else f"pivot_{c}") for c in side.columns])
        return pairs.join(side, "id").join(right, "pivot")

    ids = pairs.select("id").union(pairs.select("pivot")).distinct()
    known = stage(banded.join(ids, "id", "left_semi").select("id", "n", "sketch"), "pair-sketches")
    likely = both_sides(pairs, known).select("pivot", "id", "n", "pivot_n", "sketch", "pivot_sketch")
    likely = stage(likely.mapInArrow(lean(_estimate(num, den)), "pivot long, id long"), "likely")
    ids = likely.select("id").union(likely.select("pivot")).distinct()
    texts = stage(d.join(stage(ids.withColumnRenamed("id", "doc_id"), "pair-ids"), "doc_id")
                  .withColumnRenamed("doc_id", "id"), "pair-texts")
    return stage(both_sides(likely, texts).select("pivot", "id", "text", "pivot_text")
                 .mapInArrow(lean(_verify(k, num, den)), "a long, b long"), "verified")
