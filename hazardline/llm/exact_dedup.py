"""Exact duplicates by two-pass Bloom filtering (built-in functions only).

Pass 1 sets ``K`` bits per text hash and keeps the bits that were hit more than once (counted with
map-side combine, then packed into 4 KB bitmaps).  Pass 2 tests each row: a hash can be a repeated one only
if all its bits were hit twice.  Only such rows are shuffled and grouped; all others are known to be
unique and pass straight through.  False positives are grouped like the rest and come out as groups
of one, so the result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import docs_of, join_counted, stage

K = 2                      # bits per hash
BITS_PER_ROW = 32          # filter size: false positives about (K / BITS_PER_ROW) ** K = 0.4 %
BROADCAST_BYTES = 64 << 20  # a larger filter is joined by shuffling (hash, bit) instead
_BUCKET = 4096 * 8         # bits of one bitmap of bitmap_construct_agg


def _positions(bits: int) -> Column:
    """The K bit numbers of a text hash, two independent hashes of its digest."""
    return F.array(*[F.pmod(F.xxhash64(F.col("sha"), F.lit(i)), F.lit(bits)) for i in range(K)])


def _bit_is_set(bitmap: str, pos: str) -> Column:
    at = F.col(pos) % _BUCKET
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1


def repeated_bits(hashes: DataFrame, bits: int) -> DataFrame:
    """(bucket, bitmap) of the bits that more than one row has hit."""
    hit = hashes.select(F.explode(_positions(bits)).alias("pos")).groupBy("pos").count().where("count > 1")
    return hit.groupBy((F.col("pos") / _BUCKET).cast("long").alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("pos") % _BUCKET).alias("bitmap"))


def possibly_repeated(hashes: DataFrame, bits: int, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``hashes`` with ``maybe``: whether all bits of the row's hash were hit more than once."""
    out = hashes.withColumn("_pos", _positions(bits)).withColumn("maybe", F.lit(True))
    filt = stage(repeated_bits(hashes, bits), "bloom")
    for i in range(K):
        side = filt.select(F.col("bucket").alias("_b"), F.col("bitmap").alias("_m"))
        if bits // 8 <= broadcast_bytes:  # the filter's size is fixed by `bits`
            side = F.broadcast(side)
        out = out.withColumn("_p", F.col("_pos")[i])
        out = out.join(side, (F.col("_p") / _BUCKET).cast("long") == F.col("_b"), "left")
        out = out.withColumn("maybe", F.col("maybe") & F.coalesce(_bit_is_set("_m", "_p"), F.lit(False))) \
            .drop("_b", "_m", "_p")
    return out.drop("_pos")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bits_per_row: int = BITS_PER_ROW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical (null counts as empty); equality is that of their SHA-256.  The row with
    the largest id stays.  Rows repeated with the same id and text count in ``group_size`` and are all
    ``kept`` if their id is.  A null id is smaller than any other: it is kept only if its whole group has null ids.
    """
    hashes = stage(docs_of(docs, id_col, text_col).select(
        "doc_id", F.unhex(F.sha2(F.col("text"), 256)).alias("sha")), "text-hashes")
    n = hashes.count()
    bits = 1 << max(20, (max(n, 1) * bits_per_row - 1).bit_length())
    tested = stage(possibly_repeated(hashes, bits, broadcast_bytes), "tested")
    unique = tested.where("NOT maybe").select("doc_id", "sha", F.col("doc_id").alias("keep_id"),
                                              F.lit(1).cast("long").alias("group_size"))
    again = tested.where("maybe").select("doc_id", "sha")
    groups = stage(again.groupBy("sha").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")),
                   "groups")
    grouped = join_counted(again, groups, "sha", ["keep_id", "group_size"], "group_size", F.col("doc_id"))
    return unique.unionByName(grouped).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
