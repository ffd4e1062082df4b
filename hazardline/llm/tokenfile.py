"""Token-id shards: independent zstandard frames with a trailing seek table.

One shard file, all integers little-endian (the public zstd seekable layout):

    frame 0 .. frame n-1        one zstd frame per document: its ids as unsigned 32-bit integers
    skippable frame 0x184D2A5D  the n document ids, signed 64-bit (id NULL: the smallest value)
    skippable frame 0x184D2A5E  the seek table: n entries (compressed size u32, raw size u32, checksum u32),
                                then n u32, descriptor u8 (0x80: checksums present), magic 0x8F92EAB1

The checksum is the low half of XXH64 of the raw ids.  A plain zstd decoder reads the whole file; a reader that
wants some documents reads the tail, then only their frames.  Shards are numbered in ascending doc_id order.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardline.llm.common import docs_of, stage
from hazardline.llm.encode import encoder
from hazardline.session import scratch_path

IDS_MAGIC, SEEK_MAGIC, TAIL_MAGIC = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1  # fixed values of the format
NO_ID = -(1 << 63)
SHARD_BYTES = 16 << 20   # a shard is closed once it holds so many compressed bytes
LEVEL = 3


def shard_bytes(docs: list[tuple[int, bytes]]) -> bytes:
    """One shard of (doc_id, raw ids) in the order given."""
    w = ShardWriter()
    for doc, raw in docs:
        w.add(doc, raw)
    return w.finish()


class ShardWriter:
    def __init__(self):
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.frames, self.table, self.ids, self.size = [], [], [], 0

    def add(self, doc: int | None, raw: bytes) -> None:
        f = self.zstd.compress(raw)
        self.frames.append(f)
        self.table.append((len(f), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.ids.append(NO_ID if doc is None else doc)
        self.size += len(f)

    def finish(self) -> bytes:
        n = len(self.frames)
        ids = np.array(self.ids, "<i8").tobytes()
        table = np.array(self.table, "<u4").reshape(n, 3).tobytes() + struct.pack("<IBI", n, 0x80, TAIL_MAGIC)
        return b"".join([*self.frames, struct.pack("<II", IDS_MAGIC, len(ids)), ids,
                         struct.pack("<II", SEEK_MAGIC, len(table)), table])


def seek_table(tail: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(doc ids, entries [compressed, raw, checksum]) from a shard's bytes or its tail."""
    n, flags, magic = struct.unpack("<IBI", tail[-9:])
    if magic != TAIL_MAGIC or flags != 0x80:
        raise ValueError("not a token shard")
    at = len(tail) - 9 - 12 * n
    if struct.unpack("<II", tail[at - 8:at]) != (SEEK_MAGIC, 12 * n + 9) or \
            struct.unpack("<II", tail[at - 16 - 8 * n:at - 8 - 8 * n]) != (IDS_MAGIC, 8 * n):
        raise ValueError("damaged seek table")
    return (np.frombuffer(tail, "<i8", n, at - 8 - 8 * n),
            np.frombuffer(tail, "<u4", 3 * n, at).reshape(n, 3))


def frame_ids(frame: bytes, raw: int, checksum: int) -> bytes:
    """The raw ids of one frame; raises if they are not those that were written."""
    out = zstandard.ZstdDecompressor().decompress(frame, max_output_size=raw) if raw else b""
    if len(out) != raw or xxhash.xxh64_intdigest(out) & 0xFFFFFFFF != checksum:
        raise ValueError("damaged frame")
    return out


def read_documents(path: str, wanted: set[int]) -> dict[int, np.ndarray]:
    """The ids of some documents of one shard; reads and decompresses only their frames."""
    fs, p = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    with fs.open_input_file(p) as f:
        size = f.size()
        f.seek(size - 9)
        n = struct.unpack("<IBI", f.read(9))[0]
        f.seek(size - (9 + 20 * n + 16))
        ids, table = seek_table(f.read(9 + 20 * n + 16))
        at = np.concatenate([[0], np.cumsum(table[:, 0].astype(np.int64))])
        out = {}
        for k in np.flatnonzero(np.isin(ids, list(wanted))):
            f.seek(int(at[k]))
            out[int(ids[k])] = np.frombuffer(frame_ids(f.read(int(table[k, 0])), int(table[k, 1]), int(table[k, 2])), "<u4")
        return out


def _write(tokenizer: str, folder: str, shard_size: int):
    def run(batches):
        from pyspark import TaskContext
        ctx, enc = TaskContext.get(), encoder(tokenizer)
        fs, base = pafs.FileSystem.from_uri(folder) if ":" in folder else (pafs.LocalFileSystem(), folder)
        fs.create_dir(base, recursive=True)
        part, attempt, shard, w = ctx.partitionId(), ctx.taskAttemptId(), 0, ShardWriter()

        def close(w, shard):
            # a retried task writes the same bytes to the same name; a reader never sees half a file
            name = f"{base}/part-{part:06d}-{shard:05d}.zst"
            with fs.open_output_stream(f"{name}.{attempt}.tmp") as f:
                f.write(w.finish())
            fs.move(f"{name}.{attempt}.tmp", name)
            return pa.RecordBatch.from_arrays([pa.array([name.rpartition("/")[2]]), pa.array([len(w.ids)], pa.int64())],
                                              names=["shard", "docs"])
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                x = b.slice(lo, 2000)
                for doc, raw in zip(x.column("doc_id").to_pylist(), enc.documents(x.column("text"))):
                    w.add(doc, raw)
                    if w.size >= shard_size:
                        yield close(w, shard)
                        w, shard = ShardWriter(), shard + 1
        if w.ids:
            yield close(w, shard)
    return run


def write_shards(docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 shard_size: int = SHARD_BYTES) -> DataFrame:
    """Write shards in ascending doc_id order under ``folder`` (shared by all executors); returns (shard, docs)."""
    d = docs_of(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.crc32("text"))
    return stage(d.mapInArrow(_write(tokenizer, folder, shard_size), "shard string, docs long"), "shards")


def _read(batches):
    for b in batches:
        for shard, content in zip(b.column("shard").to_pylist(), b.column("content")):
            content = content.as_py()
            ids, table = seek_table(content)
            at, rows = 0, []
            for size, raw, checksum in table.tolist():
                rows.append((raw // 4, zlib.crc32(frame_ids(content[at:at + size], raw, checksum))))
                at += size
            n = np.array([r[0] for r in rows], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * len(rows), pa.string()), pa.array(ids, mask=ids == NO_ID),
                 pa.array(np.cumsum(n) - n), pa.array(n), pa.array([r[1] for r in rows], pa.int64())],
                names=["shard", "doc_id", "within", "n_tokens", "ids_crc32"])


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the shards in ``folder``: doc_id, start, n_tokens, ids_crc32 (checksums verified)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zst").load(folder).select(
        F.element_at(F.split("path", "/"), -1).alias("shard"), "content")
    rows = stage(files.mapInArrow(_read, "shard string, doc_id long, within long, n_tokens long, ids_crc32 long"),
                 "shard-rows")
    # one row per shard of about 16 MB meets in the running sum
    per = rows.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = per.select("shard", F.coalesce(F.sum("n").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return rows.join(before, "shard").select("doc_id", (F.col("before") + F.col("within")).alias("start"),
                                             "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents (ids and the end id 0 each) and read them back: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before, in ascending doc_id order (null ids first; rows repeated
    with one id in order of their text's crc32).  An empty or null text is the end id alone.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-shards")
    if write_shards(docs, tokenizer, folder, id_col, text_col).limit(1).count() == 0:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_shards(spark, folder)
