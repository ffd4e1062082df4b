"""Best-fit packing planned on a length histogram.

1. Tokenise, cut into pieces, give every piece its rank among the pieces of its length (a counter inside
   the task; the tasks' counts are then summed, so no length, however common, is ranked in one place).
2. Best-fit decreasing over the histogram: bins with the same free space are one class with a count, and a
   length's pieces are placed class by class.  The work depends on the capacity, not on the corpus.
3. Pieces take the planned slots by joining on (length, rank).
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import docs_of, stage, lean
from hazardline.llm.encode import encoder

CAPACITY = 2048


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows (length, first rank, pieces, first sequence, pieces per sequence, offset).

    Slot of rank r in a row: sequence ``first + (r - lo) // per``, offset ``offset + ((r - lo) % per) * length``.
    Every class of bins is a run of sequence numbers with equal fill; a length either uses a class whole or
    splits it, so there are at most three new classes per length.
    """
    rows, free, space, made = [], {}, [], 0  # free: space -> [(first sequence, count)]; space: its keys, sorted
    def add(rem, first, n):
        if n and rem:
            if rem not in free:
                bisect.insort(space, rem)
                free[rem] = []
            free[rem].append((first, n))
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(space, length)
            if at < len(space):
                rem = space[at]
                first, n = free[rem].pop()
                if not free[rem]:
                    del free[rem]
                    space.pop(at)
            else:
                rem = capacity
                n = -(-left // (capacity // length))
                first, made = made, made + n
            per = min(rem // length, left)
            used = min(n, left // per)
            rows.append((length, rank, used * per, first, per, capacity - rem))
            add(rem - per * length, first, used)
            add(rem, first + used, n - used)
            rank, left = rank + used * per, left - used * per
    return rows


def _pieces(tokenizer: str, capacity: int):
    def run(batches):
        from pyspark import TaskContext
        task, enc, seen = TaskContext.get().partitionId(), encoder(tokenizer), np.zeros(capacity + 1, np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000)
                cols = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "rank")}
                for doc, ids in zip(part.column("doc_id").to_pylist(), enc.documents(part.column("text"))):
                    for at in range(0, len(ids), 4 * capacity):
                        x = ids[at:at + 4 * capacity]
                        n = len(x) // 4
                        for k, v in zip(cols, (doc, at // (4 * capacity), at // 4, n, zlib.crc32(x), int(seen[n]))):
                            cols[k].append(v)
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols["doc_id"], pa.int64()), pa.array(cols["piece"], pa.int32()),
                     pa.array(cols["start"], pa.int64()), pa.array(cols["length"], pa.int64()),
                     pa.array(cols["ids_crc32"], pa.int64()), pa.array([task] * len(cols["rank"]), pa.int32()),
                     pa.array(cols["rank"], pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"])
    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and the end id 0, so an empty or null text is one piece of length 1.  Only
    documents over ``capacity`` are cut.  Rows repeated with the same id are packed each on their own.
    """
    pieces = stage(docs_of(docs, id_col, text_col).mapInArrow(
        lean(_pieces(tokenizer, capacity)),
        "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"), "pieces")
    counts = stage(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "length-counts")
    # at most `capacity` rows come to the driver, whatever the corpus
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    from pyspark.sql import Window
    w = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["length", "task"]).withColumn("rank", F.col("rank") + F.col("before"))

    slots: dict[int, list] = {}
    for length, lo, _, first, per, off in plan(histogram, capacity):
        slots.setdefault(length, []).append((lo, first, per, off))
    slots = {k: np.array(v, np.int64) for k, v in slots.items()}

    def place(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for run in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(run):
                    n = int(length[run[0]])
                    row = slots[n][np.searchsorted(slots[n][:, 0], rank[run], "right") - 1]
                    k = rank[run] - row[:, 0]
                    seq[run], off[run] = row[:, 1] + k // row[:, 2], row[:, 3] + k % row[:, 2] * n
            cols = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seq), pa.array(off)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32",
                                                    "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        lean(place), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
