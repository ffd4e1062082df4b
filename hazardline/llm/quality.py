"""Quality by compression: which of two zstandard dictionaries, of good or of bad text, shrinks a text more."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import docs_of, lean
from hazardline.llm.textnp import utf8

#: Labelled rows used, per label: for the dictionaries and, other rows, for the calibration.  Rows are taken in
#: order of a hash of their id, so the sample does not depend on how the table is stored.
DICT_ROWS, CALIBRATION_ROWS = 1500, 3000
DICT_BYTES = 96 << 10
LEVEL = 3
THRESHOLD = 0.3


def _features(dicts: dict[str, bytes]):
    """Arrow batches (doc_id, text, ...) -> the columns without text, and the three sizes by the text's bytes."""
    def compressors():
        return [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dicts[k])) if k else
                zstandard.ZstdCompressor(level=LEVEL) for k in ("good", "bad", "")]
    def run(batches):
        cs = compressors()
        for b in batches:
            data, offs = utf8(b.column("text"))
            raw, o = data.tobytes(), offs.tolist()
            sizes = np.array([[len(c.compress(raw[o[i]:o[i + 1]])) for c in cs] for i in range(b.num_rows)],
                             np.float64).reshape(-1, 3)
            yield b, features(sizes, np.diff(offs))
    return run


def features(sizes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """[difference of the compressed sizes over their sum, size by the good dictionary over the bytes,
    plain size over the bytes, log of the bytes]"""
    good, bad, plain = sizes[:, 0], sizes[:, 1], sizes[:, 2]
    m = np.maximum(n, 1)
    return np.stack([(bad - good) / np.maximum(bad + good, 1), np.minimum(good / m, 2), np.minimum(plain / m, 2),
                     np.log1p(n) / 10], 1)


def _basis(x: np.ndarray) -> np.ndarray:
    """The difference and its products with the other features."""
    d = x[:, :1]
    return np.concatenate([np.ones_like(d), d, x[:, 1:], d * x[:, 1:], x[:, 1:2] * x[:, 2:]], 1)


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> dict:
    """Logistic calibration by Newton's method."""
    z = _basis(x)
    mean, sd = z.mean(0), z.std(0) + 1e-9
    mean[0], sd[0] = 0, 1
    z = (z - mean) / sd
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (p - y) + ridge * w
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return {"w": w, "mean": mean, "sd": sd}


def score(model: dict, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip((_basis(x) - model["mean"]) / model["sd"] @ model["w"], -30, 30)))


def held_out(doc_id) -> "F.Column":
    """Whether a row is kept from training: crc32 of its id as text divides by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        dict_rows: int = DICT_ROWS, calibration_rows: int = CALIBRATION_ROWS) -> dict | None:
    """Dictionaries and calibration from labelled rows that are not held out (None: a label has too few rows).

    Ids labelled both ways, null ids and null labels are not used.
    """
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")) \
        .where("doc_id IS NOT NULL AND y IN (0, 1)").groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("y2")) \
        .where("y = y2").where(~held_out("doc_id")).select("doc_id", "y")
    take = dict_rows + calibration_rows
    picked = []
    for y in (0, 1):  # at most `take` ids each
        picked += [(r[0], y, k) for k, r in enumerate(
            lab.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(take).collect())]
    counts = np.bincount([y for _, y, _ in picked], minlength=2) if picked else [0, 0]
    if min(counts) < 4:
        return None
    # the first third of a small class, else dict_rows, go to the dictionary
    cut = [min(dict_rows, int(c) // 3 + 1) for c in counts]
    spark = docs.sparkSession
    side = spark.createDataFrame([(d, y, k < cut[y]) for d, y, k in picked], "doc_id long, y int, to_dict boolean")
    rows = docs_of(docs, id_col, text_col).join(F.broadcast(side), "doc_id").dropDuplicates(["doc_id"])
    texts = rows.where("to_dict").select("y", "text").orderBy(F.xxhash64("text"))
    dicts = {}
    got = [(r[0], r[1].encode()) for r in texts.collect()]
    for y, name in ((0, "bad"), (1, "good")):
        dicts[name] = dictionary([t for label, t in got if label == y])
    run = _features(dicts)

    def measured(batches):
        for b, x in run(batches):
            yield pa.RecordBatch.from_arrays([b.column("y"), *[pa.array(x[:, i]) for i in range(x.shape[1])]],
                                             names=["y", "f0", "f1", "f2", "f3"])
    xy = np.array([tuple(r) for r in rows.where("NOT to_dict").select("y", "text").mapInArrow(
        lean(measured), "y int, f0 double, f1 double, f2 double, f3 double").collect()], np.float64).reshape(-1, 5)
    if len(np.unique(xy[:, 0])) < 2:
        return None
    # the classes were sampled to equal numbers: weigh the score back to their true odds
    total = {r[0]: r[1] for r in lab.groupBy("y").count().collect()}
    model = calibrate(xy[:, 1:], xy[:, 0])
    n1 = xy[:, 0].sum()
    model["w"][0] += np.log(total[1] / total[0]) - np.log(n1 / (len(xy) - n1))
    return {"dicts": dicts, **model}


def dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A trained dictionary; of too little text, the text itself (a raw-content dictionary)."""
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return (b"\n".join(samples)[-size:]) or b"\n"


def quality_scores(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (score >= threshold).

    Null and empty texts are scored like any other text of no bytes.  Without a model (fewer than four labelled
    rows of a kind) every score is 0.5.  A null id counts as held out.
    """
    run = _features(model["dicts"]) if model else None

    def scored(batches):
        if run is None:
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.full(b.num_rows, 0.5))],
                                                 names=["doc_id", "score"])
            return
        for b, x in run(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score(model, x))], names=["doc_id", "score"])
    out = docs_of(docs, id_col, text_col).mapInArrow(lean(scored), "doc_id long, score double")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_rejected(docs: DataFrame, model: dict | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns, scored as in :func:`quality_scores`
    where they are: no join, no shuffle.  Without a model all rows stay."""
    if model is None:
        return docs
    run = _features(model["dicts"])

    def kept(batches):
        for b in batches:
            text = b.column(text_col).cast(pa.string())
            for _, x in run([pa.RecordBatch.from_arrays([text], names=["text"])]):
                yield b.filter(pa.array(score(model, x) >= threshold))
    return docs.mapInArrow(lean(kept), docs.schema)
