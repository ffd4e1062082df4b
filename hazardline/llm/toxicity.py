"""Toxicity (op 12): two Kneser-Ney models, of toxic and of ordinary text, over the bytes of each word.

A word is spelled out from the space before it to the space after it; each byte is predicted from up to ORDER - 1 bytes
before it, not beyond the word.  The longest context has counts of its own class; below it both classes share one
chain of continuation counts (in how many different places a shorter gram stands), so that a rare expression is judged
by what all text says about its parts and only frequent ones can tell the classes apart:

    P_c(x | h)  = (max(n_c(hx) - D, 0) + D * kinds_c(h) * P(x | h')) / n_c(h)       P(x | h') where n_c(h) = 0
    P(x | h)    = (max(m(hx) - D, 0)   + D * kinds(h)   * P(x | h')) / m(h)         P(x | h') where m(h) = 0

with h' = h without its first byte, m = number of different bytes before a gram, and 1/256 below the single byte.

Counts are over all labelled texts that take part, added up by Spark.  A gram of at most seven bytes is a number, so the
distinct grams are exact.  For scoring they are laid in tables of 2^BITS slots, a fixed size whatever the corpus holds;
grams that fall in one slot add up.  A document is scored by its log-likelihoods divided by its length: over the whole
text and in the window of WINDOW words where the toxic model gains most, so that a short insult in a long text is
not averaged away.  A logistic fit on rows that were not counted turns these into a probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import docs_of, stage
from hazardline.llm.quality import held_out

ORDER = 6
DISCOUNT = 0.75
BITS = 20
WINDOW = 24
#: A word's gain up to so many nats is taken for chance in the clear gains, so that a common word said often does not add up.
CLEAR = 1.5
FEATURES = 4
THRESHOLD = 0.5
#: Of the rows to learn from, those with this remainder of crc32(id) by 5 are not counted but calibrate the score: at most
#: CALIBRATION_ROWS of each label, in order of a hash of their id.
CALIBRATION_FOLD, CALIBRATION_ROWS = 1, 6000
#: Words whose log-likelihoods a task remembers.
WORDS_KEPT = 400_000

_LOW = (1 << 56) - 1
#: ASCII letters in lower case; every other ASCII byte but digits and the apostrophe parts words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 or b == 39 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(gram of up to ORDER bytes that ends at each byte after a word's first space, first gram of each word)."""
    raw = b"".join(b" %b " % w for w in words)
    data = np.frombuffer(raw, np.uint8).astype(np.int64)
    n = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    starts = np.cumsum(n) - n
    left = np.arange(len(data)) - np.repeat(starts, n)      # bytes of the word before this one
    g, size = data.copy(), np.ones(len(data), np.int64)
    for j in range(1, ORDER):
        ok = left[j:] >= j
        g[j:] += np.where(ok, data[:-j] << (8 * j), 0)
        size[j:] += ok
    keep = left > 0
    return (g + (size << 56))[keep], np.cumsum(n - 1) - (n - 1)


def context(g):
    """A gram without its last byte (numbers or columns)."""
    if isinstance(g, np.ndarray):
        return ((g & _LOW) >> 8) + (((g >> 56) - 1) << 56)
    return F.shiftright(g.bitwiseAND(F.lit(_LOW)), 8) + F.shiftleft(F.shiftright(g, 56) - 1, 56)


def last_bytes(g, m: int):
    """The last ``m`` bytes of a gram."""
    if isinstance(g, np.ndarray):
        return (g & ((1 << (8 * m)) - 1)) + (m << 56)
    return g.bitwiseAND(F.lit((1 << (8 * m)) - 1)) + F.lit(m << 56)


def slot(g, bits: int = BITS):
    """The slot of a gram: the same mixing in numpy and in Spark (31-bit products, which neither side can overflow)."""
    def step(hi, lo):
        return (hi * 40503 + lo * 69069 + 12345)
    if isinstance(g, np.ndarray):
        a, b, c = g >> 42, (g >> 21) & 0x1FFFFF, g & 0x1FFFFF
        x = step(step(a, b) & 0x7FFFFFFF, c) & 0x7FFFFFFF
        x = ((x ^ (x >> 15)) * 1103515245) & 0x7FFFFFFFFFFF
        return ((x ^ (x >> 19)) >> 3) & ((1 << bits) - 1)
    a, b, c = F.shiftright(g, 42), F.shiftright(g, 21).bitwiseAND(0x1FFFFF), g.bitwiseAND(0x1FFFFF)
    x = step(step(a, b).bitwiseAND(0x7FFFFFFF), c).bitwiseAND(0x7FFFFFFF)
    x = (x.bitwiseXOR(F.shiftright(x, 15)) * 1103515245).bitwiseAND(F.lit(0x7FFFFFFFFFFF))
    return F.shiftright(x.bitwiseXOR(F.shiftright(x, 19)), 3).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def learners(labels: DataFrame, label: str = "toxic") -> DataFrame:
    """(doc_id, y, calibrates) of the labelled ids to learn from; null and contradictory ones are not used."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")) \
        .where("doc_id IS NOT NULL AND y IN (0, 1)").groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("y2")) \
        .where("y = y2").where(~held_out("doc_id")).select("doc_id", "y", (fold == CALIBRATION_FOLD).alias("calibrates"))


def gram_counts(rows: DataFrame) -> DataFrame:
    """(gram, t, o): how often each gram stands in toxic and in ordinary texts, from rows (y, text)."""
    def of(batches):
        held: list[np.ndarray] = []
        size = 0

        def flush():
            g, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            t = (g & 1).astype(bool)
            return pa.RecordBatch.from_arrays([pa.array(g >> 1), pa.array(np.where(t, n, 0)), pa.array(np.where(t, 0, n))],
                                              names=["gram", "t", "o"])
        for b in batches:
            for y, text in zip(b.column("y").to_pylist(), b.column("text").to_pylist()):
                words = words_of(text.encode())
                for i in range(0, len(words), 1 << 16):
                    g = (grams(words[i:i + (1 << 16)])[0] << 1) + y
                    held.append(g)
                    size += len(g)
                    if size > 4_000_000:
                        yield flush()
                        size = 0
        if held:
            yield flush()
    return rows.select("y", "text").mapInArrow(of, "gram long, t long, o long").groupBy("gram").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def slot_tables(counts: DataFrame, bits: int = BITS) -> dict[str, np.ndarray]:
    """The tables of a model from a stored table of distinct grams: all sums are Spark's; at most 2^bits rows of each
    of the four tables come to the driver."""
    g = F.col("gram")
    own = counts.groupBy(slot(g, bits).alias("k")).agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    ctx = counts.groupBy(context(g).alias("c")).agg(F.sum("t").alias("t"), F.sum("o").alias("o"), F.count_if(F.col("t") > 0).alias("kt"),
                                                    F.count_if(F.col("o") > 0).alias("ko")) \
        .groupBy(slot(F.col("c"), bits).alias("k")).agg(*[F.sum(c).alias(c) for c in ("t", "o", "kt", "ko")])
    # all shorter grams that stand in a longer one, with the number of different bytes before them
    size = F.shiftright(g, 56)
    pairs = F.array(*[F.when(size >= m, F.struct(last_bytes(g, m).alias("longer"), last_bytes(g, m - 1).alias("gram")))
                      for m in range(2, ORDER + 1)])
    longer = counts.select(F.explode(F.filter(pairs, lambda x: x.isNotNull())).alias("x")).select("x.*").distinct()
    more = stage(longer.groupBy("gram").agg(F.count(F.lit(1)).alias("m")), "continuations")
    low = more.groupBy(slot(g, bits).alias("k")).agg(F.sum("m").alias("m"))
    low_ctx = more.groupBy(context(g).alias("c")).agg(F.sum("m").alias("m"), F.count(F.lit(1)).alias("km")) \
        .groupBy(slot(F.col("c"), bits).alias("k")).agg(F.sum("m").alias("m"), F.sum("km").alias("km"))
    out = {}
    for name, df in (("own", own), ("ctx", ctx), ("low", low), ("lowctx", low_ctx)):
        got = df.toArrow()
        k = got.column("k").to_numpy()
        for c in got.column_names[1:]:
            out[f"{name}_{c}"] = a = np.zeros(1 << bits, np.float32)
            a[k] = got.column(c).to_numpy()
    return out


def word_logs(model: dict, words: list[bytes]) -> np.ndarray:
    """(words, 2): natural log-likelihood of each word by the toxic and the ordinary model."""
    g, first = grams(words)
    size, t = g >> 56, model["tables"]
    p = np.full(len(g), 1 / 256)
    for m in range(1, ORDER):
        on = np.flatnonzero(size > m)
        s = last_bytes(g[on], m)
        c = slot(context(s), model["bits"])
        total = t["lowctx_m"][c].astype(np.float64)
        ok = total > 0
        on, s, c, total = on[ok], s[ok], c[ok], total[ok]
        p[on] = (np.maximum(t["low_m"][slot(s, model["bits"])] - DISCOUNT, 0) + DISCOUNT * t["lowctx_km"][c] * p[on]) / total
    k, c = slot(g, model["bits"]), slot(context(g), model["bits"])
    out = np.empty((len(words), 2))
    for i, cls in enumerate("to"):
        total = t[f"ctx_{cls}"][c].astype(np.float64)
        own = (np.maximum(t[f"own_{cls}"][k] - DISCOUNT, 0) + DISCOUNT * t[f"ctx_k{cls}"][c] * p) / np.maximum(total, 1)
        q = np.where(total > 0, own, p)
        out[:, i] = np.add.reduceat(np.log(np.maximum(q, 1e-12)), first) if len(words) else 0
    return out


class Scorer:
    """Features of texts; remembers the words it has met."""

    def __init__(self, model: dict):
        self.model, self.number, self.logs = model, {}, np.zeros((0, 2))

    def _known(self, texts: list[list[bytes]]) -> None:
        new = list({w for words in texts for w in words if w not in self.number})
        if len(self.number) + len(new) > WORDS_KEPT and self.number:
            self.number.clear()
            self.logs = np.zeros((0, 2))
            new = list({w for words in texts for w in words})
        got = []
        for i in range(0, len(new), 1 << 15):
            got.append(word_logs(self.model, new[i:i + (1 << 15)]))
        n = len(self.number)
        self.number.update(zip(new, range(n, n + len(new))))
        self.logs = np.concatenate([self.logs, *got])

    def features(self, texts: list[bytes]) -> np.ndarray:
        """[gain a byte over the text, clear gain a word over the text, clear gain a word in the best window, log of the
        number of words].  Clear gain: what a word's gain has beyond CLEAR nats either way."""
        words = [words_of(t) for t in texts]
        self._known(words)
        out = np.zeros((len(texts), FEATURES))
        for r, ws in enumerate(words):
            if ws:
                k = np.fromiter(map(self.number.__getitem__, ws), np.int64, len(ws))
                gain = self.logs[k, 0] - self.logs[k, 1]
                size = sum(map(len, ws)) + len(ws)
                clear = np.sign(gain) * np.maximum(np.abs(gain) - CLEAR, 0)
                run = np.concatenate([[0], np.cumsum(clear)])
                w = min(WINDOW, len(ws))
                out[r] = gain.sum() / size, run[-1] / len(ws), (run[w:] - run[:-w]).max() / WINDOW, np.log1p(len(ws)) / 10
        return out


def _basis(x: np.ndarray) -> np.ndarray:
    return np.concatenate([np.ones((len(x), 1)), x, x[:, :3] * x[:, 3:]], 1)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> dict:
    """Weighted logistic fit by Newton's method with a halved step where the loss would grow."""
    z = _basis(x)
    mean, sd = z.mean(0), z.std(0) + 1e-9
    mean[0], sd[0] = 0, 1
    z = (z - mean) / sd
    pen = np.full(z.shape[1], ridge)
    pen[0] = 0

    def loss(w):
        a = z @ w
        return float((weight * (np.logaddexp(0, a) - y * a)).sum() + 0.5 * (pen * w * w).sum())
    w = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (weight * (p - y)) + pen * w
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(pen + 1e-9), grad)
        f = 1.0
        while f > 1e-4 and loss(w - f * step) > loss(w):
            f /= 2
        w = w - f * step
        if np.abs(f * step).max() < 1e-7:
            break
    return {"w": w, "mean": mean, "sd": sd}


def probability(fit: dict, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip((_basis(x) - fit["mean"]) / fit["sd"] @ fit["w"], -30, 30)))


def _scorer(shared) -> Scorer:
    return Scorer(shared.value)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic",
                 calibration_rows: int = CALIBRATION_ROWS, bits: int = BITS) -> dict | None:
    """Counts over every labelled text that is not held out, and the calibration (None: a label has no counted or no
    calibrating row).  Texts meet their labels in one shuffled join; labels are looked up by id, so all texts of a
    repeated id count."""
    who = stage(learners(labels, label), "toxicity-labels")
    texts = docs_of(docs, id_col, text_col).where(~held_out("doc_id"))
    # the labels grow with the corpus: the same shuffled join at every size, never a broadcast
    counted = texts.join(who.where("NOT calibrates").select("doc_id", "y").hint("shuffle_merge"), "doc_id")
    counts = stage(gram_counts(counted), "grams")
    t, o = counts.agg(F.sum("t"), F.sum("o")).first()
    if not t or not o:
        return None
    model = {"tables": slot_tables(counts, bits), "bits": bits}
    shared = docs.sparkSession.sparkContext.broadcast(model)
    side, total = None, {0: 0, 1: 0}
    for r in who.where("calibrates").groupBy("y").count().collect():
        total[r[0]] = r[1]
    for y in (0, 1):
        part = who.where("calibrates").where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(calibration_rows)
        side = part if side is None else side.union(part)
    side = side.select("doc_id", "y")

    def measured(batches):
        s = _scorer(shared)
        for b in batches:
            x = s.features([v.encode() for v in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("y"), *[pa.array(x[:, i]) for i in range(FEATURES)]],
                                             names=["y", *[f"f{i}" for i in range(FEATURES)]])
    # at most 2 * calibration_rows ids: safe to broadcast; of a repeated id the text with the smallest hash
    rows = texts.join(F.broadcast(side), "doc_id").groupBy("doc_id").agg(
        F.min("y").alias("y"), F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x")).select("y", "x.text")
    xy = np.array([tuple(r) for r in rows.mapInArrow(
        measured, "y int, " + ", ".join(f"f{i} double" for i in range(FEATURES))).collect()], np.float64).reshape(-1, 1 + FEATURES)
    n = np.bincount(xy[:, 0].astype(int), minlength=2)
    if not n.all():
        return None
    share = np.array([total[0] / n[0], total[1] / n[1]])    # back to the odds of all calibrating rows
    weight = share[xy[:, 0].astype(int)] / share.min()
    return {"shared": shared, "fit": logistic(xy[:, 1:], xy[:, 0], weight)}


def toxicity_scores(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (score >= threshold).

    Null and empty texts, and texts without a word, are scored like any text of no words.  Without a model every score is
    0.5 less a hair, so nothing is called toxic.  A null id counts as held out; an empty table gives an empty result.
    """
    shared, fit = (model["shared"], model["fit"]) if model else (None, None)

    def scored(batches):
        s = _scorer(shared) if shared else None
        for b in batches:
            if s is None:
                p = np.full(b.num_rows, 0.499)
            else:
                p = probability(fit, s.features([v.encode() for v in b.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p)], names=["doc_id", "score"])
    out = docs_of(docs, id_col, text_col).mapInArrow(scored, "doc_id long, score double")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
