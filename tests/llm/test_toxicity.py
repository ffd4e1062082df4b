"""Toxicity (op 12): the Kneser-Ney probabilities against plain counting, and held-out accuracy."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardline.llm import toxicity as tx
from hazardline.llm.common import stage

TOXIC = ["you stupid idiot", "Stupid scum, you moron!", "idiot idiot"]
PLAIN = ["you have a nice garden", "the stupor of an ideal moment", "a nice day, you see", "moments of a day"]


def plain_word(word, ordinary, toxic):
    """(log P by the toxic, by the ordinary model), by dictionaries."""
    def spelled(texts):
        return [f" {w.decode()} ".encode() for t in texts for w in tx.words_of(t.encode())]

    def longest(s):
        return [s[max(0, i - tx.ORDER + 1):i + 1] for i in range(1, len(s))]
    own = [collections.Counter(g for s in spelled(ts) for g in longest(s)) for ts in (toxic, ordinary)]
    tops = set(own[0]) | set(own[1])
    longer = {g[-m:] for g in tops for m in range(2, len(g) + 1)}
    m = collections.Counter(g[1:] for g in longer)

    def shared(x, h):
        below = shared(x, h[1:]) if h else 1 / 256
        total = sum(v for g, v in m.items() if g[:-1] == h)
        kinds = sum(1 for g in m if g[:-1] == h)
        return (max(m[h + x] - 0.75, 0) + 0.75 * kinds * below) / total if total else below

    def one(n, g):
        h, below = g[:-1], shared(g[-1:], g[1:-1])
        total = sum(v for k, v in n.items() if k[:-1] == h)
        kinds = sum(1 for k in n if k[:-1] == h)
        return (max(n[g] - 0.75, 0) + 0.75 * kinds * below) / total if total else below
    return [sum(math.log(one(n, g)) for g in longest(f" {word} ".encode())) for n in own]


def test_probabilities(spark):
    rows = spark.createDataFrame([(1, t) for t in TOXIC] + [(0, t) for t in PLAIN], "y int, text string")
    counts = stage(tx.gram_counts(rows), "grams")
    model = {"tables": tx.slot_tables(counts, 20), "bits": 20}
    words = ["idiot", "you", "nice", "scum", "garden", "idea", "unseen", "stupidest", "é", "x" * 40]
    got = tx.word_logs(model, [w.encode() for w in words])
    want = np.array([plain_word(w, PLAIN, TOXIC) for w in words])
    np.testing.assert_allclose(got, want, rtol=1e-5)
    assert got[0, 0] > got[0, 1] + 1 and got[2, 0] < got[2, 1]


def test_slots_agree_between_numpy_and_spark(spark):
    g, _ = tx.grams([b"some", b"words", bytes(range(129, 250)), b"a"])
    df = spark.createDataFrame([(int(x),) for x in g], "g long").select(
        "g", tx.slot(F.col("g")).alias("s"), tx.context(F.col("g")).alias("c"), tx.last_bytes(F.col("g"), 1).alias("l"))
    for r in df.collect():
        x = np.array([r.g])
        assert (r.s, r.c, r.l) == (tx.slot(x)[0], tx.context(x)[0], tx.last_bytes(x, 1)[0])


def corpus():
    rnd = random.Random(3)
    parts = ["ka", "lo", "mi", "tu", "ren", "sol", "ver", "dan"]
    insults = ["zogwurst", "zogfink", "plirrhead", "plirrface"]

    def text(n, bad):
        ws = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 3))) for _ in range(n)]
        for _ in range(max(1, n // 40) if bad else 0):
            ws[rnd.randrange(n)] = rnd.choice(insults)
        return " ".join(ws)
    rows = [(i, text(rnd.randint(3, 300), i % 6 == 0), int(i % 6 == 0)) for i in range(900)]
    return rows


@pytest.fixture(scope="module")
def scored(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "en", 0.0) for i, t, _ in rows] + [(None, "zogfink", "en", 0.0), (5000, None, "en", 0.0), (5001, "", "en", 0.0), (7, rows[7][1], "en", 0.0)],
                                 "doc_id long, text string, y string, score double")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(3, 1, 0), (3, 1, 1), (None, 1, 1), (9, 1, None), (10, None, 0)],
                                   "doc_id long, quality int, toxic int")
    model = tx.fit_toxicity(docs, labels)
    return docs, labels, model, tx.toxicity_scores(docs, model).collect()


def test_held_out_accuracy(scored):
    *_, out = scored
    y = {i: y for i, _, y in corpus()}
    held = [r for r in out if r.held_out and r.doc_id in y]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    assert len(held) > 100
    assert np.mean([r.predicted == y[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)


def test_every_row_is_scored(scored):
    docs, _, _, out = scored
    assert len(out) == docs.count()
    by = {r.doc_id: r for r in out}
    assert by[5000].score == by[5001].score < 0.5
    assert by[None].held_out and len({r.score for r in out if r.doc_id == 7}) == 1


def test_labels_of_held_out_rows_change_nothing(spark, scored):
    docs, labels, model, _ = scored
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = tx.fit_toxicity(docs, flipped)
    np.testing.assert_allclose(other["fit"]["w"], model["fit"]["w"])


def test_without_labels_or_documents(spark, scored):
    docs, labels, model, _ = scored
    assert tx.fit_toxicity(docs, labels.limit(0)) is None
    assert {r.predicted for r in tx.toxicity_scores(docs, None).collect()} == {0}
    assert tx.fit_toxicity(docs.limit(0), labels) is None
    assert tx.toxicity_scores(docs.limit(0), model).count() == 0
