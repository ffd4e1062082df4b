"""Periodic runs (op 13) against comparing every pair of words at every distance."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from hazardline.llm.runs import describe, periodic_runs, runs, runs_within, stretches, words_of


def plain(x, least=6, periods=4):
    """Maximal stretches of equal words q apart, for every q, without those that have a smaller period."""
    n, out = len(x), []
    for q in range(1, n):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            size = j - i + q
            part = x[i:i + size]
            if j > i and size >= max(least, periods * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def cases():
    rnd = random.Random(5)
    for _ in range(400):
        n, k = rnd.randint(0, 60), rnd.choice([1, 2, 2, 3, 6])
        x = [rnd.randrange(k) for _ in range(n)]
        if rnd.random() < 0.6 and n > 6:
            a = rnd.randrange(n)
            p = rnd.randint(1, max(1, (n - a) // 3))
            x = [x[a + (i - a) % p] if i >= a else x[i] for i in range(n)]
        yield x


def test_runs_equal_plain_comparison():
    for x in cases():
        assert runs(np.array(x, np.int64)) == plain(x)


@pytest.mark.parametrize("periods", [2, 3])
def test_automaton_finds_weaker_runs_too(periods):
    for x in cases():
        got = sorted(((s, k, p) for (s, p), k in runs_within(x, 1, periods).items()), key=lambda r: (r[0], r[2]))
        assert got == plain(x, 1, periods)


def test_stretches_leave_prose_out():
    rnd = random.Random(1)
    prose = [rnd.randrange(5000) for _ in range(3000)]
    x = prose + [7, 8, 9] * 5 + prose[::-1]
    (lo, hi), = stretches(np.array(x))
    assert lo <= 3000 and hi >= 3015 and hi - lo < 60
    assert runs(np.array(x)) == [(3000, 15, 3)]


def test_long_repetitive_text():
    x = np.arange(60_000) % 15_000
    assert runs(x) == [(0, 60_000, 15_000)]
    assert runs(np.zeros(100_000, np.int64)) == [(0, 100_000, 1)]


def row(doc_id, text):
    """The contract, word by word."""
    words, h = words_of((text or "").encode()), zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    found = plain([w.decode() for w in words])
    drop = {i for s, k, p in found for i in range(s + p, s + k)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, hashlib.sha256("".join(f"{s},{k},{p}\n" for s, k, p in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in drop)).hexdigest())


def test_query_rows(spark):
    rnd, texts = random.Random(9), [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "A a A a A a A a", "x\x1cy\x0bz é　中 é　中",
                                    "ab " * 50 + "cd " * 7 + "e f " * 9, "one line\nto say\n" * 6]
    texts += [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 80))) for _ in range(120)]
    data = [(i, t, i, "clash", 1) for i, t in enumerate(texts)]
    data += [data[8], data[8]]
    docs = spark.createDataFrame(data, "doc_id long, text string, n_runs int, period string, start long")
    got = sorted(tuple(r) for r in periodic_runs(docs, plant=True).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect())
    assert got == sorted(row(r[0], r[1]) for r in data)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in data)
    assert periodic_runs(docs.limit(0)).count() == 0
    free = spark.createDataFrame([(None, "a a a a a a")], "doc_id long, text string")
    assert tuple(periodic_runs(free, plant=True).first())[:6] == (None, 1, 0, 6, 1, 6000)


def test_ties_go_to_the_smallest_start():
    assert describe(1, b"a a a a a a b c c c c c c", False)[2:6] == (0, 6, 1, 6000)
