"""Page parsing in linear time (against plain patterns), and the recall of edited benchmark passages by length and edits."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from hazardline.llm import decontaminate as D
from hazardline.llm.language import declared_language, visible_text, without_blocks

PLAIN = re.compile(r"<!--.*?-->|<(script|style|nav|aside|header|footer|select)\b.*?</\1\s*>"
                   r"|<(\w+)\b[^>]*\bclass=\"(?:ad|ads|nav|menu)\"[^>]*>.*?</\2\s*>", re.S | re.I)
PARTS = ["<p>", "</p>", "<P class=\"ad\">", "<div class=\"menu\" id=x>", "</div>", "<nav>", "</NAV >", "<!--", "-->", "<script>", "</script>",
         "word ", "more ", "<b", ">", "<header x>", "</header>", "class=\"nav\"", "<a class=\"note\">", "</a>"]


def test_blocks_as_plain_patterns():
    rnd = random.Random(4)
    for _ in range(4000):
        page = "".join(rnd.choice(PARTS) for _ in range(rnd.randrange(14)))
        assert without_blocks(page) == PLAIN.sub(" ", page), page


@pytest.mark.parametrize("unit", ["<p class=\"ad\" ", "<nav>", "<!--", "<", "<html ", "<p class=\"ad\">", "</nav ", "<html lang "])
@pytest.mark.parametrize("end", ["", ">"])
def test_a_megabyte_of_broken_markup(unit, end):
    page = unit * (1_000_000 // len(unit)) + end
    t = time.time()
    visible_text(page)
    declared_language(page)
    assert time.time() - t < 5


def test_declared_language():
    assert declared_language("<!doctype html><HTML class=x lang='de-AT'>") == "de"
    assert declared_language("<html><p lang=fr><html lang = en>") == "en"
    assert declared_language("<p lang=fr>") == declared_language("") == ""


WORDS = ["".join(random.Random(i).choice("abcdefghijklmnopqrstuvwxyz") for _ in range(2 + i % 8)) for i in range(20_000)]


def words(rnd, n):
    out = ""
    while len(out) < n:
        out += rnd.choice(WORDS) + " "
    return out[:n].strip().ljust(n, "x")


def edited(rnd, text, k):
    s = list(text)
    for _ in range(k):
        i, c = rnd.randrange(len(s)), rnd.choice("abcdefghijklmnopqrstuvwxyz")
        s[i:i + 1] = [[c], [c, s[i]], []][rnd.randrange(3)]
    return "".join(s)


@pytest.mark.parametrize("size", [60, 120, 200, 400])
@pytest.mark.parametrize("share", [0.05, 0.08, 0.1])
def test_recall_of_edited_passages(size, share):
    """Substitutions, insertions and deletions up to the bound: recall by length and edits, and nothing else found."""
    rnd = random.Random(size + int(100 * share))
    texts = [words(rnd, size) for _ in range(60)]
    docs = [words(rnd, 150) + " " + edited(rnd, t, int(size * share)) + " " + words(rnd, 150) for t in texts]
    items = D.Items(list(range(60)), texts)
    batch = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(docs), pa.array(range(60))], names=["doc_id", "text", "row"])
    got = {p for b in D._scan(items)([batch]) for p in zip(b["doc_id"].to_pylist(), b["item_id"].to_pylist())}
    brute = {(d, i) for d in range(60) for i in ([d, (d + 1) % 60] if size < 200 else [d])
             if D.edit_distance_inside(texts[i].encode(), docs[d].encode(), size // 10) <= size // 10}
    assert len(brute) == 60
    assert len(got & brute) >= 0.95 * len(brute) and not got - brute


def test_one_long_item_costs_the_short_ones_nothing():
    """Together they take about what each takes alone (embedded to the long one's width, 500 short ones took minutes)."""
    rnd = random.Random(9)
    short, long = [words(rnd, 100).encode() for _ in range(500)], [words(rnd, 8000).encode()]

    def timed(texts):
        size = np.array([len(t) for t in texts])
        t = time.time()
        return D.keys(texts, size, size // 10), time.time() - t
    (a, ta), (b, tb), (both, t) = timed(short), timed(long), timed(short + long)
    assert (both == np.concatenate([a, b])).all() and t < 2 * (ta + tb) + 2
