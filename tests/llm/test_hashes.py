"""Texts made to collide under polynomial hashes are told apart by every operator that names words or parts by hashes."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from hazardline.llm.encode import Encoder, encoder
from hazardline.llm.near_dedup import near_dedup
from hazardline.llm.packing import pack
from hazardline.llm.queries import tokenizer_path
from hazardline.llm.repeats import remove_repeats
from hazardline.llm.textnp import LONG_SPAN, span_hashes
from hazardline.llm.tokenfile import token_output


def thue_morse(n, a, b):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


PAIR = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
SHORT = " ".join([thue_morse(128, "a", "b")] * 3), " ".join([thue_morse(128, "b", "a")] * 3)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(1, PAIR[0]), (2, PAIR[1]), (3, SHORT[0]), (4, SHORT[1])], "doc_id long, text string")


def ids_of(name, text):
    t = Tokenizer.from_file(tokenizer_path(name))
    return t.encode(text, add_special_tokens=False).ids + [0]


def test_token_files(docs):
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in token_output(docs, tokenizer_path("byte_bpe_50k.json")).collect()}
    for i, t in zip((1, 2, 3, 4), (*PAIR, *SHORT)):
        ids = ids_of("byte_bpe_50k.json", t)
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_packing(docs):
    got = {r.doc_id: (r.length, r.ids_crc32) for r in pack(docs, tokenizer_path("word_bpe_49k.json")).collect()}
    for i, t in zip((1, 2, 3, 4), (*PAIR, *SHORT)):
        ids = ids_of("word_bpe_49k.json", t)
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_near_duplicates(docs):
    assert {r.component_id for r in near_dedup(docs, k=4, num=80, den=100).collect()} == {1, 2, 3, 4}


def test_repeats(spark):
    two = spark.createDataFrame([(1, PAIR[0][:256] + "x"), (2, "y" + PAIR[1][:256])], "doc_id long, text string")
    texts = [PAIR[0][:256] + "x", "y" + PAIR[1][:256]]
    strings = [{t[i:i + 200] for i in range(len(t) - 199)} for t in texts]
    assert not strings[0] & strings[1] and [len(s) for s in strings] == [58, 58]
    assert {r.n_removed for r in remove_repeats(two, length=200).collect()} == {0}


def test_span_hashes():
    rnd = np.random.RandomState(4)
    data = rnd.randint(97, 99, 4000).astype(np.uint8)
    start = rnd.randint(0, 3000, 3000)
    end = start + np.concatenate([rnd.randint(0, 24, 2900), rnd.randint(LONG_SPAN - 2, LONG_SPAN + 3, 100)])
    h = span_hashes(data, start, end)
    by = {}
    for s, e, x in zip(start, end, h):
        assert by.setdefault(data[s:e].tobytes(), x) == x          # a function of the bytes alone
    assert len(set(by.values())) == len(by)                        # and no two alike here
    assert (span_hashes(data, start, end, 5) != h).all()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_full_table_is_emptied(monkeypatch, name):
    """Ids stay right when the parts do not fit, and memory does not grow."""
    import pyarrow as pa
    from hazardline.llm import encode
    monkeypatch.setattr(encode, "MOST_PARTS", 50)
    rnd = np.random.RandomState(1)
    texts = [" ".join("".join(rnd.choice(list("abcdeé"), rnd.randint(1, 9))) for _ in range(40)) for _ in range(30)]
    e = Encoder(tokenizer_path(name))
    for lo in range(0, 30, 3):
        got = [np.frombuffer(x, "<u4").tolist() for x in e.documents(pa.array(texts[lo:lo + 3]))]
        assert got == [ids_of(name, t) for t in texts[lo:lo + 3]]
    assert encoder(tokenizer_path(name)) is encoder(tokenizer_path(name))
