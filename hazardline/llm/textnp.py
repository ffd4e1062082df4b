"""Vectorised hashing of the texts of an Arrow batch (numpy over the batch's own UTF-8 buffer)."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

_M64 = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
#: One random 64-bit value per byte value, so that the polynomial hash has no structure in common with text.
_BYTE = np.random.RandomState(20240229).randint(0, 1 << 62, 256, dtype=np.int64).astype(np.uint64) * np.uint64(3) + np.uint64(1)
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW.get("p", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("p", _BASE), ("i", _INV)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _POW[name] = np.cumprod(a, dtype=np.uint64)
    return _POW["p"], _POW["i"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null is an empty text."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    bufs = arr.buffers()
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    if not len(arr) or bufs[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8)[offs[0]:offs[-1]]
    return data, offs - offs[0]


def blocks(offs: np.ndarray, most: int = 1 << 20):
    """(first, last) row ranges whose texts have about ``most`` bytes; a longer text is a block of its own."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums, from which :func:`segments` takes the hash of any byte range."""
    p, _ = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * p[:len(data)], dtype=np.uint64, out=out[1:])
    return out


def segments(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end)."""
    _, inv = _powers(len(sums))
    raw = (sums[end] - sums[start]) * inv[start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


#: Spans longer than this are hashed one by one.
LONG_SPAN = 256


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0x5851F42D4C957F2D) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end), eight bytes at a time with a full mixing step after each, so that no
    sum or product over the bytes can be made to agree."""
    size = (end - start).astype(np.int64)
    h = mix(size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    todo = np.flatnonzero((size > 0) & (size <= LONG_SPAN))
    at, left = start[todo], size[todo]
    while len(todo):
        word = eight[at]
        tail = left < 8
        word[tail] &= (np.uint64(1) << (left[tail] * 8).astype(np.uint64)) - np.uint64(1)
        h[todo] = mix((h[todo] ^ word) * np.uint64(0x9FB21C651E98DF25))
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > LONG_SPAN).tolist():
        d = hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=8, key=int(seed).to_bytes(8, "little")).digest()
        h[i] = np.frombuffer(d, "<u8")[0]
    return h


_WS = np.zeros(256, bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of bytes that are not ASCII white space) of lower-cased texts, and the
    index of each text's first word (one more entry than texts).  Words end at the end of their text."""
    low = LOWER[data]
    inside = ~_WS[data]
    starts = np.empty(len(data) + 1, bool)
    starts[0] = False
    starts[-1] = False
    if len(data):
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cut = offs[(offs > 0) & (offs < len(data))]
        first[cut] = inside[cut]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        last[cut - 1] = inside[cut - 1]
        s = np.flatnonzero(first)
        e = np.flatnonzero(last) + 1
    else:
        s = e = np.zeros(0, np.int64)
    return span_hashes(low, s, e), np.searchsorted(s, offs)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of one text's words; all words as one shingle if there are fewer."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    m = max(1, n - k + 1)
    h = words[:m].copy()
    for j in range(1, min(k, n)):
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + words[j:j + m])
    if n < k:
        h = mix(h + np.uint64(n))
    return mix(h)
