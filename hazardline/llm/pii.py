"""Personal data by fixed patterns and a skip-chain conditional random field.

Base spans come from the patterns.  Around them the field labels every token that has a digit or an @.  A base span is
one node, and so is a run of digit tokens that holds one number in parts:

* node potentials: log odds of the token's shape, number of digits and preceding word under each label;
* chain potentials between tokens that follow each other closely;
* skip potentials between nodes of one document with the same digits, the same digits but for the country code or
  trunk 0 of a phone, or the same lower-cased address, however far apart: each is linked to an observed one of each kind among them; where there is none, all are linked to a hub
  variable.  So any two alike are at most two links apart, and the links grow with the tokens.

All potentials are counts over the whole corpus (labels: the base spans; unlabelled tokens with an observed one alike
in their document are what the field is to find and do not count as "none"), gathered by grouped sums into a fixed
number of feature buckets.  Tokens of base spans are observed; loopy belief propagation carries their label along the
links, and other tokens whose belief in one kind reaches ``BELIEF`` become spans of their own.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import docs_of, stage

KINDS = ("email", "ip", "card", "phone")           # label k + 1; label 0: none
BUCKETS = 1 << 12                                  # of each feature
FEATURES = 3
ROUNDS, BELIEF = 6, 0.9
_LABELS = len(KINDS) + 1

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]")
#: White space, separators, quotes and brackets; round ones stay beside digits, as in (838)555-7235.
_DELIMITER = re.compile(r"""[\s,;|"'`<>\[\]{}=&\u2018-\u201f\u00ab\u00bb\u3001\u3002\u3008-\u3011\uff01\uff08\uff09\uff0c\uff1a\uff1b\uff1d\uff1f]"""
                        r"""|\((?![0-9])|(?<![0-9])\)|(?<=\))\(""")
#: Where a number or address touches letters of a script that has no spaces.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff"
_SCRIPT = re.compile(f"(?<=[{_UNSPACED}])(?=[A-Za-z0-9+])|(?<=[A-Za-z0-9])(?=[{_UNSPACED}])")
_EDGE = ".:!?*#/\\()"
_DIGITS = re.compile(r"[0-9]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_PART = re.compile(r"[+(]?[0-9][0-9().\-/]*")      # a token that may be a part of a number
_GAP = re.compile(r"[ \t\xa0().-]{1,3}")           # between the parts
LONGEST = 19                                       # digits of a number: the longest card


def emails(t: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @, dotted domain.  A match has one @, so each @ is looked at once."""
    out, end, at = [], 0, t.find("@")
    while at >= 0:
        s = at
        while s > end and _LOCAL.match(t, s - 1):
            s -= 1
        m = _DOMAIN.match(t, at + 1) if s < at else None
        if m:
            out.append((s, m.end()))
            end = m.end()
        # the next @ starts its local part after the last match, or after this @
        end = max(end, at + 1)
        at = t.find("@", end)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(_DIGITS.findall(s))


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in the order of the digest."""
    out = [(s, 0, e) for s, e in emails(t)] if "@" in t else []
    if "." in t:
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(t) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split("."))]
    for m in _CARD.finditer(t):
        if m.end() - m.start() >= 14:
            d = _digits(m[0])
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    if "+" in t:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(t) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def _shape(w: str) -> str:
    """The token with letters as a, runs of digits as their length; long ones end after 24 signs."""
    return _LETTERS.sub("a", _DIGITS.sub(lambda m: f"<{min(len(m[0]), 20)}>", w))[:24]


def tokens(t: str) -> list[tuple[int, int]]:
    """Tokens with a digit or an @, of any length: text between delimiters and changes to a script without spaces,
    less the punctuation at its ends."""
    out, pos = [], 0
    while m := _SIGN.search(t, pos):
        s = m.start()
        while s > pos and not _DELIMITER.match(t, s - 1):
            s -= 1
        e = _DELIMITER.search(t, m.end())
        pos = e.start() if e else len(t)
        cuts = [] if t[s:pos].isascii() else [c.start() for c in _SCRIPT.finditer(t, s, pos)]
        for a, b in zip([s, *cuts], [*cuts, pos]):
            if _SIGN.search(t, a, b):
                out.append(_trim(t, a, b))
    return out


def _trim(t: str, s: int, e: int) -> tuple[int, int]:
    while t[s] in _EDGE:
        s += 1
    while t[e - 1] in _EDGE:
        e -= 1
    if s and t[s - 1] == "(" and t.find(")", s, e) >= 0 and t.find("(", s, e) < 0:
        s -= 1
    return s, e


def _national(d: str) -> str:
    """The key of a number: of the lengths of a phone with country code or trunk 0, the last ten digits."""
    if len(d) <= 15:
        d = d.lstrip("0") or d
    return d[-10:] if 10 <= len(d) <= 13 else d


def span_keys(t: str, spans: list[tuple[int, int, int]]) -> tuple[list[str], dict[str, str]]:
    """The key of each base span, and the keys of all digits by which a base span can be meant."""
    keys, digits = [], [_digits(t[s:e]) for s, _, e in spans]
    known: dict[str, str] = {}
    for (s, k, e), d in zip(spans, digits):
        kind = KINDS[k]
        keys.append(t[s:e].lower() if kind == "email" else "ip " + ".".join(str(int(x)) for x in t[s:e].split(".")) if kind == "ip"
                    else d if kind == "card" else _national(d))
        if kind in ("card", "phone"):
            known.setdefault(d, keys[-1])
    for code in (1, 2, 3):
        for (_, k, _), d, key in zip(spans, digits, keys):
            if KINDS[k] == "phone" and len(d) - code >= 7:
                known.setdefault(d[code:], key)
    return keys, known


def _key_of(d: str, known: dict[str, str]) -> str:
    return known.get(d) or known.get(d.lstrip("0")) or (_national(d) if len(d) >= 6 else "")


def pieces(t: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str]]:
    """(start, end, label, key) of the nodes: base spans, tokens outside of them, and numbers of several tokens.

    What a base span leaves of its token is kept where it may be a datum of its own (an @ or six digits).
    """
    keys, known = span_keys(t, spans)
    out = [(s, e, k + 1, key) for (s, k, e), key in zip(spans, keys)]
    covered: list[list[int]] = []
    for s, _, e in spans:
        if covered and s < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], e)
        else:
            covered.append([s, e])
    free, k = [], 0
    for s, e in tokens(t):
        while k < len(covered) and covered[k][1] <= s:
            k += 1
        at, j, rest = s, k, []
        while j < len(covered) and covered[j][0] < e:
            rest.append((at, covered[j][0]))
            at, j = covered[j][1], j + 1
        if j == k:
            free.append((s, e))
        for a, b in [*rest, (at, e)] if rest else []:
            if a < b and ("@" in t[a:b] or len(_digits(t[a:b])) >= 6):
                free.append(_trim(t, a, b))
    part = [_PART.fullmatch(t, s, e) is not None for s, e in free]
    i = 0
    while i < len(free):
        j = i + 1
        while part[i] and j < len(free) and part[j] and _GAP.fullmatch(t, free[j - 1][1], free[j][0]):
            j += 1
        if j == i + 1:
            s, e = free[i]
            out.append((s, e, 0, t[s:e].lower() if "@" in t[s:e] else _key_of(_digits(t[s:e]), known)))
        else:
            out += [(*_trim(t, s, e), y, key) for s, e, y, key in _numbers([(s, e, _digits(t[s:e])) for s, e in free[i:j]], known)]
        i = j
    return sorted(out)


def _numbers(run: list[tuple[int, int, str]], known: dict[str, str]) -> list[tuple[int, int, int, str]]:
    """Nodes of adjacent digit tokens: first the digits of base spans, then short tokens that make up one number."""
    out, rest, i = [], [], 0

    def close():
        d = "".join(x for *_, x in rest)
        if len(rest) > 1 and 7 <= len(d) <= LONGEST:
            out.append((rest[0][0], rest[-1][1], 0, _key_of(d, known)))
        else:
            out.extend((s, e, 0, _key_of(x, known)) for s, e, x in rest)
        rest.clear()

    while i < len(run):
        d, found = "", 0
        for j in range(i, len(run)):
            d += run[j][2]
            if len(d) > LONGEST:
                break
            if d in known or d.lstrip("0") in known:
                found, key = j + 1, _key_of(d, known)
        if found:
            close()
            out.append((run[i][0], run[found - 1][1], 0, key))
            i = found
            continue
        if len(run[i][2]) >= 6:
            close()
            out.append((run[i][0], run[i][1], 0, _key_of(run[i][2], known)))
        else:
            rest.append(run[i])
        i += 1
    close()
    return out


def nodes(t: str, spans: list[tuple[int, int, int]]) -> list[tuple]:
    """(start, end, label, close to the one before, index of the previous alike or -1, features, open)

    A node without a label that has an observed one alike is open: no vote of its features for "none".
    """
    out, seen, likes, last = [], {}, [], -9
    for s, e, label, like in pieces(t, spans):
        w = t[s:e]
        before = t[max(0, s - 16):s].split()
        feats = [zlib.crc32(x.encode("utf-8", "surrogatepass")) % BUCKETS for x in
                 (_shape(w), f"n{min(len(_digits(w)), 20)}", before[-1].lower().strip(".,:;*%$&#") if before else "")]
        out.append((s, e, label, s - last <= 3, seen.get(like, -1) if like else -1, *feats))
        if like:
            seen[like] = len(out) - 1
        likes.append(like)
        last = max(e, last)
    known = {x for x, r in zip(likes, out) if x and r[2]}
    return [(*r, not r[2] and x in known) for x, r in zip(likes, out)]


_NODE = "array<struct<s:int,e:int,y:int,close:boolean,alike:int,f0:int,f1:int,f2:int,open:boolean>>"
_FIRST = f"doc_id long, base array<struct<s:int,k:int,e:int>>, nodes {_NODE}"
_NODE_PA = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("y", pa.int32()), ("close", pa.bool_()),
                               ("alike", pa.int32()), ("f0", pa.int32()), ("f1", pa.int32()), ("f2", pa.int32()), ("open", pa.bool_())]))
_BASE_PA = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())]))


def _first(batches):
    for b in batches:
        base, found = [], []
        for t in b.column("text").to_pylist():
            x = base_spans(t)
            base.append([dict(zip("ske", r)) for r in x])
            found.append([dict(zip(("s", "e", "y", "close", "alike", "f0", "f1", "f2", "open"), r)) for r in nodes(t, x)])
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(base, _BASE_PA), pa.array(found, _NODE_PA)],
                                         names=["doc_id", "base", "nodes"])


class Potentials:
    """Log potentials from corpus counts; their size is fixed by BUCKETS."""

    def __init__(self, features: list[tuple], links: list[tuple]):
        count = np.zeros((FEATURES, BUCKETS, _LABELS))
        for f, v, y, n in features:
            count[f, v, y] += n
        label = count[0].sum(0) + 1.0
        prior = label / label.sum()
        p = (count + 0.5 * prior) / (count.sum(2, keepdims=True) + 0.5)     # P(label | feature), shrunk to the prior
        # one vote of evidence per feature on top of the prior, shapes in full and the weaker two by half
        self.node = (np.log(p + 1e-9) - np.log(prior)) * np.array([1.0, 0.5, 0.5])[:, None, None]
        self.prior = np.log(prior)
        self.link = np.zeros((2, _LABELS, _LABELS))
        for kind in (0, 1):
            c = np.full((_LABELS, _LABELS), 0.1) + 0.9 * np.eye(_LABELS)
            for k, a, b, n in links:
                if k == kind:
                    c[a, b] += n
                    c[b, a] += n
            c /= c.sum()
            m = c.sum(1)
            self.link[kind] = np.clip(np.log(c) - np.log(m)[:, None] - np.log(m)[None, :], -4, 4)
        # An unlabelled look-alike of a labelled token is what the field is to find, so in the skip links
        # "none" beside a kind counts as no evidence instead of as a disagreement.
        self.link[1][0, 1:] = self.link[1][1:, 0] = np.minimum(0, self.link[1][0, 1:].max())
        self.link[1][0, 0] = 0


def skip_links(y: list[int], alike: list[int], hub: int) -> tuple[list[tuple[int, int]], list[float]]:
    """Skip links (from, to) of a document's tokens and the weight of the message to the second.

    ``alike`` is the index of the previous token alike or -1.  Tokens from ``hub`` on are hubs: what reaches one is the
    mean of the tokens alike, so that mere repetition is no evidence.
    """
    groups: dict[int, list[int]] = {}
    first: list[int] = []
    for i, a in enumerate(alike):
        first.append(first[a] if a >= 0 else i)
        groups.setdefault(first[i], []).append(i)
    links, weight = [], []
    for group in groups.values():
        if len(group) < 2:
            continue
        seen = {}
        for i in group:
            if y[i]:
                seen.setdefault(y[i], i)
        if not seen and len(group) > 2:
            links += [(i, hub) for i in group]
            weight += [1 / len(group)] * len(group)
            hub += 1
        else:
            new = [(a, i) for a in seen.values() for i in group if not y[i]] if seen else [(group[0], group[1])]
            links += new
            weight += [1.0] * len(new)
    return links, weight


def beliefs(pot: Potentials, y: np.ndarray, feats: np.ndarray, edges: np.ndarray, kind: np.ndarray, weight: np.ndarray,
            hubs: int = 0, rounds: int = ROUNDS) -> np.ndarray:
    """Marginals [nodes, labels] by loopy belief propagation; nodes with y > 0 are observed, the last ``hubs`` are hubs.

    ``weight`` is that of the messages to the second node of each edge.
    """
    n = len(y)
    own = pot.prior + sum(pot.node[f][feats[:, f]] for f in range(FEATURES))
    fixed = np.full((n, _LABELS), -30.0)
    fixed[np.arange(n), y] = 0
    own = np.concatenate([np.where((y > 0)[:, None], fixed, own), np.tile(pot.prior, (hubs, 1))])
    a = np.concatenate([edges[:, 0], edges[:, 1]])
    b = np.concatenate([edges[:, 1], edges[:, 0]])
    table = pot.link[np.concatenate([kind, kind])]
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    weight = np.concatenate([weight, np.ones(len(edges))])[:, None]
    msg = np.zeros((len(a), _LABELS))
    for _ in range(rounds if len(edges) else 0):
        total = own.copy()
        np.add.at(total, b, weight * msg)
        out = total[a] - (weight * msg)[back]
        out = np.logaddexp.reduce(out[:, :, None] + table, 1)
        msg = 0.5 * msg + 0.5 * (out - np.logaddexp.reduce(out, 1)[:, None])
    np.add.at(own, b, weight * msg)
    return np.exp(own - np.logaddexp.reduce(own, 1)[:, None])[:n]


def _label(pot: Potentials):
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                x = b.slice(lo, 500)
                base, found = x.column("base").to_pylist(), x.column("nodes").to_pylist()
                size = [len(f or []) for f in found]
                first = np.cumsum(size) - size
                flat = [r for f in found for r in f or []]
                edges, kind, weight, hubs = [], [], [], 0
                for f, at in zip(found, first.tolist()):
                    chain = [(at + i - 1, at + i) for i, r in enumerate(f or []) if i and r["close"]]
                    skip, w = skip_links([r["y"] for r in f or []], [r["alike"] for r in f or []], len(flat) + hubs - at)
                    skip = [(at + i, at + j) for i, j in skip]
                    hubs = max([hubs, *[j - len(flat) + 1 for _, j in skip]])
                    edges += chain + skip
                    kind += [0] * len(chain) + [1] * len(skip)
                    weight += [1.0] * len(chain) + w
                y = np.array([r["y"] for r in flat], np.int64)
                feats = np.array([(r["f0"], r["f1"], r["f2"]) for r in flat], np.int64).reshape(-1, FEATURES)
                p = beliefs(pot, y, feats, np.array(edges, np.int64).reshape(-1, 2), np.array(kind, np.int64),
                            np.array(weight), hubs) if flat else np.zeros((0, _LABELS))
                best = p[:, 1:].argmax(1) if len(p) else np.zeros(0, np.int64)
                new = (y == 0) & (p[np.arange(len(p)), best + 1] >= BELIEF) if len(p) else np.zeros(0, bool)
                out = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
                for i, spans in enumerate(base):
                    own = [(s["s"], s["k"], s["e"]) for s in spans or []]
                    for k, name in enumerate(KINDS):
                        out[f"n_{name}"].append(sum(1 for s in own if s[1] == k))
                    text = lambda rows: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in rows)
                    out["base_sha256"].append(hashlib.sha256(text(own).encode()).hexdigest())
                    more = [(flat[j]["s"], int(best[j]), flat[j]["e"]) for j in range(first[i], first[i] + size[i]) if new[j]]
                    out["spans"].append(text(sorted(own + more)))
                yield pa.RecordBatch.from_arrays(
                    [x.column("doc_id"), *[pa.array(out[f"n_{k}"], pa.int64()) for k in KINDS],
                     pa.array(out["base_sha256"], pa.string()), pa.array(out["spans"], pa.string())],
                    names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])
    return run


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Spans are kind:start:end in code points, by start and then kind.  A null or empty text has none (empty string).
    Rows are answered one by one, so null and repeated ids are no matter.
    """
    found = stage(docs_of(docs, id_col, text_col).mapInArrow(_first, _FIRST), "pii-nodes")
    node = found.select(F.explode("nodes").alias("x")).select("x.*")
    votes = node.where("NOT open").select("y", F.posexplode(F.array("f0", "f1", "f2")).alias("f", "v")).groupBy("f", "v", "y").count()
    pairs = found.select(F.explode(F.expr(
        "flatten(transform(nodes, (x, i) -> filter(array("
        "  if(i > 0 AND x.close, named_struct('k', 0, 'a', nodes[greatest(i - 1, 0)].y, 'b', x.y), null),"
        "  if(x.alike >= 0, named_struct('k', 1, 'a', nodes[greatest(x.alike, 0)].y, 'b', x.y), null)), r -> r IS NOT NULL)))"
    )).alias("r")).select("r.*").groupBy("k", "a", "b").count()
    # at most 3 * BUCKETS * 5 and 2 * 25 rows
    pot = Potentials([tuple(r) for r in votes.select("f", "v", "y", "count").collect()], [tuple(r) for r in pairs.collect()])
    return found.mapInArrow(_label(pot), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
