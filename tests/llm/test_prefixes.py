"""The prefix trie (op 11) against a dictionary of all prefixes."""

import collections
import hashlib
import random
import zlib

from hazardline.llm.prefixes import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, id int"


def plain(rows, rebuild):
    turns = collections.defaultdict(list)
    for c, t, r, x, *_ in rows:
        if c is not None:
            r, x = r or "", x or ""
            turns[c].append((t is not None, t or 0, hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()[:16], (r, x)))
    turns = {c: [z[3] for z in sorted(ts)] for c, ts in turns.items()}
    convs = {}
    for c, own in turns.items():
        if rebuild:
            h, sign = zlib.crc32(str(c).encode()) % 6, -1 if c < 0 else 1
            own = turns.get(c - sign * (abs(c) % 100), [])[:h] + own[h:]
        convs[c] = tuple(own)
    members = collections.defaultdict(list)
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p)))).encode()).hexdigest())
                   for p, m in members.items()), key=str)


def found(spark, rows, **kw):
    return sorted((tuple(r) for r in prefix_trie(spark.createDataFrame(rows, SCHEMA), **kw).collect()), key=str)


def conversations(seed):
    rnd, rows = random.Random(seed), []
    for c in [*range(40), 100, 103, 117, 205, 250, -5, -101]:
        for t in range(rnd.choice([1, 2, 3, 9, 23])):
            rows.append((c, t if rnd.random() < 0.95 else None, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "bb", "", None, "é中"]), "x", 1))
    rows += [(None, 0, "user", "of no conversation", "x", 1), rows[3], rows[5]]
    # two long ones with a long common beginning; several hundred rows of one conversation are cut over tasks
    return rows + [(c, t, "user", "z" * (t % 3), "x", 1) for c, n in ((300, 400), (301, 250)) for t in range(n)]


def test_trie_of_rebuilt_conversations(spark):
    rows = conversations(0)
    assert found(spark, rows, rebuild=True) == plain(rows, True)


def test_trie_in_narrow_blocks(spark):
    rows = conversations(1)
    assert found(spark, rows, width=2) == plain(rows, False)


def test_one_first_turn_for_all_and_exact_copies(spark):
    rows = [(c, t, "user", ["hello", "same", f"own {c % 7}"][t], "x", 1) for c in range(1, 3001, 5) for t in range(1 + c % 3)]
    assert found(spark, rows) == plain(rows, False)


def test_empty_and_turnless(spark):
    assert found(spark, []) == []
    # the hundred's first conversation is missing and the own turns are all replaced: only the root is left
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(c, t, "user", "x", "x", 1) for t in range(3)]
    assert found(spark, rows, rebuild=True) == plain(rows, True)
    assert len(plain(rows, True)) == 1
