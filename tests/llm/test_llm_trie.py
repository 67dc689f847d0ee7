"""Operator 12 against a plain-Python trie; the radix tree against a dictionary."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from playmart.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string, path string, depth int"


def lists(rows):
    """conv_id -> [(role, text)] in order."""
    key = lambda r, t: hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest()
    out = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            out.setdefault(c, []).append((turn is not None, turn or 0, role, key(role, text), text))
    return {c: [(r[2], r[4]) for r in sorted(t)] for c, t in out.items()}


def rebuild(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def plain(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    own = {p: (len(m) - 1) * (len(p[-1][1].encode()) if p else 0) for p, m in members.items()}
    saved, leaves = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p in members:
        for d in range(len(p) + 1):
            saved[p[:d]] += own[p]
            leaves[p[:d]] += p not in kids
    rows = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        rows.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, ())), leaves[p], saved[p],
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def conversations(seed=1, n=120):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rnd.choice([1, 2, 5, 8])):
            rows.append((c, turn, rnd.choice(["user", "user", "assistant", None]), f"t{rnd.randrange(3)} ü" * rnd.randrange(3)))
    for c in range(300, 360):  # one large group of copies
        rows += [(c, t, "user", f"copy {t}") for t in range(4)]
    rows += [(500, None, "user", "first"), (500, 3, None, None), (500, 3, "a", "tie"), (500, 3, "a", "tie"), (500, 3, "a", "eit"),
             (501, 0, "user", ""), (-7, 0, "user", "negative"), (-5, 0, "user", "base"), (None, 0, "user", "lost"), (502, None, None, None)]
    rows += [(600, t, "user", f"long {t % 7}") for t in range(700)] + [(601, t, "user", f"long {t % 7}") for t in range(650)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk", [7, 50_000])
def test_nodes_match_a_plain_trie(spark, tmp_root, chunk):
    rows = conversations()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)
    got = sorted((tuple(r) for r in ct.prefix_trie(ct.turn_lists(df), chunk).collect()), key=str)
    assert got == plain(lists(rows))
    path = f"{tmp_root}/llm-trie-{chunk}"
    df.write.mode("overwrite").parquet(f"{path}/conversations.parquet")
    out = ct.op12_conversation_trie(spark, path)
    assert out.columns == ct.NODE
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain(rebuild(lists(rows)))


def test_empty_and_turnless(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert ct.prefix_trie(ct.rebuilt(none)).count() == 0
    rows = [(11, 0, "user", "a"), (13, 0, "user", "b")]  # no base: the first h turns go, nothing comes
    got = ct.prefix_trie(ct.rebuilt(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA))).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rebuild(lists(rows)))


def test_radix_tree_files_every_key():
    rnd = random.Random(5)
    keys = sorted({bytes(rnd.choices(range(256), k=k)) for k in [2] * 3000 + [4] * 500} | {b"ab" * 400, b"ab" * 399 + b"ac"})
    keys += [k + b"zz" for k in keys[:300] if k + b"zz" not in set(keys)] + [b""]
    rnd.shuffle(keys)
    root = None
    for row, key in enumerate(keys):
        root = ct.insert(root, key, row)
    found, rooms, stack = {}, set(), [(root, b"")]
    while stack:
        node, before = stack.pop()
        here = before + node.path
        rooms.add(node.room)
        for r in node.ends or ():
            found[r] = here
        kids = [(b, node.child(b)) for b in range(256)]
        kids = [(b, c) for b, c in kids if c is not None]
        assert node.room == 0 or len(kids) <= node.room
        assert len(node.children()) == len(kids)
        stack += [(c, here + bytes([b])) for b, c in kids]
    assert rooms == {0, 4, 16, 48, 256}
    assert found == dict(enumerate(keys))


def test_common_beginning():
    for a, b, n in ((b"", b"x", 0), (b"abc", b"abd", 2), (b"abc", b"abc", 3), (b"abcd", b"ab", 2), (b"x", b"y", 0)):
        assert ct.shared(a, b) == n
