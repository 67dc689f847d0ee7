"""Operator 13 against all pairs of fingerprints, and the Golay keys against their promise."""

from __future__ import annotations

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from playmart.llm import simhash


def plain(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_force(pairs):
    fps = [plain(t) for _, t in pairs]
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(pairs)), key=str)


def found(df):
    out = simhash.simhash_components(df)
    return sorted(((r.doc_id, f"{r.fp % (1 << 64):016x}", r.component_id) for r in out.collect()), key=str)


def near_texts(n=60):
    rnd = random.Random(4)
    base = [f"b{i}" for i in range(400)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(i % 6):
            w[rnd.randrange(len(w))] = f"E{i}"
        out.append((2000 + i, " ".join(w)))
    return out


def test_the_code_is_perfect_and_keys_are_all_near_codewords():
    bit, near, more = simhash.golay_tables()
    assert sorted({int(x).bit_count() for x in near}) == [0, 1, 2, 3] and len(set(near.tolist())) == 2048
    words = np.arange(1 << 23, dtype=np.int64)
    syndrome = np.zeros(len(words), dtype=np.int64)
    for i in range(23):
        syndrome ^= np.where(words >> i & 1, bit[i], 0)
    code = words[syndrome == 0]
    assert len(code) == 4096 and min(int(c).bit_count() for c in code[1:]) == 7
    rng = np.random.default_rng(1)
    some = rng.integers(0, 1 << 23, 200)
    for w, keys in zip(some.tolist(), simhash.golay_keys(some).tolist()):
        want = {int(c) >> 11 for c in code if (int(c) ^ w).bit_count() <= 4}
        assert {k for k in keys if k >= 0} == want


def test_fingerprints_that_link_share_a_key():
    rng = random.Random(2)
    for _ in range(2000):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), rng.choice([0, 1, 2, 3, 3, 3])):
            b ^= 1 << k
        row, key = simhash.filing_keys(np.array([a, b], dtype=np.uint64))
        assert set(key[row == 0].tolist()) & set(key[row == 1].tolist())


def test_spark_hashes_alike(spark):
    texts = ["one two three", "Ünï cödé", "a" * 40 + " b c", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t").alias("h"))
    assert [r.h % (1 << 64) for r in df.collect()] == [xxhash.xxh64(t.encode(), seed=42).intdigest() for t in texts]


def test_components_match_all_pairs(spark, rows, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)  # hot keys are met in pairs of blocks
    pairs = [(r[0], r[1]) for r in rows] + near_texts()
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(3)
    got, want = found(df), brute_force(pairs)
    assert len({w[2] for w in want}) < len(want) - 20
    assert got == want


def test_planted_fingerprints_chain_into_one_component(spark):
    rnd = random.Random(7)
    fps = [rnd.getrandbits(64) for _ in range(300)]
    for _ in range(900):  # neighbours of neighbours, up to 4 bits away
        x = rnd.choice(fps)
        for k in rnd.sample(range(64), rnd.choice([1, 2, 3, 4])):
            x ^= 1 << k
        fps.append(x)
    fps = sorted(set(fps))
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, x in enumerate(fps):
        for y in fps[:i]:
            if (x ^ y).bit_count() <= 3:
                root[find(x)] = find(y)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    got = {r.node % (1 << 64): r.root for r in simhash.linked_fingerprints(df).collect()}
    classes, want = {}, {}
    for x in fps:
        classes.setdefault(got.get(x, ("alone", x)), set()).add(x)
        want.setdefault(find(x), set()).add(x)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, want.values()))


def test_nulls_empty_tables_and_long_texts(spark, no_docs):
    assert simhash.simhash_components(no_docs).count() == 0
    pairs = [(None, None), (None, ""), (7, " \n"), (None, "alone here"), (3, "x " * 200000), (4, "x " * 200000), (None, "x x x x x")]
    df = spark.createDataFrame([(d, t, 1, "k") for d, t in pairs], "doc_id long, text string, fp int, key string")
    assert found(df) == brute_force(pairs)
    assert simhash.simhash(b"q w e " * 70000, step=1000) == simhash.simhash(b"q w e " * 70000)


def test_query(spark, sf, unique_docs):
    out = simhash.op13_simhash_golay(spark, sf)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == brute_force([(r.doc_id, r.text) for r in unique_docs.collect()])
